"""Daily series: remediation, splits, gaps, interpolation, moving averages, baseline forecast and audit.

All functions take (series_id, ds, y). A series has one row per calendar day at most, so windows per
series stay small however many transactions the days were summed from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.semantics import count_true, ratio

ORIGIN = "1970-01-01"


def per_series():
    return W.partitionBy("series_id")


def day_number(ds="ds") -> Column:
    return F.date_diff(ds, F.lit(ORIGIN).cast("date"))


def trim_tail(daily: DataFrame, meaningful: float = 1000.0) -> DataFrame:
    """Keep a series up to its last day above the level."""
    last = F.max(F.when(F.col("y") > meaningful, F.col("ds"))).over(per_series())
    return daily.withColumn("_last", last).filter(F.col("ds") <= F.col("_last")).drop("_last")


def date_range(daily: DataFrame, start: str | None = None, before: str | None = None) -> DataFrame:
    if start:
        daily = daily.filter(F.col("ds") >= F.lit(start).cast("date"))
    if before:
        daily = daily.filter(F.col("ds") < F.lit(before).cast("date"))
    return daily


def cap_quantile(daily: DataFrame, p: float = 0.99) -> DataFrame:
    return daily.withColumn("y", F.least("y", F.percentile("y", p).over(per_series())))


def remediate(daily: DataFrame, start: str, shutdown: str, meaningful: float = 1000.0, cap: float = 0.99) -> DataFrame:
    """The four fixes in order: tail trim, start anchor, cap, shutdown tail. The cap sees the tail that is cut last."""
    return date_range(cap_quantile(date_range(trim_tail(daily, meaningful), start=start), cap), before=shutdown)


def floor_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.greatest(F.col(c), F.lit(0.0)) for c in columns})


def split_label(daily: DataFrame, split: str, end: str | None = None) -> DataFrame:
    """train before the split date, test from there to the end date, rows after the end dropped."""
    ds = F.col("ds")
    lab = F.when(ds < F.lit(split).cast("date"), "train").when(F.lit(True) if end is None else ds <= F.lit(end).cast("date"), "test")
    return daily.withColumn("split", lab).filter(F.col("split").isNotNull())


def future_frame(daily: DataFrame, horizon: int = 90) -> DataFrame:
    last = daily.groupBy("series_id").agg(F.max("ds").alias("m"))
    return last.select("series_id", F.explode(F.sequence(F.date_add("m", 1), F.date_add("m", horizon))).alias("ds"))


def zeros_to_null(daily: DataFrame) -> DataFrame:
    return daily.withColumn("y", F.when(F.col("y") != 0, F.col("y")))


def interpolate(daily: DataFrame) -> DataFrame:
    """Fill nulls linearly by row position; trailing nulls repeat the last value, leading ones take the first."""
    rows = daily.withColumn("_i", F.row_number().over(per_series().orderBy("ds")))
    at = F.when(F.col("y").isNotNull(), F.col("_i"))
    back = per_series().orderBy("ds").rowsBetween(W.unboundedPreceding, 0)
    ahead = per_series().orderBy("ds").rowsBetween(0, W.unboundedFollowing)
    known = rows.select("*", F.last("y", True).over(back).alias("_y0"), F.last(at, True).over(back).alias("_i0"),
                        F.first("y", True).over(ahead).alias("_y1"), F.first(at, True).over(ahead).alias("_i1"))
    inner = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * (F.col("_i") - F.col("_i0")) / (F.col("_i1") - F.col("_i0"))
    return known.withColumn("y", F.coalesce("y", inner, "_y0", "_y1")).drop("_i", "_y0", "_i0", "_y1", "_i1")


def moving_average(daily: DataFrame, days: int = 30) -> DataFrame:
    """Trailing average over calendar days and over rows."""
    w = per_series().orderBy("_d").rangeBetween(-(days - 1), 0)
    return daily.withColumn("_d", day_number()).select("series_id", "ds", "y", F.avg("y").over(w).alias("ma_calendar"),
                                                       F.avg("y").over(per_series().orderBy("_d").rowsBetween(-(days - 1), 0)).alias("ma_rows"))


def gaps(daily: DataFrame) -> DataFrame:
    """Days after which at least one calendar day is missing."""
    prev = F.lag("ds").over(per_series().orderBy("ds"))
    return daily.select("series_id", "ds", prev.alias("prev_ds")).withColumn("gap_days", F.date_diff("ds", "prev_ds") - 1).filter(F.col("gap_days") > 0)


def baseline(train: DataFrame, horizon: DataFrame, z: float = 1.2815515655446004) -> DataFrame:
    """Linear trend plus weekday effect, with a normal 80 percent band; plain aggregations only."""
    t = day_number().cast("double")
    fit = train.groupBy("series_id").agg(F.regr_slope("y", t).alias("slope"), F.regr_intercept("y", t).alias("icept"))
    trend = F.col("icept") + F.col("slope") * t
    resid = train.join(fit, "series_id").select("series_id", F.dayofweek("ds").alias("dow"), (F.col("y") - trend).alias("e"))
    week = resid.groupBy("series_id", "dow").agg(F.avg("e").alias("effect"), F.count("*").alias("n"), F.sum(F.col("e") * F.col("e")).alias("ss"))
    # the residual spread follows from the weekday sums, so the history is read once for both
    spread = week.groupBy("series_id").agg(
        F.sqrt(F.sum(F.col("ss") - F.col("n") * F.col("effect") * F.col("effect")) / (F.sum("n") - 1)).alias("sd"))
    out = (horizon.join(fit, "series_id").withColumn("dow", F.dayofweek("ds")).join(week.select("series_id", "dow", "effect"), ["series_id", "dow"], "left")
           .join(spread, "series_id").withColumn("yhat", trend + F.coalesce("effect", F.lit(0.0))))
    return floor_zero(out.select("series_id", "ds", "yhat", (F.col("yhat") - z * F.col("sd")).alias("yhat_lower"),
                                 (F.col("yhat") + z * F.col("sd")).alias("yhat_upper")), ["yhat", "yhat_lower", "yhat_upper"])


def errors(actual: DataFrame, forecast: DataFrame, flag_pct: float = 40.0) -> DataFrame:
    """Actual joined with forecast: absolute and percentage error, bias and the large-error flag."""
    e = F.abs(F.col("y") - F.col("yhat"))
    return (actual.select("series_id", "ds", "y").join(forecast, ["series_id", "ds"]).withColumn("abs_error", e)
            .withColumn("pct_error", ratio(e, "y") * 100).withColumn("bias", F.col("yhat") - F.col("y"))
            .withColumn("large", F.coalesce(F.col("pct_error") > flag_pct, F.lit(False))))


def evaluate(actual: DataFrame, forecast: DataFrame, safe_pct: float = 15.0) -> DataFrame:
    """MAE, MAE as share of the mean actual, bias, share inside the band, safe gate, MAPE and WAPE per series."""
    inside = (F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))
    a = errors(actual, forecast).groupBy("series_id").agg(
        F.count("*").alias("matched"), F.avg("y").alias("mean_actual"), F.avg("abs_error").alias("mae"), F.avg("bias").alias("bias"),
        (F.avg(F.when(inside, 1.0).otherwise(0.0).cast("double")) * 100).alias("in_bounds_pct"),
        (F.avg(ratio("abs_error", "y")) * 100).alias("mape_pct"), (ratio(F.sum("abs_error"), F.sum("y")) * 100).alias("wape_pct"))
    share = ratio("mae", "mean_actual") * 100
    return a.withColumn("mae_pct_of_mean", share).withColumn("safe", share <= safe_pct)


def forecast_totals(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("series_id").agg(F.sum("yhat").alias("total"), F.min("yhat").alias("min"), F.max("yhat").alias("max"),
                                             F.avg("yhat").alias("mean"), F.count("*").alias("days"))


def boundary_jump(history: DataFrame, forecast: DataFrame, limit: float = 60.0) -> DataFrame:
    """Relative jump from the last actual to the first forecast."""
    h = history.groupBy("series_id").agg(F.max_by("y", "ds").alias("last_actual"), F.max("ds").alias("last_ds"))
    f = forecast.groupBy("series_id").agg(F.min_by("yhat", "ds").alias("first_forecast"), F.min("ds").alias("first_ds"))
    jump = F.abs(F.col("first_forecast") - F.col("last_actual")) / F.greatest(F.col("last_actual"), F.lit(1.0)) * 100
    return h.join(f, "series_id").withColumn("jump_pct", jump).withColumn("smooth", jump < limit)


AUDIT = ("date_format", "yhat_in_bounds", "starts_next_day", "row_count", "no_nulls", "yhat_non_negative", "lower_non_negative",
         "values_vary", "required_columns", "contiguous_dates", "smooth_transition")


def audit(history: DataFrame, forecast: DataFrame, horizon: int = 90) -> DataFrame:
    """Eleven checks per series in long form (series_id, check, passed, violations)."""
    need = ["ds", "yhat", "yhat_lower", "yhat_upper"]
    missing = len([c for c in need if c not in forecast.columns])
    step = F.date_diff("ds", F.lag("ds").over(per_series().orderBy("ds")))
    a = forecast.withColumn("_step", step).groupBy("series_id").agg(
        count_true(~F.date_format("ds", "yyyy-MM-dd").rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("date_format"),
        count_true(~((F.col("yhat") >= F.col("yhat_lower")) & (F.col("yhat") <= F.col("yhat_upper")))).alias("yhat_in_bounds"),
        F.abs(F.count("*") - horizon).alias("row_count"), count_true(F.expr(" OR ".join(f"{c} IS NULL" for c in need))).alias("no_nulls"),
        count_true(F.col("yhat") < 0).alias("yhat_non_negative"), count_true(F.col("yhat_lower") < 0).alias("lower_non_negative"),
        F.when(F.count_distinct("yhat") > 1, 0).otherwise(1).alias("values_vary"), F.lit(missing).alias("required_columns"),
        count_true(F.col("_step") != 1).alias("contiguous_dates"))
    j = boundary_jump(history, forecast).select(
        "series_id", F.when(F.date_diff("first_ds", "last_ds") == 1, 0).otherwise(1).alias("starts_next_day"),
        F.when(F.col("smooth"), 0).otherwise(1).alias("smooth_transition"))
    return a.join(j, "series_id").select("series_id", F.inline(F.array(*[F.struct(
        F.lit(c).alias("check"), (F.col(c) == 0).alias("passed"), F.col(c).cast("bigint").alias("violations")) for c in AUDIT])))


def series_checks(daily: DataFrame) -> DataFrame:
    """Row count, date range, nulls, duplicates, zeros and variance per series."""
    return daily.groupBy("series_id").agg(
        F.count("*").alias("rows"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), count_true(F.col("y").isNull()).alias("nulls"),
        (F.count("*") - F.count_distinct("ds")).alias("duplicate_days"), count_true(F.col("y") == 0).alias("zeros"),
        (F.coalesce(F.var_samp("y"), F.lit(0.0)) > 0).alias("varies"))
