"""Customer value: scoring with given model parameters, segments, risk flags and the validation report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import (ALIVE_RISK_CUTOFF, BGNBD, FORECAST_DAYS, GAMMA_GAMMA, MIN_TENURE_DAYS,
                                      SILENCE_RISK_DAYS)
from ..functions.semantics import count_true
from ..functions.special import hyp2f1_series
from ..functions.text import plain
from .ordered import exact_quantiles

WEEKS_IN_HORIZON = FORECAST_DAYS / 7.0


def _weeks(c: str) -> Column:
    return F.col(c) / 7.0


def _dropout(x: Column, t: Column, T: Column, p: dict) -> Column:
    """a/(b+x-1) * ((alpha+T)/(alpha+t))^(r+x) for buyers with repeats."""
    return p["a"] / (p["b"] + x - 1) * F.pow((p["alpha"] + T) / (p["alpha"] + t), x + p["r"])


def prob_alive(p: dict = BGNBD) -> Column:
    x = F.col("frequency")
    return F.when(x == 0, F.lit(1.0)).otherwise(1.0 / (1.0 + _dropout(x, _weeks("recency"), _weeks("T"), p)))


def expected_purchases(weeks, p: dict = BGNBD) -> Column:
    """Expected purchases in the next ``weeks``; Euler-transformed series, whose terms shrink quickly."""
    x, t, T = F.col("frequency"), _weeks("recency"), _weeks("T")
    a = p["a"] if abs(p["a"] - 1.0) > 1e-6 else 1.0 + 1e-6
    s = F.lit(weeks).cast("double") if not isinstance(weeks, Column) else weeks
    z = s / (p["alpha"] + T + s)
    series = hyp2f1_series(a + p["b"] - 1 - p["r"], a - 1.0, x + (a + p["b"] - 1), z)
    grown = (x + (a + p["b"] - 1)) / (a - 1.0) * (1.0 - F.pow(1.0 - z, F.lit(a - 1.0)) * series)
    return grown / F.when(x > 0, 1.0 + _dropout(x, t, T, {**p, "a": a})).otherwise(F.lit(1.0))


def expected_spend(g: dict = GAMMA_GAMMA) -> Column:
    x, m = F.col("frequency"), F.col("monetary_value")
    w = g["p"] * x + g["q"] - 1
    return (g["q"] - 1) / w * (g["v"] * g["p"] / (g["q"] - 1)) + g["p"] * x / w * m


def shrinkage(x: Column, g: dict = GAMMA_GAMMA, convention: str = "reference") -> Column:
    """Weight of the population mean; 'published' uses q-1 where the reference uses q."""
    q = g["q"] if convention == "reference" else g["q"] - 1
    return q / (g["p"] * F.greatest(x, F.lit(1.0)) + q)


def implied_mean_spend(g: dict = GAMMA_GAMMA, convention: str = "reference") -> float:
    return g["p"] * g["v"] / (g["q"] if convention == "reference" else g["q"] - 1)


def purchase_rate(p: dict = BGNBD) -> tuple[float, float]:
    """Mean purchases per week and per horizon."""
    return p["r"] / p["alpha"], p["r"] / p["alpha"] * WEEKS_IN_HORIZON


def variation(shape: float) -> float:
    return shape ** -0.5


def score(summary: DataFrame, p: dict = BGNBD, g: dict = GAMMA_GAMMA) -> DataFrame:
    return (summary.withColumn("predicted_purchases", expected_purchases(WEEKS_IN_HORIZON, p))
            .withColumn("expected_avg_spend", expected_spend(g))
            .withColumn("cltv_90d", F.col("predicted_purchases") * F.col("expected_avg_spend"))
            .withColumn("prob_alive", prob_alive(p)).withColumn("days_silent", F.col("T") - F.col("recency")))


def at_risk() -> Column:
    x = F.col("frequency")
    return F.when(x == 0, F.lit(False)).otherwise(
        (F.col("prob_alive") < ALIVE_RISK_CUTOFF) | ((x > 0) & (F.col("days_silent") > SILENCE_RISK_DAYS)))


def risk_triggers(scored: DataFrame) -> DataFrame:
    low = F.col("prob_alive") < ALIVE_RISK_CUTOFF
    silent = (F.col("frequency") > 0) & (F.col("days_silent") > SILENCE_RISK_DAYS)
    return scored.agg(count_true(low).alias("low_alive"), count_true(silent).alias("long_silence"), count_true(at_risk()).alias("at_risk"))


def segment(scored: DataFrame) -> DataFrame:
    """Quartile labels over repeat buyers only; customers without repeats get their own label."""
    q = exact_quantiles(scored.filter(F.col("frequency") > 0), "cltv_90d", {"a": 0.25, "b": 0.5, "c": 0.75}).select(
        F.struct("a", "b", "c").alias("q")).scalar()
    v = F.col("cltv_90d")
    label = (F.when(F.col("frequency") <= 0, "New/Insufficient Data").when(v <= F.col("_q.a"), "Low Value")
             .when(v <= F.col("_q.b"), "Mid Value").when(v <= F.col("_q.c"), "High Value").otherwise("Champions"))
    return scored.withColumn("_q", q).withColumn("cltv_segment", label).drop("_q")


def segment_summary(segmented: DataFrame) -> DataFrame:
    """Mean, median, count, sum and revenue share per segment of repeat buyers."""
    v = segmented.filter(F.col("frequency") > 0)
    med = exact_quantiles(v, "cltv_90d", {"median_cltv": 0.5}, ["cltv_segment"])
    total = v.agg(F.sum("cltv_90d").alias("t")).scalar()
    return (v.groupBy("cltv_segment").agg(F.avg("cltv_90d").alias("mean_cltv"), F.count("*").alias("customers"), F.sum("cltv_90d").alias("total_cltv"))
            .withColumn("share_pct", F.col("total_cltv") * 100 / total).join(med, "cltv_segment"))


def cohort_labels(scored: DataFrame, col: str = "cltv_90d") -> DataFrame:
    """Percentile cohorts 10/20/30/40 by share of rows above; equal values share a cohort.

    Only three cut values are needed, so rows are compared with them and never ranked.
    """
    from .ordered import running_totals, value_counts, with_bucket

    counts = value_counts(scored, col).withColumn("_neg", -F.col(col))
    cum = running_totals(with_bucket(counts, "_neg"), [F.col("_neg")], {"cum": "n"}, totals={"_n": "n"}).withColumn("above", F.col("cum") - F.col("n"))
    lowest = lambda pct: F.min(F.when(F.col("above") * 100 < F.col("_n") * pct, F.col(col)))
    cuts = cum.agg(F.struct(lowest(10).alias("vip"), lowest(30).alias("high"), lowest(60).alias("mid")).alias("c")).scalar()
    v = F.col(col)
    return scored.withColumn("_c", cuts).withColumn("cohort", F.when(v >= F.col("_c.vip"), "VIP").when(v >= F.col("_c.high"), "High")
                                                    .when(v >= F.col("_c.mid"), "Medium").otherwise("Low")).drop("_c")


# --- validation report --------------------------------------------------------------------------------

def tier(v: Column) -> Column:
    return (F.when(v.isNull(), "Unscored").when(v >= 2000, "Platinum").when(v >= 1000, "Gold").when(v >= 500, "Silver").otherwise("Bronze"))


def rfm_grade() -> Column:
    x, share = F.col("frequency"), F.try_divide(F.col("recency"), F.col("T"))
    return (F.when(F.col("T") <= 0, "Insufficient Data").when((x >= 10) & (share >= 0.8), "Champion")
            .when((x >= 5) & (share >= 0.6), "Loyal").when(x >= 3, "Potential Loyalist").when(x == 1, "One-Time Buyer")
            .when(x == 0, "New/No Purchase").otherwise("At Risk"))


def history(scored: DataFrame) -> DataFrame:
    """Past purchase rate and the ratio of predicted to past purchases; no history gives a null ratio."""
    rate = F.when(F.col("T") > 0, F.col("frequency") / F.col("T") * 7).otherwise(F.lit(0.0))
    return (scored.withColumn("hist_rate_week", rate).withColumn("hist_90d", F.col("hist_rate_week") * WEEKS_IN_HORIZON)
            .withColumn("pred_ratio", F.when(F.col("hist_90d") > 0, F.col("predicted_purchases") / F.col("hist_90d"))))


def confidence() -> Column:
    return (F.when(F.col("T") < MIN_TENURE_DAYS, "LOW_TENURE").when(F.col("frequency") <= 1, "LOW_FREQ")
            .when(F.col("pred_ratio") > 2.0, "OVER_OPTIMISTIC").otherwise("OK"))


def verdict() -> Column:
    short, none = F.col("T") < MIN_TENURE_DAYS, F.col("pred_ratio").isNull()
    return (F.when(short & (none | (F.col("pred_ratio") > 3.0)), "SUSPICIOUS")
            .when(short | none | (F.col("pred_ratio") > 2.0), "WATCH").otherwise("REALISTIC"))


def validation_report(scored: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Tier, grade, confidence and verdict per customer; customers without repeats are always on watch."""
    h, zero = history(scored), F.col("frequency") == 0
    out = (h.withColumn("tier", F.when(zero, "Unscored").otherwise(tier(F.col("cltv_90d")))).withColumn("rfm_grade", rfm_grade())
           .withColumn("confidence_flag", F.when(zero, "LOW_FREQ").otherwise(confidence()))
           .withColumn("verdict", F.when(zero, "WATCH").otherwise(verdict())).withColumn("at_risk", at_risk()))
    if overrides is not None:  # (customer_id, verdict)
        o = overrides.select("customer_id", F.col("verdict").alias("_v"))
        out = out.join(o, "customer_id", "left").withColumn("verdict", F.coalesce("_v", "verdict")).drop("_v")
    return out.select("customer_id", "tier", "rfm_grade", F.col("predicted_purchases").alias("predicted_purchases_90d"),
                      "expected_avg_spend", "cltv_90d", "confidence_flag", "at_risk", "verdict")


def tier_summary(report: DataFrame) -> DataFrame:
    n = report.agg(F.count("*").alias("n")).scalar()
    return report.groupBy("tier").agg(F.count("*").alias("customers"), (F.count("*") * 100.0 / n).cast("double").alias("pct"),
                                      F.avg("cltv_90d").alias("mean_cltv"), count_true(F.col("at_risk")).alias("at_risk"))


def verdict_summary(report: DataFrame) -> DataFrame:
    n = report.agg(F.count("*").alias("n")).scalar()
    return report.groupBy("verdict").agg(F.count("*").alias("customers"), (F.count("*") * 100.0 / n).cast("double").alias("pct"))


def tier_shares(scored: DataFrame) -> DataFrame:
    """Share of value and share of customers per tier, repeat buyers only."""
    v = scored.filter(F.col("frequency") > 0).withColumn("tier", tier(F.col("cltv_90d")))
    t = v.agg(F.struct(F.sum("cltv_90d").alias("s"), F.count("*").alias("n")).alias("t")).scalar()
    return v.groupBy("tier").agg(F.sum("cltv_90d").alias("s"), F.count("*").alias("n")).withColumn("_t", t).select(
        "tier", (F.col("s") * 100 / F.col("_t.s")).alias("revenue_pct"), (F.col("n") * 100.0 / F.col("_t.n")).cast("double").alias("customer_pct"))


def lookup_ids(wanted: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Rows of the wanted (pos, customer_id) in list order; ids missing in the first source come from the second.

    Columns only the first source has are zero for the back-filled rows.
    """
    found = primary.join(wanted, "customer_id")
    missing = wanted.join(primary.select("customer_id"), "customer_id", "left_anti")
    extra = fallback.join(missing, "customer_id")
    filled = found.unionByName(extra, allowMissingColumns=True)
    gaps = [c for c in primary.columns if c not in fallback.columns]
    return filled.na.fill(0, subset=gaps) if gaps else filled


def spot_check(rows: DataFrame) -> DataFrame:
    """Flags and verdict for a short list of customers."""
    h = history(rows)
    short, ratio = F.col("T") < MIN_TENURE_DAYS, F.col("pred_ratio")
    flags = F.array_compact(F.array(
        F.when(short, F.concat(F.lit("SHORT_TENURE (T="), plain("T", 0), F.lit(f"d < {MIN_TENURE_DAYS}d threshold)"))),
        F.when(ratio > 2.0, F.concat(F.lit("OVER_OPTIMISTIC (predicted "), plain(ratio, 1), F.lit("x historical rate)"))),
        F.when(F.col("hist_90d") == 0, F.lit("INF_RATIO (no repeat purchase history to compare against)"))))
    label = (F.when(short & (ratio.isNull() | (ratio > 3.0)), "SUSPICIOUS").when((ratio > 2.0) | short, "WATCH").otherwise("REALISTIC"))
    return h.select("pos", "customer_id", "hist_rate_week", "hist_90d", "pred_ratio", shrinkage(F.col("frequency")).alias("population_weight"),
                    F.when(F.size(flags) == 0, F.lit("none")).otherwise(F.concat_ws(" | ", flags)).alias("flags"), label.alias("verdict"))


def discounted_value(summary: DataFrame, p: dict, g: dict, months: int = 12, rate: float = 0.01, weeks_per_month: float = 4.345) -> DataFrame:
    """Discounted value over several months: increments of expected purchases times expected spend."""
    total, before = F.lit(0.0), F.lit(0.0)
    for i in range(1, months + 1):
        until = F.col(f"_e{i}")
        total = total + (until - before) / (1 + rate) ** i
        before = until
    steps = summary.withColumns({f"_e{i}": expected_purchases(i * weeks_per_month, p) for i in range(1, months + 1)})
    return steps.select("customer_id", (total * expected_spend(g)).alias("clv"))


# --- population checks --------------------------------------------------------------------------------

def value_benchmark(scored: DataFrame, typical: float = 125.0) -> DataFrame:
    rep = scored.filter(F.col("frequency") > 0)
    q = exact_quantiles(rep, "cltv_90d", {"m": 0.5}).scalar()
    qp = exact_quantiles(scored, "predicted_purchases", {"m": 0.5}).scalar()
    a = rep.agg(F.avg("cltv_90d").alias("mean_cltv"), F.sum("cltv_90d").alias("total_cltv"))
    return a.select("mean_cltv", q.alias("median_cltv"), "total_cltv", (F.col("mean_cltv") / typical).alias("times_typical"),
                    F.when(F.col("mean_cltv") > 300, "wholesale").otherwise("normal range").alias("diagnosis"), qp.alias("median_predicted"))


def shrinkage_check(scored: DataFrame, g: dict = GAMMA_GAMMA) -> DataFrame:
    """Observed pull of predicted spend toward the population mean against the theoretical weight."""
    rep, x = scored.filter(F.col("frequency") > 0), F.col("frequency")
    mean = lambda cond, c: F.avg(F.when(cond, F.col(c)))
    one, ten = x == 1, x >= 10
    a = rep.agg(F.avg("monetary_value").alias("pop"), mean(one, "monetary_value").alias("o1"), mean(one, "expected_avg_spend").alias("p1"),
                mean(ten, "monetary_value").alias("o10"), mean(ten, "expected_avg_spend").alias("p10"))
    def row(name, o, p, theory, tol):
        gap = F.abs(F.col(o) - F.col("pop"))
        s = F.when(gap > 0, 1.0 - F.abs(F.col(p) - F.col("pop")) / gap).otherwise(F.lit(0.0))
        return F.struct(F.lit(name).alias("cohort"), F.col(o).alias("observed"), F.col(p).alias("predicted"), s.alias("shrinkage"),
                        F.lit(theory).alias("theory"), F.when(F.abs(s - theory) < tol, "MATCH").otherwise("MISMATCH").alias("result"))
    w = lambda k: g["q"] / (g["p"] * k + g["q"])
    return a.select(F.inline(F.array(row("freq=1", "o1", "p1", w(1), 0.15), row("freq>=10", "o10", "p10", w(10), 0.20))))


def implied_gap(summary: DataFrame, g: dict = GAMMA_GAMMA, convention: str = "reference") -> DataFrame:
    implied = implied_mean_spend(g, convention)
    gap = F.abs(F.lit(implied) - F.avg("monetary_value")) / F.avg("monetary_value") * 100
    return summary.agg(F.lit(implied).alias("implied_mean"), F.avg("monetary_value").alias("observed_mean"), gap.alias("gap_pct"),
                       F.when(gap < 15, "ACCEPTABLE").otherwise("WARNING").alias("status"))


def correlation(summary: DataFrame, a: str = "frequency", b: str = "monetary_value", limit: float = 0.2) -> DataFrame:
    c = F.corr(a, b)
    return summary.agg(c.alias("correlation"), (F.abs(c) < limit).alias("weak"))
