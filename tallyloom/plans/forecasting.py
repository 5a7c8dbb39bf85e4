"""Registered daily-series queries with their SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC, series as S
from ..session import materialize
from . import views as V
from .registry import Registry, r, rounded

START, SHUTDOWN, SPLIT, END = "1995-03-01", "2001-06-20", "2001-01-01", "2001-06-10"
Z = 1.2815515655446004


def _baseline_sql(train, frame):
    t = "(ds - DATE '1970-01-01')"
    return f"""SELECT series_id, ds, greatest(yhat,0) AS yhat, greatest(yhat-{Z}::DOUBLE*sd,0) AS yhat_lower, greatest(yhat+{Z}::DOUBLE*sd,0) AS yhat_upper FROM (
      WITH fit AS (SELECT series_id, regr_slope(y, {t}::DOUBLE) AS slope, regr_intercept(y, {t}::DOUBLE) AS icept FROM {train} GROUP BY series_id),
      res AS (SELECT series_id, dayofweek(ds) AS dow, y-(icept+slope*{t}) AS e FROM {train} JOIN fit USING (series_id)),
      wk AS (SELECT series_id, dow, avg(e) AS effect FROM res GROUP BY ALL),
      sp AS (SELECT series_id, sqrt(sum((e-effect)*(e-effect))/(count(*)-1)) AS sd FROM res JOIN wk USING (series_id, dow) GROUP BY series_id)
      SELECT f.series_id, f.ds, icept+slope*{t.replace('ds', 'f.ds')}+coalesce(effect,0) AS yhat, sd FROM {frame} f JOIN fit USING (series_id)
      LEFT JOIN wk ON wk.series_id=f.series_id AND wk.dow=dayofweek(f.ds) JOIN sp ON sp.series_id=f.series_id) b"""


EXTRA = {
    "w_trim": "SELECT series_id, ds, y FROM (SELECT *, max(CASE WHEN y>1000 THEN ds END) OVER (PARTITION BY series_id) AS m FROM v_daily) x WHERE ds<=m",
    "w_start": f"SELECT * FROM w_trim WHERE ds >= DATE '{START}'",
    "w_cap": "SELECT series_id, ds, least(y, quantile_cont(y,0.99) OVER (PARTITION BY series_id)) AS y FROM w_start",
    "w_clean": f"SELECT * FROM w_cap WHERE ds < DATE '{SHUTDOWN}'",
    "w_label": f"SELECT *, CASE WHEN ds < DATE '{SPLIT}' THEN 'train' ELSE 'test' END AS split FROM w_clean WHERE ds <= DATE '{END}'",
    "w_train": "SELECT * FROM w_label WHERE split='train'",
    "w_test": "SELECT * FROM w_label WHERE split='test'",
    "w_future": "SELECT series_id, unnest(generate_series(max(ds)+1, max(ds)+90, INTERVAL 1 DAY))::DATE AS ds FROM w_clean GROUP BY series_id",
    "w_fc_test": _baseline_sql("w_train", "w_test"),
    "w_fc": _baseline_sql("w_clean", "w_future"),
    "w_err": """SELECT t.series_id, t.ds, y, yhat, yhat_lower, yhat_upper, abs(y-yhat) AS abs_error, abs(y-yhat)/nullif(y,0)*100 AS pct_error, yhat-y AS bias,
        coalesce(abs(y-yhat)/nullif(y,0)*100>40,false) AS large FROM w_test t JOIN w_fc_test USING (series_id, ds)""",
    "w_edge": """SELECT h.series_id, last_actual, last_ds, first_forecast, first_ds, abs(first_forecast-last_actual)/greatest(last_actual,1)*100 AS jump_pct
        FROM (SELECT series_id, arg_max(y,ds) AS last_actual, max(ds) AS last_ds FROM w_clean GROUP BY series_id) h
        JOIN (SELECT series_id, arg_min(yhat,ds) AS first_forecast, min(ds) AS first_ds FROM w_fc GROUP BY series_id) f USING (series_id)""",
    "w_step": "SELECT *, ds - lag(ds) OVER (PARTITION BY series_id ORDER BY ds) AS step FROM w_fc",
    "w_rows": "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS i FROM (SELECT series_id, ds, nullif(y,0) AS y FROM v_daily) z",
    "w_known": """SELECT *, last_value(y IGNORE NULLS) OVER b AS y0, last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i0,
        first_value(y IGNORE NULLS) OVER a AS y1, first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i1 FROM w_rows
        WINDOW b AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               a AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
}
reg = Registry(EXTRA)
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


def clean(s, d):
    return S.remediate(V.daily(s, d), START, SHUTDOWN)


def clean_table(s, d):
    """The remediated days written once: fits, forecasts and checks all read them, the orders are read once."""
    return materialize(clean(s, d), "daily")


def labelled(s, d):
    return S.split_label(clean_table(s, d), SPLIT, END)


def train_test(s, d):
    x = labelled(s, d)
    return x.filter("split = 'train'").drop("split"), x.filter("split = 'test'").drop("split")


def test_forecast(s, d):
    train, test = train_test(s, d)
    return test, S.baseline(train, test.select("series_id", "ds"))


def future(s, d):
    h = clean_table(s, d)
    return h, S.baseline(h, S.future_frame(h))


@query("p04_tail_trim", "SELECT * FROM w_trim")
def _(s, d):
    return S.trim_tail(V.daily(s, d))


@query("p05_date_range", f"SELECT * FROM v_daily WHERE ds >= DATE '{START}' AND ds < DATE '{SHUTDOWN}'")
def _(s, d):
    return S.date_range(V.daily(s, d), START, SHUTDOWN)


@query("p06_quantile_cap", f"SELECT {rounded('series_id ds y:4')} FROM w_cap")
def _(s, d):
    return r(S.cap_quantile(S.date_range(S.trim_tail(V.daily(s, d)), START)), y=4)


@query("t10_remediation", f"SELECT {rounded('series_id ds y:4')} FROM w_clean")
def _(s, d):
    return r(clean(s, d), y=4)


@query("p07_floor_zero", "SELECT series_id, ds, greatest(round(y-100000,4),0) AS y FROM v_daily")
def _(s, d):
    return r(S.floor_zero(V.daily(s, d).withColumn("y", F.col("y") - 100000), ["y"]), y=4)


@query("p08_temporal_split", "SELECT series_id, split, count(*) AS n, min(ds) AS first_ds, max(ds) AS last_ds FROM w_label GROUP BY ALL")
def _(s, d):
    return S.split_label(clean(s, d), SPLIT, END).groupBy("series_id", "split").agg(F.count("*").alias("n"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))


@query("p20_future_frame", "SELECT * FROM w_future")
def _(s, d):
    return S.future_frame(clean(s, d))


@query("w06_moving_average", """SELECT series_id, ds, round(y,4) AS y, round(avg(y) OVER (PARTITION BY series_id ORDER BY ds RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)+3.3e-7,4) AS ma_calendar,
    round(avg(y) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)+3.3e-7,4) AS ma_rows FROM v_daily""")
def _(s, d):
    return r(S.moving_average(V.daily(s, d)), nudge=["ma_calendar", "ma_rows"], y=4, ma_calendar=4, ma_rows=4)


@query("w08_gaps", "SELECT series_id, ds, p AS prev_ds, (ds-p-1)::INT AS gap_days FROM (SELECT *, lag(ds) OVER (PARTITION BY series_id ORDER BY ds) AS p FROM v_daily) x WHERE ds-p>1")
def _(s, d):
    return S.gaps(V.daily(s, d))


@query("w09_interpolation", "SELECT series_id, ds, round(coalesce(y, y0+(y1-y0)*(i-i0)/(i1-i0), y0, y1)+3.3e-7,4) AS y FROM w_known")
def _(s, d):
    return r(S.interpolate(S.zeros_to_null(V.daily(s, d))), nudge=["y"], y=4)


@query("t02_baseline_forecast", f"SELECT {rounded('series_id ds yhat:2 yhat_lower:2 yhat_upper:2')} FROM w_fc")
def _(s, d):
    return r(future(s, d)[1], yhat=2, yhat_lower=2, yhat_upper=2)


@query("j07_actual_vs_forecast", f"SELECT {rounded('series_id ds y:2 yhat:2 yhat_lower:2 yhat_upper:2')} FROM w_err")
def _(s, d):
    e = S.errors(*test_forecast(s, d))
    return r(e.select("series_id", "ds", "y", "yhat", "yhat_lower", "yhat_upper"), y=2, yhat=2, yhat_lower=2, yhat_upper=2)


@query("f22_error_columns", f"SELECT {rounded('series_id ds abs_error:2 pct_error:6 bias:2 large')} FROM w_err")
def _(s, d):
    return r(S.errors(*test_forecast(s, d)).select("series_id", "ds", "abs_error", "pct_error", "bias", "large"), abs_error=2, pct_error=6, bias=2)


_agg = """SELECT series_id, count(*) AS matched, avg(y) AS mean_actual, avg(abs_error) AS mae, avg(bias) AS bias, avg(abs_error)/avg(y)*100 AS mae_pct_of_mean,
    avg(CASE WHEN y>=yhat_lower AND y<=yhat_upper THEN 1.0::DOUBLE ELSE 0 END)*100 AS in_bounds_pct, avg(abs_error)/avg(y)*100<=15 AS safe,
    avg(abs_error/nullif(y,0))*100 AS mape_pct, sum(abs_error)/sum(y)*100 AS wape_pct FROM w_err GROUP BY series_id"""


@query("t06_test_evaluation", f"SELECT {rounded('series_id matched mean_actual:3 mae:3 bias:3 mae_pct_of_mean:6 in_bounds_pct:6 safe')} FROM ({_agg}) a")
def _(s, d):
    e = S.evaluate(*test_forecast(s, d)).drop("mape_pct", "wape_pct")
    return r(e, mean_actual=3, mae=3, bias=3, mae_pct_of_mean=6, in_bounds_pct=6)


@query("t07_mape_wape", f"SELECT {rounded('series_id mape_pct:6 wape_pct:6')} FROM ({_agg}) a")
def _(s, d):
    return r(S.evaluate(*test_forecast(s, d)).select("series_id", "mape_pct", "wape_pct"), mape_pct=6, wape_pct=6)


@query("a30_forecast_totals", "SELECT series_id, round(sum(yhat),2) AS total, round(min(yhat),2) AS min, round(max(yhat),2) AS max, round(avg(yhat),2) AS mean, count(*) AS days FROM w_fc GROUP BY series_id")
def _(s, d):
    return r(S.forecast_totals(future(s, d)[1]), total=2, min=2, max=2, mean=2)


@query("a32_in_sample_mae", f"SELECT series_id, round(avg(abs(y-yhat)),3) AS mae, count(*) AS n FROM w_train JOIN ({_baseline_sql('w_train', 'w_train')}) f USING (series_id, ds) GROUP BY series_id")
def _(s, d):
    train, _ = train_test(s, d)
    e = S.errors(train, S.baseline(train, train.select("series_id", "ds")))
    return e.groupBy("series_id").agg(F.round(F.avg("abs_error"), 3).alias("mae"), F.count("*").alias("n"))


@query("w10_boundary_jump", f"SELECT {rounded('series_id last_actual:2 last_ds first_forecast:2 first_ds jump_pct:4')}, jump_pct<60 AS smooth FROM w_edge")
def _(s, d):
    return r(S.boundary_jump(*future(s, d)), last_actual=2, first_forecast=2, jump_pct=4)


def _audit_sql():
    base = {"date_format": "count(*) FILTER (NOT regexp_matches(ds::VARCHAR,'^\\d{4}-\\d{2}-\\d{2}$'))", "yhat_in_bounds": "count(*) FILTER (NOT (yhat>=yhat_lower AND yhat<=yhat_upper))",
            "row_count": "abs(count(*)-90)", "no_nulls": "count(*) FILTER (ds IS NULL OR yhat IS NULL OR yhat_lower IS NULL OR yhat_upper IS NULL)",
            "yhat_non_negative": "count(*) FILTER (yhat<0)", "lower_non_negative": "count(*) FILTER (yhat_lower<0)",
            "values_vary": "CASE WHEN count(DISTINCT yhat)>1 THEN 0 ELSE 1 END", "required_columns": "0", "contiguous_dates": "count(*) FILTER (step<>1)"}
    parts = [f"SELECT series_id, '{k}' AS check, {v}=0 AS passed, ({v})::BIGINT AS violations FROM w_step GROUP BY series_id" for k, v in base.items()]
    parts += ["SELECT series_id, 'starts_next_day', first_ds-last_ds=1, (CASE WHEN first_ds-last_ds=1 THEN 0 ELSE 1 END)::BIGINT FROM w_edge",
              "SELECT series_id, 'smooth_transition', jump_pct<60, (CASE WHEN jump_pct<60 THEN 0 ELSE 1 END)::BIGINT FROM w_edge"]
    return " UNION ALL ".join(parts)


@query("t09_forecast_audit", _audit_sql())
def _(s, d):
    h, fc = future(s, d)
    return S.audit(h, materialize(fc, "forecast"))


@query("q07_series_checks", """SELECT series_id, count(*) AS rows, min(ds) AS first_ds, max(ds) AS last_ds, count(*) FILTER (y IS NULL) AS nulls, count(*)-count(DISTINCT ds) AS duplicate_days,
    count(*) FILTER (y=0) AS zeros, coalesce(var_samp(y),0)>0 AS varies FROM v_daily GROUP BY series_id""")
def _(s, d):
    return S.series_checks(V.daily(s, d))


# --- fitted forecasts: no SQL form ---

def holidays(s, d):
    """Year-end days of the observed years plus two, as a user's holiday table would list them."""
    years = V.daily(s, d).agg(F.min(F.year("ds")).alias("a"), F.max(F.year("ds")).alias("b"))
    y = years.select(F.explode(F.sequence("a", F.col("b") + 2)).alias("y"))
    return y.select(F.inline(F.array(F.struct(F.make_date("y", F.lit(12), F.lit(25)).alias("ds"), F.lit("christmas").alias("holiday")),
                                     F.struct(F.make_date("y", F.lit(1), F.lit(1)).alias("ds"), F.lit("new_year").alias("holiday")))))


@query("t01_forecaster_test")
def _(s, d):
    x = labelled(s, d)
    return r(S.evaluate(x.filter("split = 'test'").drop("split"), FC.predict_test(x)), mae=3, mae_pct_of_mean=4)


@query("t03_logistic_growth")
def _(s, d):
    return r(FC.forecast(clean_table(s, d), settings=FC.Settings(logistic=True)), yhat=2, yhat_lower=2, yhat_upper=2)


@query("t04_holiday_regressors")
def _(s, d):
    return r(FC.forecast(clean_table(s, d), holidays=holidays(s, d)), yhat=2, yhat_lower=2, yhat_upper=2)


@query("t05_flexibility_search")
def _(s, d):
    return r(FC.best_setting(FC.tune(labelled(s, d))), mae=3, mae_pct=4)


def chosen_forecast(s, d):
    """90 days ahead, each series with the flexibility that the search chose."""
    return FC.forecast(clean_table(s, d), scales=FC.best_setting(FC.tune(labelled(s, d))))


@query("t08_forecast_90_days")
def _(s, d):
    return r(chosen_forecast(s, d), yhat=2, yhat_lower=2, yhat_upper=2)


@query("t09_fitted_forecast_audit")
def _(s, d):
    return S.audit(clean_table(s, d), materialize(chosen_forecast(s, d), "forecast"))


@query("t01_band_coverage")
def _(s, d):
    """Share of held-out days inside the band, and its mean width in the first and in the last month of them."""
    x = labelled(s, d)
    fc = FC.predict_test(x).join(x.filter("split = 'test'").select("series_id", "ds", "y"), ["series_id", "ds"])
    edge = fc.groupBy("series_id").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    width = F.col("yhat_upper") - F.col("yhat_lower")
    out = fc.join(edge, "series_id").groupBy("series_id").agg((F.avg(F.when(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")), 1.0).otherwise(0.0)) * 100).alias("covered_pct"),
                                                           F.avg(F.when(F.col("ds") < F.date_add("a", 30), width)).alias("first_width"), F.avg(F.when(F.col("ds") > F.date_sub("b", 30), width)).alias("last_width"))
    return r(out, covered_pct=2, first_width=2, last_width=2)
