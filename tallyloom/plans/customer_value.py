"""Registered customer-value queries with their SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed_values import BGNBD, GAMMA_GAMMA
from ..functions.special import gamma_quantile
from ..operators import cleaning as C, clv, quality as Q, rfm
from ..operators.ordered import top_share
from . import views as V
from .registry import Registry, r, rounded

# a purchase model with real drop-out, used wherever the published near-zero drop-out would hide branches
MODEL = {"r": 0.243, "alpha": 4.414, "a": 0.793, "b": 2.426}
SPEND = {**GAMMA_GAMMA, "v": 25000.0}
WEEKS = 90 / 7.0


def _series(src: str, p: dict, weeks: float) -> dict[str, str]:
    """Expected purchases by the transformed series as a recursive query."""
    r_, al, a, b = (repr(float(p[k])) for k in ("r", "alpha", "a", "b"))
    drop = f"({a}/({b}+frequency-1))*pow(({al}+T/7.0::DOUBLE)/({al}+recency/7.0::DOUBLE), frequency+{r_})"
    z = f"({weeks!r}::DOUBLE/({al}+T/7.0::DOUBLE+{weeks!r}))"
    return {
        "w_series": f"""/*RECURSIVE*/SELECT customer_id, 0 AS k, 1.0::DOUBLE AS term, 1.0::DOUBLE AS total, {a}+{b}-1-{r_} AS ha, {a}-1.0 AS hb,
            frequency+({a}+{b}-1) AS hc, {z} AS z FROM {src}
          UNION ALL SELECT customer_id, k+1, term*(ha+k)*(hb+k)/((hc+k)*(k+1))*z, total+term*(ha+k)*(hb+k)/((hc+k)*(k+1))*z, ha, hb, hc, z
          FROM w_series WHERE k<150""",
        "w_predicted": f"""SELECT c.*, (frequency+({a}+{b}-1))/({a}-1.0)*(1-pow(1-s.z, {a}-1.0)*s.total)
              / CASE WHEN frequency>0 THEN 1+{drop} ELSE 1 END AS predicted_purchases,
            CASE WHEN frequency=0 THEN 1.0::DOUBLE ELSE 1/(1+{drop}) END AS prob_alive
          FROM {src} c JOIN (SELECT * FROM w_series WHERE k=150) s USING (customer_id)""",
    }


_g = SPEND
EXTRA = {
    "w_clean": """SELECT * REPLACE (customer_id::BIGINT AS customer_id) FROM v_txn WHERE customer_id IS NOT NULL
        AND NOT starts_with(invoice_no,'C') AND quantity>0 AND unit_price>0""",
    "w_days": "SELECT customer_id, invoice_date::DATE AS day, sum(quantity*unit_price) AS total FROM w_clean GROUP BY ALL",
    "w_first": "SELECT *, min(day) OVER (PARTITION BY customer_id) AS first_day FROM w_days",
    "w_rfm": """SELECT customer_id, (count(*)-1)::DOUBLE AS frequency, (max(day)-min(day))::DOUBLE AS recency,
        ((SELECT max(day) FROM w_days)-min(day))::DOUBLE AS T, coalesce(avg(CASE WHEN day>first_day THEN total END),0) AS monetary_value
        FROM w_first GROUP BY customer_id""",
    **_series("w_rfm", MODEL, WEEKS),
    "w_spend": f"""SELECT *, {_g['q'] - 1!r}/({_g['p']!r}*frequency+{_g['q'] - 1!r})*({_g['v']!r}*{_g['p']!r}/{_g['q'] - 1!r})
        + {_g['p']!r}*frequency/({_g['p']!r}*frequency+{_g['q'] - 1!r})*monetary_value AS expected_avg_spend FROM w_predicted""",
    "w_scored": """SELECT *, predicted_purchases*expected_avg_spend AS cltv_90d, T-recency AS days_silent,
        frequency>0 AND (prob_alive<0.5 OR T-recency>180) AS at_risk FROM w_spend""",
    "w_quart": """SELECT quantile_cont(cltv_90d,0.25) AS a, quantile_cont(cltv_90d,0.5) AS b, quantile_cont(cltv_90d,0.75) AS c
        FROM w_scored WHERE frequency>0""",
    "w_segment": """SELECT s.*, CASE WHEN frequency<=0 THEN 'New/Insufficient Data' WHEN cltv_90d<=a THEN 'Low Value' WHEN cltv_90d<=b THEN 'Mid Value'
        WHEN cltv_90d<=c THEN 'High Value' ELSE 'Champions' END AS cltv_segment FROM w_scored s, w_quart""",
    "w_hist": """SELECT *, CASE WHEN T>0 THEN frequency/T*7 ELSE 0 END AS hist_rate_week, CASE WHEN T>0 THEN frequency/T*7 ELSE 0 END*(90/7.0::DOUBLE) AS hist_90d
        FROM w_scored""",
    "w_ratio": "SELECT *, CASE WHEN hist_90d>0 THEN predicted_purchases/hist_90d END AS pred_ratio FROM w_hist",
    "w_report": """SELECT customer_id, CASE WHEN frequency=0 THEN 'Unscored' WHEN cltv_90d>=2000 THEN 'Platinum' WHEN cltv_90d>=1000 THEN 'Gold'
          WHEN cltv_90d>=500 THEN 'Silver' ELSE 'Bronze' END AS tier,
        CASE WHEN T<=0 THEN 'Insufficient Data' WHEN frequency>=10 AND recency/T>=0.8 THEN 'Champion' WHEN frequency>=5 AND recency/T>=0.6 THEN 'Loyal'
          WHEN frequency>=3 THEN 'Potential Loyalist' WHEN frequency=1 THEN 'One-Time Buyer' WHEN frequency=0 THEN 'New/No Purchase' ELSE 'At Risk' END AS rfm_grade,
        predicted_purchases AS predicted_purchases_90d, expected_avg_spend, cltv_90d,
        CASE WHEN frequency=0 THEN 'LOW_FREQ' WHEN T<90 THEN 'LOW_TENURE' WHEN frequency<=1 THEN 'LOW_FREQ' WHEN pred_ratio>2 THEN 'OVER_OPTIMISTIC' ELSE 'OK' END AS confidence_flag,
        at_risk, CASE WHEN frequency=0 THEN 'WATCH' WHEN T<90 AND (pred_ratio IS NULL OR pred_ratio>3) THEN 'SUSPICIOUS'
          WHEN T<90 OR pred_ratio IS NULL OR pred_ratio>2 THEN 'WATCH' ELSE 'REALISTIC' END AS verdict FROM w_ratio""",
    "w_wanted": """SELECT row_number() OVER (ORDER BY days_silent DESC, customer_id) AS pos, customer_id FROM
        (SELECT * FROM w_scored ORDER BY days_silent DESC, customer_id LIMIT 10) x""",
}
reg = Registry(EXTRA)
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


def clean(s, d):
    return C.clean_transactions(V.txn(s, d))


def summary(s, d):
    return rfm.repeat_summary(clean(s, d))


def scored(s, d):
    return clv.score(summary(s, d), MODEL, SPEND).withColumn("at_risk", clv.at_risk())


def scored_table(s, d):
    """Scored customers written once: the ordered operators below read them several times."""
    from ..session import materialize

    return materialize(scored(s, d), "scored-customers")


@query("p01_cleaning_report", """SELECT * FROM (SELECT 1 AS step, 'null_customer' AS rule, count(*) FILTER (customer_id IS NULL) AS dropped, count(*) FILTER (customer_id IS NOT NULL) AS remaining FROM v_txn
    UNION ALL SELECT 2, 'cancelled_invoice', count(*) FILTER (starts_with(invoice_no,'C')), count(*) FILTER (NOT starts_with(invoice_no,'C')) FROM v_txn WHERE customer_id IS NOT NULL
    UNION ALL SELECT 3, 'non_positive_quantity', count(*) FILTER (quantity<=0), count(*) FILTER (quantity>0) FROM v_txn WHERE customer_id IS NOT NULL AND NOT starts_with(invoice_no,'C')
    UNION ALL SELECT 4, 'non_positive_price', count(*) FILTER (unit_price<=0), count(*) FILTER (unit_price>0) FROM v_txn WHERE customer_id IS NOT NULL AND NOT starts_with(invoice_no,'C') AND quantity>0) x""")
def _(s, d):
    return C.drop_report(V.txn(s, d))


@query("p01_clean_transactions", "SELECT customer_id, invoice_no, stock_code, quantity, invoice_date, round(quantity*unit_price,4) AS revenue FROM w_clean")
def _(s, d):
    return r(C.with_revenue(clean(s, d)).select("customer_id", "invoice_no", "stock_code", "quantity", "invoice_date", "revenue"), revenue=4)


@query("p03_week_rescale", "SELECT customer_id, round(recency/7,6) AS recency_weeks, round(T/7,6) AS T_weeks FROM w_rfm")
def _(s, d):
    return summary(s, d).select("customer_id", F.round(F.col("recency") / 7, 6).alias("recency_weeks"), F.round(F.col("T") / 7, 6).alias("T_weeks"))


@query("p11_training_eligibility", """SELECT count(*) FILTER (T>=90) AS kept, count(*) FILTER (T<90) AS excluded,
    round(avg(CASE WHEN T>=90 THEN 1.0::DOUBLE ELSE 0 END)*100,6) AS kept_pct FROM w_rfm""")
def _(s, d):
    return r(C.eligibility(summary(s, d)), kept_pct=6)


@query("p12_repeat_buyers", "SELECT customer_id, frequency, round(monetary_value+3.3e-7,4) AS monetary_value FROM w_rfm WHERE frequency>0 AND monetary_value>0")
def _(s, d):
    return r(C.repeat_buyers(summary(s, d)).select("customer_id", "frequency", "monetary_value"), nudge=["monetary_value"], monetary_value=4)


@query("p17_select_rename", "SELECT customer_id AS id, frequency AS purchases, T AS age_days FROM w_rfm")
def _(s, d):
    return summary(s, d).select(F.col("customer_id").alias("id"), F.col("frequency").alias("purchases"), F.col("T").alias("age_days"))


@query("a01_manual_rfm", """SELECT customer_id, min(invoice_date) AS first_purchase, max(invoice_date) AS last_purchase, count(DISTINCT invoice_no)-1 AS frequency,
    round(avg(order_total)+3.3e-7,4) AS monetary_value, floor(date_diff('microsecond',min(invoice_date),max(invoice_date))/86400000000.0)::BIGINT AS recency_days,
    floor(date_diff('microsecond',min(invoice_date),(SELECT max(invoice_date) FROM w_clean))/86400000000.0)::BIGINT AS T_days
    FROM (SELECT customer_id, invoice_no, invoice_date, sum(quantity*unit_price) AS order_total FROM w_clean GROUP BY ALL) o GROUP BY customer_id""")
def _(s, d):
    return r(rfm.manual_summary(clean(s, d)), nudge=["monetary_value"], monetary_value=4)


@query("a02_repeat_rfm", "SELECT customer_id, frequency, recency, T, round(monetary_value+3.3e-7,4) AS monetary_value FROM w_rfm")
def _(s, d):
    return r(summary(s, d), nudge=["monetary_value"], monetary_value=4)


def _describe_sql(c):
    return (f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}),5) AS mean, round(stddev_samp({c}),5) AS std, round(min({c}),5) AS min, "
            f"round(quantile_cont({c},0.25),5) AS p25, round(quantile_cont({c},0.5),5) AS p50, round(quantile_cont({c},0.75),5) AS p75, round(max({c}),5) AS max FROM w_rfm")


@query("a16_describe", " UNION ALL ".join(_describe_sql(c) for c in ("frequency", "recency", "T", "monetary_value")))
def _(s, d):
    from ..session import materialize

    t = materialize(summary(s, d), "summary")
    return r(rfm.describe(t, ["frequency", "recency", "T", "monetary_value"]), **{c: 5 for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


@query("a19_correlation", "SELECT round(corr(frequency,monetary_value),6) AS correlation, abs(corr(frequency,monetary_value))<0.2 AS weak FROM w_rfm WHERE frequency>0 AND monetary_value>0")
def _(s, d):
    return r(clv.correlation(C.repeat_buyers(summary(s, d))), correlation=6)


@query("a20_implied_gap", f"""SELECT round({clv.implied_mean_spend(SPEND)!r}::DOUBLE,6) AS implied_mean, round(avg(monetary_value),5) AS observed_mean,
    round(abs({clv.implied_mean_spend(SPEND)!r}-avg(monetary_value))/avg(monetary_value)*100,6) AS gap_pct,
    CASE WHEN abs({clv.implied_mean_spend(SPEND)!r}-avg(monetary_value))/avg(monetary_value)*100<15 THEN 'ACCEPTABLE' ELSE 'WARNING' END AS status
    FROM w_rfm WHERE frequency>0 AND monetary_value>0""")
def _(s, d):
    return r(clv.implied_gap(C.repeat_buyers(summary(s, d)), SPEND), implied_mean=6, observed_mean=5, gap_pct=6)


@query("a28_column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS rows, count(*)-count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, "
    f"count(DISTINCT {c})+CASE WHEN count(*)>count({c}) THEN 1 ELSE 0 END AS distinct_with_null FROM v_txn" for c in ("customer_id", "invoice_no", "stock_code")))
def _(s, d):
    return C.column_profile(V.txn(s, d), ["customer_id", "invoice_no", "stock_code"])


@query("c04_prob_alive", "SELECT customer_id, round(prob_alive,8) AS prob_alive FROM w_scored")
def _(s, d):
    return summary(s, d).select("customer_id", F.round(clv.prob_alive(MODEL), 8).alias("prob_alive"))


_b = BGNBD
@query("c04_prob_alive_degenerate", f"""SELECT customer_id, round(CASE WHEN frequency=0 THEN 1.0::DOUBLE ELSE
    1/(1+1e-9::DOUBLE/(1e-9::DOUBLE+frequency-1)*pow(({_b['alpha']}::DOUBLE+T/7)/({_b['alpha']}::DOUBLE+recency/7),frequency+{_b['r']}::DOUBLE)) END,6) AS prob_alive FROM w_rfm""")
def _(s, d):
    return summary(s, d).select("customer_id", F.round(clv.prob_alive(BGNBD), 6).alias("prob_alive"))


@query("c05_expected_purchases", "SELECT customer_id, round(predicted_purchases,6) AS predicted_purchases FROM w_predicted")
def _(s, d):
    return summary(s, d).select("customer_id", F.round(clv.expected_purchases(WEEKS, MODEL), 6).alias("predicted_purchases"))


@query("c06_expected_spend", "SELECT customer_id, round(expected_avg_spend+3.3e-7,4) AS expected_avg_spend FROM w_spend")
def _(s, d):
    return summary(s, d).select("customer_id", F.round(clv.expected_spend(SPEND) + 3.3e-7, 4).alias("expected_avg_spend"))


@query("c07_cltv", "SELECT customer_id, round(cltv_90d,4) AS cltv_90d, days_silent FROM w_scored")
def _(s, d):
    return r(scored(s, d).select("customer_id", "cltv_90d", "days_silent"), cltv_90d=4)


@query("c08_discounted_value")
def _(s, d):
    return r(clv.discounted_value(summary(s, d), MODEL, SPEND), clv=4)


@query("c09_segments", "SELECT customer_id, round(cltv_90d,4) AS cltv_90d, cltv_segment FROM w_segment")
def _(s, d):
    return r(clv.segment(scored_table(s, d)).select("customer_id", "cltv_90d", "cltv_segment"), cltv_90d=4)


@query("w05_quartile_cuts", "SELECT round(a,4) AS p25, round(b,4) AS p50, round(c,4) AS p75 FROM w_quart")
def _(s, d):
    from ..operators.ordered import exact_quantiles

    v = scored_table(s, d).filter(F.col("frequency") > 0)
    return r(exact_quantiles(v, "cltv_90d", {"p25": 0.25, "p50": 0.5, "p75": 0.75}), p25=4, p50=4, p75=4)


@query("a17_segment_summary", """SELECT cltv_segment, round(avg(cltv_90d),4) AS mean_cltv, round(median(cltv_90d),4) AS median_cltv, count(*) AS customers, round(sum(cltv_90d),3) AS total_cltv,
    round(sum(cltv_90d)*100/(SELECT sum(cltv_90d) FROM w_segment WHERE frequency>0),6) AS share_pct FROM w_segment WHERE frequency>0 GROUP BY ALL""")
def _(s, d):
    return r(clv.segment_summary(clv.segment(scored_table(s, d))), mean_cltv=4, median_cltv=4, total_cltv=3, share_pct=6)


@query("w04_pareto_share", " UNION ALL ".join(f"""SELECT {p} AS pct, max(k)::BIGINT AS k, round(sum(CASE WHEN rn<=k THEN cltv_90d END)*100/sum(cltv_90d),6) AS share_pct FROM
    (SELECT cltv_90d, row_number() OVER (ORDER BY cltv_90d DESC) AS rn, greatest(1, count(*) OVER () * {p} // 100) AS k FROM w_scored WHERE frequency>0) x""" for p in (1, 5, 10, 20)))
def _(s, d):
    return r(top_share(scored_table(s, d).filter(F.col("frequency") > 0), "cltv_90d", [1, 5, 10, 20]), share_pct=6)


@query("w07_percentile_cohorts", """SELECT customer_id, CASE WHEN above*100<n*10 THEN 'VIP' WHEN above*100<n*30 THEN 'High' WHEN above*100<n*60 THEN 'Medium' ELSE 'Low' END AS cohort
    FROM (SELECT customer_id, rank() OVER (ORDER BY cltv_90d DESC)-1 AS above, count(*) OVER () AS n FROM w_scored) x""")
def _(s, d):
    return clv.cohort_labels(scored_table(s, d)).select("customer_id", "cohort")


@query("w15_longest_silence", f"SELECT {rounded('customer_id frequency recency T days_silent prob_alive:8 cltv_90d:4')} FROM w_scored WHERE at_risk ORDER BY days_silent DESC, customer_id LIMIT 8")
def _(s, d):
    t = scored(s, d).filter("at_risk").orderBy(F.col("days_silent").desc(), "customer_id").limit(8)
    return r(t.select("customer_id", "frequency", "recency", "T", "days_silent", "prob_alive", "cltv_90d"), prob_alive=8, cltv_90d=4)


@query("f05_days_silent", "SELECT customer_id, T-recency AS days_silent FROM w_rfm")
def _(s, d):
    return summary(s, d).select("customer_id", (F.col("T") - F.col("recency")).alias("days_silent"))


@query("f07_prefix_test", "SELECT invoice_no, starts_with(invoice_no,'C') AS cancelled, count(*) AS n FROM v_txn GROUP BY ALL")
def _(s, d):
    return V.txn(s, d).groupBy("invoice_no", F.startswith("invoice_no", F.lit("C")).alias("cancelled")).agg(F.count("*").alias("n"))


@query("f18_tier_and_grade", "SELECT customer_id, tier, rfm_grade, confidence_flag, verdict FROM w_report")
def _(s, d):
    return clv.validation_report(scored(s, d)).select("customer_id", "tier", "rfm_grade", "confidence_flag", "verdict")


@query("f19_risk_triggers", """SELECT count(*) FILTER (prob_alive<0.5) AS low_alive, count(*) FILTER (frequency>0 AND days_silent>180) AS long_silence,
    count(*) FILTER (at_risk) AS at_risk FROM w_scored""")
def _(s, d):
    return clv.risk_triggers(scored(s, d))


@query("f20_history_ratio", "SELECT customer_id, round(hist_rate_week,8) AS hist_rate_week, round(hist_90d,8) AS hist_90d, round(pred_ratio,6) AS pred_ratio FROM w_ratio")
def _(s, d):
    return r(clv.history(scored(s, d)).select("customer_id", "hist_rate_week", "hist_90d", "pred_ratio"), hist_rate_week=8, hist_90d=8, pred_ratio=6)


def _weight_sql(q):
    return f"round({q!r}::DOUBLE/({SPEND['p']!r}*greatest(frequency,1)+{q!r}),8)"


@query("f21_shrinkage_weight", f"SELECT customer_id, {_weight_sql(SPEND['q'])} AS reference_weight, {_weight_sql(SPEND['q'] - 1)} AS published_weight FROM w_rfm")
def _(s, d):
    x = F.col("frequency")
    return summary(s, d).select("customer_id", F.round(clv.shrinkage(x, SPEND), 8).alias("reference_weight"),
                                F.round(clv.shrinkage(x, SPEND, "published"), 8).alias("published_weight"))


@query("f16_purchase_rate_gap", """SELECT customer_id, round(frequency/nullif(T,0)*7,8) AS own_rate_week,
    round(coalesce(frequency/nullif(T,0)*7,0)/(0.243/4.414),6) AS times_population FROM w_rfm""")
def _(s, d):
    own = F.col("frequency") / F.nullif(F.col("T"), F.lit(0.0)) * 7
    return summary(s, d).select("customer_id", F.round(own, 8).alias("own_rate_week"),
                                F.round(F.coalesce(own, F.lit(0.0)) / clv.purchase_rate(MODEL)[0], 6).alias("times_population"))


@query("f15_variation", """SELECT round(stddev_pop(frequency)/avg(frequency),6) AS observed_cv, round(1/sqrt(0.243::DOUBLE),6) AS model_cv FROM w_rfm""")
def _(s, d):
    return summary(s, d).agg(F.round(F.stddev_pop("frequency") / F.avg("frequency"), 6).alias("observed_cv"), F.round(F.lit(clv.variation(MODEL["r"])), 6).alias("model_cv"))


HEAVY = gamma_quantile(0.9, MODEL["r"], 1 / MODEL["alpha"])


@query("f17_heavy_buyers", f"""SELECT count(*) FILTER (frequency/nullif(T,0)*7>{HEAVY!r}) AS above, count(*) AS customers, round({HEAVY!r}::DOUBLE,8) AS rate_p90 FROM w_rfm""")
def _(s, d):
    own = F.col("frequency") / F.nullif(F.col("T"), F.lit(0.0)) * 7
    return summary(s, d).agg(F.count_if(own > HEAVY).alias("above"), F.count("*").alias("customers"), F.round(F.lit(HEAVY), 8).alias("rate_p90"))


@query("c10_validation_report", f"SELECT {rounded('customer_id tier rfm_grade predicted_purchases_90d:6 expected_avg_spend:3 cltv_90d:4 confidence_flag at_risk verdict')} FROM w_report")
def _(s, d):
    return r(clv.validation_report(scored(s, d)), predicted_purchases_90d=6, expected_avg_spend=3, cltv_90d=4)


@query("a18_tier_summary", """SELECT tier, count(*) AS customers, round(count(*)*100.0::DOUBLE/(SELECT count(*) FROM w_report),6) AS pct, round(avg(cltv_90d),4) AS mean_cltv,
    count(*) FILTER (at_risk) AS at_risk FROM w_report GROUP BY ALL""")
def _(s, d):
    return r(clv.tier_summary(clv.validation_report(scored(s, d))), pct=6, mean_cltv=4)


@query("a18_verdict_summary", "SELECT verdict, count(*) AS customers, round(count(*)*100.0::DOUBLE/(SELECT count(*) FROM w_report),6) AS pct FROM w_report GROUP BY ALL")
def _(s, d):
    return r(clv.verdict_summary(clv.validation_report(scored(s, d))), pct=6)


@query("c12_tier_shares", """SELECT tier, round(sum(cltv_90d)*100/max(st),6) AS revenue_pct, round(count(*)*100.0::DOUBLE/max(nt),6) AS customer_pct FROM
    (SELECT cltv_90d, CASE WHEN cltv_90d>=2000 THEN 'Platinum' WHEN cltv_90d>=1000 THEN 'Gold' WHEN cltv_90d>=500 THEN 'Silver' ELSE 'Bronze' END AS tier,
     sum(cltv_90d) OVER () AS st, count(*) OVER () AS nt FROM w_scored WHERE frequency>0) x GROUP BY tier""")
def _(s, d):
    return r(clv.tier_shares(scored(s, d)), revenue_pct=6, customer_pct=6)


def wanted(t):
    from pyspark.sql import Window as W

    first = t.orderBy(F.col("days_silent").desc(), "customer_id").limit(10)
    return first.select(F.row_number().over(W.orderBy(F.col("days_silent").desc(), "customer_id")).cast("bigint").alias("pos"), "customer_id")


@query("c11_spot_check", """SELECT pos, customer_id, round(hist_rate_week,8) AS hist_rate_week, round(hist_90d,8) AS hist_90d, round(pred_ratio,6) AS pred_ratio,
    round(6.1421::DOUBLE/(1.8368*greatest(frequency,1)+6.1421),8) AS population_weight,
    coalesce(nullif(concat_ws(' | ', CASE WHEN T<90 THEN 'SHORT_TENURE (T=' || format('{:.0f}',T) || 'd < 90d threshold)' END,
      CASE WHEN pred_ratio>2 THEN 'OVER_OPTIMISTIC (predicted ' || format('{:.1f}',round(pred_ratio,6)) || 'x historical rate)' END,
      CASE WHEN hist_90d=0 THEN 'INF_RATIO (no repeat purchase history to compare against)' END),''),'none') AS flags,
    CASE WHEN T<90 AND (pred_ratio IS NULL OR pred_ratio>3) THEN 'SUSPICIOUS' WHEN pred_ratio>2 OR T<90 THEN 'WATCH' ELSE 'REALISTIC' END AS verdict
    FROM w_ratio JOIN w_wanted USING (customer_id)""")
def _(s, d):
    t = scored_table(s, d)
    return r(clv.spot_check(t.join(wanted(t), "customer_id")), hist_rate_week=8, hist_90d=8, pred_ratio=6, population_weight=8)


@query("j06_left_join_backfill", """SELECT customer_id, round(coalesce(s.days_silent, r.T),4) AS days_silent, coalesce(s.at_risk, false) AS at_risk FROM w_rfm r
    LEFT JOIN (SELECT * FROM w_scored WHERE frequency>0) s USING (customer_id)""")
def _(s, d):
    base = summary(s, d)
    part = clv.score(base, MODEL, SPEND).withColumn("at_risk", clv.at_risk()).filter(F.col("frequency") > 0).select("customer_id", "days_silent", "at_risk")
    j = base.select("customer_id", "T").join(part, "customer_id", "left")
    return j.select("customer_id", F.round(F.coalesce("days_silent", "T"), 4).alias("days_silent"), F.coalesce("at_risk", F.lit(False)).alias("at_risk"))


_lookup_sql = """SELECT pos, customer_id, round(w.cltv_90d,4) AS cltv_90d, CASE WHEN w.frequency>0 THEN w.frequency ELSE 0 END AS frequency,
    CASE WHEN w.frequency>0 THEN w.recency ELSE 0 END AS recency FROM w_wanted JOIN w_scored w USING (customer_id)"""


def lookup(s, d):
    t = scored_table(s, d)
    first = t.filter(F.col("frequency") > 0).select("customer_id", "cltv_90d", "frequency", "recency")
    return r(clv.lookup_ids(wanted(t), first, t.select("customer_id", "cltv_90d")), cltv_90d=4)


@query("j09_missing_backfill", _lookup_sql)
def _(s, d):
    return lookup(s, d)


@query("j10_ordered_lookup", "SELECT pos, customer_id, tier FROM w_wanted JOIN w_report USING (customer_id)")
def _(s, d):
    t = scored_table(s, d)
    return clv.validation_report(t).join(wanted(t), "customer_id").select("pos", "customer_id", "tier").orderBy("pos")


@query("u01_union_missing_columns", """SELECT customer_id, frequency, recency, NULL::DOUBLE AS cltv_90d FROM w_rfm WHERE frequency=0
    UNION ALL SELECT customer_id, frequency, NULL, round(cltv_90d,4) FROM w_scored WHERE frequency>0""")
def _(s, d):
    t = scored_table(s, d)
    a = t.filter(F.col("frequency") == 0).select("customer_id", "frequency", "recency")
    b = t.filter(F.col("frequency") > 0).select("customer_id", "frequency", F.round("cltv_90d", 4).alias("cltv_90d"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u02_set_difference", "SELECT o_custkey AS customer_id FROM orders EXCEPT SELECT customer_id FROM w_clean")
def _(s, d):
    asked = V.table(s, d, "orders").select(F.col("o_custkey").alias("customer_id"))
    return asked.subtract(clean(s, d).select("customer_id"))


@query("a29_value_benchmark", """SELECT round(avg(cltv_90d) FILTER (frequency>0),4) AS mean_cltv, round(median(cltv_90d) FILTER (frequency>0),4) AS median_cltv, round(sum(cltv_90d) FILTER (frequency>0),3) AS total_cltv,
    round((avg(cltv_90d) FILTER (frequency>0))/125,6) AS times_typical, CASE WHEN (avg(cltv_90d) FILTER (frequency>0))>300 THEN 'wholesale' ELSE 'normal range' END AS diagnosis,
    round(median(predicted_purchases),6) AS median_predicted FROM w_scored""")
def _(s, d):
    return r(clv.value_benchmark(scored_table(s, d)), mean_cltv=4, median_cltv=4, total_cltv=3, times_typical=6, median_predicted=6)


@query("a21_shrinkage_check", """SELECT cohort, round(o+3.3e-7,4) AS observed, round(p+3.3e-7,4) AS predicted, round(CASE WHEN abs(o-pop)>0 THEN 1-abs(p-pop)/abs(o-pop) ELSE 0 END,6) AS shrinkage, round(th,6) AS theory,
    CASE WHEN abs(CASE WHEN abs(o-pop)>0 THEN 1-abs(p-pop)/abs(o-pop) ELSE 0 END - th)<tol THEN 'MATCH' ELSE 'MISMATCH' END AS result FROM
    (SELECT 'freq=1' AS cohort, avg(monetary_value) FILTER (frequency=1) AS o, avg(expected_avg_spend) FILTER (frequency=1) AS p, avg(monetary_value) AS pop, 6.1421::DOUBLE/(1.8368+6.1421) AS th, 0.15 AS tol FROM w_scored WHERE frequency>0
     UNION ALL SELECT 'freq>=10', avg(monetary_value) FILTER (frequency>=10), avg(expected_avg_spend) FILTER (frequency>=10), avg(monetary_value), 6.1421::DOUBLE/(18.368+6.1421), 0.20 FROM w_scored WHERE frequency>0) x""")
def _(s, d):
    return r(clv.shrinkage_check(scored(s, d), SPEND), nudge=["observed", "predicted"], observed=4, predicted=4, shrinkage=6, theory=6)


# --- quality checks ---

@query("q02_unique_key", """SELECT 'unique_order_id_line' AS check, sum(n-1)=0 AS passed, sum(n-1)::BIGINT AS violations, 'rows beyond the first per key' AS note
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) x""")
def _(s, d):
    k = V.table(s, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"))
    return Q.unique_key(k, ["order_id", "line"])


def _chk(name, cond, src, note):
    return f"SELECT '{name}' AS check, count(*) FILTER ({cond})=0 AS passed, count(*) FILTER ({cond}) AS violations, '{note}' AS note FROM {src}"


@query("q03_null_checks", " UNION ALL ".join(_chk(f"no_null_{c}", f"{c} IS NULL", "v_txn", "null values") for c in ("customer_id", "invoice_no", "unit_price")))
def _(s, d):
    return Q.null_checks(V.txn(s, d), ["customer_id", "invoice_no", "unit_price"])


@query("q04_non_negative", " UNION ALL ".join(_chk(f"non_negative_{c}", f"{c}<0", "v_txn", "negative values") for c in ("quantity", "unit_price")))
def _(s, d):
    return Q.non_negative(V.txn(s, d), ["quantity", "unit_price"])


@query("q05_column_order", _chk("recency_le_T", "recency>T", "w_rfm", "pairs out of order"))
def _(s, d):
    return Q.ordered_columns(summary(s, d), [("recency", "T")])


@query("q06_one_time_share", """SELECT count(*) FILTER (frequency=0) AS one_time_buyers, count(*) AS customers,
    round(avg(CASE WHEN frequency=0 THEN 1.0::DOUBLE ELSE 0 END)*100,6) AS pct FROM w_rfm""")
def _(s, d):
    return r(Q.one_time_share(summary(s, d)), pct=6)


@query("q08_all_checks", "SELECT count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, count(*) FILTER (NOT passed)=0 AS all_passed FROM ("
       + " UNION ALL ".join([_chk(f"no_null_{c}", f"{c} IS NULL", "v_txn", "n") for c in ("customer_id", "invoice_no")]
                            + [_chk(f"nn_{c}", f"{c}<0", "v_txn", "n") for c in ("quantity", "unit_price")]
                            + [_chk("o", "recency>T", "w_rfm", "n")]) + ") x")
def _(s, d):
    t = V.txn(s, d)
    return Q.verdict(Q.null_checks(t, ["customer_id", "invoice_no"]).unionByName(Q.non_negative(t, ["quantity", "unit_price"]))
                     .unionByName(Q.ordered_columns(summary(s, d), [("recency", "T")])))


@query("q01_schema_check")
def _(s, d):
    t = V.txn(s, d)
    n = t.agg(F.count("*").alias("n")).scalar()
    return Q.schema_check(t, ["invoice_no", "customer_id", "quantity", "unit_price", "country"], exact=True).withColumn("rows_in_table", n)
