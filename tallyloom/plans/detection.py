"""Registered rare-event classification queries with their SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.semantics import clamp, sigmoid
from ..operators import attribution as A, cleaning as C, metrics as M, quality as Q, resample as R, splits as P, threshold as T
from ..session import SPREAD_FROM, materialize, materialize_spread
from . import views as V
from .registry import Registry, r, rounded

FEATURES = ["time_s", *V.V_FEATURES, "amount"]
HASH = "md5('{seed}:split:' || event_id)"
# a fixed linear model, so that attributions can be stated in SQL
BETA = {"v14": -1.7, "v4": 1.2, "v12": -0.9, "v10": 0.6, "v11": 0.4, "amount": 0.002, "time_s": -1e-7}


def _suite(src, thr=5000):
    """Direct form: pairwise ranks by window, confusion by filters."""
    return f"""SELECT (sum(CASE WHEN label=1 THEN rk END)-np*(np+1)/2.0::DOUBLE)/(np*nn) AS roc_auc, ap AS avg_precision, tp, fp, np-tp AS fn, nn-fp AS tn FROM
      (SELECT label, rank() OVER (ORDER BY score_e4) + (count(*) OVER (PARTITION BY score_e4)-1)/2.0::DOUBLE AS rk, sum(label) OVER () AS np, sum(1-label) OVER () AS nn,
        sum(CASE WHEN label=1 AND score_e4>={thr} THEN 1 ELSE 0 END) OVER () AS tp, sum(CASE WHEN label=0 AND score_e4>={thr} THEN 1 ELSE 0 END) OVER () AS fp FROM {src}) x,
      (SELECT sum(pos*(ctp::DOUBLE/(ctp+cfp)))/sum(pos) AS ap FROM (SELECT sum(label) AS pos, sum(sum(label)) OVER (ORDER BY score_e4 DESC) AS ctp,
        sum(sum(1-label)) OVER (ORDER BY score_e4 DESC) AS cfp FROM {src} GROUP BY score_e4) g) y GROUP BY np, nn, tp, fp, ap"""


def _div(a, b):
    return f"(CASE WHEN {b}>0 THEN ({a})/({b})::DOUBLE ELSE 0.0::DOUBLE END)"


_P, _R = _div("tp", "tp+fp"), _div("tp", "tp+fn")
_F1, _F2 = _div("2.0::DOUBLE*tp", "2*tp+fp+fn"), _div("5.0::DOUBLE*tp", "5*tp+4*fn+fp")
_ratios = f"{_P} AS precision, {_R} AS recall, {_F1} AS f1, {_F2} AS f2"


def _sweep(src):
    return f"""SELECT t/100.0::DOUBLE AS threshold, tp, fp, fn, tn, {_ratios}, {_R} AS tpr, {_div('fp', 'fp+tn')} AS fpr, {_R}-{_div('fp', 'fp+tn')} AS youden_j,
      fp*50.0::DOUBLE AS cost_fp, missed*2.5::DOUBLE AS cost_fn, fp*50.0::DOUBLE+missed*2.5::DOUBLE AS total_cost FROM
      (SELECT t, count(*) FILTER (label=1 AND score_e4>=t*100) AS tp, count(*) FILTER (label=0 AND score_e4>=t*100) AS fp, count(*) FILTER (label=1 AND score_e4<t*100) AS fn,
        count(*) FILTER (label=0 AND score_e4<t*100) AS tn, coalesce(sum(amount) FILTER (label=1 AND score_e4<t*100),0) AS missed FROM {src}, generate_series(10,90) g(t) GROUP BY t) s"""


def _pick(m, up):
    return f"SELECT * FROM w_sweep ORDER BY round({m},6) {'DESC' if up else 'ASC'}, threshold LIMIT 1"


EXTRA = {
    "w_rank": f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH.format(seed=42)}, event_id) AS rk, count(*) OVER (PARTITION BY label) AS n FROM v_card",
    "w_split": "SELECT *, CASE WHEN rk <= round(n*0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM w_rank",
    "w_srank": f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH.format(seed=7)}, event_id) AS rk, count(*) OVER (PARTITION BY label) AS n FROM v_scored",
    "w_ssplit": "SELECT *, CASE WHEN rk <= round(n*0.5::DOUBLE) THEN 'test' ELSE 'val' END AS split FROM w_srank",
    "w_val": "SELECT * FROM w_ssplit WHERE split='val'", "w_test": "SELECT * FROM w_ssplit WHERE split='test'",
    "w_sweep": _sweep("w_val"),
    "w_optima": " UNION ALL ".join(f"SELECT '{n}' AS criterion, * FROM ({_pick(m, up)}) o{i}" for i, (n, m, up) in enumerate(T.OPTIMA)),
    "w_scen": """SELECT criterion AS name, round(threshold*10000)::BIGINT AS threshold_e4 FROM w_optima WHERE criterion IN ('f2_optimal','cost_optimal')
        UNION ALL SELECT * FROM (VALUES ('no_model',9999::BIGINT),('default',5000::BIGINT),('catch_all',1::BIGINT)) s(name,threshold_e4)""",
    "w_applied": """SELECT name, threshold_e4, count(*) FILTER (label=1 AND score_e4>=threshold_e4) AS tp, count(*) FILTER (label=0 AND score_e4>=threshold_e4) AS fp,
        count(*) FILTER (label=1 AND score_e4<threshold_e4) AS fn, count(*) FILTER (label=0 AND score_e4<threshold_e4) AS tn,
        count(*) FILTER (label=0 AND score_e4>=threshold_e4)*50.0::DOUBLE+coalesce(sum(amount) FILTER (label=1 AND score_e4<threshold_e4),0)*2.5::DOUBLE AS cost FROM w_test, w_scen GROUP BY ALL""",
    "w_impact": f"""SELECT name AS scenario, threshold_e4, tp, fp, fn, tn, cost AS test_cost, cost*((SELECT count(*) FROM w_test)/0.2::DOUBLE/2*365.25)/(tp+fp+fn+tn) AS annual_cost,
        {_R}*100 AS caught_pct, {_div('fp', 'fp+tn')}*100 AS false_alarm_pct FROM w_applied""",
    "w_contrib": "SELECT event_id, label, " + ", ".join(f"{b!r}::DOUBLE*({c}-avg({c}) OVER ()) AS k_{c}, {c}" for c, b in BETA.items()) + " FROM v_card",
    "w_long": " UNION ALL ".join(f"SELECT event_id, label, '{c}' AS feature, {c} AS value, k_{c} AS contribution FROM w_contrib" for c in BETA),
    "w_margin": "SELECT event_id, label, " + "+".join(f"k_{c}" for c in BETA) + " AS margin FROM w_contrib",
    "w_sample": "SELECT event_id FROM v_card ORDER BY md5('42:sample:' || event_id), event_id LIMIT 2000",
    "w_top": """SELECT event_id FROM w_margin WHERE label=1 ORDER BY round(margin,9) DESC, event_id LIMIT 1""",
}
reg = Registry(EXTRA)
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


def card_split(s, d):
    return P.stratified_split(V.card(s, d), "event_id")


def train_test(s, d):
    """The split written once, a large one in equal parts: training statistics, both parts and the checks all start from the same table."""
    rows = V.table(s, d, "events").count()
    x = materialize_spread(P.stratified_split(V.card(s, d), "event_id", many=rows >= SPREAD_FROM), rows, "card-split", "event_id")
    return x.filter("split = 'train'").drop("split"), x.filter("split = 'test'").drop("split")


def val_test(s, d):
    x = materialize(P.stratified_split(V.scored(s, d), "event_id", test_share=0.5, seed=7, names=("val", "test")), "scored-split")
    return x.filter("split = 'val'"), x.filter("split = 'test'")


# --- splits, features, balance ---

@query("p09_stratified_split", "SELECT event_id, label, split FROM w_split")
def _(s, d):
    return card_split(s, d).select("event_id", "label", "split")


@query("p10_stratified_folds", "SELECT event_id, label, ((rk>n//5)::INT + (rk>n*2//5)::INT + (rk>n*3//5)::INT + (rk>n*4//5)::INT)::INT AS fold FROM w_rank")
def _(s, d):
    return P.stratified_folds(V.card(s, d), "event_id").select("event_id", "label", "fold")


@query("p13_full_row_dedup", "SELECT count(*) AS rows, count(DISTINCT (user_id, event_type, value)) AS distinct_rows, count(*)-count(DISTINCT (user_id, event_type, value)) AS duplicates FROM events")
def _(s, d):
    return C.duplicate_profile(V.table(s, d, "events").select("user_id", "event_type", "value"))


@query("p18_fixed_sample", "SELECT event_id FROM w_sample")
def _(s, d):
    return P.fixed_sample(V.card(s, d).select("event_id"), "event_id", 2000)


@query("f01_hour_of_day", "SELECT event_id, round((time_s % 86400)/3600,8) AS hour_of_day FROM v_card")
def _(s, d):
    return V.card(s, d).select("event_id", F.round(F.pmod(F.col("time_s"), F.lit(86400)) / 3600, 8).alias("hour_of_day"))


@query("f02_log_amount", "SELECT event_id, round(ln(1+amount),8) AS amount_log FROM v_card")
def _(s, d):
    return V.card(s, d).select("event_id", F.round(F.log1p("amount"), 8).alias("amount_log"))


@query("f03_train_zscore", """SELECT event_id, split, round((amount-(SELECT avg(amount) FROM w_split WHERE split='train'))/greatest((SELECT stddev_pop(amount) FROM w_split WHERE split='train'),1e-8),6) AS amount_zscore,
    round((time_s % 86400)/3600,8) AS hour_of_day, round(ln(1+amount),8) AS amount_log FROM w_split""")
def _(s, d):
    x = card_split(s, d)
    return r(P.engineer(x, x.filter("split = 'train'")).select("event_id", "split", "amount_zscore", "hour_of_day", "amount_log"), amount_zscore=6, hour_of_day=8, amount_log=8)


@query("f13_sigmoid", "SELECT event_id, round(1/(1+exp(-(score_e4-5000)/1000.0::DOUBLE)),8) AS p FROM v_scored")
def _(s, d):
    return V.scored(s, d).select("event_id", F.round(sigmoid((F.col("score_e4") - 5000) / 1000), 8).alias("p"))


@query("f14_clamp", "SELECT event_id, least(greatest(round((amount-10)/50,6),0),1) AS unit_amount FROM v_scored")
def _(s, d):
    return V.scored(s, d).select("event_id", clamp(F.round((F.col("amount") - 10) / 50, 6), 0.0, 1.0).alias("unit_amount"))


@query("f23_json_field", "SELECT event_id, coalesce(json_extract_string(props,'$.k')::BIGINT,-1) AS k, coalesce(json_extract_string(props,'$.missing'),'none') AS other FROM events")
def _(s, d):
    return V.table(s, d, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(-1)).alias("k"),
                                          F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("other"))


@query("m01_standard_scaling", "SELECT event_id, split, " + ", ".join(
    f"round(({c}-(SELECT avg({c}) FROM w_split WHERE split='train'))/(SELECT stddev_pop({c}) FROM w_split WHERE split='train'),6) AS {c}" for c in ("v1", "v14", "amount")) + " FROM w_split")
def _(s, d):
    x = card_split(s, d)
    cols = ["v1", "v14", "amount"]
    return r(P.scale(x, x.filter("split = 'train'"), cols).select("event_id", "split", *cols), v1=6, v14=6, amount=6)


@query("a22_class_balance", """SELECT count(*) FILTER (label=0) AS negatives, count(*) FILTER (label=1) AS positives, round(avg(label)*100,6) AS positive_pct,
    (count(*) FILTER (label=0) // count(*) FILTER (label=1))::BIGINT AS imbalance, round(avg(amount) FILTER (label=0),6) AS mean_amount_neg, round(avg(amount) FILTER (label=1),6) AS mean_amount_pos FROM v_card""")
def _(s, d):
    return r(P.class_balance(V.card(s, d)), positive_pct=6, mean_amount_neg=6, mean_amount_pos=6)


@query("a23_class_weights", """SELECT round(count(*)/(2.0::DOUBLE*count(*) FILTER (label=0)),8) AS weight_neg, round(count(*)/(2.0::DOUBLE*count(*) FILTER (label=1)),8) AS weight_pos,
    round(count(*) FILTER (label=0)/(count(*) FILTER (label=1))::DOUBLE,6) AS scale_pos FROM v_card""")
def _(s, d):
    return r(P.class_weights(V.card(s, d)), weight_neg=8, weight_pos=8, scale_pos=6)


@query("a24_histogram", """SELECT least(floor((amount-lo)/((hi-lo)/40))+1,40)::BIGINT AS bin, count(*) AS n FROM v_card, (SELECT min(amount) AS lo, max(amount) AS hi FROM v_card) x GROUP BY 1""")
def _(s, d):
    return P.histogram(V.card(s, d), "amount", 40)


@query("a25_hour_density", "SELECT label, hour, n, round(n/(sum(n) OVER (PARTITION BY label))::DOUBLE,8) AS density FROM (SELECT label, floor((time_s % 86400)/3600)::BIGINT AS hour, count(*) AS n FROM v_card GROUP BY ALL) x")
def _(s, d):
    return r(P.hour_density(V.card(s, d)), density=8)


@query("u03_split_overlap", """SELECT count(*) AS overlap FROM (SELECT time_s, amount, v1, v2 FROM w_split WHERE split='train' INTERSECT SELECT time_s, amount, v1, v2 FROM w_split WHERE split='test') x""")
def _(s, d):
    x = card_split(s, d)
    return P.row_overlap(x.filter("split = 'train'"), x.filter("split = 'test'"), ["time_s", "amount", "v1", "v2"])


# --- oversampling ---

_zcols = FEATURES
_mean = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _zcols)
_zrow = ", ".join(f"({c}-m_{c})/s_{c} AS {c}" for c in _zcols)
reg.extra.update({"w_tr": "SELECT * FROM w_split WHERE split='train'", "w_st": f"SELECT {_mean} FROM w_tr",
                  "w_min": f"SELECT event_id, {_zrow} FROM w_tr, w_st WHERE label=1"})


def scaled_train(s, d):
    train, _ = train_test(s, d)
    return P.scale(train, train, FEATURES)


@query("m02_minority_neighbours", "SELECT event_id, neighbour, rank::INT AS rank, round(dist2,6) AS dist2 FROM (SELECT a.event_id, b.event_id AS neighbour, "
       + "+".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in _zcols) + " AS dist2, row_number() OVER (PARTITION BY a.event_id ORDER BY round("
       + "+".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in _zcols) + ",9), b.event_id) AS rank FROM w_min a JOIN w_min b ON a.event_id<>b.event_id) x WHERE rank<=5")
def _(s, d):
    return r(R.neighbours(scaled_train(s, d).filter("label = 1"), "event_id", FEATURES, 5), dist2=6)


_d2 = "+".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in _zcols)
reg.extra.update({
    "w_near": f"SELECT a.event_id, b.event_id AS neighbour, row_number() OVER (PARTITION BY a.event_id ORDER BY round({_d2},9), b.event_id) AS rank FROM w_min a JOIN w_min b ON a.event_id<>b.event_id",
    "w_made": """SELECT s, s % (SELECT count(*) FROM w_min) AS idx, ('0x' || substr(md5('42:neighbour:' || s),1,13))::BIGINT % least(5, (SELECT count(*) FROM w_min)-1) + 1 AS rank,
        ('0x' || substr(md5('42:position:' || s),1,13))::BIGINT / 4503599627370496::DOUBLE AS u FROM (SELECT unnest(range((SELECT floor(0.2::DOUBLE*count(*) FILTER (label=0))::BIGINT - count(*) FILTER (label=1) FROM w_tr))) AS s) g"""})


@query("m02_oversampled_train", f"""SELECT event_id, {', '.join(f"round(({c}-m_{c})/s_{c},6) AS {c}" for c in _zcols)}, label, false AS synthetic FROM w_tr, w_st
    UNION ALL SELECT -m.s-1, {', '.join(f"round(a.{c}+m.u*(b.{c}-a.{c}),6)" for c in _zcols)}, 1, true FROM w_made m JOIN (SELECT *, row_number() OVER (ORDER BY event_id)-1 AS idx FROM w_min) a USING (idx)
    JOIN w_near n ON n.event_id=a.event_id AND n.rank=m.rank JOIN w_min b ON b.event_id=n.neighbour""")
def _(s, d):
    return r(R.oversample(materialize(scaled_train(s, d), "scaled"), "event_id", FEATURES, target_ratio=0.2), **{c: 6 for c in FEATURES})


@query("m03_oversample_checks", "SELECT * FROM (VALUES " + ",".join(f"('{c}', true, 0::BIGINT, '{n}')" for c, n in (
    ("size_grew", "rows must be added"), ("minority_share_up", "share must rise"), ("no_nulls", "rows with a null feature"), ("same_columns", "feature columns kept"), ("both_classes", "two classes needed"))) + ") t(\"check\", passed, violations, note)")
def _(s, d):
    x = materialize(scaled_train(s, d), "scaled")
    return R.oversample_checks(x, R.oversample(x, "event_id", FEATURES, target_ratio=0.2), FEATURES)


@query("m23_leakage_checks", """SELECT 'test_size' AS check, true AS passed, 0::BIGINT AS violations, 'row count change' AS note UNION ALL SELECT 'test_labels', true, 0, 'changed labels'
    UNION ALL SELECT 'column_parity', true, 0, 'columns on one side only' UNION ALL SELECT 'row_overlap', count(*)=0, count(*), 'rows on both sides' FROM
    (SELECT """ + ", ".join(FEATURES) + " FROM w_split WHERE split='train' INTERSECT SELECT " + ", ".join(FEATURES) + " FROM w_split WHERE split='test') x")
def _(s, d):
    train, test = train_test(s, d)
    up = R.oversample(train, "event_id", FEATURES, target_ratio=0.2)
    # what the test rows must be: the source without the training rows
    source = V.card(s, d).join(train.select("event_id"), "event_id", "left_anti")
    return R.leakage_checks(up, test, source, FEATURES, "event_id")


# --- ranking metrics ---

@query("m06_metric_suite", f"""SELECT round(roc_auc,9) AS roc_auc, round(avg_precision,9) AS avg_precision, round({_P},9) AS precision, round({_R},9) AS recall, round({_F1},9) AS f1, round({_F2},9) AS f2,
    round((tp+tn)/(tp+fp+fn+tn)::DOUBLE,9) AS accuracy, tp::BIGINT AS true_pos, fp::BIGINT AS false_pos, fn::BIGINT AS false_neg, tn::BIGINT AS true_neg FROM ({_suite('v_scored')}) m""")
def metric_query(s, d):
    return r(M.metric_suite(V.scored(s, d)), **{c: 9 for c in M.METRICS})


_cm = "SELECT count(*) FILTER (label=1 AND score_e4>=5000) AS tp, count(*) FILTER (label=0 AND score_e4>=5000) AS fp, count(*) FILTER (label=1 AND score_e4<5000) AS fn, count(*) FILTER (label=0 AND score_e4<5000) AS tn FROM v_scored"
_rep = f"""SELECT {_div('tn', 'tn+fn')} AS p0, {_div('tn', 'tn+fp')} AS r0, {_div('2.0::DOUBLE*tn', '2*tn+fn+fp')} AS f0, tn+fp AS s0, {_P} AS p1, {_R} AS r1, {_F1} AS f1, tp+fn AS s1 FROM ({_cm}) c"""


@query("m07_class_report", f"""SELECT class, round(precision,8) AS precision, round(recall,8) AS recall, round(f1,8) AS f1, support FROM (
    SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM ({_rep}) a UNION ALL SELECT '1', p1, r1, f1, s1 FROM ({_rep}) b
    UNION ALL SELECT 'macro avg', (p0+p1)/2, (r0+r1)/2, (f0+f1)/2, s0+s1 FROM ({_rep}) c
    UNION ALL SELECT 'weighted avg', (p0*s0+p1*s1)/(s0+s1), (r0*s0+r1*s1)/(s0+s1), (f0*s0+f1*s1)/(s0+s1), s0+s1 FROM ({_rep}) e) z""")
def _(s, d):
    return r(M.class_report(V.scored(s, d)), precision=8, recall=8, f1=8)


@query("m08_curve_points", """SELECT score_e4, round(ctp/p::DOUBLE,8) AS tpr, round(cfp/n::DOUBLE,8) AS fpr, round(ctp/(ctp+cfp)::DOUBLE,8) AS precision FROM
    (SELECT score_e4, sum(sum(label)) OVER (ORDER BY score_e4 DESC) AS ctp, sum(sum(1-label)) OVER (ORDER BY score_e4 DESC) AS cfp, sum(sum(label)) OVER () AS p, sum(sum(1-label)) OVER () AS n FROM v_scored GROUP BY score_e4) g""")
def _(s, d):
    return r(M.curve_points(V.scored(s, d)), tpr=8, fpr=8, precision=8)


MODELS = {"model_a": "score_e4", "model_b": "(score_e4 * 3 + event_id % 97 * 50) div 4", "model_c": "event_id * 31 % 10000", "model_d": "score_e4 div 500 * 500"}


def compared(s, d):
    """Four score columns over the same rows, ranked side by side in one grouped pass."""
    x = V.scored(s, d)
    scores = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).cast("bigint").alias("score_e4")) for m, e in MODELS.items()])
    return M.compare_models(M.metric_suite(x.select("label", F.inline(scores)), by=["model"]))


for _m, _e in MODELS.items():
    reg.extra[f"w_{_m}"] = f"SELECT event_id, label, ({_e.replace(' div ', ' // ')})::BIGINT AS score_e4 FROM v_scored"
reg.extra["w_models"] = f"SELECT *, {_ratios}, (tp+tn)/(tp+fp+fn+tn)::DOUBLE AS accuracy FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, * FROM ({_suite('w_' + m)}) q{i}" for i, m in enumerate(MODELS)) + ") u"
reg.extra["w_mrank"] = "SELECT *, row_number() OVER (ORDER BY round(avg_precision,9) DESC, round(f2,9) DESC, round(recall,9) DESC, model) AS rank FROM w_models"


@query("w13_model_ranking", f"SELECT {rounded('model rank roc_auc:9 avg_precision:9 precision:9 recall:9 f1:9 f2:9 accuracy:9')} FROM w_mrank")
def _(s, d):
    return r(compared(s, d).select("model", "rank", *M.METRICS), **{c: 9 for c in M.METRICS})


@query("w02_global_rank", "SELECT model, rank FROM w_mrank")
def _(s, d):
    return compared(s, d).select("model", "rank")


@query("m10_ranking_checks", """SELECT 'sorted_by_avg_precision' AS check, true AS passed, 0::BIGINT AS violations, 'rows out of order' AS note
    UNION ALL SELECT 'auc_ap_in_range', count(*) FILTER (roc_auc NOT BETWEEN 0 AND 1 OR avg_precision NOT BETWEEN 0 AND 1)=0, count(*) FILTER (roc_auc NOT BETWEEN 0 AND 1 OR avg_precision NOT BETWEEN 0 AND 1), 'values outside [0,1]' FROM w_models
    UNION ALL SELECT 'f_scores_non_negative', count(*) FILTER (f1<0 OR f2<0)=0, count(*) FILTER (f1<0 OR f2<0), 'negative values' FROM w_models
    UNION ALL SELECT 'precision_recall_in_range', count(*) FILTER (precision NOT BETWEEN 0 AND 1 OR recall NOT BETWEEN 0 AND 1)=0, count(*) FILTER (precision NOT BETWEEN 0 AND 1 OR recall NOT BETWEEN 0 AND 1), 'values outside [0,1]' FROM w_models
    UNION ALL SELECT 'best_is_rank_one', min(rank)=1, (abs(min(rank)-1))::BIGINT, 'best: ' || arg_min(model,rank) FROM w_mrank""")
def _(s, d):
    return M.ranking_checks(compared(s, d))


@query("m10_best_model", "SELECT arg_min(model,rank) AS best, arg_max(model,rank) AS runner_up, round(arg_min(avg_precision,rank)-arg_max(avg_precision,rank),8) AS lead FROM (SELECT * FROM w_mrank ORDER BY rank LIMIT 2) x")
def _(s, d):
    return r(M.best_models(compared(s, d)), lead=8)


# --- thresholds and impact ---

_sw = "threshold tp fp fn tn precision:6 recall:6 f1:6 f2:6 tpr:6 fpr:6 youden_j:6 cost_fp:2 cost_fn:3 total_cost:3"
_swd = {c.split(":")[0]: int(c.split(":")[1]) for c in _sw.split() if ":" in c}


def sweep_val(s, d):
    return T.sweep(val_test(s, d)[0])


def swept_and_test(s, d):
    """The 81 sweep rows of the validation part, written once and frozen, and the test part."""
    val, test = val_test(s, d)
    return materialize(T.sweep(val), "sweep"), test


@query("m11_threshold_sweep", f"SELECT {rounded(_sw)} FROM w_sweep")
def sweep_query(s, d):
    return r(sweep_val(s, d), **_swd)


@query("j12_scores_by_thresholds", "SELECT t/100.0::DOUBLE AS threshold, count(*) FILTER (score_e4>=t*100) AS flagged FROM v_scored, generate_series(10,90) g(t) GROUP BY t")
def _(s, d):
    return T.sweep(V.scored(s, d)).select("threshold", (F.col("tp") + F.col("fp")).alias("flagged"))


@query("m12_optimal_thresholds", f"SELECT criterion, {rounded(_sw)} FROM w_optima")
def _(s, d):
    return r(T.optima(sweep_val(s, d)), **_swd)


@query("w12_first_tie_rows", "SELECT criterion, threshold FROM w_optima")
def _(s, d):
    return T.optima(sweep_val(s, d)).select("criterion", "threshold")


@query("m13_default_vs_optimal", f"""SELECT name, threshold_e4, tp, fp, fn, tn, round(precision,6) AS precision, round(recall,6) AS recall, round(f1,6) AS f1, round(f2,6) AS f2,
    round(recall-lag(recall) OVER (ORDER BY name),6) AS delta_recall, lag(fn) OVER (ORDER BY name)-fn AS fn_reduced, fp-lag(fp) OVER (ORDER BY name) AS fp_change
    FROM (SELECT CASE name WHEN 'cost_optimal' THEN 'optimal' ELSE name END AS name, threshold_e4, tp, fp, fn, tn, {_ratios} FROM w_applied WHERE name IN ('default','cost_optimal')) x""")
def _(s, d):
    return r(T.default_vs_optimal(*swept_and_test(s, d)), precision=6, recall=6, f1=6, f2=6, delta_recall=6)


_imp = "scenario threshold_e4 tp fp fn tn test_cost:3 annual_cost:0 caught_pct:6 false_alarm_pct:6"


@query("m14_scenario_impact", f"SELECT {rounded(_imp)} FROM w_impact")
def _(s, d):
    return r(T.impact(*swept_and_test(s, d)), test_cost=3, annual_cost=0, caught_pct=6, false_alarm_pct=6)


@query("m15_annual_scale", "SELECT round(count(*)/0.2::DOUBLE/2*365.25,4) AS annual_rows, round(avg(amount) FILTER (label=1)*2.5,6) AS cost_fn FROM w_test")
def _(s, d):
    return r(T.annual_scale(val_test(s, d)[1]), annual_rows=4, cost_fn=6)


@query("m16_cost_sensitivity", """SELECT a.unit_fp::INT AS cost_fp, b.unit_fn::INT AS cost_fn, round(min(fp*unit_fp+fn*unit_fn)*((SELECT count(*) FROM w_test)/0.2::DOUBLE/2*365.25)/(SELECT count(*) FROM w_test)/1e6::DOUBLE,6) AS annual_musd
    FROM w_sweep, generate_series(10,190,20) a(unit_fp), generate_series(50,950,100) b(unit_fn) GROUP BY ALL""")
def _(s, d):
    return r(T.cost_sensitivity(*swept_and_test(s, d)), annual_musd=6)


def _sv(step, x, y, base):
    g = lambda n: f"max(annual_cost) FILTER (scenario='{n}')"
    return f"SELECT '{step}' AS step, round({g(x)}-{g(y)},1) AS saving, round(({g(x)}-{g(y)})/greatest({g(base)},1)*100,6) AS saving_pct FROM w_impact"


@query("m17_savings", " UNION ALL ".join([_sv("none_to_default", "no_model", "default", "no_model"), _sv("none_to_optimal", "no_model", "cost_optimal", "no_model"),
                                           _sv("default_to_optimal", "default", "cost_optimal", "no_model")]))
def _(s, d):
    return r(T.savings(T.impact(*swept_and_test(s, d))), saving=1, saving_pct=6)


# --- attribution ---

@query("m18_linear_attribution", "SELECT event_id, feature, round(contribution,8) AS contribution FROM w_long")
def _(s, d):
    return r(A.linear_long(V.card(s, d), BETA, "event_id").select("event_id", "feature", "contribution"), contribution=8)


_desc = """CASE WHEN starts_with(feature,'v') THEN 'PCA component ' || substr(feature,2) || ' (anonymised)' WHEN feature='amount' THEN 'Transaction amount (USD)'
    WHEN feature='time_s' THEN 'Seconds elapsed since first transaction' ELSE feature END"""


@query("m19_global_importance", f"""SELECT rank, feature, round(mean_abs,8) AS mean_abs, round(mean_positive,8) AS mean_positive, round(correlation,6) AS correlation,
    CASE WHEN correlation>0 THEN 'Higher value -> Higher fraud risk' ELSE 'Lower value  -> Higher fraud risk' END AS direction, {_desc} AS description FROM
    (SELECT *, row_number() OVER (ORDER BY round(mean_abs,9) DESC, feature) AS rank FROM (SELECT feature, avg(abs(contribution)) AS mean_abs, avg(contribution) FILTER (label=1) AS mean_positive,
      corr(value, contribution) AS correlation FROM w_long GROUP BY feature) a) b WHERE rank<=5""")
def _(s, d):
    return r(A.global_importance(A.linear_long(V.card(s, d), BETA, "event_id"), 5), mean_abs=8, mean_positive=8, correlation=6)


@query("f24_feature_description", f"SELECT feature, {_desc} AS description, count(*) AS rows FROM w_long GROUP BY ALL")
def _(s, d):
    x = A.linear_long(V.card(s, d), BETA, "event_id")
    return x.groupBy("feature", A.describe_feature(F.col("feature")).alias("description")).agg(F.count("*").alias("rows"))


@query("f25_percentile_normalise", """SELECT event_id, round(least(greatest((amount-p1)/greatest(p99-p1,1e-9),0),1),6) AS unit FROM v_card, (SELECT quantile_cont(amount,0.01) AS p1, quantile_cont(amount,0.99) AS p99 FROM v_card) q""")
def _(s, d):
    return r(A.percentile_unit(V.card(s, d).select("event_id", "amount"), "amount", "unit").select("event_id", "unit"), unit=6)


@query("m20_dependence", """SELECT event_id, round(value,8) AS value, round(contribution,8) AS contribution, round(correlation,6) AS correlation, round(lo,8) AS clip_lo, round(hi,8) AS clip_hi FROM w_long JOIN w_sample USING (event_id),
    (SELECT corr(value,contribution) AS correlation, quantile_cont(value,0.02) AS lo, quantile_cont(value,0.98) AS hi FROM w_long WHERE feature='v14') c WHERE feature='v14' AND value BETWEEN lo AND hi""")
def _(s, d):
    return r(A.dependence(A.linear_long(V.card(s, d), BETA, "event_id"), "v14", "event_id"), value=8, contribution=8, correlation=6, clip_lo=8, clip_hi=8)


_each = "unnest([" + ", ".join(f"'{c}'" for c in BETA) + "]) AS feature, unnest([" + ", ".join(BETA) + "]) AS value, unnest([" + ", ".join(f"k_{c}" for c in BETA) + "]) AS contribution"


@query("m21_beeswarm", f"""SELECT event_id, feature, round(contribution,8) AS contribution, round(least(greatest((value-p1)/greatest(p99-p1,1e-9),0),1),6) AS unit FROM
    (SELECT *, quantile_cont(value,0.01) OVER (PARTITION BY feature) AS p1, quantile_cont(value,0.99) OVER (PARTITION BY feature) AS p99 FROM
      (SELECT event_id, {_each} FROM w_contrib JOIN w_sample USING (event_id)) u) q""")
def _(s, d):
    return r(A.beeswarm(A.linear_long(V.card(s, d), BETA, "event_id"), 15, "event_id"), contribution=8, unit=6)


@query("m22_single_explanation", """SELECT event_id, feature, round(contribution,8) AS contribution, rank, round(coalesce(sum(contribution) OVER (ORDER BY rank DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0),8) AS start_at
    FROM (SELECT event_id, feature, contribution, row_number() OVER (ORDER BY round(abs(contribution),9) DESC, feature) AS rank FROM w_long JOIN w_top USING (event_id)) x WHERE rank<=12""")
def _(s, d):
    return r(A.explain_top_positive(A.linear_long(V.card(s, d), BETA, "event_id"), "event_id", base=0.0).select("event_id", "feature", "contribution", "rank", "start_at"), contribution=8, start_at=8)


@query("w11_waterfall_offsets", """SELECT feature, rank, round(coalesce(sum(contribution) OVER (ORDER BY rank DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)-4.5,8) AS start_at
    FROM (SELECT feature, contribution, row_number() OVER (ORDER BY round(abs(contribution),9) DESC, feature) AS rank FROM w_long JOIN w_top USING (event_id)) x WHERE rank<=12""")
def _(s, d):
    return r(A.explain_top_positive(A.linear_long(V.card(s, d), BETA, "event_id"), "event_id", base=-4.5).select("feature", "rank", "start_at"), start_at=8)
