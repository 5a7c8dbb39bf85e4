"""Registered model-fitting queries. Fits have no SQL form; the likelihood they maximise does."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attribution as A, cleaning as C, clv, fitting as FT, models as ML, resample as R, splits as P, threshold as T
from ..operators.metrics import METRICS, compare_models, score_units
from ..session import SPREAD_FROM, materialize, materialize_spread, spread
from . import customer_value as CV, detection as DT
from .registry import Registry, r

FEATURES = [*DT.FEATURES, "hour_of_day", "amount_log", "amount_zscore"]
_m = CV.MODEL
_x, _t, _T = "frequency", "(recency/7.0::DOUBLE)", "(T/7.0::DOUBLE)"
_r, _al, _a, _b = (f"{_m[k]!r}::DOUBLE" for k in ("r", "alpha", "a", "b"))
_a3, _a4 = f"(-({_r}+{_x})*ln({_al}+{_T}))", f"(ln({_a})-ln({_b}+greatest({_x},1)-1)-({_r}+{_x})*ln({_al}+{_t}))"
reg = Registry(CV.EXTRA)
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


@query("c01_log_likelihood", f"""SELECT customer_id, round(lgamma({_r}+{_x})-lgamma({_r})+{_r}*ln({_al})+lgamma({_a}+{_b})+lgamma({_b}+{_x})-lgamma({_b})-lgamma({_a}+{_b}+{_x})
    +CASE WHEN {_x}>0 THEN greatest({_a3},{_a4})+ln(exp({_a3}-greatest({_a3},{_a4}))+exp({_a4}-greatest({_a3},{_a4}))) ELSE {_a3} END,6) AS ll FROM w_rfm""")
def _(s, d):
    return r(FT.log_likelihood(CV.summary(s, d), CV.MODEL), ll=6)


def eligible(s, d):
    return CV.summary(s, d).filter(F.col("T") >= 90)


def _params(s, p, fit):
    rows = [*p.items(), ("objective", fit.value), ("converged", fit.converged), ("rounds", fit.rounds), ("at_bound", len(fit.bounds))]
    return s.createDataFrame([(k, float(v)) for k, v in rows], "parameter string, value double")


@query("c01_fit_purchases")
def _(s, d):
    return r(_params(s, *FT.fit_purchases(eligible(s, d), 0.001)), value=3)


@query("c02_penalty_sweep")
def _(s, d):
    return r(FT.penalty_sweep(eligible(s, d)), **{c: 3 for c in ("r", "alpha", "a", "b", "dropout_share", "objective")})


@query("c03_fit_spend")
def _(s, d):
    return r(_params(s, *FT.fit_spend(C.repeat_buyers(eligible(s, d)))), value=2)


# --- from fitted models to scores and report ---

_VALUED: dict = {}


def value_chain(s, d):
    """(purchase parameters, spend parameters, scored customers): the swept penalty's purchase model and the fitted spend model score every customer. One fit a session and folder."""
    key = s.sparkContext.applicationId, d
    if key not in _VALUED:
        rows = materialize(CV.summary(s, d), "value-summary")
        old_enough = rows.filter(F.col("T") >= 90)
        best = FT.penalty_sweep(old_enough).filter("chosen").first()
        p, g = {k: best[k] for k in FT.PURCHASE_NAMES}, FT.fit_spend(C.repeat_buyers(old_enough))[0]
        _VALUED[key] = p, g, materialize(clv.score(rows, p, g).withColumn("at_risk", clv.at_risk()), "fitted-values")
    return _VALUED[key]


@query("c07_fitted_scores")
def _(s, d):
    """Every customer with the parameters that scored it, so that any engine can recompute the figures."""
    p, g, scored = value_chain(s, d)
    fitted = [F.lit(float(v)).alias(f"{model}_{k}") for model, names in (("purchase", p), ("spend", g)) for k, v in names.items()]
    return scored.select("customer_id", "frequency", "recency", "T", "monetary_value", "predicted_purchases", "expected_avg_spend", "cltv_90d", "prob_alive", "at_risk", *fitted)


@query("c09_fitted_segments")
def _(s, d):
    return r(clv.segment(value_chain(s, d)[2]).select("customer_id", "cltv_90d", "cltv_segment"), cltv_90d=4)


@query("c10_fitted_report")
def _(s, d):
    return r(clv.validation_report(value_chain(s, d)[2]), predicted_purchases_90d=6, expected_avg_spend=3, cltv_90d=4)


@query("c12_fitted_tier_shares")
def _(s, d):
    return r(clv.tier_shares(value_chain(s, d)[2]), revenue_pct=6, customer_pct=6)


@query("a21_fitted_shrinkage")
def _(s, d):
    _p, g, scored = value_chain(s, d)
    return r(clv.shrinkage_check(scored, g), observed=3, predicted=3, shrinkage=6, theory=6)


LEAF_WISE = {"rounds": 25, "rate": 0.3}  # a level of a tree is a job: fewer, stronger trees


def prepared(s, d):
    """Training rows with synthetic ones, so that the classes are equal, and test rows as they are."""
    train, test = DT.train_test(s, d)
    a, b = P.engineer(train, train), P.engineer(test, train)
    rows = materialize(a.select("event_id", "label", *FEATURES), "engineered")
    up = R.oversample(rows, "event_id", FEATURES, target_ratio=1.0).select("event_id", "label", F.lit(1.0).alias("weight"), *FEATURES)
    return materialize_spread(up, R.sizes_after(rows)[2], "train", "event_id"), b.select("event_id", "label", *FEATURES)


def _with_features(rows):
    return ML.assemble(rows.withColumn("w", F.col("weight")), FEATURES, keep=["w"]).withColumnRenamed("w", "weight")


def _assembled(s, d):
    train, test = prepared(s, d)
    return _with_features(train), ML.assemble(test, FEATURES), test


@query("m04_classifiers")
def _(s, d):
    train, test, _raw = _assembled(s, d)
    suites, _models = ML.train_and_measure(train, test, ML.classifiers(rows=train.count(), leaf_wise=LEAF_WISE))
    return r(compare_models(suites).select("rank", "model", *METRICS), **{c: 4 for c in METRICS})


@query("m04_balanced_forest")
def _(s, d):
    train, test = DT.train_test(s, d)
    a, b = P.engineer(train, train), P.engineer(test, train)
    suites, _models = ML.train_and_measure(_with_features(spread(materialize(ML.with_weights(a), "weighted"), "spread-weighted", "event_id")), ML.assemble(b, FEATURES), {"balanced_forest": ML.balanced_forest()})
    return r(suites.select("model", *METRICS), **{c: 4 for c in METRICS})


# --- from fitted model to frozen impact ---

_FITTED: dict = {}


def chain(s, d):
    """(model, validation scores, test scores, test rows): the leaf-wise model fitted on oversampled rows that neither the validation nor the test rows took part in. One fit a session and folder."""
    key = s.sparkContext.applicationId, d
    if key not in _FITTED:
        rest, test = DT.train_test(s, d)
        parts = materialize(P.stratified_split(rest, "event_id", test_share=0.2, seed=7, names=("main", "val")), "validation-split")
        main, val = (parts.filter(F.col("split") == n).drop("split") for n in ("main", "val"))
        fit, val, test = (materialize(P.engineer(x, main).select("event_id", "label", *FEATURES), n) for x, n in ((main, "main"), (val, "val"), (test, "test")))
        up = R.oversample(fit, "event_id", FEATURES, target_ratio=1.0).withColumn("weight", F.lit(1.0))
        if fit.count() >= SPREAD_FROM:
            up = materialize_spread(up, R.sizes_after(fit)[2], "chain-train", "event_id")
        model = ML.classifiers(leaf_wise=LEAF_WISE)["boosted_trees_b"].fit(_with_features(up))

        def scores(x, name):
            p = ML.vector_to_array(F.col("probability"))[1]
            full = model.transform(ML.assemble(x, FEATURES, keep=["event_id", "amount"]))
            return materialize(full.select("event_id", F.col("label").cast("int").alias("label"), "amount", p.alias("score")).withColumn("score_e4", score_units(F.col("score"))), name)

        _FITTED[key] = model, scores(val, "val-scores"), scores(test, "test-scores"), test
    return _FITTED[key]


@query("m04_chain_scores")
def _(s, d):
    _model, val, test, _rows = chain(s, d)
    return r(val.withColumn("part", F.lit("val")).unionByName(test.withColumn("part", F.lit("test"))), score=6)


@query("m11_chain_sweep")
def _(s, d):
    return r(T.sweep(chain(s, d)[1]), **DT._swd)


@query("m14_chain_impact")
def _(s, d):
    """The threshold is swept and frozen on validation rows; only then the test rows are seen."""
    _model, val, test, _rows = chain(s, d)
    return r(T.impact(materialize(T.sweep(val), "sweep"), test), test_cost=3, annual_cost=0, caught_pct=6, false_alarm_pct=6)


def chain_long(s, d):
    """Exact Shapley contributions of the fitted model to the log-odds of every test row, over all its features."""
    model, _val, _test, rows = chain(s, d)
    return ML.tree_contributions(model, rows, "event_id", FEATURES)


def _features_only(s, d):
    return materialize(chain_long(s, d).filter("feature <> '(base)'"), "contributions")


@query("m18_boosted_attribution")
def _(s, d):
    return r(chain_long(s, d), value=6, contribution=6)


@query("m19_fitted_importance")
def _(s, d):
    return r(A.global_importance(_features_only(s, d), 5), mean_abs=6, mean_positive=6, correlation=6)


@query("m20_fitted_dependence")
def _(s, d):
    long = _features_only(s, d)
    best = A.global_importance(long, 1).first()["feature"]
    return r(A.dependence(long, best, "event_id").withColumn("feature", F.lit(best)), value=6, contribution=6, correlation=6, clip_lo=6, clip_hi=6)


@query("m21_fitted_beeswarm")
def _(s, d):
    return r(A.beeswarm(_features_only(s, d), 15, "event_id"), contribution=6, unit=6)


@query("m22_fitted_explanation")
def _(s, d):
    long = materialize(chain_long(s, d), "contributions")
    base = long.filter("feature = '(base)'").first()["contribution"]
    return r(A.explain_top_positive(long.filter("feature <> '(base)'"), "event_id", base=base).select("event_id", "feature", "contribution", "rank", "start_at"), contribution=6, start_at=6)


@query("m05_resampled_cross_validation")
def _(s, d):
    train, _t = DT.train_test(s, d)
    forest = ML.classifiers(trees=100)["random_forest"].setCacheNodeIds(False)  # four folds at a time: the memory for their rows' nodes would be held four times
    return r(ML.cross_validate(materialize(train, "cv-rows"), "event_id", DT.FEATURES, forest), mean=4, std=4)


@query("m09_feature_importance")
def _(s, d):
    train, _t, _raw = _assembled(s, d)
    est = ML.classifiers(rows=train.count(), leaf_wise=LEAF_WISE)
    models = ML.fit_all(train, {k: est[k] for k in ("logistic_regression", "random_forest", "boosted_trees_b")})
    return r(ML.side_by_side(ML.importance(models, FEATURES, s), list(models)), logistic_regression=4, random_forest=4, boosted_trees_b=4)


@query("m18_tree_attribution")
def _(s, d):
    train, _t, raw = _assembled(s, d)
    model = ML.classifiers(rows=train.count())["random_forest"].fit(train)
    return r(ML.tree_contributions(model, raw, "event_id", FEATURES), value=6, contribution=6)
