"""Ranking and confusion metrics for scored rows: exact with ties, one pass over the rows.

Scores are either integers in 1/10000 units (score_e4), so that a score exactly on a threshold is never a rounding matter, or a model's unrounded
probabilities. Everything starts from one row per distinct score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.semantics import count_true
from .ordered import running_totals, with_bucket

METRICS = ("roc_auc", "avg_precision", "precision", "recall", "f1", "f2", "accuracy")


def score_units(score: Column) -> Column:
    """A probability as an integer number of 1/10000."""
    return F.floor(score * 10000 + 1e-9).cast("bigint")


def score_groups(scored: DataFrame, by: list[str] = (), score: str = "score_e4") -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest score down.

    The scale of score_e4 has 10,001 values, so hundredths of it are ready-made, evenly sized buckets; other scores get ordered buckets of their own.
    """
    by = list(by)
    g = scored.groupBy(*by, score).agg(count_true(F.col("label") == 1).alias("pos"), count_true(F.col("label") == 0).alias("neg"))
    if score == "score_e4":
        g = g.withColumn("_bucket", -F.floor(F.col(score) / 100))
    else:
        g = with_bucket(g.withColumn("_down", -F.col(score)), "_down").drop("_down")
    return running_totals(g, [F.col(score).desc()], {"tp": "pos", "fp": "neg"}, by)


def f_beta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b2 = beta * beta
    den = (1 + b2) * tp + b2 * fn + fp
    return F.when(den > 0, (1 + b2) * tp / den).otherwise(F.lit(0.0)).cast("double")


def over(a: Column, b: Column) -> Column:
    """a/b with 0 for an empty denominator."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")


def metric_suite(scored: DataFrame, threshold: float = 5000, by: list[str] = (), score: str = "score_e4") -> DataFrame:
    """ROC-AUC with mid-ranks for ties, step-sum average precision, and the metrics at a threshold on the score's own scale."""
    by = list(by)
    g = score_groups(scored, by, score)
    p, n = F.sum("pos"), F.sum("neg")
    hit = F.col(score) >= threshold
    tp, fp = F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)), F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0))
    # positives before half of the tied negatives: counted as wins of each negative's rank
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + F.col("neg") * F.col("pos") * 0.5)
    ap = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    a = g.groupBy(*by).agg(p.alias("p"), n.alias("n"), tp.alias("tp"), fp.alias("fp"), wins.alias("w"), ap.alias("ap"))
    fn, tn = F.col("p") - F.col("tp"), F.col("n") - F.col("fp")
    return a.select(*by, over(F.col("w"), F.col("p") * F.col("n")).alias("roc_auc"), over(F.col("ap"), F.col("p")).alias("avg_precision"),
                    over(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), over(F.col("tp"), F.col("p")).alias("recall"),
                    f_beta(F.col("tp"), F.col("fp"), fn, 1).alias("f1"), f_beta(F.col("tp"), F.col("fp"), fn, 2).alias("f2"),
                    over(F.col("tp") + tn, F.col("p") + F.col("n")).alias("accuracy"),
                    F.col("tp").alias("true_pos"), F.col("fp").alias("false_pos"), fn.alias("false_neg"), tn.alias("true_neg"))


def confusion(scored: DataFrame, threshold_e4: int = 5000) -> DataFrame:
    hit, one = F.col("score_e4") >= threshold_e4, F.col("label") == 1
    return scored.agg(count_true(hit & one).alias("tp"), count_true(hit & ~one).alias("fp"), count_true(~hit & one).alias("fn"), count_true(~hit & ~one).alias("tn"))


def class_report(scored: DataFrame, threshold_e4: int = 5000) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    c = confusion(scored, threshold_e4).select(
        over(tn, tn + fn).alias("p0"), over(tn, tn + fp).alias("r0"), f_beta(tn, fn, fp, 1).alias("f0"), (tn + fp).alias("s0"),
        over(tp, tp + fp).alias("p1"), over(tp, tp + fn).alias("r1"), f_beta(tp, fp, fn, 1).alias("f1"), (tp + fn).alias("s1"))
    n = F.col("s0") + F.col("s1")
    row = lambda name, p, r_, f, s: F.struct(F.lit(name).alias("class"), p.alias("precision"), r_.alias("recall"), f.alias("f1"), s.alias("support"))
    mean = lambda k: (F.col(f"{k}0") + F.col(f"{k}1")) / 2
    wmean = lambda k: over(F.col(f"{k}0") * F.col("s0") + F.col(f"{k}1") * F.col("s1"), n)
    cl = lambda i: [F.col(f"{k}{i}") for k in "prfs"]
    return c.select(F.inline(F.array(row("0", *cl(0)), row("1", *cl(1)), row("macro avg", mean("p"), mean("r"), mean("f"), n),
                                     row("weighted avg", wmean("p"), wmean("r"), wmean("f"), n))))


def curve_points(scored: DataFrame) -> DataFrame:
    """ROC and precision-recall points per distinct score."""
    g = score_groups(scored)
    t = scored.agg(F.struct(count_true(F.col("label") == 1).alias("p"), count_true(F.col("label") == 0).alias("n")).alias("t")).scalar()
    g = g.withColumn("_t", t)
    return g.select("score_e4", over(F.col("tp"), F.col("_t.p")).alias("tpr"), over(F.col("fp"), F.col("_t.n")).alias("fpr"),
                    over(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def compare_models(suites: DataFrame) -> DataFrame:
    """Rank by average precision, then F2, then recall; the table has one row per model."""
    from pyspark.sql import Window as W

    w = W.orderBy(F.round("avg_precision", 9).desc(), F.round("f2", 9).desc(), F.round("recall", 9).desc(), "model")
    return suites.withColumn("rank", F.row_number().over(w).cast("bigint"))


def ranking_checks(ranked: DataFrame) -> DataFrame:
    """Five checks of the comparison table."""
    from pyspark.sql import Window as W

    from .quality import check_table

    prev = F.lag("avg_precision").over(W.orderBy("rank"))
    unit = lambda c: ~F.col(c).between(0.0, 1.0)
    one = ranked.withColumn("_prev", prev).agg(
        count_true(F.col("avg_precision") > F.col("_prev")).alias("a"), count_true(unit("avg_precision") | unit("roc_auc")).alias("b"),
        count_true((F.col("f1") < 0) | (F.col("f2") < 0)).alias("c"), count_true(unit("precision") | unit("recall")).alias("d"),
        F.abs(F.min("rank") - 1).alias("e"), F.min_by("model", "rank").alias("best"))
    note = lambda t: F.lit(t)
    return check_table(one, [("sorted_by_avg_precision", F.col("a"), note("rows out of order")), ("auc_ap_in_range", F.col("b"), note("values outside [0,1]")),
                             ("f_scores_non_negative", F.col("c"), note("negative values")), ("precision_recall_in_range", F.col("d"), note("values outside [0,1]")),
                             ("best_is_rank_one", F.col("e"), F.concat(F.lit("best: "), F.col("best")))])


def best_models(ranked: DataFrame) -> DataFrame:
    """Best model and runner-up with the lead in average precision."""
    top = ranked.orderBy("rank").limit(2)
    return top.agg(F.min_by("model", "rank").alias("best"), F.max_by("model", "rank").alias("runner_up"),
                   (F.min_by("avg_precision", "rank") - F.max_by("avg_precision", "rank")).alias("lead"))
