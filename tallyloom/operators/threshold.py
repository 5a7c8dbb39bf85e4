"""Threshold sweep, optima, scenario costs and sensitivity, all from one aggregation of at most 101 buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.fixed_values import CHARGEBACK, COST_FP_USD
from ..functions.semantics import count_true
from .metrics import f_beta, over

LO, HI = 10, 90  # thresholds in hundredths


def buckets(scored: DataFrame) -> DataFrame:
    """Rows per hundredth of score: positives, negatives and positive amount in cents (exact integers)."""
    one = F.col("label") == 1
    cents = F.round(F.col("amount") * 100).cast("bigint")
    return scored.groupBy(F.expr("score_e4 div 100").alias("b")).agg(
        count_true(one).alias("pos"), count_true(~one).alias("neg"), F.coalesce(F.sum(F.when(one, cents)), F.lit(0)).alias("pos_cents"))


def sweep(scored: DataFrame, lo: int = LO, hi: int = HI, cost_fp: float = COST_FP_USD, chargeback: float = CHARGEBACK) -> DataFrame:
    """One row per threshold; a score on the threshold counts as flagged. Suffix sums replace one pass per threshold."""
    spark = scored.sparkSession
    grid = spark.range(lo, hi + 1).select(F.col("id").alias("b"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg"), F.lit(0).cast("bigint").alias("pos_cents"))
    cells = buckets(scored).unionByName(grid).groupBy("b").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "pos_cents")])
    down = W.orderBy(F.col("b").desc()).rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    s = cells.select("b", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.sum("pos").over(everything).alias("p"),
                     F.sum("neg").over(everything).alias("n"), (F.sum("pos_cents").over(everything) - F.sum("pos_cents").over(down)).alias("missed"))
    s = s.filter(F.col("b").between(lo, hi)).withColumn("fn", F.col("p") - F.col("tp")).withColumn("tn", F.col("n") - F.col("fp"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return s.select((F.col("b") / 100).alias("threshold"), "tp", "fp", "fn", "tn", over(tp, tp + fp).alias("precision"), over(tp, tp + fn).alias("recall"),
                    f_beta(tp, fp, fn, 1).alias("f1"), f_beta(tp, fp, fn, 2).alias("f2"), over(tp, tp + fn).alias("tpr"), over(fp, fp + tn).alias("fpr"),
                    (over(tp, tp + fn) - over(fp, fp + tn)).alias("youden_j"), (fp * cost_fp).alias("cost_fp"), (F.col("missed") * (chargeback / 100)).alias("cost_fn"),
                    (fp * cost_fp + F.col("missed") * (chargeback / 100)).alias("total_cost"))


OPTIMA = (("f1_optimal", "f1", True), ("f2_optimal", "f2", True), ("cost_optimal", "total_cost", False), ("youden_optimal", "youden_j", True))


def optima(swept: DataFrame) -> DataFrame:
    """The sweep row of each optimum; ties go to the lowest threshold."""
    best = lambda m, up: F.min_by(F.struct(*swept.columns), F.struct(F.round(-F.col(m) if up else F.col(m), 6), F.col("threshold")))
    return swept.agg(*[best(m, up).alias(name) for name, m, up in OPTIMA]).select(
        F.inline(F.array(*[F.struct(F.lit(name).alias("criterion"), *[F.col(name)[c].alias(c) for c in swept.columns]) for name, _, _ in OPTIMA])))


def apply_thresholds(scored: DataFrame, named: DataFrame, cost_fp: float = COST_FP_USD, chargeback: float = CHARGEBACK) -> DataFrame:
    """Confusion and cost for a few (name, threshold_e4) rows. Rows collapse to distinct scores before meeting the names."""
    one = F.col("label") == 1
    g = scored.groupBy("score_e4").agg(count_true(one).alias("pos"), count_true(~one).alias("neg"),
                                       F.coalesce(F.sum(F.when(one, F.round(F.col("amount") * 100).cast("bigint"))), F.lit(0)).alias("cents"))
    names = named.agg(F.collect_list(F.struct("name", "threshold_e4")).alias("l")).scalar()  # a handful of scenarios
    x = g.withColumn("_l", names).select("score_e4", "pos", "neg", "cents", F.inline("_l"))
    hit = F.col("score_e4") >= F.col("threshold_e4")
    s = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    return x.groupBy("name", "threshold_e4").agg(
        s(hit, "pos").alias("tp"), s(hit, "neg").alias("fp"), s(~hit, "pos").alias("fn"), s(~hit, "neg").alias("tn"), s(~hit, "cents").alias("missed")).withColumn(
        "cost", F.col("fp") * cost_fp + F.col("missed") * (chargeback / 100)).drop("missed")


def default_vs_optimal(swept: DataFrame, test: DataFrame) -> DataFrame:
    """The 0.50 row and the cost optimum of the sweep, both applied to the test rows, with the changes."""
    base = swept.filter(F.col("threshold").between(0.499, 0.501)).select(F.lit("default").alias("name"), (F.col("threshold") * 10000).cast("bigint").alias("threshold_e4"))
    best = optima(swept).filter(F.col("criterion") == "cost_optimal").select(F.lit("optimal").alias("name"), F.round(F.col("threshold") * 10000).cast("bigint").alias("threshold_e4"))
    c = apply_thresholds(test, base.unionByName(best))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    c = c.select("name", "threshold_e4", "tp", "fp", "fn", "tn", over(tp, tp + fp).alias("precision"), over(tp, tp + fn).alias("recall"), f_beta(tp, fp, fn, 1).alias("f1"), f_beta(tp, fp, fn, 2).alias("f2"))
    pair = W.orderBy("name")
    prev = lambda x: F.lag(x).over(pair)
    return c.withColumn("delta_recall", F.col("recall") - prev("recall")).withColumn("fn_reduced", prev("fn") - F.col("fn")).withColumn("fp_change", F.col("fp") - prev("fp"))


def annual_scale(scored: DataFrame, test_share: float = 0.2, days: float = 2.0) -> DataFrame:
    """Rows scaled from the test share of a few days to a year, and the cost of a missed case."""
    return scored.agg((F.count("*") / test_share / days * 365.25).alias("annual_rows"),
                      (F.avg(F.when(F.col("label") == 1, F.col("amount"))) * CHARGEBACK).alias("cost_fn"))


SCENARIOS = ("no_model", "default", "f2_optimal", "cost_optimal", "catch_all")


def scenario_table(swept: DataFrame) -> DataFrame:
    o = optima(swept).select(F.col("criterion").alias("name"), F.round(F.col("threshold") * 10000).cast("bigint").alias("threshold_e4")).filter(F.col("name").isin("f2_optimal", "cost_optimal"))
    fixed = swept.sparkSession.createDataFrame([("no_model", 9999), ("default", 5000), ("catch_all", 1)], "name string, threshold_e4 bigint")
    return o.unionByName(fixed)


def impact(swept: DataFrame, test: DataFrame) -> DataFrame:
    """Five scenarios with test cost, annual cost, share caught and false alarms."""
    c = apply_thresholds(test, scenario_table(swept))
    scale = annual_scale(test).select("annual_rows").scalar()
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return c.select(F.col("name").alias("scenario"), "threshold_e4", "tp", "fp", "fn", "tn", F.col("cost").alias("test_cost"), (F.col("cost") * scale / n).alias("annual_cost"),
                    (over(F.col("tp"), F.col("tp") + F.col("fn")) * 100).alias("caught_pct"), (over(F.col("fp"), F.col("fp") + F.col("tn")) * 100).alias("false_alarm_pct"))


def savings(impacts: DataFrame) -> DataFrame:
    """Annual savings between scenarios; the base is at least 1."""
    pick = lambda name: F.max(F.when(F.col("scenario") == name, F.col("annual_cost")))
    a = impacts.agg(pick("no_model").alias("none"), pick("default").alias("dflt"), pick("cost_optimal").alias("opt"))
    row = lambda name, x, y, base: F.struct(F.lit(name).alias("step"), (F.col(x) - F.col(y)).alias("saving"), ((F.col(x) - F.col(y)) / F.greatest(F.col(base), F.lit(1.0)) * 100).alias("saving_pct"))
    return a.select(F.inline(F.array(row("none_to_default", "none", "dflt", "none"), row("none_to_optimal", "none", "opt", "none"), row("default_to_optimal", "dflt", "opt", "none"))))


def cost_sensitivity(swept: DataFrame, test: DataFrame) -> DataFrame:
    """Cheapest annual cost in millions for 10 x 10 unit costs; 81 sweep rows times 100 cells, nothing larger."""
    st = annual_scale(test).select((F.col("annual_rows")).alias("s")).scalar()
    n = test.agg(F.count("*").alias("n")).scalar()
    g = swept.select("fp", "fn", F.explode(F.sequence(F.lit(10), F.lit(190), F.lit(20))).alias("cost_fp"))
    g = g.select("fp", "fn", "cost_fp", F.explode(F.sequence(F.lit(50), F.lit(950), F.lit(100))).alias("cost_fn"))
    return g.groupBy("cost_fp", "cost_fn").agg(F.min(F.col("fp") * F.col("cost_fp") + F.col("fn") * F.col("cost_fn")).alias("m")).select(
        "cost_fp", "cost_fn", (F.col("m") * st / n / 1e6).alias("annual_musd"))
