"""Order-dependent results without a one-task window: running totals, exact quantiles, exact ranks.

Pattern: values are cut into ordered buckets, one small table of bucket totals gives each bucket its
starting offset, and windows only run inside a bucket. Any cut is correct; a good cut only balances.
Quantiles and top shares only open the cells in which a wanted rank lies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.semantics import hash_number, order_hash
from ..session import materialize

STEPS = 256  # cells of an e-fold of values, for selection
PREFIX = 3  # hex digits of the hash order that are counted to find a cut


def bucket_count(df: DataFrame) -> int:
    """Four buckets per shuffle partition, so that buckets grow in number with the cluster."""
    return max(16, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def with_bucket(df: DataFrame, col: str, name: str = "_bucket") -> DataFrame:
    """Ordered bucket number of a numeric column, from approximate quantiles of that column."""
    n = bucket_count(df)
    cuts = df.approxQuantile(col, [i / n for i in range(1, n)], 0.5 / n)
    cuts = sorted({float(c) for c in cuts})
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    return Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol=f"{name}_in", outputCol=name).transform(
        df.withColumn(f"{name}_in", F.col(col).cast("double"))).drop(f"{name}_in")


def running_totals(df: DataFrame, order_by: list[Column], sums: dict[str, str], by: list[str] = (),
                   totals: dict[str, str] | None = None, bucket: str = "_bucket") -> DataFrame:
    """Add inclusive running sums ``{new column: source column}`` per ``by`` in the given order.

    ``totals`` adds whole-group sums, which come from the same small table as the offsets, so no join
    on the group alone is ever needed. ``bucket`` must be non-decreasing in the order.
    """
    by, totals = list(by), totals or {}
    cells = df.groupBy(*by, bucket).agg(*[F.sum(src).alias(f"_o_{name}") for name, src in sums.items()],
                                        *[F.sum(src).alias(f"_t_{name}") for name, src in totals.items()])
    # one row per group and bucket, so these windows are small whatever the table size
    before = W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(*by, bucket, *[F.coalesce(F.sum(f"_o_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in sums],
                           *[F.sum(f"_t_{name}").over(W.partitionBy(*by)).alias(name) for name in totals])
    local = W.partitionBy(*by, bucket).orderBy(*order_by).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = df.select("*", *[F.sum(src).over(local).alias(f"_l_{name}") for name, src in sums.items()])
    # same keys as the window above: the rows are already partitioned for this join; a null group is a group like any other
    named = offsets.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, bucket)], *[f"_o_{n}" for n in sums], *totals)
    joined = out.join(named, same_keys(out, named, [*by, bucket]))
    return joined.select(*df.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums], *totals).drop(bucket)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the keys with their copies (prefix _k_) on the right."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_k_{c}"]) for c in keys])


def value_counts(df: DataFrame, col: str, by: list[str] = (), **sums: str) -> DataFrame:
    """One row per distinct value: ties and hot values collapse before anything is ordered. NaN counts as missing, like null."""
    return df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).groupBy(*by, col).agg(
        F.count("*").alias("n"), *[F.sum(src).alias(name) for name, src in sums.items()])


def prefix(value: Column) -> Column:
    """An integer that never falls when the value rises: sign, and some leading digits of the logarithm (which Java promises to be semi-monotonic)."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.least(F.log1p(F.abs(v)) * STEPS, F.lit(1e6)))).cast("int")


def _counted(df: DataFrame, col: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (by..., _v, _cell) without missing values, and the cells of equal prefix with their count, sum, lowest and highest value: the first scan."""
    keyed = df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).select(*by, F.col(col).alias("_v"), prefix(F.col(col)).alias("_cell"))
    return keyed, keyed.groupBy(*by, "_cell").agg(F.count("*").alias("_n"), F.sum("_v").alias("_s"), F.min("_v").cast("double").alias("_a"), F.max("_v").cast("double").alias("_b"))


def _inside(keyed: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Distinct values of the wanted cells with their counts and a bucket that cuts a cell evenly: the second scan, which moves nothing of the other cells."""
    named = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, "_cell")], "_a", "_b")
    near = keyed.join(named, same_keys(keyed, named, [*by, "_cell"])).groupBy(*by, "_cell", "_a", "_b", "_v").agg(F.count("*").alias("n"))
    place = F.when(F.col("_b") > F.col("_a"), (F.col("_v").cast("double") - F.col("_a")) / (F.col("_b") - F.col("_a"))).otherwise(0.0)
    return near.select(*by, "_cell", "_v", "n", F.floor(F.least(F.greatest(place, F.lit(0.0)), F.lit(1.0)) * 1024).cast("int").alias("_bucket"))


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles per group in two scans.

    The first counts values by an order-preserving prefix and so finds the cells in which the wanted ranks lie; the second looks at the values of these cells only.
    """
    by = list(by)
    keyed, cells = _counted(df, col, by)
    # a bounded number of cells of each group
    upto = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    cells = cells.select("*", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(W.partitionBy(*by)).alias("_total"))
    last, before = F.col("_total") - 1, F.col("_upto") - F.col("_n")
    ranks = F.array(*[f(last * p).cast("bigint") for p in probs.values() for f in (F.floor, F.ceil)])
    wanted = materialize(cells.withColumn("_before", before).filter(F.exists(ranks, lambda x: (x >= F.col("_before")) & (x < F.col("_upto")))), "cells")
    inside = running_totals(_inside(keyed, wanted, by), [F.col("_v")], {"cum": "n"}, [*by, "_cell"])
    named = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, "_cell")], "_before", "_total")
    cum = inside.join(named, same_keys(inside, named, [*by, "_cell"])).withColumn("cum", F.col("cum") + F.col("_before"))
    at = lambda pos: F.min(F.when(F.col("cum") > pos, F.col("_v")))
    aggs = []
    for name, p in probs.items():
        aggs += [at(F.floor(last * p)).alias(f"_lo_{name}"), at(F.ceil(last * p)).alias(f"_hi_{name}"),
                 F.max(last * p - F.floor(last * p)).alias(f"_f_{name}")]
    out = cum.groupBy(*by).agg(*aggs)
    return out.select(*by, *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in probs])


def hash_rank(df: DataFrame, id_col: str, by: list[str] = (), seed: int = 42, name: str = "rank", size: str = "group_size") -> DataFrame:
    """1-based rank of every row per group, and the group size, in a reproducible random order; independent of partitioning."""
    n = bucket_count(df)
    cut = df.withColumn("_h", order_hash(id_col, seed)).withColumn("_bucket", F.floor(hash_number(id_col, seed, digits=8) * n / 2 ** 32)).withColumn("_one", F.lit(1))
    return running_totals(cut, [F.col("_h"), F.col(id_col)], {name: "_one"}, by, {size: "_one"}).drop("_h", "_one")


def hash_cuts(df: DataFrame, id_col: str, by: list[str], positions: list[Column], seed: int = 42) -> DataFrame:
    """Per group the place in the hash order of the ids at each of ``positions`` (columns over ``_size``, the group's size; 0 gives null).

    (by..., cut_0, cut_1, ...) with a cut as struct (hash, id). Only counts of hash prefixes are gathered, then the rows of the one prefix in which a position falls
    are ranked, so no row of ``df`` is moved but a few ids.
    """
    by = list(by)
    keyed = df.select(*by, F.col(id_col).alias("_id"), order_hash(id_col, seed).alias("_h")).withColumn("_p", F.substring("_h", 1, PREFIX))
    cells = keyed.groupBy(*by, "_p").agg(F.count("*").alias("_n"))
    # at most 16 ** PREFIX cells of each group
    upto = W.partitionBy(*by).orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)
    cells = cells.select("*", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(W.partitionBy(*by)).alias("_size"))
    wanted = cells.select("*", F.posexplode(F.array(*[p.cast("bigint") for p in positions])).alias("_cut", "_pos")).filter("_pos > _upto - _n AND _pos <= _upto")
    wanted = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, "_p")], "_cut", (F.col("_pos") - F.col("_upto") + F.col("_n")).alias("_at"))
    near = keyed.join(wanted, same_keys(keyed, wanted, [*by, "_p"]))
    ranked = near.withColumn("_rank", F.row_number().over(W.partitionBy(*by, "_cut").orderBy("_h", "_id"))).filter("_rank = _at")
    return ranked.groupBy(*by).agg(*[F.max(F.when(F.col("_cut") == i, F.struct("_h", "_id"))).alias(f"cut_{i}") for i in range(len(positions))])


def dense_index(df: DataFrame, id_col: str, by: list[str] = (), name: str = "idx") -> DataFrame:
    """0-based position of every row in id order (ids unique within the group)."""
    cut = with_bucket(df, id_col).withColumn("_one", F.lit(1))
    return running_totals(cut, [F.col(id_col)], {name: "_one"}, by).drop("_one").withColumn(name, F.col(name) - 1)


def top_share(df: DataFrame, col: str, percents: list[int]) -> DataFrame:
    """Share of the total held by the top 1, 5, ... percent of rows (at least one row each), in two scans.

    Cells above a cut count whole; of the cell that the cut crosses only the distinct values are looked at, and a value group crossing it contributes
    the part inside, so no tie has to be broken and no row has to be ranked.
    """
    keyed, cells = _counted(df, col, [])
    down = W.orderBy(F.col("_cell").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)  # a bounded number of cells
    cells = cells.select("*", F.sum("_n").over(down).alias("_upto"), F.sum("_s").over(down).alias("_above"), F.sum("_n").over(W.partitionBy()).alias("_total"), F.sum("_s").over(W.partitionBy()).alias("_sum"))
    grid = cells.withColumn("pct", F.explode(F.array(*[F.lit(p) for p in percents]))).withColumn("k", F.greatest(F.lit(1), F.expr("_total * pct div 100")))
    cut = materialize(grid.filter("k > _upto - _n AND k <= _upto").withColumn("_before", F.col("_upto") - F.col("_n")).withColumn("_above", F.col("_above") - F.col("_s")), "cuts")
    values = _inside(keyed, cut.dropDuplicates(["_cell"]), []).withColumn("_neg", -F.col("_v")).withColumn("_bucket", -F.col("_bucket"))
    inside = running_totals(values, [F.col("_neg")], {"cum": "n"}, ["_cell"])
    each = inside.join(cut.select("_cell", "pct", "k", "_before", "_above", "_sum"), "_cell")
    part = F.least(F.col("n"), F.greatest(F.lit(0), F.col("k") - F.col("_before") - (F.col("cum") - F.col("n"))))
    return each.groupBy("pct").agg(F.max("k").cast("bigint").alias("k"), ((F.max("_above") + F.sum(F.col("_v") * part)) * 100 / F.max("_sum")).alias("share_pct"))
