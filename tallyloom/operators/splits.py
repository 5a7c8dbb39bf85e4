"""Exact stratified splits, folds and reproducible samples; the same rows under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.semantics import count_true, order_hash
from ..session import materialize, parts_of
from .ordered import hash_cuts, same_keys


def beside_cuts(df: DataFrame, id_col: str, by: list[str], positions: list, seed: int, parts: Column, many: bool = False) -> DataFrame:
    """``df`` with a column ``_part``: ``parts`` over the row's place (``_here``) and its group's cuts. Groups are few, so Spark can send the cuts to the rows.

    With ``many`` rows it is told to, or it would move all rows by their group before it knows.
    """
    cuts = hash_cuts(df, id_col, by, positions, seed)
    cuts = cuts.select(*[F.col(c).alias(f"_k_{c}") for c in by], *[f"cut_{i}" for i in range(len(positions))])
    cuts = F.broadcast(cuts) if many else cuts  # a row for each class
    rows = df.withColumn("_here", F.struct(order_hash(id_col, seed).alias("_h"), F.col(id_col).alias("_id")))
    return rows.join(cuts, same_keys(rows, cuts, by), "left").select(*df.columns, parts.alias("_part"))


def stratified_split(df: DataFrame, id_col: str, label: str = "label", test_share: float = 0.2, seed: int = 42,
                     names: tuple[str, str] = ("train", "test"), many: bool = False) -> DataFrame:
    """Per class, null included, exactly round(share * n) rows go to the second part: those that come first in a hash order of the ids."""
    first = F.col("_here") <= F.col("cut_0")
    out = beside_cuts(df, id_col, [label], [F.round(F.col("_size") * F.lit(test_share))], seed, F.coalesce(first, F.lit(False)), many)
    return out.withColumn("split", F.when(F.col("_part"), names[1]).otherwise(names[0])).drop("_part")


def stratified_folds(df: DataFrame, id_col: str, label: str = "label", k: int = 5, seed: int = 42) -> DataFrame:
    """Folds of equal size per class, to one row: consecutive parts of a hash order of the ids."""
    positions = [F.floor(F.col("_size") * i / k) for i in range(1, k)]
    after = sum((F.coalesce(F.col("_here") > F.col(f"cut_{i}"), F.lit(True)).cast("int") for i in range(k - 1)), F.lit(0))
    return beside_cuts(df, id_col, [label], positions, seed, after).withColumnRenamed("_part", "fold")


def fixed_sample(df: DataFrame, id_col: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """The n rows that come first in a hash order of its own (a top-k, no full sort)."""
    return df.orderBy(order_hash(id_col, seed, "sample"), id_col).limit(n)


def class_balance(df: DataFrame, label: str = "label", amount: str = "amount") -> DataFrame:
    one = F.col(label) == 1
    neg, pos = count_true(~one), count_true(one)
    return df.agg(neg.alias("negatives"), pos.alias("positives"), (F.avg(F.when(one, 1.0).otherwise(0.0).cast("double")) * 100).alias("positive_pct"),
                  F.when(pos > 0, F.floor(neg / pos)).cast("bigint").alias("imbalance"),
                  F.avg(F.when(~one, F.col(amount))).alias("mean_amount_neg"), F.avg(F.when(one, F.col(amount))).alias("mean_amount_pos"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n/(2 n_class) per class, and the negative/positive ratio."""
    g = df.agg(F.count("*").alias("n"), count_true(F.col(label) == 0).alias("n0"), count_true(F.col(label) == 1).alias("n1"))
    return g.select((F.col("n") / (2.0 * F.col("n0"))).cast("double").alias("weight_neg"), (F.col("n") / (2.0 * F.col("n1"))).cast("double").alias("weight_pos"),
                    (F.col("n0") / F.col("n1")).cast("double").alias("scale_pos"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width counts between the smallest and largest value; the largest falls in the last bin."""
    lim = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("l")).scalar()
    w = (F.col("_l.hi") - F.col("_l.lo")) / bins
    b = F.least(F.floor((F.col(col) - F.col("_l.lo")) / w) + 1, F.lit(bins))
    return df.filter(F.col(col).isNotNull()).withColumn("_l", lim).groupBy(b.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def hour_density(df: DataFrame, time: str = "time_s", label: str = "label") -> DataFrame:
    from pyspark.sql import Window as W

    g = df.groupBy(label, F.floor(F.pmod(F.col(time), F.lit(86400)) / 3600).cast("bigint").alias("hour")).agg(F.count("*").alias("n"))
    return g.withColumn("density", F.col("n") / F.sum("n").over(W.partitionBy(label)))


def engineer(df: DataFrame, train: DataFrame) -> DataFrame:
    """Hour of day, log amount and amount z-score; the z-score only knows the training rows."""
    st = train.agg(F.struct(F.avg("amount").alias("m"), F.greatest(F.stddev_pop("amount"), F.lit(1e-8)).alias("s")).alias("x")).scalar()
    return (df.withColumn("_x", st).withColumn("hour_of_day", F.pmod(F.col("time_s"), F.lit(86400)) / 3600).withColumn("amount_log", F.log1p("amount"))
            .withColumn("amount_zscore", (F.col("amount") - F.col("_x.m")) / F.col("_x.s")).drop("_x"))


def scale(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """Population-standardised columns with the training mean and deviation (a constant column keeps scale 1)."""
    st = train.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).alias("x")).scalar()
    z = {c: (F.col(c) - F.col(f"_x.m_{c}")) / F.when(F.col(f"_x.s_{c}") > 0, F.col(f"_x.s_{c}")).otherwise(1.0) for c in columns}
    return df.withColumn("_x", st).withColumns(z).drop("_x")


def row_overlap(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows that both sides hold; a hash finds the rows that may be equal, equality decides.

    Only hashes are grouped for all rows, in parts of bounded size; a task that grouped whole rows of its files would hold more the larger the table.
    """
    rows = materialize(train.select(*columns, F.lit(0).alias("_side")).union(test.select(*columns, F.lit(1).alias("_side"))), "overlap-rows")
    rows, parts = rows.withColumn("_h", F.xxhash64(*columns)), parts_of(rows.sparkSession, rows.count())
    both = lambda df, *keys: df.repartition(parts, "_h").groupBy("_h", *keys).agg(F.min("_side").alias("_a"), F.max("_side").alias("_b")).filter("_a < _b")
    met = materialize(both(rows.select("_h", "_side")).select("_h"), "overlap-hashes")
    return both(rows.join(met, "_h", "left_semi"), *columns).agg(F.count("*").alias("overlap"))
