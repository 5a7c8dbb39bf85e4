"""Working tables in the shared folder, column hygiene and connected components."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..session import shared_dir


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends there and any executor may be lost."""
    path = os.path.join(shared_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under own names, so that columns of the caller can't clash."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


FILTER_BITS = 1 << 23  # of an id filter: 256 rows of 4 KB, whatever the number of ids


def likely_among(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts: the rows whose id may be among the single column of ``ids``, and rows whose id surely is not (null is not).

    A bit map of hashed ids with a fixed size is sent to all tasks, so that rows without a partner need not be shuffled for an exact join. With very many ids
    it lets everything through, and the exact join has to do it all.
    """
    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))

    only = ids.select(F.col(ids.columns[0]).alias("i")).filter("i IS NOT NULL").select(place("i").alias("h"))
    maps = keep(only.groupBy(F.bitmap_bucket_number("h").alias("map_number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("map_bits")), "idmap")
    h = F.when(F.col(column).isNotNull(), place(column))
    bit = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring("map_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # at most FILTER_BITS / 8 bytes by construction
    seen = df.join(F.broadcast(maps), F.bitmap_bucket_number(h) == F.col("map_number"), "left").withColumn("maybe", F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0, F.lit(False)))
    return tuple(seen.filter(c).select(*df.columns) for c in ("maybe", "NOT maybe"))


def thinned(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Edges (a, b) with the same components but not more than about one for each node and one for each pair of nodes that are smallest neighbours of others.

    A node's edges to smaller nodes become one edge to the smallest of these, which takes the edges to the others.
    """
    low = keep(edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).groupBy("high").agg(F.min("low").alias("least"), F.collect_set("low").alias("lows")), "edges")
    up = low.select(F.col("high").alias("a"), F.col("least").alias("b"))
    return up.unionByName(low.select(F.explode("lows").alias("a"), F.col("least").alias("b")).filter("a <> b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, label): label is the smallest node reachable over the undirected edges; only nodes with an edge to another node.

    Every round takes the smallest label among the neighbours and then follows labels of labels, so the number of rounds grows with
    the logarithm of a component's width in practice. Each round is written to the shared folder. Minima are taken before the shuffle.
    """
    pairs = thinned(edges.filter(F.col(a) != F.col(b)), a, b).select(F.col("a").alias("x"), F.col("b").alias("y"))
    both = keep(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = keep(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")).select(F.col("x").alias("node"), "label"), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("y"), F.col("label").alias("far")), "y").groupBy(F.col("x").alias("node")).agg(F.min("far").alias("far"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "far").alias("low"))
        root = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        new = keep(step.join(root, "low", "left").select("node", F.least("low", F.coalesce("up", "low")).alias("next"), "label"), "labels")
        if not new.filter("next <> label").limit(1).count():
            return labels
        labels = new.select("node", F.col("next").alias("label"))
    raise RuntimeError(f"components are not complete after {max_rounds} rounds")
