"""Left joins that stand hot and missing keys: heavy hitters are found by a mergeable summary and spread over salts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

CAPACITY = 1024  # keys of a summary: it undercounts a key by at most rows / CAPACITY
HOT_SHARE = 0.01  # keys of this share of all rows are spread
SALTS = 32


def heavy_hitters(df: DataFrame, key: str, share: float = HOT_SHARE, capacity: int = CAPACITY) -> list:
    """All keys of at least ``share`` of the rows, and perhaps some of up to rows / capacity less; null is none of them.

    Every task keeps the counts of at most ``capacity`` keys; when there are more, the count of the largest one that must go is taken off all. Summaries add up, their errors too, and at most
    1 / (share - 1 / capacity) keys reach the driver.
    """
    if share <= 1 / capacity:
        raise ValueError("the share must be larger than the summary's error")
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        held: dict = {}
        rows = 0
        for batch in batches:
            counts = pc.value_counts(batch.column(0).drop_null())
            rows += batch.num_rows
            for v, n in zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()):
                held[v] = held.get(v, 0) + n
            if len(held) > capacity:
                off = int(np.partition(np.fromiter(held.values(), np.int64, len(held)), len(held) - capacity - 1)[len(held) - capacity - 1])
                held = {v: n - off for v, n in held.items() if n > off}
        yield pa.RecordBatch.from_arrays([pa.array([*held, None], batch_type), pa.array([*held.values(), rows], pa.int64()), pa.array([False] * len(held) + [True])], names=["key", "n", "whole"])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(df.schema[key].dataType)
    merged = df.select(key).mapInArrow(run, f"key {kind}, n long, whole boolean").groupBy("key", "whole").agg(F.sum("n").alias("n"))
    rows = merged.filter("whole").agg(F.sum("n").alias("n")).first()["n"] or 0
    return sorted(r["key"] for r in merged.filter((~F.col("whole")) & (F.col("n") >= rows * (share - 1 / capacity)) & (F.col("n") > 0)).collect())


def left_join(facts: DataFrame, dimension: DataFrame, key: str, share: float = HOT_SHARE, salts: int = SALTS, hot: list | None = None) -> DataFrame:
    """``facts`` LEFT JOIN ``dimension`` USING (key), the same rows as a plain join.

    One join by key and salt, so that ``facts`` are read once: rows without a key and rows of hot keys are dealt to ``salts`` places, to each of which the few dimension rows of
    the hot keys are copied; all other rows have salt 0. ``hot``: the hot keys, where they are known; else they are looked for.
    """
    hot = heavy_hitters(facts, key, share) if hot is None else hot
    among = F.col(key).isin(hot) if hot else F.lit(False)
    dealt = facts.withColumn("_salt", F.when(F.col(key).isNull() | among, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int"))
    places = F.when(among, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    copies = dimension.filter(F.col(key).isNotNull()).withColumn("_salt", F.explode(places))
    return dealt.join(copies, [key, "_salt"], "left").drop("_salt")
