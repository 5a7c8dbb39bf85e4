"""Hot and missing keys: the same rows as a plain join, spread over tasks without adaptive plans."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import joins as J


def facts(spark, n=4000):
    rng = np.random.default_rng(1)
    key = np.where(np.arange(n) % 2 == 0, 7, rng.integers(100, 900, n))
    rows = [(i, None if i % 5 == 0 else int(k), float(i)) for i, k in enumerate(key)]
    return spark.createDataFrame(rows, "id long, k long, v double").repartition(8)


def test_summary_finds_all_heavy_keys_with_a_small_memory(spark):
    f = facts(spark)
    assert J.heavy_hitters(f, "k", share=0.1, capacity=16) == [7]
    names = f.withColumn("k", F.concat(F.lit("n"), F.col("k").cast("string")))
    assert J.heavy_hitters(names, "k", share=0.1, capacity=16) == ["n7"]
    count = Counter(r.k for r in f.collect() if r.k is not None)
    found = J.heavy_hitters(f, "k", share=0.002, capacity=1024)
    assert {k for k, n in count.items() if n >= 0.002 * 4000} <= set(found)
    assert J.heavy_hitters(f.filter("k IS NULL"), "k") == [] and J.heavy_hitters(f.limit(0), "k") == []


def test_same_rows_as_a_plain_join_and_the_hot_key_is_spread(spark):
    f = facts(spark)
    d = spark.createDataFrame([(7, "seven"), (7, "again"), *[(k, f"d{k}") for k in range(100, 700)], (None, "none")], "k long, name string")
    want, got = f.join(d, "k", "left"), J.left_join(f, d, "k")
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        most = lambda df: df.filter("k = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most(J.left_join(f, d, "k")) < 0.5 * most(f.join(d, "k", "left"))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert J.left_join(f.limit(0), d, "k").count() == 0 and J.left_join(f, d.limit(0), "k").count() == 4000


def test_facts_are_read_once_and_known_hot_keys_give_the_same_rows(spark, tmp_path):
    f = facts(spark)
    d = spark.createDataFrame([(7, "seven"), (7, "again"), *[(k, f"d{k}") for k in range(100, 700)], (None, "none")], "k long, name string")
    path = str(tmp_path / "facts")
    f.write.parquet(path)
    want = sorted(map(tuple, f.join(d, "k", "left").collect()), key=repr)
    for hot in (None, [], [7], [7, 100, 5000]):
        got = J.left_join(spark.read.parquet(path), d, "k", hot=hot)
        assert sorted(map(tuple, got.collect()), key=repr) == want
        assert str(got._jdf.queryExecution().optimizedPlan()).count("parquet") == 1, "a branch for each kind of key reads and moves the facts again"
