"""Ordered operators against brute force, with hot values and under different partitionings."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import clv, metrics as M, nearest as N, ordered as O, splits as P, threshold as T


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value and one group."""
    rng = np.random.default_rng(3)
    n = 3000
    v = np.round(rng.lognormal(3, 1.5, n), 2)
    g = rng.choice(["a", "b", "c"], n)
    v[: n // 3], g[: n // 3] = 20.0, "a"
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_quantiles(skewed):
    pdf, df = skewed
    probs = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99}
    row = O.exact_quantiles(df, "v", probs).first()
    for k, p in probs.items():
        assert row[k] == pytest.approx(np.quantile(pdf.v, p))
    for row in O.exact_quantiles(df, "v", probs, ["g"]).collect():
        for k, p in probs.items():
            assert row[k] == pytest.approx(np.quantile(pdf[pdf.g == row.g].v, p))


def test_quantiles_of_one_value_and_with_nulls(spark):
    df = spark.createDataFrame([(None,), (4.0,)], "v double")
    assert O.exact_quantiles(df, "v", {"m": 0.5}).first().m == 4.0


def test_top_share(skewed):
    pdf, df = skewed
    s = np.sort(pdf.v)[::-1]
    for row in O.top_share(df, "v", [1, 10, 50]).collect():
        k = max(1, len(s) * row.pct // 100)
        assert row.k == k and row.share_pct == pytest.approx(s[:k].sum() / s.sum() * 100)


def test_cohorts_share_ties(skewed):
    pdf, df = skewed
    got = clv.cohort_labels(df, "v").toPandas().set_index("id")
    above = pdf.v.rank(ascending=False, method="min") - 1
    pct = above / len(pdf)
    want = np.select([pct < 0.1, pct < 0.3, pct < 0.6], ["VIP", "High", "Medium"], "Low")
    assert (got.loc[pdf.id].cohort.to_numpy() == want).all()


def test_ranks_do_not_depend_on_partitions(skewed):
    pdf, df = skewed
    a = O.hash_rank(df, "id", ["g"]).select("id", "rank").toPandas().sort_values("id")
    b = O.hash_rank(df.repartition(3, "v"), "id", ["g"]).select("id", "rank").toPandas().sort_values("id")
    assert (a["rank"].to_numpy() == b["rank"].to_numpy()).all()
    for g, part in a.merge(pdf, on="id").groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))


def test_dense_index(skewed):
    _pdf, df = skewed
    got = O.dense_index(df, "id").select("id", "idx").toPandas()
    assert (got.id == got.idx).all()


def test_split_and_folds_are_exact(skewed):
    pdf, df = skewed
    x = df.withColumn("label", (F.col("g") == "b").cast("int"))
    s = P.stratified_split(x, "id").groupBy("label", "split").count().toPandas()
    for lab, part in s.groupby("label"):
        n = part["count"].sum()
        assert part[part.split == "test"]["count"].iloc[0] == int(n * 0.2 + 0.5)
    f = P.stratified_folds(x, "id").groupBy("label", "fold").count().toPandas()
    assert f.groupby("label")["count"].agg(lambda c: c.max() - c.min()).max() <= 1


def test_metrics_with_ties_by_hand(spark):
    rows = [(1, 9000), (0, 9000), (1, 7000), (0, 5000), (1, 3000), (0, 1000)]
    m = M.metric_suite(spark.createDataFrame(rows, "label int, score_e4 bigint")).first()
    wins = sum((p > n) + 0.5 * (p == n) for a, p in rows if a for b, n in rows if not b)
    assert m.roc_auc == pytest.approx(wins / 9)
    assert m.avg_precision == pytest.approx((1 / 2) / 3 + (2 / 3) / 3 + (3 / 5) / 3)
    assert (m.true_pos, m.false_pos, m.false_neg, m.true_neg) == (2, 2, 1, 1)


def test_metrics_without_positives(spark):
    m = M.metric_suite(spark.createDataFrame([(0, 9000), (0, 100)], "label int, score_e4 bigint")).first()
    assert (m.roc_auc, m.avg_precision, m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0, 0.0, 0.0)


def test_sweep_counts_scores_on_the_threshold(spark):
    df = spark.createDataFrame([(1, 5000, 10.0), (1, 4999, 3.0), (0, 5000, 1.0)], "label int, score_e4 bigint, amount double")
    s = {round(r.threshold * 100): r for r in T.sweep(df).collect()}
    assert len(s) == 81 and (s[50].tp, s[50].fp, s[50].fn) == (1, 1, 1) and s[50].cost_fn == 7.5 and s[49].tp == 2 and s[51].tp == 0


def test_optima_take_the_lowest_threshold_on_ties(spark):
    df = spark.createDataFrame([(1, 9500, 1.0), (0, 500, 1.0)], "label int, score_e4 bigint, amount double")
    assert {r.threshold for r in T.optima(T.sweep(df)).collect()} == {0.10}


def _brute(q, x, k):
    s = np.round(q @ x.T, 9)
    return [[(int(j), round(float(s[i, j]), 9)) for j in sorted(range(len(x)), key=lambda j: (-s[i, j], j))[:k]] for i in range(len(q))]


@pytest.mark.parametrize("block", [20_000, 7])
def test_search_is_exact_in_both_forms(spark, block):
    """Small blocks force the block-by-block form; a third of the corpus are copies of one vector."""
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(60, 8)), rng.normal(size=(15, 8))
    x[20:40] = x[20]
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(5)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id bigint, embedding array<double>")
    got = N.top_k_search(d, c, 4, block_rows=block).orderBy("query_id", "rank").collect()
    want = _brute(q, x, 4)
    for i in range(len(q)):
        assert [(r.vec_id, round(r.score, 9)) for r in got if r.query_id == i] == want[i]


@pytest.mark.parametrize("block", [20_000, 7])
def test_neighbours_are_exact_in_both_forms(spark, block):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(40, 3)), 3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>").repartition(3)
    got = N.k_neighbours(df, 3, "id", "v", block_rows=block).orderBy("id", "rank").collect()
    dist = np.round(((x[:, None] - x[None]) ** 2).sum(2), 9)
    for i in range(len(x)):
        want = sorted((j for j in range(len(x)) if j != i), key=lambda j: (dist[i, j], j))[:3]
        assert [r.neighbour for r in got if r.id == i] == want


def test_split_keeps_rows_without_label_and_depends_on_the_seed(spark):
    from tallyloom.operators import splits as P

    df = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 3 == 0).cast("int")).alias("label"))
    parts = {seed: {r.id for r in P.stratified_split(df, "id", seed=seed).filter("split = 'test'").collect()} for seed in (1, 2)}
    whole = P.stratified_split(df, "id", seed=1)
    assert whole.count() == 3000
    sizes = {r.label: (r.n, r.t) for r in whole.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()}
    assert len(sizes) == 3 and all(t == round(n * 0.2) for n, t in sizes.values())
    assert 60 < len(parts[1] & parts[2]) < 180  # a fifth of the 600 test rows, about
    sample = {r.id for r in P.fixed_sample(df, "id", 500, seed=1).collect()}
    assert 60 < len(sample & parts[1]) < 140
    folds = {(r.label, r.fold): r.n for r in P.stratified_folds(df, "id", seed=1).groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
    assert len(folds) == 15 and sum(folds.values()) == 3000
    for label in (None, 0, 1):
        n = [folds[label, f] for f in range(5)]
        assert max(n) - min(n) <= 1


def test_groups_and_ranks_keep_null_keys_and_nan_is_missing(spark):
    rows = [(i, None if i % 4 == 0 else i % 2, float("nan") if i % 5 == 0 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    assert O.hash_rank(df, "id", ["g"]).count() == 200
    got = {r.g: r.m for r in O.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    import statistics
    for g in (None, 0, 1):
        assert got[g] == statistics.median(v for _, k, v in rows if k == g and v == v)


def test_cells_stay_exact_when_one_vector_is_a_third_and_text_ids_tie(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(90, 4)), 2)
    x[30:60] = x[30]
    ids = [f"r{i:03d}" for i in range(90)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)] + [("none", None)], "id string, v array<double>").repartition(4)
    got = N.k_neighbours(df, 3, "id", "v", block_rows=8).collect()
    dist = np.round(((x[:, None] - x[None]) ** 2).sum(2), 9)
    want = {(ids[i], r): ids[j] for i in range(90) for r, j in enumerate(sorted((j for j in range(90) if j != i), key=lambda j: (dist[i, j], ids[j]))[:3], 1)}
    assert {(r.id, r["rank"]): r.neighbour for r in got} == want
    assert N.k_neighbours(df.filter("id = 'none'"), 3, "id", "v").count() == 0
    assert N.k_neighbours(df.filter("id = 'r001'"), 3, "id", "v").count() == 0


def test_clustered_rows_are_compared_with_few_others(spark, monkeypatch):
    """The cells' work is counted where it is done, on the groups that Spark makes of them."""
    import pyarrow as pa

    rng = np.random.default_rng(10)
    centre = rng.normal(size=(20, 6)) * 10
    x = centre[np.arange(1200) % 20] + rng.normal(size=(1200, 6)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, p array<double>").repartition(4)
    rows, cells = N.in_cells(df, N.choose_pivots(df), 1e-6, 64)
    asked = df.withColumnRenamed("id", "q").withColumn("radius", F.lit(0.5))
    seen = 0
    groups = {}
    for first in (True, False):
        visits = N._visits(asked, cells, 4, first).toArrow().to_pylist()
        for v in visits:
            groups.setdefault((v["cell"], v["ring"]), []).append(v)
    held = {}
    for r in rows.toArrow().to_pylist():
        held.setdefault((r["cell"], r["ring"]), []).append(r)
    for key, visitors in groups.items():
        seen += N.best_in_group(pa.Table.from_pylist(visitors), pa.Table.from_pylist(held[key]), 3, 9, 1e-6, False, True)[3]
    assert seen < 0.12 * 1200 * 1200


def test_quantiles_of_odd_values_and_one_hot_cell(spark):
    """Negative, tiny, huge, infinite and equal values; a third of all rows in one cell; values closer than a cell."""
    rng = np.random.default_rng(11)
    groups = {"mixed": np.concatenate([rng.normal(size=200) * 1e-6, -np.exp(rng.normal(size=200) * 9), np.exp(rng.normal(size=200) * 9), np.full(300, 7.25), [0.0, -0.0, 1e308, -1e308]]),
              "close": 1000 + rng.random(400) * 1e-7, "equal": np.full(50, -3.5), "one": np.array([2.0]), "infinite": np.array([1.0, np.inf, 5.0])}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("mixed", None), ("mixed", float("nan"))], "g string, v double").repartition(7)
    probs = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.77, "e": 1.0}
    got = {r.g: r for r in O.exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g, x in groups.items():
        if g != "infinite":
            assert [got[g][n] for n in probs] == pytest.approx([float(np.quantile(x, p)) for p in probs.values()], rel=1e-12, abs=1e-18), g
    assert got["infinite"].c == 5.0
    whole = O.exact_quantiles(df.filter("g <> 'infinite'"), "v", {"m": 0.5}).first().m
    assert whole == pytest.approx(float(np.quantile(np.concatenate([x for g, x in groups.items() if g != "infinite"]), 0.5)), rel=1e-12)
    for x in (groups["close"], np.concatenate([groups["equal"] * -1, rng.random(70) * 9])):
        share = {r.pct: (r.k, r.share_pct) for r in O.top_share(spark.createDataFrame([(float(v),) for v in x], "v double").repartition(5), "v", [1, 10, 50]).collect()}
        down = np.sort(x)[::-1]
        for p in (1, 10, 50):
            k = max(1, len(x) * p // 100)
            assert share[p][0] == k and share[p][1] == pytest.approx(down[:k].sum() * 100 / x.sum(), rel=1e-12)


def test_neighbour_rows_are_written_once(spark, monkeypatch):
    names, real = [], N.materialize
    monkeypatch.setattr(N, "materialize", lambda df, name: (names.append((name, "parquet" in df._jdf.queryExecution().optimizedPlan().toString())), real(df, name))[1])
    rows = spark.range(60).selectExpr("id", "array(cast(id as double), cast(id % 7 as double)) as v")
    assert N.k_neighbours(rows, 3, "id", "v").count() == 180
    assert ("rows", False) in names and dict(names)["queries"] and dict(names)["points"]  # asked and found rows are read back
