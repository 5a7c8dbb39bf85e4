import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id string, x int, v double, at int"


def table(spark, rows):
    return spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], "n", None, 1.0, 3) for i, v in rows], SCHEMA)


def brute(rows, components=32):
    """Exact sums in Python integers, eigenvectors by a dense solver."""
    fine = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [v for _, v in fine]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    off = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    c = np.array(off, float) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    return [i for i, _ in fine], [sum(o * o for o in r) for r in off], (c @ q[:, :k]) / np.sqrt(e[:k]), e[:k] / e.sum()


def compared(spark, rows, components=32):
    got = whitening.whiten(table(spark, rows), components=components).orderBy("component", "vec_id").toPandas()
    ids, deviation, white, share = brute(rows, components)
    k = white.shape[1]
    assert len(got) == len(ids) * k
    order = np.argsort(ids, kind="stable")
    w = got["whitened"].to_numpy().reshape(k, -1).T
    assert got["vec_id"].tolist() == [ids[i] for i in order] * k
    assert got["deviation"].tolist() == [deviation[i] for i in order] * k
    sign = np.sign((w * white[order]).sum(axis=0))
    assert np.abs(w - white[order] * sign).max() < 1e-9
    assert np.abs(got["explained"].to_numpy()[::len(ids)] / share - 1).max() < 1e-10
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    assert (got["n"] == len(ids)).all()


def test_equals_a_dense_solver_and_leaves_out_broken_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(9) * np.arange(1, 10) + 4).tolist()) for i in range(150)]
    compared(spark, [*rows, (500, None), (501, [None] + [0.0] * 8), (502, [float("nan")] * 9), (503, [float("inf")] + [1.0] * 8)])


def test_fewer_components_than_dimensions_stop_early(spark, monkeypatch):
    jobs, rng = [], np.random.default_rng(2)
    added = whitening.added
    monkeypatch.setattr(whitening, "added", lambda *a: jobs.append(1) or added(*a))
    rows = [(i, (rng.standard_normal(40) * np.concatenate([[400, 200, 100], np.full(37, 0.02)])).tolist()) for i in range(60)]
    compared(spark, rows, components=2)
    assert len(jobs) < 30  # not all 40 steps


def test_dependent_dimensions_equal_deviations_and_large_values(spark):
    rng = np.random.default_rng(3)
    a = rng.standard_normal((80, 3)).astype(np.float32)
    compared(spark, [(i, [*map(float, r), float(r[0]), 2.0, 0.0]) for i, r in enumerate(a)], components=3)  # rounding to integers leaves the copy exact
    cross = [(i, v) for i, v in enumerate([[1.0, 0, 0], [-1.0, 0, 0], [0, 1.0, 0], [0, -1.0, 0], [0, 0, 1.0], [0, 0, -1.0]])]
    got = whitening.whiten(table(spark, cross)).toPandas()  # all eigenvalues equal: any axes do
    assert len(got) == 18 and got["identity_error"][0] < 1e-9 and np.allclose(got["explained"], 1 / 3)
    big = whitening.whiten(table(spark, [(1, [3e15, 1.0]), (2, [-3e15, 2.0]), (3, [1e30, 0.0])])).toPandas()
    assert set(big["vec_id"]) == {1, 2} and big["deviation"].isna().all()  # 64 * 1e30 is no long; the exact sum isn't either


def test_hot_vector_repeats_null_ids_and_nothing(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(40)]
    compared(spark, rows + [(1000 + i, [0.5, 0.25, -1.0, 2.0]) for i in range(60)] + rows[:5])
    got = whitening.whiten(table(spark, [*rows, (None, [1.0, 2.0, 3.0, 4.0]), (7, [1.0])]))  # the short row takes no part
    assert got.filter("vec_id IS NULL").count() == 4 and got.filter("vec_id = 7").count() == 4
    for nothing in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(table(spark, nothing)).count() == 0


@pytest.mark.parametrize("size", [3])
def test_exact_parts_with_python_integers(size):
    x = np.array([[2 ** 61, -5, 1], [2 ** 60, 7, 2]])
    sums = [int(c) for c in x.astype(object).sum(axis=0)]
    off = whitening.exact_offsets(x, 2, sums)
    assert off.tolist() == [[2 * int(v) - s for v, s in zip(r, sums)] for r in x.tolist()]
    assert whitening.squares(off) == [sum(int(o) ** 2 for o in r) for r in off.tolist()]


def test_registered_query(spark, sf):
    from tallyloom.llm.queries import QUERIES

    got = QUERIES["op13_embedding_whitening"](spark, sf).toPandas()
    ids, deviation, white, share = brute([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    assert len(got) == len(ids) * 32 and (got["identity_error"] < 1e-4).all()
    assert dict(zip(got["vec_id"], got["deviation"])) == dict(zip(ids, deviation))
    assert np.abs(got.groupby("component")["explained"].first().to_numpy() / share - 1).max() < 1e-4
    w = got.sort_values(["vec_id", "component"])["whitened"].to_numpy().reshape(-1, 32)
    white = white[np.argsort(ids)]
    assert np.abs(w - white * np.sign((w * white).sum(axis=0))).max() < 1e-8
