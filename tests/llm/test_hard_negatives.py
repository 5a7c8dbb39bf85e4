import math

import numpy as np
import pytest

from tallyloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, q int, cell double, norm string"


def table(spark, rows):
    return spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], label, "n", 1, None, "m") for i, v, label in rows], SCHEMA)


def brute(rows, low=80, high=100):
    part = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(c is not None and math.isfinite(c) and abs(256 * c) < 2 ** 31 for c in v):
            part[i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(c)) for c in v)] = None
    out = set()
    for i, label, q in part:
        if i % 100:
            continue
        score = [(sum(a * b for a, b in zip(q, p)), other, own) for other, own, p in part if other != i]
        same = sorted((-s, o) for s, o, own in score if own == label)[:5]
        for s, positive in same:
            hard = sorted((-x, o) for x, o, own in score if own != label and low * -s <= 100 * x <= high * -s)[:5]
            out |= {(i, positive, r, o, -s, -x) for r, (x, o) in enumerate(hard, 1)}
    return out


def mined(spark, rows):
    return {tuple(r) for r in hard_negatives.mine(table(spark, rows)).collect()}


def test_ties_nulls_repeats_zero_negative_and_short_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 4).tolist(), int(i % 3)) for i in range(320)]  # few values: many ties, zero rows
    rows += [(400, None, 1), (401, [None, 1, 1, 1], 1), (402, [1, 1, 1, 1], None), (403, [float("nan")] * 4, 2), (404, [float("inf"), 0, 0, 0], 0), (None, [1, 1, 1, 1], 1), (405, [1e12, 0, 0, 0], 1)]
    rows += [(406, [2, 1], 0), (407, [], 1), rows[3], rows[200], (100_000, [-5, -5, -5, -5], 9), (-100, [1, 1, 0, 0], 2)]
    want = brute(rows)
    assert want and mined(spark, rows) == want


def test_hot_vector_small_chunks_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)  # many chunks of rows and of visitors
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((6, 8))
    rows = [(i, (centre[i % 6] + rng.standard_normal(8) * 0.05).tolist(), int(rng.integers(0, 4))) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.25, 0, 0, 1, 0, 0, 0.125], i % 2) for i in range(150)]
    rows += [(2000 + 100 * i, [0.5, 0.25, 0, 0, 1, 0, 0, 0.125], i % 4) for i in range(40)]  # more visitors than a chunk in one cell
    assert mined(spark, rows) == brute(rows)


def test_windows_leave_out_most_scores(spark, monkeypatch):
    """On clustered rows the bounds keep most pairs from being scored."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((16, 12))
    rows = [(i, (centre[i % 16] * (1 + i % 3) + rng.standard_normal(12) * 0.01).tolist(), int(i % 2)) for i in range(800)]
    directions = centre / np.linalg.norm(centre, axis=1)[:, None]
    q = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64)
    norm = np.linalg.norm(q.astype(float), axis=1)
    angle = hard_negatives.angles_to(q, norm, directions)
    scored = 0
    for a in range(0, 800, 100):
        exact = q @ q[a]
        low, high = hard_negatives.score_bounds(norm[a], angle[a], norm, angle)
        assert ((low <= exact) & (exact <= high)).all()
        scored += int(((high >= 0.95 * exact[a]) & (low <= exact[a])).sum())
    assert scored < 0.3 * 8 * 800
    assert mined(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [float(3 * 10 ** 6 + i * 7), float(-10 ** 6 + i), float(i)], i % 2) for i in range(0, 130)]
    assert mined(spark, rows) == brute(rows)
    m = np.array([[2 ** 31, 2 ** 31], [-(2 ** 31), 5]])
    assert hard_negatives.integer_scores(m, np.array([2 ** 31, 2 ** 31])).tolist() == [2 ** 63, -(2 ** 62) + 5 * 2 ** 31]


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 1)], [(5, [1.0], 1), (7, [1.0], 2)], [(0, None, None)], [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 2)]])
def test_little_or_nothing(spark, rows):
    assert mined(spark, rows) == brute(rows)
