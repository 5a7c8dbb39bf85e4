"""Exact nearest neighbours and inner-product search in pivot cells, without comparing all pairs.

Every row lies in the cell of its nearest pivot and keeps its distance to it. Crowded cells are cut into rings of that distance. By the triangle inequality a query at distance d from a pivot is
at least |d - r| away from a row at distance r, and at least half of d minus its distance to any other pivot away from all rows of the cell. A query first visits the nearest rings
that hold k rows; the k-th distance found there is the radius, and only rings that can reach into it are visited next, in each of them only the rows whose own distance to
the pivot allows it. Rows and visitors of a ring are both cut into chunks of bounded size, so copies of one vector are many groups. Only k rows per visit leave a task.

Largest inner products are nearest neighbours after one more coordinate that gives all rows the same length.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize

BLOCK_ROWS = 4_096  # rows, and visitors, of one group
PIVOTS, RINGS = 64, 64  # so at most 4,096 rings are known to the driver
SAMPLE = 4_096  # rows that pivots are chosen from
ROOM = 1e-7  # for rounding of distances, times the largest length


class Cells(NamedTuple):
    """Pivots, and for each ring its cell, place, rows, and smallest and largest distance to the pivot; ``room`` for rounding."""

    pivots: np.ndarray
    cell: np.ndarray
    ring: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    room: float


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _ids(column) -> np.ndarray:
    """Ids as an array that sorts by value: whole numbers, or text."""
    out = np.asarray(column.to_pylist())
    return out.astype(str) if out.dtype == object else out


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a ** 2).sum(1)[:, None] - 2 * a @ b.T + (b ** 2).sum(1)[None, :], 0.0))


def choose_pivots(points: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Rows far from each other, taken greedily from the sample of least hash."""
    m = _matrix(points.select("p", F.xxhash64("id", "p").alias("h")).orderBy("h").limit(SAMPLE).select("p").toArrow().column("p"))
    at, near = [0], ((m - m[0]) ** 2).sum(1)
    while len(at) < count and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, ((m - m[at[-1]]) ** 2).sum(1))
    return m[at]


def in_cells(points: DataFrame, pivots: np.ndarray, room: float, block_rows: int) -> tuple[DataFrame, Cells]:
    """``points`` (id, p) with their cell, distance to its pivot and ring, written once, and the rings."""
    kind = points.schema["id"].dataType.simpleString()

    def nearest(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column(1)), pivots) if batch.num_rows else np.zeros((0, 1))
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], names=["id", "p", "cell", "r"])

    placed = materialize(points.select("id", "p").mapInArrow(nearest, f"id {kind}, p array<double>, cell int, r double"), "cells")
    cuts = {}
    for c in placed.groupBy("cell").agg(F.count("*").alias("n"), F.percentile_approx("r", [i / RINGS for i in range(1, RINGS)], 1000).alias("cuts")).collect():
        rings = min(RINGS, -(-c["n"] // block_rows))
        cuts[c["cell"]] = np.unique([c["cuts"][i * RINGS // rings - 1] for i in range(1, rings)])

    def ring(batches):
        for batch in batches:
            cell, r = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            out = np.zeros(len(r), np.int32)
            for c in np.unique(cell):
                out[cell == c] = np.searchsorted(cuts[c], r[cell == c])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["id", "p", "cell", "r", "ring"])

    rings = placed.mapInArrow(ring, f"id {kind}, p array<double>, cell int, r double, ring int")
    found = rings.groupBy("cell", "ring").agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high")).orderBy("cell", "ring").collect()
    return rings, Cells(pivots, *(np.array([x[c] for x in found]) for c in ("cell", "ring", "n", "low", "high")), room)


def _visits(queries: DataFrame, cells: Cells, k: int, first: bool) -> DataFrame:
    """A row for each ring a query visits: the nearest ones that hold ``k`` rows, or the others that reach into its radius."""
    kind = queries.schema["q"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            p, radius = _matrix(batch.column(1)), batch.column(2).to_numpy()
            if not len(p):
                continue
            d = _distances(p, cells.pivots)
            row, ring = [], []
            for i in range(len(p)):
                own = d[i][cells.cell]
                least = np.maximum(np.maximum(own - cells.high, cells.low - own), (own - d[i].min()) / 2) - cells.room
                order = np.argsort(least, kind="stable")
                held = np.cumsum(cells.rows[order])
                begin = int(np.searchsorted(held, k)) + 1
                go = order[:begin] if first else order[begin:][least[order[begin:]] <= radius[i]]
                row.append(np.full(len(go), i))
                ring.append(go)
            row, ring = np.concatenate(row), np.concatenate(ring)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(d[row, cells.cell[ring]]), pa.array(cells.cell[ring].astype(np.int32)), pa.array(cells.ring[ring].astype(np.int32))],
                                             names=["q", "p", "radius", "far", "cell", "ring"])

    return queries.select("q", "p", "radius").mapInArrow(run, f"q {kind}, p array<double>, radius double, far double, cell int, ring int")


def best_in_group(v: pa.Table, r: pa.Table, k: int, digits: int, room: float, product: bool, skip_self: bool):
    """(queries, ids, scores, rows compared): the k best rows of a group for each visitor."""
    line = r.column("r").to_numpy()
    order = np.argsort(line, kind="stable")
    line, ids, p = line[order], _ids(r.column("id"))[order], _matrix(r.column("p"))[order]
    qid, q = _ids(v.column("q")), _matrix(v.column("p"))
    at, found, score, compared = [], [], [], 0
    for i, (far, radius) in enumerate(zip(v.column("far").to_numpy(), v.column("radius").to_numpy())):
        a, b = np.searchsorted(line, far - radius - room, side="left"), np.searchsorted(line, far + radius + room, side="right")
        compared += b - a
        s = np.round(p[a:b, :-1] @ q[i, :-1] if product else -((p[a:b] - q[i]) ** 2).sum(axis=1), digits)
        place = np.flatnonzero(ids[a:b] != qid[i]) if skip_self else np.arange(b - a)
        if len(place) > k:
            edge = np.partition(s[place], len(place) - k)[len(place) - k]
            place = place[s[place] >= edge]
        place = place[np.lexsort((ids[a:b][place], -s[place]))[:k]]
        at.append(np.full(len(place), i))
        found.append(order[a:b][place])
        score.append(s[place])
    return np.concatenate(at).astype(np.int64), np.concatenate(found).astype(np.int64), np.concatenate(score), compared


def _met(visits: DataFrame, rows: DataFrame, cells: Cells, k: int, digits: int, product: bool, skip_self: bool, block_rows: int) -> DataFrame:
    """(q, id, score) of every pair of a chunk of a ring's visitors and a chunk of its rows."""
    schema = f"q {visits.schema['q'].dataType.simpleString()}, id {rows.schema['id'].dataType.simpleString()}, score double"
    visits = materialize(visits, "visits")
    seen = {(r["cell"], r["ring"]): r["n"] for r in visits.groupBy("cell", "ring").agg(F.count("*").alias("n")).collect()}  # at most one for each ring
    chunks = {(c, g): (-(-int(n) // block_rows), -(-seen[c, g] // block_rows)) for c, g, n in zip(cells.cell.tolist(), cells.ring.tolist(), cells.rows.tolist()) if (c, g) in seen}
    if not chunks:
        return visits.sparkSession.createDataFrame([], schema)
    sizes = visits.sparkSession.createDataFrame([(c, g, a, b) for (c, g), (a, b) in chunks.items()], "cell int, ring int, row_chunks int, visit_chunks int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # at most PIVOTS * RINGS rows
    left = visits.join(F.broadcast(sizes), ["cell", "ring"]).withColumn("vc", F.pmod(F.xxhash64("q"), F.col("visit_chunks")).cast("int")).withColumn("rc", span("row_chunks")).drop("row_chunks", "visit_chunks")
    right = rows.join(F.broadcast(sizes), ["cell", "ring"]).withColumn("rc", F.pmod(F.xxhash64("id"), F.col("row_chunks")).cast("int")).withColumn("vc", span("visit_chunks")).drop("row_chunks", "visit_chunks")

    def run(v: pa.Table, r: pa.Table) -> pa.Table:
        if not v.num_rows or not r.num_rows:
            return pa.table({"q": v.column("q").slice(0, 0), "id": r.column("id").slice(0, 0), "score": pa.array([], pa.float64())})
        at, found, score, _ = best_in_group(v, r, k, digits, cells.room, product, skip_self)
        return pa.table({"q": v.column("q").take(pa.array(at)), "id": r.column("id").take(pa.array(found)), "score": pa.array(score)})

    keys = ("cell", "ring", "rc", "vc")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _ranked(pairs: DataFrame, query_id: str, out_id: str, k: int) -> DataFrame:
    w = W.partitionBy(query_id).orderBy(F.col("score").desc(), out_id)
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _found(queries: DataFrame, points: DataFrame, k: int, digits: int, product: bool, skip_self: bool, block_rows: int) -> DataFrame:
    """(q, id, score, rank) for queries (q, p) and points (id, p) in the same coordinates; for products the last coordinate is not part of the score."""
    points = materialize(points, "points")
    longest = points.agg(F.max(F.aggregate("p", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()["m"]
    if longest is None:
        return queries.sparkSession.createDataFrame([], f"q {queries.schema['q'].dataType.simpleString()}, id {points.schema['id'].dataType.simpleString()}, score double, rank int")
    room = ROOM * max(1.0, float(np.sqrt(longest)))
    rows, cells = in_cells(points, choose_pivots(points), room, block_rows)
    asked = materialize(queries.withColumn("radius", F.lit(float("inf"))), "queries")
    need = k + int(skip_self)
    met = lambda visits: _met(visits, rows, cells, k, digits, product, skip_self, block_rows)
    first = materialize(_ranked(met(_visits(asked, cells, need, True)), "q", "id", k), "first")
    # distance of the k-th row so far; a product s is a squared distance of |q|^2 + M^2 - 2 s
    worst = first.filter(F.col("rank") == k).select("q", F.col("score").alias("worst"))
    length = F.aggregate("p", F.lit(0.0), lambda a, x: a + x * x)
    square = length + float(longest) - 2 * F.col("worst") if product else -F.col("worst")
    radius = F.sqrt(F.greatest(square, F.lit(0.0)) + 4 * 10.0 ** -digits) + 2 * room
    second = asked.drop("radius").join(worst, "q", "left").withColumn("radius", F.coalesce(radius, F.lit(float("inf"))))
    more = met(_visits(second, cells, need, False))
    return _ranked(first.drop("rank").unionByName(more), "q", "id", k)


def top_k_search(queries: DataFrame, corpus: DataFrame, k: int = 5, query_id: str = "query_id", id_col: str = "vec_id",
                 vec: str = "embedding", digits: int = 9, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top-k inner products per query over the whole corpus: (query_id, id, score, rank); ties to the smaller id. Null vectors take no part."""
    square = F.aggregate("p", F.lit(0.0), lambda a, x: a + x * x)
    points = corpus.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("p")).filter("p IS NOT NULL")
    longest = points.agg(F.max(square).alias("m")).first()["m"] or 0.0
    points = points.select("id", F.concat("p", F.array(F.sqrt(F.greatest(F.lit(float(longest)) - square, F.lit(0.0))))).alias("p"))
    asked = queries.select(F.col(query_id).alias("q"), F.concat(F.col(vec).cast("array<double>"), F.array(F.lit(0.0))).alias("p")).filter("p IS NOT NULL")
    out = _found(asked, points, k, digits, True, False, block_rows)
    return out.select(F.col("q").alias(query_id), F.col("id").alias(id_col), "score", "rank")


def k_neighbours(rows: DataFrame, k: int, id_col: str, vec: str, digits: int = 9, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """k nearest other rows by squared distance: (id, neighbour, dist2, rank); ties to the smaller id. Null vectors take no part."""
    # written once: the same rows ask and are found
    points = materialize(rows.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("p")).filter("p IS NOT NULL"), "rows")
    out = _found(points.withColumnRenamed("id", "q"), points, k, digits, False, True, block_rows)
    return out.select(F.col("q").alias(id_col), F.col("id").alias("neighbour"), "rank", (-F.col("score")).alias("dist2"))
