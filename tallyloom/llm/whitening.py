"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows are made integers, so sums and deviations are exact, and are centred before anything is multiplied. With X the centred rows, the bidiagonalisation alternates
u = Xv and v = X'u, a Spark job a step, and keeps both families orthogonal by full, repeated reorthogonalisation. A left vector has an entry for every row of the
table; it is never stored, but kept as the short vector w with u = Xw, from which each task makes its part of u again. So the driver holds vectors and sums of the
width of an embedding only, and a task that is run again needs nothing but its rows. The singular values of the small bidiagonal matrix are the deviations along
the components, and its right vectors, turned back by the v's, are the components.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import keep, plain

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
TOLERANCE = 1e-14  # of the largest singular value: residuals at which components are taken as found
FLAT = 1e-12  # of the largest eigenvalue: directions of less variance are rounding, not components


class Fit(NamedTuple):
    """What whitening needs of the fit list: rows, per-dimension sums, components (as rows), their eigenvalues and the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """(id, x): whole vectors as integers floor(scale * c) + shift. Rows with a null vector, a null or non-finite entry, or one beyond 64 bits are left out."""
    v = F.col("v")
    fine = v.isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(2.0 ** 62)), F.lit(False)))
    rows = plain(vectors, id=F.col(f"`{id_col}`").cast("long"), v=F.col(f"`{vec_col}`").cast("array<double>"))
    return rows.filter(fine).select("id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long")).alias("x"))


def exact_offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: 64-bit integers where they hold the result, Python integers otherwise."""
    top = int(np.abs(x).max(initial=0))
    if (top + 1) * n < 1 << 62 and all(abs(s) < 1 << 62 for s in sums):
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(offsets: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows."""
    if offsets.dtype != object:
        top = int(np.abs(offsets).max(initial=0))
        if top * top * max(1, offsets.shape[1]) < 1 << 63:
            return (offsets * offsets).sum(axis=1).tolist()
        offsets = offsets.astype(object)
    return [int(s) for s in (offsets * offsets).sum(axis=1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(column: pa.Array, n: int, sums: list[int]) -> np.ndarray:
    return exact_offsets(_matrix(column, len(sums)), n, sums).astype(float) / n


def added(rows: DataFrame, width: int, part) -> np.ndarray:
    """Sum over all rows of ``part(column x)``, an array of ``width`` numbers for each batch: added up in each task, then by Spark."""
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += part(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], names=["at", "total"])

    out = np.zeros(width)
    for r in rows.select("x").mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect():
        out[r["at"]] = r["total"]
    return out


def column_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""
    def run(batches):
        count, total = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column(0), width)
            wide = int(np.abs(x).max(initial=0)) * max(1, len(x)) >= 1 << 62
            total = [a + int(b) for a, b in zip(total, (x.astype(object) if wide else x).sum(axis=0))] if len(x) else total
            count += len(x)
        yield pa.RecordBatch.from_pydict({"at": pa.array([-1, *range(width)], pa.int32()), "total": pa.array([str(count), *map(str, total)])})

    found = rows.select("x").mapInArrow(run, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = {r["at"]: int(r["total"]) for r in found}
    return sums.get(-1, 0), [sums.get(i, 0) for i in range(width)]


def _against(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``vector`` without its part in the span of the orthonormal ``basis``, taken off twice."""
    for _ in range(2):
        for b in basis:
            vector = vector - b * (b @ vector)
    return vector


def bidiagonalise(rows: DataFrame, n: int, sums: list[int], wanted: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors as rows) of the centred rows, the ``wanted`` largest, falling.

    Where the space is used up (equal singular values, dependent dimensions) the recurrence goes on with a new direction, so at most as many steps as dimensions are taken.
    """
    d, random = len(sums), np.random.default_rng(len(sums))
    vs: list[np.ndarray] = []  # right vectors
    ws: list[np.ndarray] = []  # left vectors u = Xw
    zs: list[np.ndarray] = []  # X'u
    alphas: list[float] = []
    betas: list[float] = []

    def right(w, basis):
        """X'u, u'u and the products of u = Xw with the left vectors so far."""
        def part(x):
            c = _centred(x, n, sums)
            u = c @ w
            return np.concatenate([c.T @ u, [u @ u], (c @ basis).T @ u])
        sent = added(rows, d + 1 + basis.shape[1], part)
        return sent[:d], sent[d], sent[d + 1:]

    v, scale = random.standard_normal(d), 0.0
    v /= np.linalg.norm(v)
    while len(vs) < d:
        vs.append(v)
        basis = np.array(ws).T if ws else np.zeros((d, 0))
        w = v - betas[-1] * ws[-1] if ws else v  # u = Xv without its part along the last left vector
        for _ in range(4):  # what is left along all earlier ones, rounding as a rule, goes too; a large part is measured again
            z, norm2, rest = right(w, basis)
            for r, old, zo in zip(rest, ws, zs):
                w, z = w - r * old, z - r * zo
            if rest @ rest <= 1e-16 * norm2:
                break
        alpha = float(np.sqrt(max(norm2 - rest @ rest, 0.0)))
        scale = max(scale, alpha)
        if alpha <= 1e-13 * scale or alpha == 0.0:  # v is a direction without deviation
            alpha, w, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, z = w / alpha, z / alpha
        ws.append(w)
        zs.append(z)
        alphas.append(alpha)
        new = _against(z, vs)
        beta = float(np.linalg.norm(new))
        scale = max(scale, beta)
        if len(vs) == d:
            break
        if beta <= 1e-13 * scale or beta == 0.0:
            beta, new = 0.0, _against(random.standard_normal(d), vs)
        betas.append(beta)
        if len(vs) >= wanted and beta > 0.0:
            p, s, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            if (beta * np.abs(p[-1, :wanted]) <= tolerance * s[0]).all():
                break
        v = new / np.linalg.norm(new)
    k = len(vs)
    _, s, q = np.linalg.svd(np.diag(alphas) + np.diag(betas[:k - 1], 1))
    return s[:wanted], (q @ np.array(vs))[:wanted]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Components of integer rows (id, x) of one width; None without rows. Every row is in every sum."""
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if not widths or not widths["width"]:
        return None
    rows = rows.filter(F.size("x") == widths["width"])
    n, sums = column_sums(rows, widths["width"])
    spread = float(added(rows, 1, lambda x: np.array([(_centred(x, n, sums) ** 2).sum()]))[0])
    if not spread:
        return Fit(n, sums, np.zeros((0, len(sums))), np.zeros(0), 0.0)
    values, vectors = bidiagonalise(rows, n, sums, min(components, len(sums)))
    eigen = values ** 2 / n
    real = eigen > FLAT * eigen[0]
    return Fit(n, sums, vectors[real], eigen[real], spread / n)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor n) minus the identity."""
    k = len(found.eigenvalues)
    turn = (found.components / np.sqrt(found.eigenvalues)[:, None]).T
    n, sums = found.n, found.sums

    def part(x):
        w = _centred(x, n, sums) @ turn
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    flat = added(rows, k * k + k, part)
    mean = flat[:k] / n
    return float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row and component, numbered from 1 by falling eigenvalue.

    Rows with a null vector or a null or non-finite entry take no part, nor do rows with an entry that is no 64-bit integer after scaling, or with another width than
    most rows have (of equally many the larger width). Repeated rows and ids count and come back as often as they occur, a null id as null. Directions without deviation
    are no components: equal rows, a single row and an empty table give no result rows, dependent dimensions fewer components. ``deviation`` is null where the exact
    number is beyond a long. Other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = keep(integer_rows(vectors, id_col, vec_col, scale, shift), "whitening")
    found = fit(rows, components)
    if found is None or not len(found.eigenvalues):
        return spark.createDataFrame([], schema)
    n, sums, k = found.n, found.sums, len(found.eigenvalues)
    rows = rows.filter(F.size("x") == len(sums))
    error = identity_error(rows, found)
    turn = (found.components / np.sqrt(found.eigenvalues)[:, None]).T
    share = found.eigenvalues / found.trace

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets = exact_offsets(_matrix(batch.column(1), len(sums)), n, sums)
            white = (offsets.astype(float) / n) @ turn
            deviation = pa.array([s if s < 1 << 63 else None for s in squares(offsets)], pa.int64())
            each = pa.array(np.repeat(np.arange(len(white)), k))
            many = len(white) * k
            yield pa.RecordBatch.from_arrays([batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(white))), pa.array(np.full(many, n)), deviation.take(each),
                                              pa.array(white.ravel()), pa.array(np.tile(share, len(white))), pa.array(np.full(many, error))], names=[c.split()[0] for c in schema.split(", ")])

    return rows.select("id", "x").mapInArrow(run, schema)
