"""Hard-negative mining by angular triangle filtering.

Every row stores its angles to a fixed number of reference directions. The angle between an anchor and a row lies between the largest difference and the smallest sum
of their angles to the references, so the cosine lies in an interval, which times both norms and with room for rounding bounds their score. Rows lie in cells (nearest
reference, band of the angle to it); a cell's ranges of angles and norms bound the scores of all its rows, and an anchor visits only cells whose bounds reach
the scores it looks for. Inside a cell rows are ordered by the angle to its reference, the bounds cut out a window of that order, the remaining references thin it out,
and only what is left gets integer scoring.

Three rounds of visits: the anchor's own cell gives a first list of positives, whose last score all other cells must reach to be visited for better ones; the final
positives give the score windows of the negatives. A cell's rows and its visitors are both cut into chunks of bounded size and every pair of chunks is one group, so a cell
of a third of all rows is many groups. What leaves a group are a few best rows for each visitor.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .tables import keep, plain

REFERENCES, BANDS = 16, 16
SAMPLE = 4096  # rows that the reference directions are fitted on
CHUNK = 4096  # rows and visitors of a group
SLACK = 1e-6  # radians, far more than arccos loses by rounding
LIMIT = 2.0 ** 31  # scaled components at or beyond it leave no room for a score


class Cells(NamedTuple):
    """Reference directions (as rows) and, for each cell, its rows, lowest and highest angles to the references, and largest norm."""

    directions: np.ndarray
    cells: list[int]
    counts: list[int]
    low: np.ndarray
    high: np.ndarray
    norms: np.ndarray


def _matrix(column) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), flat.dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def integer_scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows with one integer vector."""
    bound = int(np.abs(rows).max(initial=0)) * int(np.abs(anchor).max(initial=0)) * max(1, rows.shape[1])
    if bound < 1 << 53:
        return (rows.astype(float) @ anchor.astype(float)).astype(np.int64)
    if bound < 1 << 63:
        return rows @ anchor
    return rows.astype(object) @ anchor.astype(object)


def angles_to(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of each row to each direction; a right angle for zero rows, whose norm makes every bound 0."""
    cosine = (vectors.astype(float) @ _wide(directions, vectors.shape[1]).T[:vectors.shape[1]]) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def score_bounds(a_norm, a_angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) that the score of a vector with one or more rows can be: rows have angles ``low`` (to ``high``) to the references and norms up to ``norms``."""
    high = low if high is None else high
    apart = np.maximum(np.maximum(low - a_angles, a_angles - high), 0.0).max(axis=-1) - SLACK
    turned = np.minimum(a_angles + high, 2 * np.pi - a_angles - low).min(axis=-1) + SLACK
    size = a_norm * norms
    most, least = size * np.cos(np.clip(apart, 0.0, np.pi)), size * np.cos(np.clip(turned, 0.0, np.pi))
    room = SLACK * size + 1e-6
    return np.where(least < 0, least, 0.0 if high is not low else least) - room, np.where(most > 0, most, 0.0 if high is not low else most) + room


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int, shift_every: int, labels: int) -> DataFrame:
    """(id, label, q): rows that take part, each once."""
    rows = plain(vectors, id=F.col(f"`{id_col}`").cast("long"), label=F.col(f"`{label_col}`").cast("long"), v=F.col(f"`{vec_col}`").cast("array<double>"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(LIMIT)), F.lit(False)))
    moved = F.when(F.pmod("id", F.lit(shift_every)) == 0, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label")) if shift_every else F.col("label")
    rows = rows.filter(fine & F.col("id").isNotNull() & F.col("label").isNotNull())
    return rows.select("id", moved.alias("label"), F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("q")).distinct()


def fit_directions(rows: DataFrame, references: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Directions that lie far apart: a few rounds of spherical k-means on the ``sample`` rows of least hash."""
    got = rows.select("q", F.xxhash64("id", "label", "q").alias("h")).orderBy("h").limit(sample).select("q").toArrow().column("q")
    m = _matrix(got).astype(float)
    norm = np.linalg.norm(m, axis=1) if m.size else np.zeros(len(m))
    m = np.unique(m[norm > 0] / norm[norm > 0][:, None], axis=0) if (norm > 0).any() else np.zeros((0, 1))
    if not len(m):
        return np.ones((1, 1))
    at = [0]
    near = m @ m[0]
    while len(at) < min(references, len(m)):  # the row whose best direction is farthest
        at.append(int(near.argmin()))
        near = np.maximum(near, m @ m[at[-1]])
    centre = m[at]
    for _ in range(5):
        own = (m @ centre.T).argmax(axis=1)
        for c in range(len(centre)):
            total = m[own == c].sum(axis=0)
            if np.linalg.norm(total) > 1e-9:
                centre[c] = total / np.linalg.norm(total)
    return centre


def placed(rows: DataFrame, directions: np.ndarray) -> DataFrame:
    """(id, label, q, norm, angles, cell): rows with their stored angles and the cell they lie in."""
    def run(batches):
        for batch in batches:
            q = _matrix(batch.column(2))
            norm = np.linalg.norm(q.astype(float), axis=1) if q.size else np.zeros(len(q))
            angle = angles_to(q, norm, directions)
            own = angle.argmin(axis=1) if len(angle) else np.zeros(0, np.int64)
            band = np.minimum((angle[np.arange(len(own)), own] / np.pi * BANDS).astype(np.int64), BANDS - 1)
            offsets = pa.array(np.arange(len(angle) + 1) * len(directions), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), pa.ListArray.from_arrays(offsets, pa.array(angle.ravel())), pa.array((own * BANDS + band).astype(np.int32))],
                                             names=["id", "label", "q", "norm", "angles", "cell"])
    return rows.select("id", "label", "q").mapInArrow(run, "id long, label long, q array<long>, norm double, angles array<double>, cell int")


def cells_of(rows: DataFrame, directions: np.ndarray) -> Cells:
    """The cells' bounds, at most REFERENCES * BANDS of them."""
    r = range(len(directions))
    found = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("norm").alias("norm"), F.array(*(F.min(F.col("angles")[i]) for i in r)).alias("low"), F.array(*(F.max(F.col("angles")[i]) for i in r)).alias("high")).orderBy("cell").collect()
    return Cells(directions, [x["cell"] for x in found], [x["n"] for x in found], np.array([x["low"] for x in found]), np.array([x["high"] for x in found]), np.array([x["norm"] for x in found]))


def visits(anchors: DataFrame, cells: Cells, first: bool | None) -> DataFrame:
    """A row (cell, ...) for each cell an anchor has to visit: its own one (``first``), the others that can hold a score of ``least`` or more and up to ``most``, or (None) all such."""
    names = anchors.columns
    at = {c: names.index(c) for c in ("norm", "angles", "cell", "least", "most")}

    def run(batches):
        ids = np.array(cells.cells)
        for batch in batches:
            angles = _matrix(batch.column(at["angles"]))
            norm, own, least, most = (batch.column(at[c]).to_numpy(zero_copy_only=False) for c in ("norm", "cell", "least", "most"))
            row, cell = [], []
            for i in range(len(angles)):
                low, high = score_bounds(norm[i], angles[i], cells.norms, cells.low, cells.high)
                go = ids == own[i] if first else (high >= least[i]) & (low <= most[i]) & ((ids != own[i]) | (first is None))
                cell.append(ids[go])
                row.append(np.full(int(go.sum()), i))
            row, cell = np.concatenate([*row, np.zeros(0, np.int64)]), np.concatenate([*cell, np.zeros(0, np.int64)])
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.int32())], names=[*names, "visit"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, f"{kinds}, visit int")


def met(visitors: DataFrame, rows: DataFrame, cells: Cells, found, schema: str) -> DataFrame:
    """``found(visitors, rows, reference)`` for every pair of a chunk of a cell's visitors and a chunk of its rows."""
    visitors = keep(visitors, "visits")
    many = {r["visit"]: r["n"] for r in visitors.groupBy("visit").agg(F.count("*").alias("n")).collect()}  # at most one for each cell
    if not many:
        return visitors.sparkSession.createDataFrame([], schema)

    def pieces(numbers: dict, key: str):  # chunks of each cell, a bounded list of constants
        return F.create_map(*(F.lit(int(x)) for kv in numbers.items() for x in kv))[F.col(key)]

    row_chunks = {c: -(-n // CHUNK) for c, n in zip(cells.cells, cells.counts)}
    visit_chunks = {c: -(-n // CHUNK) for c, n in many.items()}
    left = visitors.withColumn("vchunk", F.pmod(F.xxhash64("id", "label", "q"), pieces(visit_chunks, "visit")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), pieces(row_chunks, "visit") - 1)))
    right = rows.filter(F.col("cell").isin(list(many))).withColumn("chunk", F.pmod(F.xxhash64("id", "label", "q"), pieces(row_chunks, "cell")).cast("int")).withColumn("vchunk", F.explode(F.sequence(F.lit(0), pieces(visit_chunks, "cell") - 1)))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(v: pa.Table, r: pa.Table) -> pa.Table:
        out = found(v, r, v.column("visit")[0].as_py() // BANDS) if v.num_rows and r.num_rows else [[] for _ in names]
        return pa.table([pa.array(c, pa.int64()) for c in out], names=names)

    return left.groupBy("visit", "chunk", "vchunk").cogroup(right.groupBy(F.col("cell").alias("visit"), "chunk", "vchunk")).applyInArrow(run, schema)


class Side:
    """The rows of a group in the order of their angle to the cell's reference."""

    def __init__(self, rows: pa.Table, reference: int):
        angles = _matrix(rows.column("angles"))
        order = np.argsort(angles[:, reference], kind="stable")
        self.angles, self.line = angles[order], angles[order, reference]
        self.q = _matrix(rows.column("q"))[order]
        self.id, self.label, self.norm = (rows.column(c).to_numpy()[order] for c in ("id", "label", "norm"))
        self.most, self.reference = float(self.norm.max()), reference

    def window(self, norm: float, angles: np.ndarray, least: float, most: float, fits: np.ndarray) -> np.ndarray:
        """Places of the rows that ``fits`` admits and whose score bounds overlap [least, most]."""
        size, at = norm * self.most, angles[self.reference]
        reach = np.pi
        if least > 0:
            share = (least - 1e-6) / size - SLACK if size > 0 else 2.0
            if share > 1.0:
                return np.zeros(0, np.int64)
            reach = float(np.arccos(max(share, -1.0))) + 2 * SLACK
        a, b = np.searchsorted(self.line, [at - reach, at + reach], side="left")
        place = a + np.flatnonzero(fits[a:b])
        low, high = score_bounds(norm, angles, self.norm[place], self.angles[place])
        return place[(high >= least) & (low <= most)]

    def scores(self, place: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores, best first, ties to the smaller id."""
        width = max(self.q.shape[1], len(q))
        if self.q.shape[1] < width:
            self.q = _wide(self.q, width)
        s = integer_scores(self.q[place], np.pad(q, (0, width - len(q))))
        order = sorted(range(len(s)), key=lambda i: (-s[i], self.id[place[i]])) if s.dtype == object else np.lexsort((self.id[place], -s))
        return place[order], s[order]


def _visitors(v: pa.Table):
    q, angles = _matrix(v.column("q")), _matrix(v.column("angles"))
    return zip(*(v.column(c).to_pylist() for c in ("id", "label", "norm")), q, angles)


def _positives(k: int):
    def found(v, r, reference):
        side, out = Side(r, reference), []
        for (anchor, label, norm, q, angles), least in zip(_visitors(v), v.column("least").to_pylist()):
            place = side.window(norm, angles, least, np.inf, (side.label == label) & (side.id != anchor))
            place, s = side.scores(place, q)
            out += [(anchor, label, int(side.id[p]), int(x)) for p, x in zip(place[:k].tolist(), s[:k].tolist())]
        return list(zip(*out)) if out else [[]] * 4
    return found


def _negatives(k: int, low: int, high: int):
    def found(v, r, reference):
        side, out = Side(r, reference), []
        for (anchor, label, norm, q, angles), least, most, positives in zip(_visitors(v), v.column("least").to_pylist(), v.column("most").to_pylist(), v.column("positives").to_pylist()):
            place = side.window(norm, angles, least, most, (side.label != label) & (side.id != anchor))
            if not len(place):
                continue
            place, s = side.scores(place, q)
            for p in positives:
                score = p["score"]
                top, end = high * score // 100, -(-low * score // 100)
                if s.dtype == object:
                    hit = [i for i, x in enumerate(s) if end <= x <= top][:k]
                else:  # falling: from the first score within the upper end to the last one within the lower end
                    a, b = int(np.searchsorted(-s, -top, side="left")), int(np.searchsorted(-s, -end, side="right"))
                    hit = range(a, min(b, a + k))
                out += [(anchor, label, p["id"], score, int(side.id[place[i]]), int(s[i])) for i in hit]
        return list(zip(*out)) if out else [[]] * 6
    return found


def _best(df: DataFrame, keys: list[str], score: str, other: str, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), other))).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", anchor_every: int = 100, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, scale: int = 256, shift_every: int = 7, labels: int = 10) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its ``positives`` best rows of the same label
    the ``negatives`` best rows of other labels whose score is ``low`` to ``high`` per cent of the positive's.

    Scores are exact integer products of floor(scale * component); ties go to the smaller id. Where the id is divisible by ``shift_every`` the label moves on by one
    modulo ``labels`` first. Rows with a null id, label or vector, a null or non-finite component, or one of 2**31 or more after scaling (its scores need not fit a
    long) take no part. Equal rows count once; different rows of one id are rows of their own but never partners of each other, and as anchors they are mined
    together by label. Of vectors of different widths the shorter ends in zeros; an empty vector scores 0. A positive without such negatives gives no row, a negative
    positive score can have none. Other columns are ignored; an empty table gives no rows.
    """
    rows = keep(integer_rows(vectors, id_col, vec_col, label_col, scale, shift_every, labels), "integers")
    directions = fit_directions(rows)
    rows = keep(placed(rows, directions), "placed")
    cells = cells_of(rows, directions)
    endless = F.lit(float("inf"))
    anchors = keep(rows.filter(F.pmod("id", F.lit(anchor_every)) == 0).select("*", (-endless).alias("least"), endless.alias("most")), "anchors")
    found = "anchor long, label long, other long, score long"
    first = keep(met(visits(anchors, cells, True), rows, cells, _positives(positives), found), "positives")
    first = _best(first, ["anchor", "label"], "score", "other", positives).drop("rank")
    full = first.groupBy("anchor", "label").agg(F.min("score").alias("least_score"), F.count("*").alias("n")).filter(F.col("n") >= positives)
    raised = anchors.drop("least").join(full.select(F.col("anchor").alias("id"), "label", F.col("least_score").cast("double").alias("least")), ["id", "label"], "left").select(*anchors.drop("least").columns, F.coalesce("least", -endless).alias("least"))
    more = met(visits(raised, cells, False), rows, cells, _positives(positives), found)
    best = keep(_best(first.unionByName(more), ["anchor", "label"], "score", "other", positives), "positives")
    windows = best.groupBy(F.col("anchor").alias("id"), "label").agg(F.collect_list(F.struct(F.col("other").alias("id"), "score")).alias("positives"), (F.min("score") * (low / 100)).alias("least"), (F.max("score") * (high / 100)).alias("most"))
    looking = anchors.drop("least", "most").join(windows, ["id", "label"]).filter("most >= least")
    pairs = met(visits(looking, cells, None), rows, cells, _negatives(negatives, low, high), "anchor long, label long, positive long, positive_score long, negative long, negative_score long")
    out = _best(pairs, ["anchor", "label", "positive", "positive_score"], "negative_score", "negative", negatives)
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("negative").alias("negative_id"), "positive_score", "negative_score")
