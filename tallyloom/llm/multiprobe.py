"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors get one more component that lifts all of them to the largest norm, so the largest inner product is the smallest Euclidean
distance. A table hashes a vector by k functions floor((a.x + b) / w) with Gaussian a. A query visits its own bucket and buckets with
some functions moved to other cells, in the order of their estimated chance to hold a neighbour; candidates of all tables merge and are ranked by exact scores.

How many buckets all queries visit is fitted: a bounded sample of queries is compared with all rows, and the number of visits is the smallest one that finds TARGET of the true
neighbours. Then each query judges by its own evidence: at the distance of the last neighbour it found, the estimated chance of the cells it saw must reach TARGET, else it goes on to
further cells; where all cells within reach are not enough, or hold fewer rows than are asked for, it is compared with all rows, in blocks. Every row is indexed. Equal vectors are one entry that remembers as many of its smallest ids as a result can hold, and a crowded bucket is cut into
chunks that its visitors all see, so neither a frequent vector nor a crowded bucket is one task's work.
"""

from __future__ import annotations

from itertools import combinations, product
from math import erf

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .hashing import U, mix
from .tables import keep, plain

TABLES = 2
WIDTH = 2.0          # cell width in units of the norm
BUCKET = 2000        # entries of a bucket aimed at
MOST_FUNCTIONS = 20
FULL_MOVES = 8       # functions up to which all may move at once; of more, MOVED at most
MOVED = 4
CHUNK = 8192         # entries of a chunk of a crowded bucket
SAMPLE = 64          # queries of the fit
TARGET = 0.96        # share of true neighbours to be found in the fit

def _phi(z: np.ndarray) -> np.ndarray:
    """The normal distribution function."""
    return np.array([0.5 * (1 + erf(v / 2 ** 0.5)) for v in z.ravel().tolist()]).reshape(z.shape)


def _clean(dimension: int | None, ids_kept: int):
    """Valid vectors of (id, vector): for each distinct one in the task its bytes, its smallest ids and its ids that are queries."""
    def run(batches):
        found: dict[bytes, list] = {}
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            flat = np.where(np.isnan(flat.astype(float)), np.nan, flat).astype(float) + 0.0
            ends = np.cumsum(size)
            for i in np.flatnonzero((size == dimension) & ~np.asarray(batch.column(0).is_null())).tolist():
                v = flat[ends[i] - size[i]:ends[i]]
                if np.isfinite(v).all() and v.any():
                    found.setdefault(v.tobytes(), []).append(int(ids[i]))
            if len(found) > 20_000:
                yield from _entries(found, ids_kept)
                found = {}
        yield from _entries(found, ids_kept)
    return run


def _entries(found: dict, ids_kept: int):
    part = TaskContext.get().partitionId()
    rows = [(v, sorted(set(i))[:ids_kept], part) for v, i in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.list_(pa.int64()), pa.int64()))], names=["vec", "ids", "part"])


def _moves(functions: int, reach: int) -> np.ndarray:
    """By how many cells each function's value is moved, for all cells that may be visited; the own cell comes first."""
    if functions <= FULL_MOVES:
        return np.array(sorted(product(range(-reach, reach + 1), repeat=functions), key=lambda m: sum(map(abs, m))), np.int64)
    out = [np.zeros((1, functions), np.int64)]
    for n in range(1, MOVED + 1):
        at, signs = np.array(list(combinations(range(functions), n))), np.array(list(product((-1, 1), repeat=n)))
        part = np.zeros((len(at), len(signs), functions), np.int64)
        np.put_along_axis(part, np.broadcast_to(at[:, None, :], (len(at), len(signs), n)), np.broadcast_to(signs[None], (len(at), len(signs), n)), axis=2)
        out.append(part.reshape(-1, functions))
    return np.concatenate(out)


class Tables:
    """The hash functions; ``scale`` is the largest norm."""

    def __init__(self, dimension: int, functions: int, scale: float, tables: int = TABLES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.k, self.scale, self.tables = functions, scale, tables
        self.a = rng.standard_normal((tables, dimension + 1, functions)) / (WIDTH * scale)
        self.b = rng.uniform(0, 1, (tables, functions))
        self.reach = 2 if functions <= 4 else 1  # cells that a function's value is moved by at most
        self.moves = _moves(functions, self.reach)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(self.scale ** 2 - (x * x).sum(1), 0))[:, None]], axis=1)

    def query(self, x: np.ndarray) -> np.ndarray:
        """Queries as long as the longest vector; that does not change the order of their neighbours."""
        return np.concatenate([x * (self.scale / np.sqrt((x * x).sum(1)))[:, None], np.zeros((len(x), 1))], axis=1)

    def place(self, lifted: np.ndarray, table: int) -> np.ndarray:
        return lifted @ self.a[table] + self.b[table]

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        h = np.full(cells.shape[:-1], mix(np.array([table + 1], U))[0], U)
        for j in range(self.k):
            h = mix(h * U(0x9E3779B97F4A7C15) + cells[..., j].astype(np.int64).view(U))
        return h.view(np.int64)

    def chances(self, at: np.ndarray, apart) -> np.ndarray:
        """For each query place the logarithm of each move's chance to hold a neighbour at the distance ``apart`` (one, or one for each query)."""
        spread = np.maximum(np.broadcast_to(apart, len(at)) / (WIDTH * self.scale), 1e-9)[:, None]
        inside = at - np.floor(at)
        chance = np.stack([_phi((m + 1 - inside) / spread) - _phi((m - inside) / spread) for m in range(-self.reach, self.reach + 1)], axis=2)
        log = np.log(chance + 1e-300)
        return sum((log[:, j, :][:, self.moves[:, j] + self.reach] for j in range(self.k)), np.zeros((len(at), len(self.moves))))

    def order(self, at: np.ndarray, apart) -> np.ndarray:
        """For each query place the moves, likeliest first."""
        return np.argsort(-self.chances(at, apart), axis=1, kind="stable")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n largest scores of each row, ties to the smaller id."""
    if scores.shape[1] > n:
        edge = np.partition(scores, -n, axis=1)[:, -n]
        out = []
        for row, low in zip(scores, edge):
            c = np.flatnonzero(row >= low)
            out.append(c[np.lexsort((ids[c], -row[c]))[:n]])
        return np.stack(out)
    return np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)


def _true_neighbours(queries: np.ndarray, names: np.ndarray, n: int, tables: Tables):
    """Of each task's entries (cid, vec) the nearest of each sample query, with their bucket keys."""
    def run(batches):
        part = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            scores = queries @ x.T
            scores[names[:, None] == ids[None, :]] = -np.inf
            best = _best(scores, ids, n)
            lifted = tables.lift(x)
            keys = np.stack([tables.keys(np.floor(tables.place(lifted, t)), t) for t in range(tables.tables)], axis=1)
            q = np.repeat(np.arange(len(queries)), best.shape[1])
            c = best.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array([part % 64] * len(q), pa.int64()), pa.array(-scores[q, c]), pa.array(ids[c]), pa.array(list(keys[c]), pa.list_(pa.int64()))], names=["q", "salt", "minus", "cid", "keys"])
    return run


def _fit_visits(entries: DataFrame, tables: Tables, sample: list, n: int) -> tuple[int, float]:
    """(visits of each table, typical distance of a neighbour) from sample queries (cid, vec) against all entries."""
    names = np.array([r["cid"] for r in sample], np.int64)
    queries = np.stack([np.frombuffer(r["vec"], np.float64) for r in sample])
    found = entries.select("cid", "vec").mapInArrow(_true_neighbours(queries, names, n, tables), "q long, salt long, minus double, cid long, keys array<long>").filter("minus < double('inf')")
    top = F.slice(F.array_sort(F.collect_list(F.struct("minus", "cid", "keys"))), 1, n).alias("near")
    again = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, n).alias("near")
    near = [(r["q"], x["minus"], x["keys"]) for r in found.groupBy("q", "salt").agg(top).groupBy("q").agg(again).collect() for x in r["near"]]
    if not near:
        return len(tables.moves), tables.scale
    length = np.sqrt((queries * queries).sum(1))
    apart = float(np.sqrt(np.mean([max(2 * tables.scale ** 2 + 2 * minus * tables.scale / length[q], 0) for q, minus, _ in near])) or tables.scale)
    lifted = tables.query(queries)
    rank = np.full(len(near), len(tables.moves))
    for t in range(tables.tables):
        at = tables.place(lifted, t)
        order = tables.order(at, apart)
        for r, (q, _, keys) in enumerate(near):
            visited = tables.keys(np.floor(at[q]) + tables.moves[order[q]], t)
            hit = np.flatnonzero(visited == keys[t])
            if len(hit):
                rank[r] = min(rank[r], hit[0])
    return int(np.sort(rank)[int(np.ceil(TARGET * len(rank))) - 1]) + 1, apart


def _points(tables: Tables):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                lifted = tables.lift(_matrix(batch.column(1)))
                for t in range(tables.tables):
                    yield pa.RecordBatch.from_arrays([pa.array(tables.keys(np.floor(tables.place(lifted, t)), t)), batch.column(0), batch.column(1)], names=["bucket", "cid", "vec"])
    return run


def _visits(tables: Tables, visits: int, apart: float):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256)
                lifted = tables.query(_matrix(rows.column(1)))
                for t in range(tables.tables):
                    at = tables.place(lifted, t)
                    cells = np.floor(at)[:, None, :] + tables.moves[tables.order(at, apart)[:, :visits]]
                    keys = tables.keys(cells, t)
                    pick = pa.array(np.repeat(np.arange(rows.num_rows), keys.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), rows.column(0).take(pick), rows.column(1).take(pick)], names=["bucket", "qid", "qvec"])
    return run


def _more(tables: Tables, visits: int, apart: float, scan: bool):
    """Of queries (cid, vec, worst, few) those (qid, qvec) that no cells within reach can satisfy (``scan``), or the further cells of the others (bucket, qid, qvec).

    ``worst`` is the negative score of the last neighbour found so far. A table's cells are enough when their chances at that distance add up to what TARGET asks of each table.
    """
    enough = 1 - (1 - TARGET) ** (1 / tables.tables)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256)
                x, worst, few = _matrix(rows.column(1)), rows.column(2).to_numpy(zero_copy_only=False), np.asarray(rows.column(3).to_pylist(), bool)
                own = np.sqrt(np.maximum(2 * tables.scale ** 2 + 2 * np.where(few, 0.0, worst) * tables.scale / np.sqrt((x * x).sum(1)), 0))
                lifted, lost, found = tables.query(x), few.copy(), []
                for t in range(tables.tables):
                    at = tables.place(lifted, t)
                    chance = tables.chances(at, own)
                    order = np.argsort(-chance, axis=1, kind="stable")
                    total = np.cumsum(np.exp(np.take_along_axis(chance, order, 1)), axis=1)
                    lost |= total[:, -1] < enough
                    need = np.concatenate([np.ones((len(x), 1), bool), total[:, :-1] < enough], axis=1)
                    wanted = np.zeros_like(need)
                    np.put_along_axis(wanted, order, need, axis=1)
                    np.put_along_axis(wanted, tables.order(at, apart)[:, :visits], False, axis=1)  # seen already
                    found.append((t, at, wanted))
                if scan:
                    yield rows.select([0, 1]).rename_columns(["qid", "qvec"]).filter(pa.array(lost))
                    continue
                for t, at, wanted in found:
                    row, move = np.nonzero(wanted & ~lost[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(tables.keys(np.floor(at[row]) + tables.moves[move], t)), rows.column(0).take(pa.array(row)), rows.column(1).take(pa.array(row))], names=["bucket", "qid", "qvec"])
    return run


def _met(points: DataFrame, calls: DataFrame, kept: int) -> DataFrame:
    """(qid, minus, cids) of every pair of a chunk of a bucket's entries and a chunk of its visitors."""
    many = lambda df, name: df.groupBy("bucket").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias(name))
    crowd = keep(many(points.select("bucket"), "chunks").join(many(calls.select("bucket"), "visitors"), "bucket"), "buckets")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = points.join(crowd, "bucket").select("bucket", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int").alias("chunk"), span("visitors").alias("visitor"), "cid", "vec")
    asked = calls.join(crowd, "bucket").select("bucket", span("chunks").alias("chunk"), F.pmod(F.xxhash64("qid"), F.col("visitors")).cast("int").alias("visitor"), "qid", "qvec")
    keys = ("bucket", "chunk", "visitor")
    return placed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_rank(kept), "qid long, minus array<double>, cids array<long>")


def _nearest_entries(ranked: DataFrame, kept: int) -> DataFrame:
    """(qid, near): the nearest entries of all that were found for a query. Tables find the same entry, perhaps with another last bit of its score: it counts once."""
    by_entry = ranked.groupBy("qid").agg(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("cids", "minus")))).alias("all"))
    once = by_entry.select("qid", F.filter("all", lambda x, i: (i == 0) | (F.get("all", i - 1)["cids"] != x["cids"])).alias("all"))
    return once.select("qid", F.slice(F.array_sort(F.transform("all", lambda x: F.struct(x["minus"].alias("minus"), x["cids"].alias("cids")))), 1, kept).alias("near"))


def _rank(n: int):
    """The nearest entries of a bucket's chunk for each query that visits it."""
    def run(points: pa.Table, visitors: pa.Table) -> pa.Table:
        names, out = visitors.column("qid").to_numpy(), ([], [])
        if points.num_rows and visitors.num_rows:
            ids, x = points.column("cid").to_numpy(), _matrix(points.column("vec"))
            q = _matrix(visitors.column("qvec"))
            for a in range(0, len(q), 256):
                scores = q[a:a + 256] @ x.T
                best = _best(scores, ids, n)
                out[0].extend(-np.take_along_axis(scores, best, 1))
                out[1].extend(ids[best])
        return pa.table({"qid": pa.array(names[:len(out[0])]), "minus": pa.array(out[0], pa.list_(pa.float64())), "cids": pa.array(out[1], pa.list_(pa.int64()))})
    return run


def nearest(vectors: DataFrame, neighbours: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found rows of each row whose id is divisible by ``every``, itself left out.

    Ranked by the inner product of the original vectors in double precision, ties to the smaller id; a query has fewer than ``neighbours`` only if there are fewer rows. Vectors that are null, zero, or
    have null or non-finite components take no part, nor do those without an id or not of the commonest dimension. Rows that repeat id and vector count once.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = plain(vectors, id=F.col(f"`{id_col}`").cast("long"), vector=F.col(f"`{vector_col}`").cast("array<double>"))
    result = "query_id long, rank int, vec_id long, score double"
    common = rows.groupBy(F.size("vector").alias("d")).count().filter("d > 0").orderBy(F.desc("count"), "d").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], result)
    dimension, kept = common["d"], neighbours + 1
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, kept).alias("ids")
    local = rows.mapInArrow(_clean(dimension, kept), "vec binary, ids array<long>, part long")
    entries = local.groupBy("vec", F.pmod("part", F.lit(64)).alias("part")).agg(smallest).groupBy("vec").agg(smallest)
    entries = keep(entries.select(F.col("ids")[0].alias("cid"), "vec", "ids"), "entries")
    # every query row, by the entry of its vector
    asked = rows.filter(F.pmod("id", F.lit(every)) == 0).mapInArrow(_clean_rows(dimension), "query_id long, vec binary").join(entries.select("vec", "cid"), "vec").select("query_id", F.col("cid").alias("qid")).distinct()
    asked = keep(asked, "asked")
    queries = entries.join(asked.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi").select("cid", "vec")
    count = entries.count()
    sample = queries.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).collect()
    if not sample:
        return vectors.sparkSession.createDataFrame([], result)
    scale = entries.select("vec").mapInArrow(_norms, "n double").agg(F.max("n")).first()[0]
    functions = int(np.clip(round(np.log(max(count / BUCKET, 1)) / np.log(2.8)), 1, MOST_FUNCTIONS))
    tables = Tables(dimension, functions, scale, TABLES)
    visits, apart = _fit_visits(entries, tables, sample, neighbours)
    points = entries.select("cid", "vec").mapInArrow(_points(tables), "bucket long, cid long, vec binary")
    calls = "bucket long, qid long, qvec binary"
    first = keep(_nearest_entries(_met(points, queries.mapInArrow(_visits(tables, visits, apart), calls), kept), kept), "found")
    # each query's own evidence: further cells, or all rows
    seen = first.select(F.col("qid").alias("cid"), F.element_at("near", -1)["minus"].alias("worst"), (F.size("near") < min(kept, count)).alias("few"))
    judged = keep(queries.join(seen, "cid", "left").select("cid", "vec", F.coalesce("worst", F.lit(0.0)).alias("worst"), F.coalesce("few", F.lit(True)).alias("few")), "judged")
    more = _met(points, judged.mapInArrow(_more(tables, visits, apart, False), calls), kept)
    lost = keep(judged.mapInArrow(_more(tables, visits, apart, True), "qid long, qvec binary"), "lost")
    blocks = max(1, -(-count // CHUNK))
    everywhere = lost.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("bucket"), "qid", "qvec")
    rest = _met(entries.select(F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("long").alias("bucket"), "cid", "vec"), everywhere, kept) if lost.limit(1).count() else None
    parts = first.select("qid", F.transform("near", lambda x: x["minus"]).alias("minus"), F.transform("near", lambda x: x["cids"]).alias("cids")).unionByName(more)
    merged = _nearest_entries(parts if rest is None else parts.unionByName(rest), kept)
    # entries back to rows
    members = merged.select("qid", F.explode("near").alias("x")).join(entries.select(F.col("cid").alias("of"), "ids"), F.col("x.cids") == F.col("of"))
    lists = members.groupBy("qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("x.minus").alias("minus"), i.alias("id")))))), 1, 2 * kept).alias("near"))
    mine = asked.join(lists, "qid").select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, neighbours).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def _norms(batches):
    for batch in batches:
        x = _matrix(batch.column(0)) if batch.num_rows else np.zeros((0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((x * x).sum(1)))], names=["n"])


def _clean_rows(dimension: int):
    """(query_id, vec) of the valid vectors among (id, vector)."""
    def run(batches):
        for batch in batches:
            rows = [(i, v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if i is not None and v is not None and len(v) == dimension and None not in v]
            found = [(i, x) for i, x in ((i, np.array(v, float) + 0.0) for i, v in rows) if np.isfinite(x).all() and x.any()]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([x.tobytes() for _, x in found], pa.binary())], names=["query_id", "vec"])
    return run
