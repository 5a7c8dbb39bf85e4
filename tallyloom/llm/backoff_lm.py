"""Stupid-backoff language-model scores from counts of the whole corpus.

The corpus's n-gram counts are tables partitioned by the n-grams' hash; the documents' n-grams are exploded, joined to the counts and summed for each document. To
move little, documents are dealt into blocks of some megabytes, and a block explodes to its distinct n-grams of each order with their counts, cut into
hash ranges (shards). A shard adds up what all blocks have of its n-grams and gives every block the totals of just the n-grams it asked for; the block
sums the scores of its documents. What is sent grows with the corpus, and a frequent n-gram is one item for each block, however often it occurs.

S(w | context) = count(context w) / count(context) if that n-gram occurs, else BACKOFF * S(w | shorter context); a single word has count / number of words, and an
unknown one 1 / number of words. A document's own n-grams are taken out of the counts before it is scored, so copies within it do not vouch for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import U, mix, segment_sums, slices, span_hashes, text_buffers, words
from .tables import plain

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20
SHARDS_A_BLOCK = 2
BUNDLE = "block long, ids array<long>, sizes array<int>, size long, packed binary"
PARTS = "block long, part long, start long, deltas binary, counts binary"


class Block:
    """The n-grams of a block of texts: for each order the sorted distinct hashes, their counts, and each word's place among them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, order: int, drop: int):
        """``drop``: low bits of the n-grams' hashes that the size of the corpus does not call for."""
        hashes, sizes = [], []
        for a, b in slices(offsets, 1 << 20):
            part = raw[offsets[a]:offsets[b]]
            starts, ends, first = words(part, offsets[a:b + 1] - offsets[a])
            hashes.append(span_hashes(part, starts, ends, lower=True))
            sizes.append(np.diff(first))
        word = np.concatenate([*hashes, np.zeros(0, U)])
        size = np.concatenate([*sizes, np.zeros(0, np.int64)])
        self.first = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(size), dtype=np.int64), size)
        self.depth = np.arange(len(word)) - np.repeat(self.first[:-1], size)  # words before this one in its text
        self.grams, self.counts, self.at = [], [], []
        gram = word
        for n in range(1, order + 1):
            if n > 1:  # the n-gram that ends at each word, from the (n-1)-gram that ends at the word before
                gram = np.concatenate([np.zeros(min(1, len(word)), U), mix(gram[:-1] * U(0x9E3779B97F4A7C15) + word[1:] + U(n))])
            whole = self.depth >= n - 1
            distinct, at, count = np.unique(gram[whole] >> U(drop) << U(drop), return_inverse=True, return_counts=True)
            place = np.full(len(word), -1, np.int64)
            place[whole] = at
            self.grams.append(distinct)
            self.counts.append(count)
            self.at.append(place)

    def own_counts(self, n: int) -> np.ndarray:
        """How often the n-gram that ends at each word occurs in the word's own text; 0 where there is none."""
        place = self.at[n - 1]
        whole = place >= 0
        _, at, count = np.unique(place[whole] * np.int64(len(self.first)) + self.doc[whole], return_inverse=True, return_counts=True)
        out = np.zeros(len(place), np.int64)
        out[whole] = count[at]
        return out


def shard_bounds(grams: np.ndarray, shards: int) -> np.ndarray:
    """Where each of ``shards`` equal hash ranges starts among sorted hashes."""
    edges = np.array([(i << 64) // shards for i in range(shards)], dtype=U)
    return np.append(np.searchsorted(grams, edges), len(grams))


def narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes as the largest needs; the first byte is that number."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widen(data: bytes) -> np.ndarray:
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return out.view("<u8").ravel()


def _bundle(batches):
    """Texts of (id, text, block), compressed together for each block."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column(1))
        data, block = memoryview(raw), batch.column(2).to_numpy()
        order = np.argsort(block, kind="stable")
        ids, sizes, rows = batch.column(0).take(pa.array(order)).to_pylist(), np.diff(offsets)[order], []
        cut = np.flatnonzero(np.concatenate([[True], block[order][1:] != block[order][:-1]])).tolist() if len(order) else []
        for a, b in zip(cut, [*cut[1:], len(order)]):
            blob = b"".join(data[offsets[i]:offsets[i + 1]] for i in order[a:b].tolist())
            rows.append((int(block[order[a]]), ids[a:b], sizes[a:b].tolist(), len(blob), pa.compress(blob, "zstd", asbytes=True)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary()))] if rows else [pa.array([], k) for k in (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary())],
                                         names=[c.split()[0] for c in BUNDLE.split(", ")])


def _unbundle(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """(ids, bytes, offsets) of the texts of a block."""
    raw = [np.frombuffer(pa.decompress(p, n, "zstd"), np.uint8) for p, n in zip(table.column("packed").to_pylist(), table.column("size").to_pylist()) if n]
    sizes = [n for part in table.column("sizes").to_pylist() for n in part]
    return [i for part in table.column("ids").to_pylist() for i in part], np.concatenate([*raw, np.zeros(0, np.uint8)]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _explode(order: int, shards: int, drop: int):
    def run(table: pa.Table) -> pa.Table:
        _, raw, offsets = _unbundle(table)
        block = Block(raw, offsets, order, drop)
        name, rows = table.column("block")[0].as_py(), []
        for n, (grams, counts) in enumerate(zip(block.grams, block.counts), 1):
            bounds = shard_bounds(grams, shards)
            for shard, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if b > a or n == 1:  # every block hears of all words, for their number
                    g = grams[a:b]
                    rows.append((name, n * shards + shard, int(g[0].view(np.int64)) if len(g) else 0, narrow(np.diff(g) >> U(drop)), narrow(counts[a:b])))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.binary()] * 2)], names=[c.split()[0] for c in PARTS.split(", ")])
    return run


def _total(drop: int):
    def run(table: pa.Table) -> pa.Table:
        """Totals of a shard's n-grams, in the order in which each block sent them."""
        counts = [widen(c).astype(np.int64) for c in table.column("counts").to_pylist()]
        grams = [np.cumsum(np.concatenate([[np.int64(s).view(U)], widen(d) << U(drop)]), dtype=U)[:len(c)] for s, d, c in zip(table.column("start").to_pylist(), table.column("deltas").to_pylist(), counts)]
        _, at = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        ends = np.cumsum([len(c) for c in counts])
        out = [narrow(total[at[e - len(c):e]]) for e, c in zip(ends.tolist(), counts)]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "all": pa.array([int(total.sum())] * len(counts), pa.int64()),
                         "size": pa.array([len(t) for t in out], pa.int64()), "totals": pa.array([pa.compress(t, "zstd", asbytes=True) for t in out], pa.binary())})
    return run


def _score(order: int, shards: int, drop: int):
    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        ids, raw, offsets = _unbundle(docs)
        block = Block(raw, offsets, order, drop)
        parts = sorted(zip(*(sums.column(c).to_pylist() for c in ("part", "all", "size", "totals"))))
        corpus = sum(n for part, n, _, _ in parts if part < 2 * shards)
        totals = [np.concatenate([*(widen(pa.decompress(t, size, "zstd", asbytes=True)).astype(np.int64) for part, _, size, t in parts if part // shards == n), np.zeros(0, np.int64)]) for n in range(1, order + 1)]
        words_left = np.maximum(corpus - np.diff(block.first), 1)[block.doc]  # of the other documents
        best = np.zeros(len(block.doc))
        context = words_left
        for n in range(1, order + 1):
            place = block.at[n - 1]
            left = np.where(place >= 0, totals[n - 1][np.maximum(place, 0)] if len(totals[n - 1]) else 0, 0) - block.own_counts(n)
            if n == 1:
                best = np.log(np.maximum(left, 1) / words_left)
            else:
                seen = (left > 0) & (context > 0)
                longer = np.log(np.where(seen, left, 1)) - np.log(np.where(seen, context, 1))
                best = np.where(seen, longer, np.where(place >= 0, best + np.log(BACKOFF), best))
            context = np.concatenate([[0], left[:-1]])[:len(left)]  # count of the n-gram that ends before each word
        total = segment_sums(best, block.first)
        n_words = np.diff(block.first)
        mean = pa.array(total / np.maximum(n_words, 1), mask=n_words == 0)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words), "log_score": pa.array(total), "mean_log_score": mean})
    return run


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every whole text against the counts of all other rows.

    Words are [^\\x20\\x09-\\x0D]+ after A-Z became lower case. A null or empty text has no words, log_score 0 and a null mean. Rows that repeat an id or a text are
    documents of their own, so copies vouch for each other. Other columns are ignored; an empty table gives no rows.

    N-grams are told apart by hashes with 22 bits or more beyond what counts the corpus's bytes, so that one in some millions may share another's count.
    """
    texts = plain(docs, id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = blocks * SHARDS_A_BLOCK
    drop = 64 - min(64, -(-(size.bit_length() + 22) // 8) * 8)
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))).mapInArrow(_bundle, BUNDLE)
    parts = dealt.groupBy("block").applyInArrow(_explode(order, shards, drop), PARTS)
    sums = parts.groupBy("part").applyInArrow(_total(drop), "block long, part long, all long, size long, totals binary")
    return dealt.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_score(order, shards, drop), "doc_id long, n_words long, log_score double, mean_log_score double")
