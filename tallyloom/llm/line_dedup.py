"""Line de-duplication by pairwise alignment.

Documents overlap if they share a window: consecutive lines, blank ones left out, that reach the words of a block and no line more, counted from their first line or
from their last one. Every shared block is covered by shared windows. A window of more documents than one ties each later document to the window's first
document, so the number of pairs grows with the number of lines however common a passage is. Each pair is aligned by patience diff: lines
that are unique in both, in their longest common order, are anchors; the alignment grows from them and is repeated inside the gaps; without such lines the
n-th occurrences of a line are anchors. Aligned blocks of enough words are deleted from the later document, and so are common windows that the alignment
passes by because they lie in another order or several times: a document between the two may hold them alone.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import _powers, mix, segment_sums, slices, span_hashes, text_buffers, words
from .tables import keep, likely_among, plain

BLOCK_WORDS = 20  # words of an aligned block that is deleted


def longest_rise(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tails, at, back = [], [], []
    for i, v in enumerate(values):
        p = bisect_left(tails, v)
        tails[p:p + 1] = [v]
        at[p:p + 1] = [i]
        back.append(at[p - 1] if p else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Patience diff: matching places (i, j) with a[i] == b[j], increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        once_a, once_b = {}, {}
        for part, low, high, once in ((a, i0, i1, once_a), (b, j0, j1, once_b)):
            for p in range(low, high):
                once[part[p]] = -1 if part[p] in once else p
        common = [(p, once_b[v]) for v, p in once_a.items() if p >= 0 and once_b.get(v, -1) >= 0]
        if not common:
            places = {}
            for p in range(j1 - 1, j0 - 1, -1):
                places.setdefault(b[p], []).append(p)
            common = [(p, places[a[p]].pop()) for p in range(i0, i1) if places.get(a[p])]
        chain = [common[k] for k in longest_rise([j for _, j in common])]
        last = (i0, j0)
        for i, j in chain:
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        if chain:
            todo.append((last[0], i1, last[1], j1))
    return sorted(out)


def window_ends(weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the shortest runs whose weights (1 or more each) sum to ``least``, from each first and from each last line."""
    total = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    at = np.arange(len(total))
    end = np.searchsorted(total, total + least)
    start = np.searchsorted(total, total - least, side="right") - 1
    fits, begun = end < len(total), start >= 0
    return np.concatenate([at[fits], start[begun]]), np.concatenate([end[fits], at[begun]])


def common_blocks(earlier: list, later: list, weights: list[int], least: int) -> list[int]:
    """Lines of ``later`` in blocks that are in both and whose weights sum to ``least`` or more; blank lines (0) neither part a block nor start or end it."""
    full = [p for p, v in enumerate(later) if v != 0]
    a, b, w = [v for v in earlier if v != 0], [later[p] for p in full], [weights[p] for p in full]
    blocks, block = [], []
    for i, j in [*align(a, b), (-2, -2)]:
        if block and (i - 1, j - 1) != block[-1]:
            blocks.append((block[0][1], block[-1][1] + 1))
            block = []
        block.append((i, j))
    out = {q for i, j in blocks if sum(w[i:j]) >= least for q in range(full[i], full[j - 1] + 1)}
    heavy = dict(zip(b, w))
    known = {tuple(a[i:j]) for i, j in zip(*(x.tolist() for x in window_ends(np.array([heavy.get(v, least) for v in a]), least)))}
    for i, j in zip(*(x.tolist() for x in window_ends(np.array(w), least))):
        if tuple(b[i:j]) in known:
            out.update(range(full[i], full[j - 1] + 1))
    return sorted(out)


def window_hashes(hashes: np.ndarray, n: np.ndarray, lines: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text's windows, with their offsets; ``lines`` are the offsets of the texts' lines."""
    full = np.flatnonzero(n > 0)
    first = np.searchsorted(full, lines)
    text = np.repeat(np.arange(len(lines) - 1), np.diff(first))
    start, end = window_ends(n[full], least)
    inside = text[start] == text[end - 1]
    start, end = start[inside], end[inside]
    up, down = _powers(len(full) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes[full] * up[:len(full)], dtype=np.uint64)])
    key = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    order = np.lexsort((key, text[start]))
    key, of = key[order], text[start][order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    return key[new], np.concatenate([[0], np.cumsum(np.bincount(of[new], minlength=len(lines) - 1))])


def line_hashes(texts: DataFrame, least: int) -> DataFrame:
    """(id, digest, hashes, words, windows): the lines of each text of (id, digest, text), blanks at their ends left out of the hash; a blank line has hash 0."""
    def run(batches):
        for batch in batches:
            raw, offsets = text_buffers(batch.column(2))
            for a, b in slices(offsets, 1 << 20):
                part, off = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                cut = np.flatnonzero(part == 10)
                starts = np.sort(np.concatenate([off[:-1], cut + 1]), kind="stable")
                lines = np.concatenate([[0], np.cumsum(np.searchsorted(cut, off[1:]) - np.searchsorted(cut, off[:-1]) + 1)])
                ws, we, first = words(part, np.append(starts, len(part)))
                n = np.diff(first)
                full = np.flatnonzero(n > 0)
                hashes = np.zeros(len(starts), np.uint64)
                if len(full):
                    hashes[full] = span_hashes(part, ws[first[full]], we[first[full + 1] - 1])
                at = pa.array(lines, pa.int32())
                window, ends = window_hashes(hashes, n, lines, least)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(at, pa.array(hashes.view(np.int64))), pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32))),
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(window.view(np.int64)))], names=["id", "digest", "hashes", "words", "windows"])
    return texts.mapInArrow(run, "id long, digest long, hashes array<long>, words array<int>, windows array<long>")


def _aligned(least: int):
    """Removed lines of each pair (id, digest, hashes, words, earlier)."""
    def run(batches):
        for batch in batches:
            rows = [common_blocks(e, h, w, least) for h, w, e in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["id", "digest", "gone"])
    return run


def _cut(batches):
    """(doc_id, n_lines, removed_lines, text) from (id, text, gone); texts without lines to remove pass as they are."""
    for batch in batches:
        rows = []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            drop = set(gone or ())
            lines = text.split("\n") if drop else None
            rows.append((len(lines) if drop else text.count("\n") + 1, len(drop), "\n".join(line for p, line in enumerate(lines) if p not in drop) if drop else text))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_lines", "removed_lines", "text"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_lines, removed_lines, text) of every row: the text without the blocks it shares with an earlier document (smaller id).

    Lines end at newlines; a null or empty text is one empty line and stays (null becomes empty). Of rows that repeat an id none is earlier than the other; each
    text of such an id loses its own lines. Rows without an id are not compared. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = plain(docs, id=F.col(f"`{id_col}`").cast("long"), digest=F.xxhash64(text), text=text)
    lined = keep(line_hashes(texts, block_words), "lines").filter("id IS NOT NULL")
    lists = lined.groupBy("id", "digest").agg(F.first(F.struct("hashes", "words")).alias("l")).select("id", "digest", "l.hashes", "l.words")  # rows of equal texts have equal lines
    seen = lined.select("id", "digest", F.explode("windows").alias("hash"))
    shared = seen.groupBy("hash").agg(F.min(F.struct("id", "digest")).alias("first"), F.max("id").alias("last")).filter("first.id < last").select("hash", F.col("first.id").alias("first"), F.col("first.digest").alias("first_digest"))
    pairs = seen.join(shared, "hash").filter("id > first").select("id", "digest", "first", "first_digest").distinct()
    pairs = pairs.join(lists.select(F.col("id").alias("first"), F.col("digest").alias("first_digest"), F.col("hashes").alias("earlier")), ["first", "first_digest"]).join(lists, ["id", "digest"]).select("id", "digest", "hashes", "words", "earlier")
    gone = pairs.mapInArrow(_aligned(block_words), "id long, digest long, gone array<int>").filter(F.size("gone") > 0)
    gone = keep(gone.groupBy("id", "digest").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")), "gone")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # only texts that may lose lines are shuffled
    maybe, whole = likely_among(texts, "id", gone.select("id"))
    cut = maybe.join(gone, ["id", "digest"], "left").select("id", "text", "gone").mapInArrow(_cut, "doc_id long, n_lines long, removed_lines long, text string")
    return cut.unionByName(whole.select(F.col("id").alias("doc_id"), lines.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("removed_lines"), "text"))
