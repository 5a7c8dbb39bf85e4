"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's evidence is a weighted sum of its own features and those of the lines before and after it; neighbouring labels are tied
by learnt transition weights. Forward and backward passes give each line's probability of being good, and a document's score is the
mean of its lines' probabilities, weighted by their length in bytes. All passes run over the documents of a batch side by side.

Documents carry one label, so training takes it for each of their lines and maximises the conditional likelihood of the label chains (with an L2 penalty) on a
bounded sample: at most TRAIN_DOCS labelled documents, of each at most TRAIN_LINES lines in a row. Scoring has no bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import segment_sums, slices, span_hashes, text_buffers, words
from .tables import plain

TRAIN_DOCS = 6000
TRAIN_LINES = 64
STEPS = 150
THRESHOLD = 0.3
OWN = 14  # features of one line

_CLASS = np.zeros((6, 256), bool)
_CLASS[0, 65:91] = True                                    # upper case
_CLASS[1, 97:123] = True                                   # lower case
_CLASS[2, 48:58] = True                                    # digits
_CLASS[3, [ord(c) for c in ".,;:?'\"()-"]] = True          # punctuation of prose
_CLASS[4, [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"]] = True  # other symbols
_CLASS[5, [32, 9, 11, 12, 13]] = True


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, offsets of each text's lines). Lines end at newlines; an empty text is one empty line."""
    cut = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([offsets[:-1], cut + 1]), kind="stable")
    stop = np.sort(np.concatenate([cut, offsets[1:]]), kind="stable")
    per_text = np.searchsorted(cut, offsets[1:]) - np.searchsorted(cut, offsets[:-1]) + 1
    lines = np.concatenate([[0], np.cumsum(per_text)])
    size = stop - starts
    total = np.zeros(len(raw) + 1, np.int64)
    counts = []
    for c in _CLASS:
        np.cumsum(c[raw], out=total[1:])
        counts.append(total[stop] - total[starts])
    upper, lower, digit, prose, other, blank = counts
    # words lie inside lines; accents are bytes above 127 and count as letters
    ws, we, first = words(raw, np.append(starts, len(raw)))
    n = np.diff(first)
    hashes = span_hashes(raw, ws, we, lower=True) if len(ws) else np.zeros(0, np.uint64)
    line = np.repeat(np.arange(len(size)), n)
    again = np.zeros(len(ws), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    fresh = np.ones(len(ws), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    tail = _CLASS[4][raw[we - 1]] if len(ws) else np.zeros(0, bool)
    capital = _CLASS[0][raw[ws]] if len(ws) else np.zeros(0, bool)
    lone = (we - ws) == 1
    totals = [segment_sums(x.astype(np.int64), first) for x in (again, fresh, tail, capital, lone & tail)]
    repeat, distinct, tailed, capitals, marks = totals
    by_byte, by_word = 1.0 / np.maximum(size, 1), 1.0 / np.maximum(n, 1)
    own = np.stack([
        np.ones(len(size)), size == 0, np.log1p(size) / 10, np.log1p(n) / 6, upper * by_byte, np.minimum(5 * other * by_byte, 2), np.minimum(5 * digit * by_byte, 2), np.minimum(10 * prose * by_byte, 2),
        repeat * by_word, 1 - distinct * by_word, tailed * by_word, capitals * by_word, marks * by_word, np.minimum((size - blank) * by_word / 10, 2)], axis=1)
    own[size == 0, 2:] = 0
    around = np.zeros((len(size), 2 * OWN))
    head, last = np.zeros(len(size), bool), np.zeros(len(size), bool)
    head[lines[:-1]], last[lines[1:] - 1] = True, True
    inner = np.flatnonzero(~head)
    around[inner, :OWN] = own[inner - 1]
    inner = np.flatnonzero(~last)
    around[inner, OWN:] = own[inner + 1]
    return np.concatenate([own, around], axis=1), size, lines


def _lse(a, b):
    high = np.maximum(a, b)
    return high + np.log1p(np.exp(-np.abs(a - b)))


def forward_backward(evidence: np.ndarray, lines: np.ndarray, ties: np.ndarray):
    """Of chains with the given log odds of 'good' and transition weights ties[2, 2]: P(good) of each line, log partition of each chain, and the
    expected number of each transition. Chains run side by side, longest first, so the ones still running are always a prefix."""
    length = np.diff(lines)
    order = np.argsort(-length, kind="stable")
    start, size = lines[:-1][order], length[order]
    steps = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    good, bad = np.empty(len(evidence)), np.empty(len(evidence))  # forward
    for t in range(steps):
        at = start[:running[t]] + t
        if t:
            g, b = good[at - 1], bad[at - 1]
            good[at], bad[at] = evidence[at] + _lse(g + ties[1, 1], b + ties[0, 1]), _lse(g + ties[1, 0], b + ties[0, 0])
        else:
            good[at], bad[at] = evidence[at], 0.0
    end = lines[1:] - 1
    partition = _lse(good[end], bad[end])
    back_good, back_bad = np.zeros(len(evidence)), np.zeros(len(evidence))
    pairs = np.zeros((2, 2))
    whole = np.empty(len(size))
    whole[:] = partition[order]
    for t in range(steps - 2, -1, -1):
        n = running[t + 1]
        at = start[:n] + t
        g, b = evidence[at + 1] + back_good[at + 1], back_bad[at + 1]
        back_good[at], back_bad[at] = _lse(g + ties[1, 1], b + ties[1, 0]), _lse(g + ties[0, 1], b + ties[0, 0])
        z = whole[:n]
        pairs += [[np.exp(bad[at] + ties[0, 0] + b - z).sum(), np.exp(bad[at] + ties[0, 1] + g - z).sum()], [np.exp(good[at] + ties[1, 0] + b - z).sum(), np.exp(good[at] + ties[1, 1] + g - z).sum()]]
    odds = good + back_good - bad - back_bad
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500))), partition, pairs


def fit(features: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = STEPS, penalty: float = 1e-3):
    """Weights and transitions that maximise the penalised conditional likelihood, by Adam on the whole sample. A chain counts as one whatever its length."""
    weights, ties = np.zeros(features.shape[1]), np.zeros((2, 2))
    if not len(labels):
        return weights, ties
    size = np.diff(lines)
    share = np.repeat(1 / size, size)
    wanted = np.repeat(labels, size).astype(float)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = (size - 1)[labels == 0].sum(), (size - 1)[labels == 1].sum()
    theta, m, v = np.zeros(len(weights) + 4), 0.0, 0.0
    per_line = len(labels) / len(features)  # transitions are counted per line, scaled to chains
    for step in range(1, steps + 1):
        weights, ties = theta[:-4], theta[-4:].reshape(2, 2)
        prob, _, pairs = forward_backward(features @ weights, lines, ties)
        grad = np.concatenate([features.T @ ((wanted - prob) * share), ((seen - pairs) * per_line).ravel()]) / len(labels) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _features(texts: DataFrame) -> DataFrame:
    """(id, label, features) of training rows (id, text, label); of a longer text the TRAIN_LINES lines in its middle."""
    def run(batches):
        for batch in batches:
            raw, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets, 1 << 20):
                own, _, lines = line_features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                for i in range(b - a):
                    start = lines[i] + max(0, lines[i + 1] - lines[i] - TRAIN_LINES) // 2
                    part = own[start:min(lines[i + 1], start + TRAIN_LINES)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + i, 1), batch.column(2).slice(a + i, 1), pa.array([part.astype(np.float32).tobytes()])], names=["id", "label", "features"])
    return texts.mapInArrow(run, "id long, label int, features binary")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = TRAIN_DOCS):
    """Weights learnt from the labels of rows whose crc32(id as text) mod 5 is not 0. Ids with several labels count with the lowest, ids with several texts with
    the one that sorts first.

    At most ``max_docs`` labelled ids, in the order of a hash, are joined to the texts, so the broadcast side and what reaches the driver are bounded.
    """
    known = plain(labels, id=F.col("doc_id").cast("long"), label=F.col(f"`{label_col}`").cast("int")).filter("label IS NOT NULL AND id IS NOT NULL")
    known = known.filter(F.crc32(F.col("id").cast("string")) % 5 != 0).groupBy("id").agg(F.min("label").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_docs)
    rows = plain(docs, id=F.col(f"`{id_col}`").cast("long"), text=text_col).join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    found = sorted(_features(rows).collect(), key=lambda r: (r["id"], bytes(r["features"])))
    chains = [np.frombuffer(r["features"], np.float32).reshape(-1, 3 * OWN) for r in found]
    lines = np.concatenate([[0], np.cumsum([len(c) for c in chains])]).astype(np.int64)
    return fit(np.concatenate([*chains, np.zeros((0, 3 * OWN), np.float32)]).astype(float), lines, np.array([r["label"] for r in found], np.int64))


def quality_scores(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_lines) of every whole text; or, with ``keep_rows``, the rows of ``docs`` that are predicted to be good.

    A null or empty text is one empty line and gets that line's score. Repeated rows and null ids are scored each (a null id is never held out); other columns have no
    influence. An empty table gives no rows. Without labelled rows every score is 0.5.
    """
    weights, ties = model

    def scores(column):
        raw, offsets = text_buffers(column)
        for a, b in slices(offsets, 1 << 20):
            own, size, lines = line_features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            prob, _, _ = forward_backward(own @ weights, lines, ties)
            total = segment_sums(size.astype(float), lines)
            even = np.repeat(total == 0, np.diff(lines))
            share = np.where(even, 1.0, size)
            yield a, b, np.clip(segment_sums(prob * share, lines) / segment_sums(share, lines), 0, 1), np.diff(lines)

    def run(batches):
        for batch in batches:
            for a, b, score, n in scores(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(n)], names=["doc_id", "score", "predicted", "n_lines"])

    def keepers(batches):
        for batch in batches:
            for a, b, score, _ in scores(batch.column(place)):
                yield batch.slice(a, b - a).filter(pa.array(score >= THRESHOLD))

    if keep_rows:
        place = docs.columns.index(text_col)
        return docs.mapInArrow(keepers, docs.schema)
    out = plain(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int, n_lines long")
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted", "n_lines")
