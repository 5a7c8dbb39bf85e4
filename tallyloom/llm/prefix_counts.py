"""Exact token counts at every prefix of a text.

Byte-pair encodings have a last token for every prefix: the one piece that ends there, encodes to itself, and forms a valid pair with the last token
of the prefix before it (a pair is valid if merging its joined text gives back just that pair). A dynamic programme over prefixes therefore gives
count(p) = count(p - len(piece)) + cost(piece) without encoding any prefix. It runs over the words of a batch side by side, as no piece has a space inside; a
text's counts are those of the words before plus those inside the current word. Questions about truncation and budgets read the counts.

A prefix's last token depends on the last tokens of as many prefixes as a piece has characters. Long words are therefore cut into segments that run side by
side, each from a guess of the tokens before it; a segment whose guess was wrong runs again from its predecessor's end, until all agree.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import U, mix, slices, text_buffers
from .lexicon import gather
from .tables import plain
from .vocabulary import PairTable, PieceBPE, merge_words, piece_bpe

CACHE = 300_000    # words whose counts a worker keeps at hand
CELLS = 1 << 22    # cells of one group of words in the dynamic programme
PAIRS = 500_000    # answers about pairs of tokens that a worker keeps
LONG = 256         # characters from which a word runs in segments
SEGMENT = 128      # characters of a segment
BAND = 1 << 13     # segments that run side by side
FOREIGN = 1 << 24  # id of the first character that is no piece
_UP = np.array([0x9E3779B97F4A7C15 | 1], U)


def byte_cost(codes: np.ndarray) -> np.ndarray:
    """Bytes of each character in UTF-8."""
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


class PrefixCounter:
    """Counts at all prefixes of words that start with the space mark."""

    def __init__(self, path: str):
        self.model: PieceBPE = piece_bpe(path)
        self.word = re.compile(f"{PieceBPE.SPACE}+[^{PieceBPE.SPACE}]*")
        ids = np.array(list(self.model.texts), np.int64)
        # pieces that merging their own characters gives back
        sym, off = merge_words(*self.symbols([self.model.texts[i] for i in ids.tolist()]), self.model.table, single=True)
        whole = (np.diff(off) == 1) & (sym[np.minimum(off[:-1], len(sym) - 1)] == ids)
        codes = [np.array([ord(c) for c in self.model.texts[i]], np.int64) for i in ids[whole].tolist()]
        # by length: sorted hashes of all ends of pieces, with the piece's id where the end is a whole piece
        tails: dict[int, dict[tuple, int]] = {n: {} for n in range(1, max(map(len, codes)) + 1)}
        for code, i in zip(codes, ids[whole].tolist()):
            for n in range(1, len(code) + 1):
                tails[n].setdefault(tuple(code[-n:]), -1)
            tails[len(code)][tuple(code)] = i
        self.tails = []
        for n, found in tails.items():
            keys = self.hashes(np.array(list(found), np.int64).reshape(len(found), n))[:, -1]
            order = np.argsort(keys)
            self.tails.append((n, keys[order], np.array(list(found.values()), np.int64)[order], U(pow(int(_UP[0]), n, 1 << 64))))
        self.size = np.ones(max(self.model.texts) + 1, np.int64)
        self.size[ids] = [len(self.model.texts[i]) for i in ids.tolist()]
        self.remember(np.zeros(0, np.int64), np.zeros(0, bool))
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.off, self.counts = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.ids
        off = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=off[1:])
        return np.array([ids.get(c, FOREIGN + ord(c)) for t in texts for c in t], np.int64), off

    @staticmethod
    def hashes(codes: np.ndarray) -> np.ndarray:
        """Rolling hashes of all prefixes along the last axis."""
        out, h = np.empty(codes.shape, U), np.zeros(codes.shape[:-1], U)
        for i in range(codes.shape[-1]):
            h = h * _UP[0] + mix(codes[..., i].astype(U) + U(1))
            out[..., i] = h
        return out

    def pair_ok(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the tokens stay as they are beside each other; answers are kept: most in a hash table, new ones in a small sorted list."""
        key = left << 32 | right
        at = self.asked.find(key)
        out = self.answers[at]
        rest = np.flatnonzero(at == len(self.answers) - 1)
        if not len(rest):
            return out
        place = np.searchsorted(self.pairs, key[rest])
        new = np.ones(len(rest), bool)
        inside = np.flatnonzero(place < len(self.pairs))
        new[inside] = self.pairs[place[inside]] != key[rest[inside]]
        if new.any():
            fresh = np.unique(key[rest[new]])
            pairs = np.concatenate([self.pairs, fresh])
            order = np.argsort(pairs, kind="stable")
            self.pairs, self.valid = pairs[order], np.concatenate([self.valid, self.merged_alone(fresh)])[order]
            place = np.searchsorted(self.pairs, key[rest])
        out[rest] = self.valid[place]
        if len(self.pairs) > 5000 + len(self.answers) // 4:
            every = np.concatenate([self.asked_keys, self.pairs]) if len(self.answers) < PAIRS else self.pairs
            good = np.concatenate([self.answers[:-1], self.valid]) if len(self.answers) < PAIRS else self.valid
            self.remember(every, good)
        return out

    def remember(self, pairs: np.ndarray, good: np.ndarray) -> None:
        self.asked_keys, self.answers = pairs, np.append(good, False)
        self.asked = PairTable(pairs, np.arange(len(pairs)), np.arange(len(pairs)))
        self.pairs, self.valid = np.zeros(0, np.int64), np.zeros(0, bool)

    def merged_alone(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of each pair gives the pair again."""
        a, b, texts = pairs >> 32, pairs & 0xFFFFFFFF, self.model.texts
        sym, off = merge_words(*self.symbols([texts[x] + texts[y] for x, y in zip(a.tolist(), b.tolist())]), self.model.table, single=True)
        good = np.diff(off) == 2
        good[good] = (sym[off[:-1][good]] == a[good]) & (sym[off[:-1][good] + 1] == b[good])
        return good

    def programme(self, words: list[str]) -> np.ndarray:
        """Counts at all prefixes of words of like length, as a matrix padded with 0; column 0 is the empty prefix."""
        width = max(map(len, words))
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)
        length = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-length, kind="stable")
        last = np.full((len(words), width + 1), -1, np.int64)
        count = self.fill(codes[order], length[order], last)
        out = np.empty_like(count)
        out[order] = count
        return out

    def fill(self, codes: np.ndarray, length: np.ndarray, last: np.ndarray, known: int = 0) -> np.ndarray:
        """Fill in the last token of every prefix beyond the ``known`` first characters, longest rows first; returns the counts from there."""
        width = codes.shape[1]
        rolled = np.concatenate([np.zeros((len(codes), 1), U), self.hashes(codes)], axis=1)
        count = np.zeros((len(codes), width + 1), np.int64)
        cost = byte_cost(codes)
        for i in range(known + 1, width + 1):
            rows = np.arange(np.searchsorted(-length, -i, side="right"))
            alive = rows  # words whose last n characters end some piece and whose last token isn't found yet
            for n, keys, ids, power in self.tails:
                if n > i or not len(alive):
                    break
                key = rolled[alive, i] - rolled[alive, i - n] * power
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                found = keys[at] == key
                alive, piece = alive[found], ids[at[found]]
                hit = np.flatnonzero(piece >= 0)
                piece, row = piece[hit], alive[hit]
                before = last[row, i - n]
                ok = np.ones(len(row), bool)
                ask = (before >= 0) & (before < FOREIGN)
                ok[ask] = self.pair_ok(before[ask], piece[ask])
                last[row[ok], i] = piece[ok]
                count[row[ok], i] = count[row[ok], i - n] + 1
                alive = np.delete(alive, hit[ok])
            # no piece: the character falls back to its bytes
            rows = rows[last[rows, i] < 0]
            last[rows, i] = FOREIGN + codes[rows, i - 1]
            count[rows, i] = count[rows, i - 1] + cost[rows, i - 1]
        return count

    def settle(self, rows: list[np.ndarray], seeds: list[bytes]) -> list[np.ndarray]:
        """Last tokens at all prefixes of words cut into segments: ``rows`` has a word's segments, each with the characters before it, ``seeds`` the last tokens before the word's first one."""
        back = self.tails[-1][0]
        fresh = np.full(back, -1, np.int64).tobytes()
        names = [[r.tobytes() for r in word] for word in rows]
        ends = [[fresh] * len(word) for word in rows]  # last tokens at a segment's end, as far as they are known
        found: dict[tuple[bytes, bytes], np.ndarray] = {}
        while True:
            ask = {}
            for word, name, end, seed in zip(rows, names, ends, seeds):
                for k, row in enumerate(name):
                    key = row, seed
                    if key in found:
                        end[k] = found[key][-back:].tobytes()
                    else:
                        ask[key] = word[k]
                    seed = end[k]
            if not ask:
                break
            codes = np.stack(list(ask.values()))
            last = np.full((len(codes), codes.shape[1] + 1), -1, np.int64)
            last[:, 1:back + 1] = np.frombuffer(b"".join(seed for _, seed in ask), np.int64).reshape(-1, back)
            self.fill(codes, np.full(len(codes), codes.shape[1]), last, back)
            found.update(zip(ask, last[:, back + 1:]))
        out = []
        for name, seed in zip(names, seeds):
            parts = []
            for row in name:
                parts.append(found[row, seed])
                seed = parts[-1][-back:].tobytes()
            out.append(np.concatenate(parts))
        return out

    def long_counts(self, words: list[str]) -> list[np.ndarray]:
        """Counts at all prefixes of each word, exact and in time that grows with its length."""
        back = self.tails[-1][0]
        codes = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        rows = []
        for c in codes:
            n = -(-len(c) // SEGMENT)
            padded = np.concatenate([np.zeros(back, np.uint32), c, np.zeros(n * SEGMENT - len(c), np.uint32)])
            rows.append(np.lib.stride_tricks.sliding_window_view(padded, back + SEGMENT)[::SEGMENT])
        last: list[list[np.ndarray]] = [[] for _ in words]
        group, held = [], 0
        for w, row in enumerate(rows):
            for a in range(0, len(row), BAND):
                # a word's later band starts from the end of the one before
                if held + min(BAND, len(row) - a) > BAND or a:
                    self._settle_group(group, last, back)
                    group, held = [], 0
                group.append((w, row[a:a + BAND]))
                held += len(group[-1][1])
        self._settle_group(group, last, back)
        out = []
        for c, parts in zip(codes, last):
            tokens = np.concatenate(parts)[:len(c)]
            piece = tokens < FOREIGN
            size = np.where(piece, self.size[np.where(piece, tokens, 0)], 1)
            count = [0]
            for i, (s, n) in enumerate(zip(size.tolist(), np.where(piece, 1, byte_cost(c)).tolist()), 1):
                count.append(count[i - s] + n)
            out.append(np.array(count, np.int64))
        return out

    def _settle_group(self, group: list, last: list, back: int) -> None:
        seeds = [(last[w][-1][-back:] if last[w] else np.full(back, -1, np.int64)).tobytes() for w, _ in group]
        for (w, _), tokens in zip(group, self.settle([r for _, r in group], seeds)):
            last[w].append(tokens)

    def learn(self, words: list[str]) -> None:
        words.sort(key=len)
        a = 0
        counts, sizes = [], []
        short = bisect_left(words, LONG, key=len)
        while a < short:
            width, b = len(words[a]), a + 1
            top = max(width + 3, width * 5 // 4)
            while b < short and len(words[b]) <= top and (b - a) * top < CELLS:
                b += 1
            size = np.array([len(w) + 1 for w in words[a:b]], np.int64)
            table = self.programme(words[a:b])
            counts.append(table[np.arange(table.shape[1]) < size[:, None]])
            sizes.append(size)
            a = b
        for count in self.long_counts(words[short:]):
            counts.append(count)
            sizes.append([len(count)])
        self.known.update(zip(words, range(len(self.off) - 1, len(self.off) - 1 + len(words))))
        self.counts = np.concatenate([self.counts, *counts])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(np.concatenate(sizes))])

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all words of the texts in the table of counts, and the offsets of each text's words."""
        if len(self.known) > CACHE:
            self.reset()
        mark = PieceBPE.SPACE
        found = [self.word.findall(mark + t.replace(" ", mark)) if t else [] for t in texts]
        new = set().union(*found) - self.known.keys()
        if new:
            self.learn(list(new))
        off = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(f) for f in found], out=off[1:])
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64), off

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of each text, with the places of its words and their offsets."""
        at, off = self.split(texts)
        full = np.concatenate([[0], np.cumsum(self.counts[self.off[at + 1] - 1])])
        return full[off[1:]] - full[off[:-1]], at, off

    def prefix_counts(self, at: np.ndarray) -> np.ndarray:
        """Counts at every prefix of one text, given its words' places: item p is the count of its first p characters."""
        if not len(at):
            return np.zeros(1, np.int64)
        size = self.off[at + 1] - self.off[at] - 1
        before = np.concatenate([[0], np.cumsum(self.counts[self.off[at + 1] - 1])[:-1]])
        inside = gather(self.counts, self.off[at] + 1, size) + np.repeat(before, size)
        inside[0] = 0  # the space mark put before the text
        return inside


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter for each worker process; what it has learnt serves all its tasks."""
    return PrefixCounter(path)


def _texts(column):
    raw, offsets = text_buffers(column)
    data = memoryview(raw)
    for a, b in slices(offsets, 4 << 20):
        yield a, b, [str(data[s:e], "utf-8") for s, e in zip(offsets[a:b].tolist(), offsets[a + 1:b + 1].tolist())], np.diff(offsets[a:b + 1])


def token_counts(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, cut_chars) of every whole text, with the tokens of the SentencePiece BPE file ``model``.

    ``cut_chars``: the most characters from the text's start that have at most ``limit`` tokens, read from the prefix counts. A null or empty text has 0 of all;
    repeated rows and null ids give a row each; other columns are ignored.
    """
    def run(batches):
        counter = prefix_counter(model)
        for batch in batches:
            for a, b, texts, n_bytes in _texts(batch.column(1)):
                n, at, off = counter.totals(texts)
                cut = np.array([len(t) for t in texts], np.int64)
                for r in np.flatnonzero(n > limit).tolist():
                    cut[r] = np.flatnonzero(counter.prefix_counts(at[off[r]:off[r + 1]]) <= limit)[-1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n_bytes), pa.array(n), pa.array(n > limit), pa.array(cut)], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])
    return plain(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def prefix_table(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts): the exact token count at every prefix, item p (from 0) for the first p characters. Stored, it answers any later budget."""
    def run(batches):
        counter = prefix_counter(model)
        for batch in batches:
            for a, b, texts, _ in _texts(batch.column(1)):
                _, at, off = counter.totals(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([counter.prefix_counts(at[off[r]:off[r + 1]]) for r in range(b - a)], pa.list_(pa.int32()))], names=["doc_id", "counts"])
    return plain(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=text_col).mapInArrow(run, "doc_id long, counts array<int>")


def longest_prefix(counts, budget):
    """Column: the most characters whose count in ``counts`` is within the budget. Nothing is encoded again."""
    return F.array_max(F.transform(F.col(counts), lambda c, i: F.when(c <= budget, i).otherwise(0)))
