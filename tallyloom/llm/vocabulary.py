"""Byte-level BPE vocabularies read from tokenizer files, and exact merging of many words at once."""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush
from functools import cached_property, lru_cache

import numpy as np


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A byte-level BPE model from a ``tokenizers`` JSON file whose merge i makes id 256 + i, so that ids are merge ranks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError(f"{path}: only plain byte-level splitting is supported")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        words = {w: i for w, i in model["vocab"].items() if w not in self.special}
        self.ids = {bytes(letters[c] for c in w): i for w, i in words.items()}
        self.bytes_of = {i: w for w, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = np.array([(words[a], words[b]) for a, b in pairs], np.int64)
        made = np.array([words[a + b] for a, b in pairs], np.int64)
        self.first = int(made[0])
        if (np.diff(made) != 1).any():
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        key = self.merges[:, 0] << 32 | self.merges[:, 1]
        order = np.argsort(key)
        self.table = PairTable(key[order], order, made[order])


class PairTable:
    """Ranks and results of mergeable pairs, looked up for whole arrays; a lower rank merges first."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, results: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.at = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        self.ranks, self.results = np.append(ranks, NEVER), np.append(results, -1)
        todo, step = np.arange(len(keys)), 0
        while len(todo):  # linear probing, all keys at once
            place = (self.home(keys[todo]) + step) & self.mask
            free = self.keys[place] == -1
            spot, first = np.unique(place[free], return_index=True)
            won = todo[np.flatnonzero(free)[first]]
            self.keys[spot], self.at[spot] = keys[won], won
            todo, step = np.setdiff1d(todo, won, assume_unique=True), step + 1
        self.steps = step

    def home(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        """(rank, result) of each pair, for single lookups."""
        used = self.keys != -1
        at = self.at[used]
        return dict(zip(self.keys[used].tolist(), zip(self.ranks[at].tolist(), self.results[at].tolist())))

    def find(self, key: np.ndarray) -> np.ndarray:
        """Positions in ``ranks`` and ``results``; the last position for unknown pairs."""
        out = np.full(len(key), len(self.ranks) - 1, np.int64)
        todo, home = np.arange(len(key)), self.home(key)
        for step in range(self.steps):
            place = (home[todo] + step) & self.mask
            seen = self.keys[place]
            hit = seen == key[todo]
            out[todo[hit]] = self.at[place[hit]]
            todo = todo[~hit & (seen != -1)]
            if not len(todo):
                break
        return out


NEVER = 1 << 60
ROUNDS = 32      # rounds after which words of more than LONG_WORD symbols leave the common merging
LONG_WORD = 1024


def merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """Merge one long word, best pair first and the leftmost of equals, in time n log n."""
    pairs, none = table.pairs, (NEVER, -1)
    sym, n = symbols.tolist(), len(symbols)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    at = table.find(symbols[:-1] << 32 | symbols[1:])
    heap = [rank << 40 | i for i, rank in enumerate(table.ranks[at].tolist()) if rank != NEVER]
    heapify(heap)
    while heap:
        top = heappop(heap)
        i = top & (1 << 40) - 1
        j = after[i]
        if sym[i] < 0 or j < 0:
            continue
        rank, result = pairs.get(sym[i] << 32 | sym[j], none)
        if rank != top >> 40:
            continue  # one of the two has been merged since
        sym[i], sym[j] = result, -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right >= 0:
                found = pairs.get(sym[left] << 32 | sym[right])
                if found:
                    heappush(heap, found[0] << 40 | left)
    merged = np.array(sym, np.int64)
    return merged[merged >= 0]


def merge_words(symbols: np.ndarray, offsets: np.ndarray, table: PairTable, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Byte-pair merging of many words side by side: every round applies the best pair of each word, the leftmost of equals first.

    Words are segments of ``symbols``; returns the merged symbols and their offsets. Same result as merging each word alone. A round merges all places
    of the best pair, which is the same thing where no merge makes a pair of a better rank; ``single`` merges one place, for tables without that order.
    Words that are still long after many rounds are finished one by one from a heap.
    """
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    sym, done_sym, done_word, rounds = symbols.astype(np.int64), [], [], 0
    while len(sym):
        same = np.zeros(len(sym), bool)
        same[:-1] = word[1:] == word[:-1]
        at = np.full(len(sym), len(table.ranks) - 1, np.int64)
        left = np.flatnonzero(same)
        at[left] = table.find(sym[left] << 32 | sym[left + 1])
        rank = table.ranks[at]
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.minimum.reduceat(rank, start)
        length = np.diff(np.append(start, len(sym)))
        over = np.repeat(best == NEVER, length)
        done_sym.append(sym[over])
        done_word.append(word[over])
        hit = np.flatnonzero((rank == np.repeat(best, length)) & ~over)
        # overlapping hits (a pair of equal symbols in a run): every second one counts from the left
        chain = np.concatenate([[True], np.diff(hit) != 1]) if len(hit) else np.zeros(0, bool)
        place = np.arange(len(hit)) - np.maximum.accumulate(np.where(chain, np.arange(len(hit)), 0)) if len(hit) else hit
        hit = hit[place % 2 == 0]
        if single:
            hit = hit[np.unique(word[hit], return_index=True)[1]]
        sym[hit] = table.results[at[hit]]
        alive = ~over
        alive[hit + 1] = False
        sym, word = sym[alive], word[alive]
        rounds += 1
        if rounds == ROUNDS and len(sym):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(start, len(sym)))
            for a, n in zip(start[length > LONG_WORD].tolist(), length[length > LONG_WORD].tolist()):
                done_sym.append(merge_long(sym[a:a + n], table))
                done_word.append(np.full(len(done_sym[-1]), word[a]))
            rest = np.repeat(length <= LONG_WORD, length)
            sym, word = sym[rest], word[rest]
    sym, word = np.concatenate([*done_sym, np.zeros(0, np.int64)]), np.concatenate([*done_word, np.zeros(0, np.int64)])
    order = np.argsort(word, kind="stable")
    out = np.zeros(len(offsets), np.int64)
    np.cumsum(np.bincount(word, minlength=len(offsets) - 1), out=out[1:])
    return sym[order], out


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


LONG_BLANK = 4096  # characters of a run of blanks that the encoder's pattern is spared


class FastEncoder:
    """A ``tiktoken`` encoder with the ids of a ``tokenizers`` file; it gives the same ids several times faster.

    Its pattern matcher needs stack for every blank of a run, so long runs are cut out by the pattern's own rule: all blanks but the one before a word
    are a part of their own, all of them where the text or a special token ends the run. Such parts are merged on arrays.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        self.model = byte_bpe(path)
        self.special = tuple(self.model.special)
        if any(regex.search(r"\p{White_Space}", t) for t in self.special):
            raise ValueError(f"{path}: special tokens with blanks are not supported")
        self.blanks = regex.compile(rf"\p{{White_Space}}{{{LONG_BLANK},}}")
        self.encoder = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.model.ids, special_tokens=self.model.special)

    def _short(self, text: str) -> np.ndarray:
        return self.encoder.encode_to_numpy(text, allowed_special="all") if text else np.zeros(0, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text; strings of special tokens count as those tokens, as in the library."""
        parts, at = [], 0
        for run in self.blanks.finditer(text) if len(text) >= LONG_BLANK else ():
            end = run.end()
            if end < len(text) and not text.startswith(self.special, end):
                end -= 1
            blank = np.frombuffer(text[run.start():end].encode(), np.uint8)
            parts += [self._short(text[at:run.start()]), merge_words(self.model.of_byte[blank], np.array([0, len(blank)]), self.model.table)[0].astype(np.uint32)]
            at = end
        return np.concatenate([*parts, self._short(text[at:])]) if parts else self._short(text)


@lru_cache(maxsize=4)
def fast_encoder(path: str) -> FastEncoder:
    return FastEncoder(path)


class PieceBPE:
    """A SentencePiece BPE model: every adjacent pair whose text is a piece can merge, better scores first; unknown characters fall back to bytes."""

    SPACE = "\u2581"

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not model.trainer_spec.byte_fallback or any(p.type == 4 for p in model.pieces):
            raise ValueError(f"{path}: only plain BPE models with byte fallback and without normalisation are supported")
        self.texts = {i: p.piece for i, p in enumerate(model.pieces) if p.type == 1}
        self.ids = {t: i for i, t in self.texts.items()}
        if any(self.SPACE in t.lstrip(self.SPACE) for t in self.ids):
            raise ValueError(f"{path}: pieces with a space inside are not supported")
        self.longest = max(map(len, self.ids))
        place = {i: r for r, i in enumerate(sorted(self.texts, key=lambda i: -model.pieces[i].score))}
        found = [(self.ids[t[:c]] << 32 | self.ids[t[c:]], place[i], i) for i, t in self.texts.items() for c in range(1, len(t)) if t[:c] in self.ids and t[c:] in self.ids]
        self.table = PairTable(*(np.array(c, np.int64) for c in zip(*found)))


@lru_cache(maxsize=2)
def piece_bpe(path: str) -> PieceBPE:
    return PieceBPE(path)
