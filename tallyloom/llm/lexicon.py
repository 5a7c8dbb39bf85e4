"""BPE encoding with a minimal acyclic transducer of frequent words.

The corpus's most frequent words are compiled into a minimal acyclic automaton (common prefixes and suffixes share states). Its transitions carry additive
outputs that sum up to the word's number, under which the word's token ids are stored. The compiled arrays are one file that Spark sends to every
executor, where workers map it into memory. Texts are cut into words at white space; words of the lexicon are looked up by walking the
automaton, all new words of a batch side by side; the others are split by the tokenizer's pattern and merged exactly.
"""

from __future__ import annotations

import io
import os
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from ..session import shared_dir
from .hashing import SPACE, U, slices, span_hashes, text_buffers, words
from .tables import keep, plain
from .vocabulary import ByteBPE, byte_bpe, merge_words

WORDS = 50_000       # frequent words in the lexicon
CACHE = 200_000      # words whose ids a worker keeps at hand
SLICE = 1 << 20      # bytes of text that are encoded at a time
BLANK = "\t-\r \x85\xa0  -     　"  # Unicode white space
UNIT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts of (text): runs of non-blank bytes with the space before them, if there is one. Counted in each task first."""
    def run(batches):
        for batch in batches:
            raw, offsets = text_buffers(batch.column(0))
            for a, b in slices(offsets, 4 << 20):
                lo, part = offsets[a], raw[offsets[a]:offsets[b]]
                starts, ends, first = words(part, offsets[a:b + 1] - lo)
                if not len(starts):
                    continue
                spaced = np.zeros(len(starts), bool)
                spaced[1:] = part[starts[1:] - 1] == 32
                heads = first[:-1][first[:-1] < first[1:]]
                own = offsets[a:b][first[:-1] < first[1:]] - lo
                spaced[heads] = (starts[heads] > own) & (part[np.maximum(starts[heads] - 1, 0)] == 32)
                starts = starts - spaced
                _, at, n = np.unique(span_hashes(part, starts, ends), return_index=True, return_counts=True)
                data = part.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())], pa.binary()), pa.array(n.astype(np.int64))], names=["word", "n"])
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def minimal_automaton(entries: list[bytes]):
    """Minimal acyclic automaton of sorted distinct words: (keys, targets, skips, final).

    ``keys`` are state * 256 + byte, sorted; ``skips`` sums to the word's place in the list; state 0 is the start. Equal ends share states: a state is looked up
    among the finished ones as soon as no later word can change it.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    counts: list[int] = []
    path: list[list] = [[False, []]]  # states of the last word that may still change: [final, [(byte, target)]]

    def freeze(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            counts.append(int(node[0]) + sum(counts[t] for _, t in node[1]))
        return register[key]

    last = b""
    for word in entries:
        common = len(os.path.commonprefix([word, last]))
        for depth in range(len(last), common, -1):
            target = freeze(path.pop())
            path[-1][1].append((last[depth - 1], target))
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        target = freeze(path.pop())
        path[-1][1].append((last[depth - 1], target))
    root = freeze(path.pop())
    order = [root] + [s for s in range(len(states)) if s != root]
    name = {s: i for i, s in enumerate(order)}
    keys, targets, skips = [], [], []
    for s in order:
        final, moves = states[s]
        skip = int(final)
        for byte, target in sorted(moves):
            keys.append(name[s] << 8 | byte)
            targets.append(name[target])
            skips.append(skip)
            skip += counts[target]
    return np.array(keys, np.int64), np.array(targets, np.int64), np.array(skips, np.int64), np.array([states[s][0] for s in order], np.int64)


def split_ids(units: list[str], model: ByteBPE) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each unit: the tokenizer's pattern splits it, and the parts are merged; with offsets."""
    import public_tokenizers
    import regex

    cut = regex.compile(public_tokenizers.PATTERN)
    found = [cut.findall(u) for u in units]
    parts = [p.encode() for f in found for p in f]
    per_unit = np.array([len(f) for f in found], np.int64)
    off = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=off[1:])
    ids, at = merge_words(model.of_byte[np.frombuffer(b"".join(parts), np.uint8)], off, model.table)
    ends = np.zeros(len(units) + 1, np.int64)
    np.cumsum(per_unit, out=ends[1:])
    return ids, at[ends]


def compile_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", words_kept: int = WORDS) -> str:
    """Count the words of all texts, compile the most frequent ones, and give the file to all executors; returns its name.

    At most ``words_kept`` words pass the driver. A word seen once is never frequent.
    """
    counted = keep(word_counts(plain(docs, text=text_col)).filter((F.col("n") > 1) & (F.octet_length("word") <= 64)), "words")
    # the smallest count that at most words_kept words reach, from a histogram of a few hundred rows
    least, total = None, 0
    for bin_, n, low in sorted(((r["bin"], r["words"], r["low"]) for r in counted.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(F.count("*").alias("words"), F.min("n").alias("low")).collect()), reverse=True):
        total += n
        if total > words_kept:
            break
        least = low
    rows = counted.filter(F.col("n") >= least).select("word").collect() if least else []
    entries = sorted({w for w in (bytes(r["word"]) for r in rows) if valid(w)})
    keys, targets, skips, final = minimal_automaton(entries)
    ids, off = split_ids([w.decode() for w in entries], byte_bpe(tokenizer))
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    parts = [keys, targets, skips, final, off, ids]
    head = np.array([len(p) for p in parts], np.int64)
    data = io.BytesIO()
    np.save(data, np.concatenate([head, *parts]))
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    spark.sparkContext.addFile(path.toString())  # for all executors, new ones too
    return name


def valid(word: bytes) -> bool:
    """Whether the word is one unit of a text: whole characters, and no blank but a leading space."""
    try:
        text = word.decode()
    except UnicodeDecodeError:
        return False
    return UNIT.findall(text) == [text]


class Lexicon:
    """The compiled automaton, mapped into memory."""

    def __init__(self, name: str):
        data = np.load(SparkFiles.get(name), mmap_mode="r")
        at = np.cumsum(np.concatenate([[6], data[:6]]))
        self.keys, self.targets, self.skips, self.final, self.off, self.ids = (data[a:b] for a, b in zip(at[:-1], at[1:]))

    def numbers(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of each word (a segment of ``raw``), -1 for words that are not in the lexicon. All words take a step at a time."""
        n = np.diff(offsets)
        order = np.argsort(-n, kind="stable")
        start, length = offsets[:-1][order], n[order]
        state, total = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        if not len(self.keys):
            return np.full(len(n), -1, np.int64)
        for step in range(int(length[0]) if len(length) else 0):
            active = np.flatnonzero((state[:np.searchsorted(-length, -step, side="left")] >= 0))
            if not len(active):
                break
            key = state[active] << 8 | raw[start[active] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            state[active] = np.where(hit, self.targets[at], -1)
            total[active] += np.where(hit, self.skips[at], 0)
        out = np.full(len(n), -1, np.int64)
        found = (state >= 0) & (length > 0)
        found[found] = self.final[state[found]] == 1
        out[order[found]] = total[found]
        return out


class Encoder:
    """Token ids of whole texts; keeps the ids of recent words."""

    def __init__(self, tokenizer: str, lexicon: str):
        self.model, self.lexicon = byte_bpe(tokenizer), Lexicon(lexicon)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.model.special, key=len, reverse=True))) + ")") if self.model.special else None
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {s: i for i, s in enumerate(self.model.special)}
        self.ids, self.off = np.array(list(self.model.special.values()), np.int64), np.arange(len(self.known) + 1, dtype=np.int64)

    def learn(self, units: list[str]) -> None:
        data = [u.encode() for u in units]
        off = np.zeros(len(data) + 1, np.int64)
        np.cumsum([len(d) for d in data], out=off[1:])
        number = self.lexicon.numbers(np.frombuffer(b"".join(data), np.uint8), off)
        rest = np.flatnonzero(number < 0)
        rest_ids, rest_off = split_ids([units[i] for i in rest], self.model)
        source = np.concatenate([self.lexicon.ids, rest_ids])
        begin, size = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        hit = number >= 0
        begin[hit], size[hit] = self.lexicon.off[number[hit]], self.lexicon.off[number[hit] + 1] - self.lexicon.off[number[hit]]
        begin[rest], size[rest] = rest_off[:-1] + len(self.lexicon.ids), np.diff(rest_off)
        self.known.update(zip(units, range(len(self.off) - 1, len(self.off) - 1 + len(units))))
        self.ids = np.concatenate([self.ids, gather(source, begin, size)])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(size)])

    def units(self, text: str) -> list[str]:
        if self.special and self.special.search(text):
            return [u for i, part in enumerate(self.special.split(text)) for u in ([part] if i % 2 else UNIT.findall(part))]
        return UNIT.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their offsets."""
        if len(self.known) > CACHE:
            self.reset()
        split = [self.units(t) for t in texts]
        new = list(set(chain.from_iterable(split)) - self.known.keys())
        if new:
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        size = self.off[at + 1] - self.off[at]
        ends = np.zeros(len(at) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        per_text = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(s) for s in split], out=per_text[1:])
        return gather(self.ids, self.off[at], size), ends[per_text]


def gather(source: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The segments source[begin:begin + size], one after the other."""
    ends = np.cumsum(size)
    return source[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)]


class Decoder:
    """Texts of token ids."""

    def __init__(self, tokenizer: str):
        table = byte_bpe(tokenizer).bytes_of
        pieces = [table.get(i, b"") for i in range(max(table) + 1)]
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.begin, self.source = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size)):
            raise ValueError("an id is not in the vocabulary")
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])[offsets].tolist()
        data = memoryview(gather(self.source, self.begin[ids], self.size[ids]))
        return [str(data[s:e], "utf-8", "replace") for s, e in zip(ends[:-1], ends[1:])]


def _rows_and_ids(batches, coder: Encoder):
    """(ids column of a slice of rows, its token ids, their offsets)."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column(1))
        data = memoryview(raw)
        for a, b in slices(offsets, SLICE):
            texts = [str(data[s:e], "utf-8") for s, e in zip(offsets[a:b].tolist(), offsets[a + 1:b + 1].tolist())]
            yield batch.column(0).slice(a, b - a), *coder.encode(texts)


def encode(docs: DataFrame, tokenizer: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text", texts_back: bool = False) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text as the ``tokenizers`` library gives them without added special tokens; ``texts_back`` adds the decoded text.

    Strings of special tokens inside a text become those tokens, as in the library. A null or empty text has no ids. Every row, repeated ones too, gives a row; ids may be
    null; other columns are ignored.
    """
    def run(batches):
        coder, back = Encoder(tokenizer, lexicon), Decoder(tokenizer) if texts_back else None
        for rows, ids, off in _rows_and_ids(batches, coder):
            out = [rows, pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(back.decode(ids, off), pa.string())] if back else []), names=["doc_id", "ids", "text"][:len(out) + bool(back)])
    return plain(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=text_col).mapInArrow(run, "doc_id long, ids array<int>" + ", text string" * texts_back)


def decode(coded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text) of token ids, special tokens as their text. Bytes that are no UTF-8 become U+FFFD. Null ids give an empty text; an unknown id fails."""
    def run(batches):
        back = Decoder(tokenizer)
        for batch in batches:
            count = np.asarray(batch.column(1).value_lengths().fill_null(0)).astype(np.int64)
            for a, b in slices(np.concatenate([[0], np.cumsum(count)]), SLICE // 4):
                part = batch.column(1).slice(a, b - a)
                ids = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), part, pa.array(back.decode(ids, np.concatenate([[0], np.cumsum(count[a:b])])), pa.string())], names=["doc_id", "ids", "text"])
    return plain(coded, doc_id=id_col, ids=ids_col).mapInArrow(run, "doc_id long, ids array<int>, text string")
