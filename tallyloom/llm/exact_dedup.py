"""Exact de-duplication by counting quotient filters.

A text's fingerprint is the first 64 bits of its SHA-256. Each task builds counting quotient filters of its fingerprints, one for each range of leading bits: quotients in bit maps, remainders
packed bit by bit, counters only where a fingerprint repeats. Filters of a range merge without loss, as sorted
remainders whose counts add up; the merged filters say which fingerprints occur more than once. Only rows with such a fingerprint go on to
byte verification, where they are grouped with the texts themselves compared; all other rows are unique and never leave their task with their text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import keep, plain

RUN = 4096  # entries of one filter, about


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Unsigned numbers of ``width`` bits each, one after the other."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - width:]
    return np.packbits(bits).tobytes()


def unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    bits = np.zeros((count, 64), np.uint8)
    bits[:, 64 - width:] = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width).reshape(count, width)
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def varints(values: np.ndarray) -> bytes:
    """Numbers in as many groups of seven bits as they need, the lowest first."""
    out = bytearray()
    for v in values.tolist():
        while v > 127:
            out.append(v & 127 | 128)
            v >>= 7
        out.append(v)
    return bytes(out)


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    start = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(start, last - start + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * place, start) if len(last) else np.zeros(0, np.int64)


class QuotientFilter(NamedTuple):
    """A counting quotient filter of ``entries`` distinct numbers of ``width`` bits, laid out at once from sorted numbers.

    The leading bits of a number, its quotient, are not stored: ``occupied`` has a bit for each quotient that occurs, and the entries of a quotient are a run of slots, whose last one has its
    bit in ``run_ends``. A slot holds the other bits, the remainder; runs are in the order of quotients, remainders sorted inside a run. ``repeated`` marks slots whose number occurs
    more than once, and ``counters`` has how often beyond twice, in as many bytes as that takes.
    """

    entries: int
    width: int
    occupied: bytes
    run_ends: bytes
    remainders: bytes
    repeated: bytes
    counters: bytes

    @staticmethod
    def quotient_bits(entries: int, width: int) -> int:
        return min(width, max(0, int(entries - 1).bit_length()))

    @classmethod
    def of(cls, numbers: np.ndarray, counts: np.ndarray, width: int) -> QuotientFilter:
        """Filter of sorted distinct ``numbers`` (uint64)."""
        q = cls.quotient_bits(len(numbers), width)
        r = width - q
        quotient = numbers >> np.uint64(r) if r < 64 else np.zeros(len(numbers), np.uint64)
        occupied = np.zeros(1 << q, np.uint8)
        occupied[quotient.astype(np.int64)] = 1
        ends = np.ones(len(numbers), np.uint8)
        ends[:-1] = quotient[1:] != quotient[:-1]
        more = counts > 1
        rest = numbers & np.uint64((1 << r) - 1)
        return cls(len(numbers), width, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), pack_bits(rest, r), np.packbits(more).tobytes(), varints(counts[more] - 2))

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted numbers and their counts."""
        q = self.quotient_bits(self.entries, self.width)
        r = self.width - q
        bits = lambda data, n: np.unpackbits(np.frombuffer(data, np.uint8), count=n)
        quotients = np.flatnonzero(bits(self.occupied, 1 << q)).astype(np.uint64)
        ends = bits(self.run_ends, self.entries).astype(np.int64)
        run = np.cumsum(ends) - ends  # runs that ended before each slot
        numbers = unpack_bits(self.remainders, self.entries, r) | (quotients[run] << np.uint64(r) if r < 64 else np.uint64(0))
        counts = np.ones(self.entries, np.int64)
        counts[bits(self.repeated, self.entries) == 1] = from_varints(self.counters) + 2
        return numbers, counts

    def size(self) -> int:
        """Bytes of all parts."""
        return sum(len(p) for p in self[2:])


def merged(filters: list[QuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers and counts of several filters together. Each is read in order, so a merge of sorted runs puts them together; nothing is lost."""
    parts = [f.read() for f in filters]
    numbers, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(numbers, kind="stable")  # a merge sort, which takes the sorted runs as they are
    numbers, counts = numbers[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return numbers[start], np.add.reduceat(counts, start)


PARTS = "bucket long, entries int, occupied binary, run_ends binary, remainders binary, repeated binary, counters binary"


def _filters(bucket_bits: int):
    """A task's filters: one for each range of leading bits."""
    def build(batches):
        seen = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        numbers, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *seen]).view(np.uint64), return_counts=True)
        width = 64 - bucket_bits
        bucket = (numbers >> np.uint64(width)).astype(np.int64) if bucket_bits else np.zeros(len(numbers), np.int64)
        inner = numbers & np.uint64((1 << width) - 1)
        start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        made = [QuotientFilter.of(inner[a:b], counts[a:b], width) for a, b in zip(start.tolist(), [*start[1:].tolist(), len(numbers)])]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[start], pa.int64()), pa.array([f.entries for f in made], pa.int32()), *(pa.array([f[i] for f in made], pa.binary()) for i in range(2, 7))], names=[c.split()[0] for c in PARTS.split(", ")])
    return build


def _repeated(bucket_bits: int):
    """Numbers of a range of leading bits that occur more than once in all its filters together."""
    def merge(table: pa.Table) -> pa.Table:
        width = 64 - bucket_bits
        numbers, counts = merged([QuotientFilter(n, width, *parts) for n, *parts in zip(*(table.column(i).to_pylist() for i in range(1, 7)))])
        lead = np.uint64(table.column("bucket")[0].as_py() << width) if bucket_bits else np.uint64(0)
        twice = counts > 1
        return pa.table({"fingerprint": pa.array((numbers[twice] | lead).view(np.int64)), "copies": pa.array(counts[twice])})
    return merge


def repeated_fingerprints(prints: DataFrame, column: str = "fingerprint", slots: int | None = None) -> DataFrame:
    """(fingerprint, copies) of the 64-bit fingerprints that occur more than once. ``slots``: ranges of leading bits, rounded up to a power of two; by default so many that a merged filter has about RUN entries."""
    one = plain(prints.filter(F.col(column).isNotNull()), fingerprint=column)
    bucket_bits = min(40, ((slots or one.count() // RUN + 1) - 1).bit_length())
    return one.mapInArrow(_filters(bucket_bits), PARTS).groupBy("bucket").applyInArrow(_repeated(bucket_bits), "fingerprint long, copies long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row: rows with identical texts are a group and its largest id stays.

    A null text counts as empty. Rows that repeat an id with an equal text are all in the group, and all rows with the largest id are
    marked as kept: a result row cannot tell them apart. The pipeline keeps one of them. A null id stays only in a group without other ids. Other columns are ignored. An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = plain(docs, id=F.col(f"`{id_col}`").cast("long"), text=text)
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    marked = keep(texts.select("id", sha.alias("sha")).withColumn("fingerprint", F.conv(F.substring("sha", 1, 16), 16, -10).cast("long")), "prints")
    repeated = keep(repeated_fingerprints(marked), "repeated")
    suspects = texts.select("id", sha.alias("sha"), "text").withColumn("fingerprint", F.conv(F.substring("sha", 1, 16), 16, -10).cast("long")).join(repeated.select("fingerprint"), "fingerprint", "left_semi")
    # byte verification: the texts behind one digest are all the same bytes
    checked = keep(suspects.groupBy("fingerprint", "sha").agg(F.max("id").alias("top"), F.count("*").alias("many"), F.min("text").alias("low"), F.max("text").alias("high")).select("sha", "top", "many", (F.col("low") == F.col("high")).alias("same")), "checked")
    same = marked.join(checked, "sha", "left").filter("same IS NULL OR same")
    same = same.select("id", F.coalesce("top", "id").alias("top"), F.coalesce("many", F.lit(1)).alias("many"), "sha")
    # different bytes behind one digest: grouped by the texts themselves
    odd = suspects.join(checked.filter("NOT same").select("sha"), "sha", "left_semi")
    groups = odd.groupBy("sha", "text").agg(F.max("id").alias("top"), F.count("*").alias("many"))
    odd = odd.join(groups, ["sha", "text"]).select("id", "top", "many", "sha")
    return same.unionByName(odd).select(F.col("id").alias("doc_id"), F.col("top").alias("keep_id"), F.col("many").cast("long").alias("group_size"),
                                        (F.col("id").eqNullSafe(F.col("top"))).alias("kept"), F.col("sha").alias("text_sha256"))
