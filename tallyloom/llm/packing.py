"""Packing token streams into sequences with bounded space.

Each task keeps a fixed number of open windows. A text's tokens first fill whole windows of their own; what remains is placed best-fit: into the open
window with the smallest gap that holds it. When none fits, the fullest window is topped up with the head of the remainder (texts may be cut
anywhere) and emitted, and the tail opens a new window. At the end of a task its open windows are merged by the same cutting, and at most one window
that is not full is left. A last step merges the left-over windows of a bounded number of tasks at a time, so only one window in that many is padded.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .hashing import text_buffers
from .tables import keep, plain
from .vocabulary import fast_encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids binary"
MERGE_TASKS = 64  # tasks whose left-over windows meet in one group


class Piece(NamedTuple):
    doc: int | None
    start: int
    ids: np.ndarray
    total: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:n]), self._replace(start=self.start + n, ids=self.ids[n:])


class Windows:
    """The open windows of one task; finished windows go to ``emit`` as lists of pieces."""

    def __init__(self, size: int, count: int, emit):
        self.size, self.count, self.emit = size, count, emit
        self.open: list[tuple[int, list[Piece]]] = []  # (used, pieces)

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.size:
            full, piece = piece.cut(self.size)
            self.emit([full])
        if not len(piece.ids):
            return
        fits = [i for i, (used, _) in enumerate(self.open) if used + len(piece.ids) <= self.size]
        used, pieces = 0, []
        if fits:
            used, pieces = self.open.pop(max(fits, key=lambda i: self.open[i][0]))
        elif len(self.open) == self.count:
            used, pieces = self.open.pop(max(range(self.count), key=lambda i: self.open[i][0]))
            head, piece = piece.cut(self.size - used)
            self.emit([*pieces, head])
            used, pieces = 0, []
        pieces.append(piece)
        used += len(piece.ids)
        if used == self.size:
            self.emit(pieces)
        else:
            self.open.append((used, pieces))

    def close(self):
        """Merge the open windows, fullest first; what is left of them is one window that is not full, or none."""
        waiting, self.open, self.count = sorted(self.open, key=lambda w: -w[0]), [], 1
        for _, pieces in waiting:
            for piece in pieces:
                self.add(piece)
        return [p for _, pieces in self.open for p in pieces]


class Rows:
    """Collects pieces as rows of ``SCHEMA``."""

    def __init__(self, part: int, first: int, with_ids: bool):
        self.part, self.next, self.with_ids, self.rows = part, first, with_ids, []

    def put(self, pieces: list[Piece], left: bool = False) -> None:
        offset = 0
        for p in pieces:
            data = p.ids.tobytes()
            self.rows.append((p.doc, p.start, len(p.ids), zlib.crc32(data), p.total, self.next, offset, self.part if left else None, data if left or self.with_ids else None))
            offset += len(p.ids)
        self.next += 1

    def flush(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 8 + [pa.binary()]
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in self.rows], kind) for i, kind in enumerate(kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])
        self.rows = []
        return out


def token_ids(column, encoder, end: int):
    """Little-endian uint32 ids of each text, followed by ``end``; strings of special tokens count as those tokens, as in the library."""
    raw, offsets = text_buffers(column)
    data = memoryview(raw)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield np.append(encoder.ids(str(data[a:b], "utf-8")), np.uint32(end)).astype("<u4")


def _pack(size: int, windows: int, tokenizer: str, end: int, with_ids: bool):
    def run(batches):
        encoder, part = fast_encoder(tokenizer), TaskContext.get().partitionId()
        rows = Rows(part, part << 32, with_ids)
        space = Windows(size, windows, rows.put)
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), token_ids(batch.column(1), encoder, end)):
                space.add(Piece(doc, 0, ids, len(ids)))
                if len(rows.rows) >= 5000:
                    yield rows.flush()
        rows.put(space.close(), left=True)
        yield rows.flush()
    return run


def _merge(size: int, with_ids: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("offset", "ascending")])
        group = table.column("part")[0].as_py() // MERGE_TASKS
        rows = Rows(group, (1 << 62) + (group << 20), with_ids)
        space = Windows(size, 1, rows.put)
        for r in table.select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist():
            space.add(Piece(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        rows.put(space.close())
        return pa.Table.from_batches([rows.flush()])
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, windows: int = 32, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of sequences of at most ``size`` tokens.

    A document's tokens are those of the byte-level BPE file ``tokenizer`` and then ``end``; each lies in exactly one piece. ``start`` counts the document's
    tokens before the piece, ``offset`` the sequence's. ``ids`` (little-endian uint32) is null unless ``with_ids``. A null or empty text is the end token
    alone. Rows with the same id, null included, are packed one by one. Other columns are ignored; an empty table gives no rows.
    Sequence ids depend on how the rows lie in partitions; a task that is run again gives the same ones.
    """
    texts = plain(docs, id=F.col(f"`{id_col}`").cast("long"), text=text_col)
    pieces = keep(texts.mapInArrow(_pack(size, windows, tokenizer, end, with_ids), SCHEMA), "pieces")
    left = pieces.filter("part IS NOT NULL")
    merged = left.groupBy(F.floor(F.col("part") / MERGE_TASKS).alias("merge_group")).applyInArrow(_merge(size, with_ids), SCHEMA)
    return pieces.filter("part IS NULL").unionByName(merged).drop("part")
