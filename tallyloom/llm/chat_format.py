"""Chat formatting: records of any known layout become canonical turns, and these one marked text with a loss mask.

A record is a JSON object. Its schema fingerprint is a hash of its distinct nested field paths, whatever their order and values; the fingerprint selects a declarative mapping, which
says where the turns, their roles and texts are. Mappings are compiled to all fingerprints they stand for, a table of fixed size. Records that no mapping fits are not
dropped: they come back with their fingerprint and without a layout.

Turns of a conversation meet in one task in their order and stream through it, so that a conversation may be longer than memory: it is written in chunks of whole turns.
Texts are escaped, so that what looks like a mark inside a text is none; the loss mask is a list of spans that hold the texts of the assistant and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import plain

CHUNK_CHARS = 8 << 20  # of one formatted row, unless a single turn is longer
LEARNT = "assistant"  # the role under the loss mask


class Turns(NamedTuple):
    """Where turns are: one turn, or one for each element of the list at path ``each``. ``role`` is a path, or a role itself after "="; paths of texts are joined by blank lines."""

    role: str
    text: tuple[str, ...]
    each: str | None = None


class Mapping(NamedTuple):
    """A layout: the paths it has and may have, its turns, names of roles to replace, and paths of the conversation's id and the turn's number, if it has them."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[Turns, ...]
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
    id: str | None = None
    order: str | None = None


SYSTEM = Turns("=system", ("system",))
MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), (Turns("role", ("text",)),), roles=(), id="conv_id", order="turn"),
    Mapping("messages", ("messages[].role", "messages[].content"), (SYSTEM, Turns("role", ("content",), "messages")), ("system", "id")),
    Mapping("message_parts", ("messages[].role", "messages[].content[].type", "messages[].content[].text"), (SYSTEM, Turns("role", ("content[].text",), "messages")), ("system", "id")),
    Mapping("from_value", ("conversations[].from", "conversations[].value"), (SYSTEM, Turns("from", ("value",), "conversations")), ("system", "id")),
    Mapping("prompt_completion", ("prompt", "completion"), (SYSTEM, Turns("=user", ("prompt",)), Turns("=assistant", ("completion",))), ("system", "id")),
    Mapping("prompt_response", ("prompt", "response"), (SYSTEM, Turns("=user", ("prompt",)), Turns("=assistant", ("response",))), ("system", "id")),
    Mapping("instruction", ("instruction", "output"), (SYSTEM, Turns("=user", ("instruction", "input")), Turns("=assistant", ("output",))), ("input", "system", "id")),
    Mapping("question_answer", ("question", "answer"), (SYSTEM, Turns("=user", ("context", "question")), Turns("=assistant", ("answer",))), ("context", "system", "id")),
)


class Template(NamedTuple):
    """Marks around a turn; ``escape`` goes before itself and before every mark inside a text."""

    open: str = "<turn "
    head_end: str = ">"
    close: str = "</turn>"
    escape: str = "\\"

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The formatted turn, and where its text starts and ends in it."""
        head = f"{self.open}{_marks(self.escape, self.head_end, chr(10)).sub(self._quoted, role)}{self.head_end}\n"
        body = _marks(self.escape, self.open, self.close).sub(self._quoted, text)
        return f"{head}{body}{self.close}\n", len(head), len(head) + len(body)

    def _quoted(self, found: re.Match) -> str:
        return self.escape + found[0]

    def plain(self, text: str) -> str:
        """A text without its escapes."""
        return text if self.escape not in text else re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    def _mark(self, text: str, mark: str, start: int) -> int:
        """Place of the next ``mark`` that no escape stands before."""
        while (at := text.index(mark, start)) >= 0:
            before = at
            while before > start and text[before - 1] == self.escape:
                before -= 1
            if (at - before) % 2 == 0:
                return at
            start = at + 1

    def turns(self, text: str) -> list[tuple[str, str]]:
        """The (role, text) that a formatted text was made of."""
        out, at = [], 0
        while at < len(text):
            if not text.startswith(self.open, at):
                raise ValueError(f"no turn at place {at}")
            head = self._mark(text, self.head_end, at + len(self.open))
            start = head + len(self.head_end) + 1
            end = self._mark(text, self.close, start)
            out.append((self.plain(text[at + len(self.open):head]), self.plain(text[start:end])))
            at = end + len(self.close) + 1
        return out


TEMPLATE = Template()


@lru_cache(maxsize=16)
def _marks(*marks: str) -> re.Pattern:
    return re.compile("|".join(map(re.escape, marks)))


def field_paths(value, at: str = "") -> set[str]:
    """Distinct nested field paths: ``a.b`` for fields of objects, ``a[]`` for elements of lists; dots and brackets inside names are escaped."""
    if isinstance(value, dict) and value:
        return {p for k, v in value.items() for p in field_paths(v, f"{at}.{k}" if at and re.fullmatch(r"\w+", k) else (at and at + ".") + re.sub(r"([.\[\]\\])", r"\\\1", k))}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


@lru_cache(maxsize=65536)
def fingerprint(paths: frozenset[str]) -> int:
    """A signed 64-bit hash of a set of field paths."""
    return int.from_bytes(hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).digest(), "little", signed=True)


def compiled(mappings: tuple[Mapping, ...]) -> dict[int, Mapping]:
    """The mapping of each fingerprint: with any of the optional fields, and with empty or missing lists."""
    out: dict[int, Mapping] = {}
    for m in mappings:
        lists = sorted({t.each for t in m.turns if t.each})
        bare = [m.paths, *([*(p for p in m.paths if not p.startswith(f"{x}[]")), end] for x in lists for end in (f"{x}[]", x))]
        for n in range(len(m.optional) + 1):
            for more in combinations(m.optional, n):
                for paths in bare:  # layouts may share their empty form, which has no turns
                    if out.setdefault(fingerprint(frozenset([*paths, *more])), m) is not m and paths is m.paths:
                        raise ValueError(f"{m.name} has a layout of {out[fingerprint(frozenset([*paths, *more]))].name}")
    return out


def _leaves(value, path: str) -> list:
    """Values at a path, in their order; missing ones are none."""
    found = [value]
    for step in path.split("."):
        name, deep = step.rstrip("[]"), step.count("[]")
        found = [v[name] for v in found if isinstance(v, dict) and name in v]
        for _ in range(deep):
            found = [x for v in found if isinstance(v, list) for x in v]
    return found


def _text(values: list) -> str:
    return "".join(v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False) for v in values)


def turns_of(record, mapping: Mapping) -> list[tuple[str, str]]:
    """The (role, text) of a record. Turns at fixed places that the record does not have are left out; missing roles and texts of listed ones are empty."""
    roles, out = dict(mapping.roles), []
    for rule in mapping.turns:
        for value in _leaves(record, f"{rule.each}[]") if rule.each else [record]:
            found = [_leaves(value, p) for p in rule.text]
            if rule.role.startswith("="):
                if any(found):
                    out.append((rule.role[1:], "\n\n".join(t for t in map(_text, found) if t)))
            else:
                role = _text(_leaves(value, rule.role))
                out.append((roles.get(role, role), "\n\n".join(t for t in map(_text, found) if t)))
    return out


def _whole(values: list) -> int | None:
    v = values[0] if values else None
    return v if isinstance(v, int) and not isinstance(v, bool) and -(1 << 63) <= v < 1 << 63 else None


TURN_ROWS = "conv_id long, own long, turn long, part int, role string, text string, layout string, fingerprint long"


def canonical_turns(records: DataFrame, record_col: str = "record", id_col: str | None = None, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, own, turn, part, role, text, layout, fingerprint): the turns of JSON records, by the mapping that their fingerprint selects.

    ``conv_id`` comes from ``id_col`` or from the mapping's path; a record without one is a conversation of its own, told apart by ``own``. A record that is null or no JSON has no
    fingerprint; like records of unknown layouts it gives one row with a null layout and no turn. Equal records are kept. An empty table gives no rows.
    """
    rows = plain(records, id=F.col(f"`{id_col}`").cast("long") if id_col else F.lit(None).cast("long"), record=F.col(f"`{record_col}`").cast("string")).withColumn("own", F.monotonically_increasing_id())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        known = compiled(mappings)
        for batch in batches:
            out = []
            for conv, text, own in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    record = json.loads(text) if text is not None else None
                    key = fingerprint(frozenset(field_paths(record))) if text is not None else None
                except (ValueError, RecursionError):
                    record, key = None, None
                m = known.get(key)
                if m is None:
                    out.append((conv, None if conv is not None else own, None, 0, None, None, None, key))
                    continue
                if conv is None and m.id:
                    conv = _whole(_leaves(record, m.id))
                turn = _whole(_leaves(record, m.order)) if m.order else 0
                out += [(conv, None if conv is not None else own, turn, i, role, said, m.name, key) for i, (role, said) in enumerate(turns_of(record, m))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in TURN_ROWS.split(", ")])

    return rows.mapInArrow(run, TURN_ROWS)


FORMATTED = "conv_id long, chunk int, text string, loss array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_chats(turns: DataFrame, template: Template = TEMPLATE, learnt: str = LEARNT, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(conv_id, chunk, text, loss): the formatted text of each conversation of ``canonical_turns`` and the spans of it, in code points, under the loss mask.

    Turns come in the order of their number (null first), place in their record, role and text; null roles and texts are empty, equal turns are kept. A conversation of more than ``chunk_chars``
    is cut between turns into chunks that follow each other in one partition. Rows without a layout are not formatted.
    """
    meet = turns.filter("layout IS NOT NULL").select("conv_id", "own", "turn", "part", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    meet = meet.repartition("conv_id", "own").sortWithinPartitions("conv_id", "own", "turn", "part", "role", "text")

    def run(batches):
        rows, held, last, chunk, pieces, spans, size = [], 0, None, 0, [], [], 0

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.string(), _SPANS))], names=["conv_id", "chunk", "text", "loss"])

        for batch in batches:
            for conv, own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "own", "role", "text"))):
                piece, start, end = template.turn(role, text)
                if pieces and ((conv, own) != last or size + len(piece) > chunk_chars):
                    rows.append((last[0], chunk, "".join(pieces), spans))
                    held += size
                    chunk, pieces, spans, size = chunk + 1 if (conv, own) == last else 0, [], [], 0
                    if held > chunk_chars or len(rows) >= 2000:
                        yield batch_of()
                        rows, held = [], 0
                last = conv, own
                pieces.append(piece)
                if role == learnt:
                    spans.append({"start": size + start, "end": size + end})
                size += len(piece)
        if pieces:
            rows.append((last[0], chunk, "".join(pieces), spans))
        yield batch_of()

    return meet.mapInArrow(run, FORMATTED)


def read_turns(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, chunk, place, role, text): the turns that formatted texts were made of."""
    def run(batches):
        for batch in batches:
            for conv, chunk, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chunk", "text"))):
                got = template.turns(text)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([conv] * len(got), [chunk] * len(got), range(len(got)), [r for r, _ in got], [t for _, t in got]), (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()))], names=["conv_id", "chunk", "place", "role", "text"])
    return formatted.select("conv_id", "chunk", "text").mapInArrow(run, "conv_id long, chunk int, place int, role string, text string")


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def chat_digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read back from formatted conversations, whose chunks follow each other as ``format_chats`` leaves them."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        conv = None  # [id, turns, digest, characters under the mask, their digest, characters]

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*((i, n, a.hexdigest(), chars, b.hexdigest(), size) for i, n, a, chars, b, size in found)) if found else [[]] * 6, kinds)], names=[c.split()[0] for c in DIGESTS.split(", ")])

        for batch in batches:
            done = []
            for i, chunk, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chunk", "text", "loss"))):
                if chunk == 0:
                    if conv:
                        done.append(conv)
                    conv = [i, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in template.turns(text):
                    conv[1] += 1
                    conv[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = template.plain(text[span["start"]:span["end"]])
                    conv[3] += len(said)
                    conv[4].update(said.encode())
                conv[5] += len(text)
            yield rows(done)
        if conv:
            yield rows([conv])

    return formatted.select("conv_id", "chunk", "text", "loss").mapInArrow(run, DIGESTS)


def row_records(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(record): JSON records of the layout "turn_rows" from a table with a row for each turn."""
    fields = plain(rows, conv_id=F.col(f"`{conv_id}`").cast("long"), turn=F.col(f"`{turn}`").cast("long"), role=F.col(f"`{role}`").cast("string"), text=F.col(f"`{text}`").cast("string"))
    return fields.select(F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
