"""Chat formatting: messages of typed parts as one marked text per conversation, and back.

A message is a list of parts: text, image, audio, document or anything else. A visitor
flattens them in order: text is escaped and written, every other part becomes a placeholder
while its reference and the tokens it expands to are noted beside the text.

    <turn>role<says>text <image> more text</turn>

Of the control strings only those of the template stand without an odd number of
backslashes before them: texts get a backslash before each control string in them, and
backslashes that would touch a control string are doubled. So the text can be read back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import ArrowFunction, by_value

by_value(__name__)

KINDS = ("image", "audio", "document", "attachment")
CONTROL = "<(?:turn|says|/turn|" + "|".join(KINDS) + ")>"
_TO_ESCAPE = re.compile(rf"(?<!\\)(\\*)({CONTROL}|\Z)")
_ESCAPED = re.compile(rf"(?<!\\)(\\+)({CONTROL}|\Z)")
_MARKS = re.compile(rf"(?<!\\)((?:\\\\)*)({CONTROL})")

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
SPANS = "array<struct<start:long,end:long>>"
ATTACHMENTS = "array<struct<type:string,ref:string,text:string,start:long,tokens:long>>"
# A conversation longer than this is formatted in several rows, cut between its turns.
ROW_CHARS = 4_000_000
# Rows that a task hands on at a time hold about so many characters.
BATCH_CHARS = 1_000_000


@dataclass(frozen=True)
class Expansion:
    """How many tokens a part that is no text stands for."""

    patch: int = 28            # pixels along the side of the square that is one token of an image
    image: int = 256           # an image of unknown size
    second: float = 25.0       # audio, per second; of unknown length it counts as one second
    page: int = 1024           # a document, per page; of unknown length it counts as one page
    other: int = 1

    def tokens(self, kind: str, part: dict) -> int:
        if kind == "image":
            width, height = part.get("width"), part.get("height")
            if not width or not height or width < 0 or height < 0:
                return self.image
            return math.ceil(width / self.patch) * math.ceil(height / self.patch)
        if kind == "audio":
            seconds = part.get("seconds")
            known = seconds is not None and math.isfinite(seconds) and seconds >= 0
            return math.ceil(self.second * (seconds if known else 1))
        if kind == "document":
            pages = part.get("pages")
            return self.page * (pages if pages is not None and pages >= 0 else 1)
        return self.other


def text_parts(text: str | Column = "text") -> Column:
    """A column of texts as lists of one text part; NULL is an empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                            F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
                            F.lit(None).cast("int").alias("pages")))


def json_parts(content: str | Column) -> Column:
    """A column of JSON lists of parts, as chat services take them; what is no such list is NULL."""
    return F.from_json(content, f"array<{PART}>")


def format_messages(messages: DataFrame, learn: Sequence[str] = ("assistant",),
                    expansion: Expansion = Expansion(), ranks: Broadcast | None = None,
                    pattern: str = "") -> DataFrame:
    """Each row of (conv_id, turn, role, parts) by itself, without a shuffle.

    Returns (conv_id, turn, formatted, loss, attachments, n_tokens): ``loss`` has the body of
    the turn as a span of code points of ``formatted`` if the role is one to ``learn`` from;
    ``attachments`` has, in order, what the placeholders stand for, where they are and how many
    tokens they expand to; ``n_tokens`` is the sum of these and of the tokens of the text by
    the rank file, if ``ranks`` and ``pattern`` are given (``bpe.read_ranks``).

    ``parts`` are structs with any of the fields of ``PART``; a part without a type is text, a
    NULL part is left out, a NULL or empty list is an empty text, and a type that is not
    known becomes an ``<attachment>``. Text parts next to each other are joined. A NULL role is
    an empty one. Repeated rows are messages of their own; other columns are not read.
    """
    rows = messages.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), "parts")
    schema = (f"conv_id {_kind(messages, 'conv_id')}, turn {_kind(messages, 'turn')}, formatted string,"
              f" loss {SPANS}, attachments {ATTACHMENTS}, n_tokens long")
    return rows.mapInArrow(_formatter(frozenset(learn), expansion, ranks, pattern), schema)


def format_conversations(messages: DataFrame, row_chars: int = ROW_CHARS, **options: object) -> DataFrame:
    """The messages of ``format_messages`` put together in order of ``turn`` (NULL first).

    Returns (conv_id, part, formatted, n_turns, loss, attachments, n_tokens), one row per
    conversation, or several with rising ``part`` for one of more than ``row_chars`` characters;
    offsets are those within the row. A partition has the rows of its conversations together
    and in order. Turns with the same number are ordered by what they say. Rows without a
    ``conv_id`` are one conversation. No messages give no rows.

    A message is formatted before the shuffle. Behind it a task streams its sorted rows and
    holds no more than one row of the result, however long a conversation is.
    """
    said = format_messages(messages, **options)
    ordered = said.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "formatted")
    schema = (f"conv_id {_kind(messages, 'conv_id')}, part int, formatted string, n_turns long,"
              f" loss {SPANS}, attachments {ATTACHMENTS}, n_tokens long")
    return ordered.mapInArrow(_assembler(row_chars), schema)


def read_turns(formatted: DataFrame) -> DataFrame:
    """The turns in rows of ``format_conversations``: (conv_id, part, turn, role, parts).

    ``turn`` counts from 0 within the row; ``parts`` are structs (type, text, ref) in order, the
    texts unescaped. Any order of rows will do.
    """
    schema = (f"conv_id {_kind(formatted, 'conv_id')}, part int, turn int, role string,"
              " parts array<struct<type:string,text:string,ref:string>>")
    return formatted.select("conv_id", "part", "formatted", "attachments").mapInArrow(_read_batches, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What the rows of ``format_conversations``, in the order it gives them, say when read back.

    Returns (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens):
    a digest of role, line break, text, line break of all turns, and one of all text under the
    loss mask, unescaped. A digest is a running one: a conversation is not gathered.
    """
    schema = (f"conv_id {_kind(formatted, 'conv_id')}, n_turns long, turns_sha256 string, loss_chars long,"
              " loss_sha256 string, formatted_chars long, n_tokens long")
    return formatted.select("conv_id", "formatted", "loss", "attachments", "n_tokens").mapInArrow(_digest, schema)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


# ---- text ------------------------------------------------------------------

def escape(text: str) -> str:
    if "<" not in text and not text.endswith("\\"):
        return text
    return _TO_ESCAPE.sub(lambda m: m[1] * 2 + ("\\" + m[2] if m[2] else ""), text)


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    return _ESCAPED.sub(lambda m: "\\" * (len(m[1]) // 2) + m[2], text)


class Flattener:
    """Visits the parts of one message: its body grows, attachments are noted in order."""

    def __init__(self, expansion: Expansion):
        self.expansion = expansion
        self.pieces: list[str] = []      # text and placeholders in turn, from text on
        self.attachments: list[dict] = []
        self.texts: list[str] = []

    def visit(self, part: dict) -> None:
        kind = (part.get("type") or "text").lower()
        getattr(self, f"visit_{kind}" if kind in ("text", *KINDS) else "visit_attachment")(part)

    def visit_text(self, part: dict) -> None:
        self.texts.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        self.attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self.attach("document", part)

    def visit_attachment(self, part: dict) -> None:
        self.attach("attachment", part)

    def attach(self, kind: str, part: dict) -> None:
        self.end_text()
        self.pieces.append(f"<{kind}>")
        self.attachments.append({"type": kind, "ref": part.get("ref"), "text": part.get("text"),
                                 "tokens": self.expansion.tokens(kind, part)})

    def end_text(self) -> None:
        """Text parts side by side are escaped as one: a control string may lie across them."""
        self.pieces.append(escape("".join(self.texts)))
        self.texts = []


def format_message(role: str, parts: Sequence[dict | None], learn: frozenset[str],
                   expansion: Expansion) -> tuple[list[str], list[dict], list[dict]]:
    """The pieces of a turn, text and placeholders in turn; its loss spans; its attachments."""
    visitor = Flattener(expansion)
    for part in parts or ():
        if part is not None:
            visitor.visit(part)
    visitor.end_text()
    head = f"<turn>{escape(role)}<says>"
    place = len(head)
    for i, piece in enumerate(visitor.pieces):
        if i % 2:
            visitor.attachments[i // 2]["start"] = place
        place += len(piece)
    loss = [{"start": len(head), "end": place}] if role in learn else []
    pieces = visitor.pieces
    pieces[0] = head + pieces[0]
    pieces[-1] += "</turn>\n"
    return pieces, loss, visitor.attachments


def parse(formatted: str, attachments: Sequence[dict]) -> Iterator[tuple[str, list[dict]]]:
    """(role, parts) of each turn of a formatted text."""
    noted = iter(attachments or ())
    role, parts, start = "", [], 0
    for mark in _MARKS.finditer(formatted):
        text = unescape(formatted[start:mark.end(1)])
        kind = mark[2][1:-1]
        if kind == "turn":
            parts = []
        elif kind == "says":
            role = text
        else:
            if text:
                parts.append({"type": "text", "text": text, "ref": None})
            if kind == "/turn":
                yield role, parts
            else:
                found = next(noted)
                parts.append({"type": kind, "text": found["text"], "ref": found["ref"]})
        start = mark.end()


# ---- tasks -----------------------------------------------------------------

def _formatter(learn: frozenset[str], expansion: Expansion, ranks: Broadcast | None, pattern: str) -> ArrowFunction:
    def run(batches):
        encoding = bpe.codec(ranks.value, pattern) if ranks is not None else None
        for batch in batches:
            texts, losses, noted, counts = [], [], [], []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                pieces, loss, attachments = format_message(role, parts, learn, expansion)
                n = sum(a["tokens"] for a in attachments)
                if encoding is not None:
                    n += sum(len(bpe.encode_text(encoding, piece)) for piece in pieces[::2])
                texts.append("".join(pieces))
                losses.append(loss)
                noted.append(attachments)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(losses, _SPANS),
                 pa.array(noted, _NOTES), pa.array(counts, pa.int64())],
                ["conv_id", "turn", "formatted", "loss", "attachments", "n_tokens"])
    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_NOTES = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("text", pa.string()),
                             ("start", pa.int64()), ("tokens", pa.int64())]))


def _assembler(row_chars: int) -> ArrowFunction:
    def run(batches):
        out, size, current = [], 0, None
        for kind, row in _rows(batches):
            if current and (current["conv_id"] != row["conv_id"] or current["chars"] >= row_chars):
                out.append(current)
                size += current["chars"]
                part = current["part"] + 1 if current["conv_id"] == row["conv_id"] else 0
                current = None
            else:
                part = 0
            if size >= BATCH_CHARS:
                yield _assembled(out, kind)
                out, size = [], 0
            current = current or {"conv_id": row["conv_id"], "part": part, "texts": [], "chars": 0, "n_turns": 0,
                                  "loss": [], "attachments": [], "n_tokens": 0}
            shift = current["chars"]
            current["loss"] += [{"start": s["start"] + shift, "end": s["end"] + shift} for s in row["loss"]]
            current["attachments"] += [{**a, "start": a["start"] + shift} for a in row["attachments"]]
            current["texts"].append(row["formatted"])
            current["chars"] += len(row["formatted"])
            current["n_turns"] += 1
            current["n_tokens"] += row["n_tokens"]
        if current:
            yield _assembled([*out, current], kind)
    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, dict]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield batch.schema.field("conv_id").type, row


def _assembled(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    column = lambda name, type_: pa.array([r[name] for r in rows], type_)
    return pa.RecordBatch.from_arrays(
        [column("conv_id", kind), column("part", pa.int32()),
         pa.array(["".join(r["texts"]) for r in rows], pa.string()), column("n_turns", pa.int64()),
         column("loss", _SPANS), column("attachments", _NOTES), column("n_tokens", pa.int64())],
        ["conv_id", "part", "formatted", "n_turns", "loss", "attachments", "n_tokens"])


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts_type = pa.list_(pa.struct([("type", pa.string()), ("text", pa.string()), ("ref", pa.string())]))
    for batch in batches:
        found = [(row["conv_id"], row["part"], i, role, parts) for row in batch.to_pylist()
                 for i, (role, parts) in enumerate(parse(row["formatted"], row["attachments"]))]
        kinds = (batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.string(), parts_type)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)],
            ["conv_id", "part", "turn", "role", "parts"])


class _Running:
    """The digests of one conversation so far."""

    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.n_turns = self.loss_chars = self.chars = self.n_tokens = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, row: dict) -> None:
        formatted = row["formatted"]
        self.chars += len(formatted)
        self.n_tokens += row["n_tokens"]
        for role, parts in parse(formatted, row["attachments"]):
            text = "".join(p["text"] for p in parts if p["type"] == "text")
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in row["loss"]:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def values(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.chars, self.n_tokens)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

    def batch_of(rows, kind):
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    done, running = [], None
    for kind, row in _rows(batches):
        if running is not None and running.conv_id != row["conv_id"]:
            done.append(running.values())
            running = None
        if len(done) >= 10_000:
            yield batch_of(done, kind)
            done = []
        running = running or _Running(row["conv_id"])
        running.add(row)
    if running is not None:
        yield batch_of([*done, running.values()], kind)
