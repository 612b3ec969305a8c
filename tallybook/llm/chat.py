"""Chat formatting with typed content parts.

A turn's content is an array of parts: text, image, audio or document. A visitor flattens them in order into one body:
texts are escaped, every other part becomes a placeholder `<|kind:number|>`, numbered within its turn, and is recorded
as an attachment with its reference and the number of tokens it will expand to. A turn is formatted as

    <|turn|>role<|body|>body<|end|>

and the loss mask covers the bodies of assistant turns. Control strings begin with `<` (those of some other templates
with `[`), so escaping writes a backslash after each `<`, `[` and backslash of a text. No control string can then occur
in a text, and removing one backslash after each of them gives the text back.

Turns are formatted where they are; only reading a conversation back puts its turns into one task, in order, and there
they are streamed, never gathered. Defined results: null text is empty, a null role is the empty role, a null part or a
null array of parts is nothing, a part of unknown type is text; a null conv_id is a conversation of its own; turns that
share a number are ordered by role, then by their body unescaped, as UTF-8 (null turns and roles come first, a null text
counts as empty); repeated rows are turns of their own; an empty
table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = "array<struct<type: string, text: string, ref: string, units: bigint>>"
FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("formatted", T.StringType()),
        # Code points of `formatted` under the loss mask; both 0 where there is no loss.
        T.StructField("loss_from", T.LongType()),
        T.StructField("loss_to", T.LongType()),
        T.StructField(
            "attachments",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("number", T.IntegerType()),
                        T.StructField("kind", T.StringType()),
                        T.StructField("ref", T.StringType()),
                        T.StructField("tokens", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return re.sub(r"([\\<\[])", r"\1" + "\\\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([\\<\[])\\", r"\1", text)


@dataclass
class Flatten:
    """Visits the parts of one turn. units: pixels of an image, milliseconds of audio, pages of a document."""

    pixels_per_token: int = 28 * 28
    millis_per_token: int = 40
    tokens_per_page: int = 1500
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type']}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach(part, -(-(part["units"] or 0) // self.pixels_per_token))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, -(-(part["units"] or 0) // self.millis_per_token))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["units"] or 0) * self.tokens_per_page)

    def _attach(self, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.pieces.append(f"<|{part['type']}:{number}|>")
        self.attachments.append({"number": number, "kind": part["type"], "ref": part["ref"], "tokens": tokens})


def text_part(text: Column) -> Column:
    """A plain text as an array of one part."""
    part = F.struct(
        F.lit("text").alias("type"),
        text.alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part).cast(PARTS)


def format_turns(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, content: PARTS) -> FORMATTED, one row per turn."""
    schema = pa.schema([("attachments", pa.list_(pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, froms, tos, attached = [], [], [], []
            for role, content in zip(batch.column("role").to_pylist(), batch.column("content").to_pylist(), strict=True):
                visitor = Flatten()
                for part in content or ():
                    if part is not None:
                        visitor.visit(part)
                head, body = f"{TURN}{escape(role or '')}{BODY}", "".join(visitor.pieces)
                loss = role == LOSS_ROLE
                texts.append(head + body + END)
                froms.append(len(head) if loss else 0)
                tos.append(len(head) + len(body) if loss else 0)
                attached.append(visitor.attachments)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "turn", "role")),
                    pa.array(texts, pa.string()),
                    pa.array(froms, pa.int64()),
                    pa.array(tos, pa.int64()),
                    pa.array(attached, schema.field("attachments").type),
                ],
                names=FORMATTED.names,
            )

    columns = [F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "content"]
    return turns.select(*columns).mapInArrow(run, FORMATTED)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders stay in the text."""
    if not (formatted.startswith(TURN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, body = formatted[len(TURN) : -len(END)].split(BODY)
    return unescape(role), unescape(body)


DIGEST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


class _Conversation:
    """What has been read of one conversation."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.text, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss_from: int, loss_to: int) -> None:
        role, text = read_turn(formatted)
        under_loss = unescape(formatted[loss_from:loss_to])
        self.turns += 1
        self.chars += len(formatted)
        self.loss_chars += len(under_loss)
        self.text.update(f"{role}\n{text}\n".encode())
        self.loss.update(under_loss.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.text.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """FORMATTED -> DIGEST per conversation, from nothing but the formatted texts and their loss masks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Conversation | None = None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_from", "loss_to"))
            for conv_id, text, loss_from, loss_to in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    done += [current.row()] if current else []
                    current = _Conversation(conv_id)
                current.add(text, loss_from, loss_to)
            yield _digests(done)
        if current:
            yield _digests([current.row()])

    # The role is escaped, so the first mark of a body is the one that ends the head.
    start = F.locate(BODY, F.col("formatted")) + len(BODY)
    body = F.substr("formatted", start, F.length("formatted") - len(END) - start + 1)
    said = F.regexp_replace(body, r"([\\<\[])\\", "$1")
    dealt = formatted.repartition("conv_id").withColumn("said", said)
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "said")
    return ordered.select("conv_id", "formatted", "loss_from", "loss_to").mapInArrow(run, DIGEST)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = zip(*rows, strict=True) if rows else ((),) * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=DIGEST.names)
