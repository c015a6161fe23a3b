"""Chat formatting with typed content parts.

A turn's content is an ordered list of parts, each with a ``type``: ``text``, ``image``,
``audio`` or ``document``.  A visitor flattens them into one string: text is escaped, every
other part becomes a numbered placeholder and an attachment record with its reference and the
number of tokens it expands to.  Formatting works row by row; nothing is collected per
conversation, so a conversation of any length is spread over tasks and only its order
(``conv_id, turn``) ties it together.

Format of a turn: ``<|im_start|>role\\ncontent<|im_end|>\\n``.  Escaping adds one backslash
between ``<`` and ``|`` (behind those already there), so no control string can come from a
text, and reading takes it away again: ``<|`` <-> ``<\\|``, ``<\\|`` <-> ``<\\\\|``.
"""
from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from airnet.llm.common import arrow, rows, ship

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLES = frozenset({"assistant"})

PART = StructType([
    StructField("type", StringType()),      # text | image | audio | document
    StructField("text", StringType()),      # of a text part
    StructField("ref", StringType()),       # of any other part: where its bytes are
    StructField("width", DoubleType()),     # image: pixels
    StructField("height", DoubleType()),    # image: pixels
    StructField("seconds", DoubleType()),   # audio
    StructField("pages", DoubleType()),     # document
])
ATTACHMENT = StructType([
    StructField("placeholder", StringType(), False), StructField("type", StringType(), False),
    StructField("ref", StringType()), StructField("offset", LongType(), False),
    StructField("tokens", LongType(), False),
])
TURN_SCHEMA = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
    StructField("formatted", StringType(), False),   # the whole turn with its marks
    StructField("loss", BooleanType(), False),       # is the content under the loss mask
    StructField("content_start", IntegerType(), False), StructField("content_end", IntegerType(), False),
    StructField("attachments", ArrayType(ATTACHMENT), False),
    StructField("attachment_tokens", LongType(), False),
])
DIGEST_SCHEMA = StructType([
    StructField("conv_id", LongType()), StructField("n_turns", LongType(), False),
    StructField("turns_sha256", StringType(), False), StructField("loss_chars", LongType(), False),
    StructField("loss_sha256", StringType(), False), StructField("formatted_chars", LongType(), False),
    StructField("n_attachments", LongType(), False), StructField("attachment_tokens", LongType(), False),
])

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class PartVisitor:
    """Flattens the parts of one turn.  A subclass may add ``visit_<type>`` for more types."""

    #: tokens an attachment expands to
    image_patch, image_unknown = 28, 256
    audio_per_second, document_per_page = 25, 512

    def __init__(self):
        self.out: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> None:
        if part is None:
            return
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self._put(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        w, h = part.get("width"), part.get("height")
        side = self.image_patch
        self._attach("image", part, math.ceil(w / side) * math.ceil(h / side) if w and h else self.image_unknown)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0) * self.audio_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, math.ceil(part.get("pages") or 1) * self.document_per_page)

    def visit_unknown(self, part: dict) -> None:
        self._attach("unknown", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        mark = f"<|{kind}:{len(self.attachments)}|>"
        self.attachments.append({"placeholder": mark, "type": kind, "ref": part.get("ref"),
                                 "offset": self.length, "tokens": int(tokens)})
        self._put(mark)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)


def text_parts(text: Column) -> Column:
    """A plain text column as one text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            null.cast("string").alias("ref"), *[null.cast("double").alias(c) for c in
                                                                ("width", "height", "seconds", "pages")]))


def format_turns(turns: DataFrame, parts: Column | None = None, visitor: type[PartVisitor] = PartVisitor) -> DataFrame:
    """One formatted row per row of ``turns`` (conv_id, turn, role, text or ``parts``).

    NULL text, NULL parts and an empty list are empty content; a NULL role is the empty role; a
    NULL ``conv_id`` is a conversation of its own and a NULL ``turn`` comes first.  Repeated rows
    stay.  Only the named columns are read.
    """
    ship(turns.sparkSession)
    schema = arrow(TURN_SCHEMA)
    parts = text_parts(F.col("text")) if parts is None else parts
    frame = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), parts.alias("parts"))

    def run(batches):
        for batch in batches:
            out = []
            for conv_id, turn, role, content in rows(batch, "conv_id", "turn", "role", "parts"):
                v = visitor()
                for part in content or ():
                    v.visit(part)
                role = role or ""
                head, body = f"{START}{escape_role(role)}\n", "".join(v.out)
                out.append((conv_id, turn, role, head + body + END, role in LOSS_ROLES, len(head),
                            len(head) + len(body), v.attachments, sum(a["tokens"] for a in v.attachments)))
            cols = list(zip(*out)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return frame.mapInArrow(run, TURN_SCHEMA)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text (placeholders stay as they are) read back from one formatted turn."""
    if not (formatted.startswith(START) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, content = formatted[len(START):-len(END)].partition("\n")
    return unescape_role(role), unescape(content)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from :func:`format_turns`: turns, characters and digests.

    The rows of a conversation meet in order in one task and are digested one at a time (a
    SHA-256 needs its bytes in order), so memory does not grow with a conversation.  Ties of
    ``turn`` go by role, then by formatted text.
    """
    ship(formatted.sparkSession)
    schema = arrow(DIGEST_SCHEMA)
    cols = ["conv_id", "formatted", "loss", "content_start", "content_end", "attachments", "attachment_tokens"]
    ordered = (formatted.repartition("conv_id")
               .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(),
                                     "role", "formatted").select(*cols))

    def run(batches):
        now, state = None, None

        def close():
            n, turns, chars, loss, total, attached, tokens = state
            return (now, n, turns.hexdigest(), chars, loss.hexdigest(), total, attached, tokens)

        def batch_of(out):
            cols = list(zip(*out)) or [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            out = []
            for conv, text, is_loss, start, end, attached, tokens in rows(batch, *cols):
                if state is None or conv != now:
                    if state is not None:
                        out.append(close())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                role, content = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{content}\n".encode())
                if is_loss:
                    masked = unescape(text[start:end])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(text)
                state[5] += len(attached)
                state[6] += tokens
            yield batch_of(out)
        if state is not None:
            yield batch_of([close()])

    return ordered.mapInArrow(run, DIGEST_SCHEMA)
