"""Chat formatting with typed content parts, and reading it back.

A message is a list of parts: text, image, audio or document. A visitor goes through them in
order; text is kept, with control strings escaped, every other part becomes a numbered placeholder
such as ``<|image:0|>``, and its reference and expanded token count are recorded. A turn is

    <|role|>\\n...<|end|>\\n

with the role percent-encoded. Escaping puts a backslash after the opening character of anything
that reads like a control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), whatever number of
backslashes is there already, so taking one away restores the text exactly.

Turns are formatted row by row, so a conversation of any length is spread over tasks. Null roles,
texts and part lists count as empty; turns without number come last; turns with equal numbers are ordered by role,
then text. Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()),
    T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("pages", T.IntegerType()),
])
ATTACHMENT = T.StructType([
    T.StructField("index", T.IntegerType()), T.StructField("type", T.StringType()), T.StructField("ref", T.StringType()),
    T.StructField("tokens", T.LongType()),
])
END = "<|end|>\n"
_LIKE_CONTROL = re.compile(r"([<\[])(?=\\*(?:\||/?s>|/?INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(?=\\*(?:\||/?s>|/?INST\]))")
_TURN = re.compile(r"<\|([A-Za-z0-9_.~%-]*)\|>\n(.*)<\|end\|>\n", re.S)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document):([0-9]+)\|>")


def escape(text: str) -> str:
    return _LIKE_CONTROL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class PartVisitor:
    """Flattens typed parts into one text; attachments are recorded in order of appearance.

    An image takes one token for each patch, audio so many a second, a document so many a page;
    parts of unknown size take one token. A part of unknown type is kept as text.
    """

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 800
    pieces: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, parts: Sequence[dict | None] | None) -> str:
        for part in parts or ():
            if part is not None:
                visit = {"image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}
                visit.get(part.get("type"), self.visit_text)(part)
        self._flush()
        return "".join(self.pieces)

    def visit_text(self, part: dict) -> None:
        self.texts.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        across, down = (-(-(part.get(side) or 1) // self.patch) for side in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, -int(-(part.get("seconds") or 0.0) * self.audio_rate // 1))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.page_tokens)

    def _flush(self) -> None:
        """Neighbouring texts are escaped as one, so no control string can form between them."""
        self.pieces.append(escape("".join(self.texts)))
        self.texts.clear()

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._flush()
        index = len(self.attachments)
        self.pieces.append(f"<|{kind}:{index}|>")
        self.attachments.append({"index": index, "type": kind, "ref": part.get("ref"), "tokens": max(1, tokens)})


def format_turn(role: str | None, parts: Sequence[dict | None] | None) -> tuple[str, list[dict]]:
    visitor = PartVisitor()
    body = visitor.visit(parts)
    return f"<|{quote(role or '', safe='')}|>\n{body}{END}", visitor.attachments


def read_turn(formatted: str) -> tuple[str, list[tuple[str, str | int]]]:
    """(role, parts) of a formatted turn; a part is ("text", text) or (type, attachment index)."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError("not a formatted turn")
    parts: list[tuple[str, str | int]] = []
    at = 0
    for p in _PLACEHOLDER.finditer(m[2]):
        if p.start() > at:
            parts.append(("text", unescape(m[2][at : p.start()])))
        parts.append((p[1], int(p[2])))
        at = p.end()
    if at < len(m[2]):
        parts.append(("text", unescape(m[2][at:])))
    return unquote(m[1]), parts


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("index", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
    for batch in batches:
        done = [format_turn(r, p) for r, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        texts, found = pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], kind)
        loss = pa.array([r == "assistant" for r in batch.column(2).to_pylist()], pa.bool_())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], texts, loss, found], ["conv_id", "turn", "role", "formatted", "in_loss", "attachments"])


def format_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, formatted, in_loss, attachments) from (conv_id, turn, role, parts)."""
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.col("parts").cast(T.ArrayType(PART)).alias("parts"))
    schema = T.StructType([
        *rows.schema.fields[:3], T.StructField("formatted", T.StringType()), T.StructField("in_loss", T.BooleanType()),
        T.StructField("attachments", T.ArrayType(ATTACHMENT)),
    ])
    return rows.mapInArrow(_format, schema)


def text_parts(text: str) -> F.Column:
    """A list of one text part from a text column."""
    values = [F.lit("text"), F.col(text)] + [F.lit(None)] * 5
    return F.array(F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, PART.fields, strict=True)]))


class _Digest:
    """What has been read of one conversation."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.attached = self.tokens = 0

    def add(self, formatted: str, in_loss: bool, attachments: list[dict]) -> None:
        role, parts = read_turn(formatted)
        text = "".join(p for kind, p in parts if kind == "text")
        self.n += 1
        self.chars += len(formatted)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if in_loss:
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.attached += len(attachments)
        self.tokens += sum(a["tokens"] for a in attachments)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.attached, self.tokens


_READ = [("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"),
         ("formatted_chars", "long"), ("n_attachments", "long"), ("attachment_tokens", "long")]


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, what its formatted turns say when read again.

    Turns stream through in order, so a task holds one running digest whatever a conversation's length.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("turn"), "role", "formatted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * (1 + len(_READ))
            kinds = [pa.int64()] + [pa.int64() if k == "long" else pa.string() for _, k in _READ]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", *[n for n, _ in _READ]])

        now, digest = None, None
        for batch in batches:
            done = []
            for conv, text, loss, found in zip(*[batch.column(i).to_pylist() for i in (0, 3, 4, 5)], strict=True):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, *digest.row()))
                    now, digest = conv, _Digest()
                digest.add(text, loss, found)
            yield out(done)
        if digest is not None:
            yield out([(now, *digest.row())])

    return ordered.mapInArrow(run, "conv_id long, " + ", ".join(f"{n} {k}" for n, k in _READ))
