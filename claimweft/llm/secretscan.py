"""Secrets in texts: fixed patterns, and character Markov models for what they miss.

Two first-order Markov models over the characters of keys and identifiers, one of random strings
and one of ordinary words, are trained from labelled samples: the secrets that the patterns find
in the corpus, and the corpus's other words. A word of ``MIN_LENGTH`` characters or more whose
log-likelihood ratio is high, in all and per character, is a further span of kind ``markov``; it
never overlaps a span of the patterns, which all stay.

Both passes read whole texts; transition counts cover all documents and are of fixed size. Null
texts count as empty and have no spans. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.llm.common import pieces_of

#: Fixed patterns, by kind.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # whole runs, so the least length can be part of the pattern
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_LENGTH = 20
#: Least log-likelihood ratio of a span, in nats: in all, and per character.
MIN_RATIO, MIN_RATIO_PER_CHAR = 20.0, 0.7
_CANDIDATE = re.compile(rf"[{re.escape(ALPHABET)}]{{{MIN_LENGTH},}}")
#: Ordinary words shorter than this teach nothing about identifiers.
_WORD_LENGTH = 8
_STATES = len(ALPHABET) + 1
_CODES = np.zeros(256, np.int64)
_CODES[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, _STATES)
#: Expected pseudo-transitions out of each state: many and even for random strings, few for words.
_RANDOM_PRIOR, _WORD_PRIOR = 500.0, 5.0
_CHARS = 2 << 20

Span = tuple[int, int, int]


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, secret) of the fixed patterns, ordered by start, then kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda s: s[:2])
    return found


def _transitions(words: list[str], shortest: int) -> np.ndarray:
    """Counts of neighbouring characters in the runs of the alphabet, ends included."""
    data = np.frombuffer((" " + " ".join(words) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    code = _CODES[data]
    edges = np.flatnonzero(np.diff((code > 0).astype(np.int8)))
    starts, ends = edges[::2] + 1, edges[1::2] + 1
    long_enough = ends - starts >= shortest
    step = np.zeros(len(code) + 1, np.int8)
    np.add.at(step, starts[long_enough] - 1, 1)
    np.add.at(step, ends[long_enough], -1)
    inside = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    return np.bincount(code[inside] * _STATES + code[inside + 1], minlength=_STATES * _STATES)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, _STATES * _STATES), np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
            secrets, rest = [], []
            for text in texts[a:b]:
                at = 0
                for start, _, end, secret in base_spans(text or ""):
                    secrets.append(secret)
                    if end > at:
                        rest.append(text[at : max(at, start)])
                        at = end
                rest.append((text or "")[at:])
            totals[0] += _transitions(rest, _WORD_LENGTH)
            totals[1] += _transitions(secrets, 1)
    label, cell = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(totals[label, cell])], ["label", "cell", "n"]
    )


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """log P(next | previous) of random strings over that of words, from (2, cells) counts."""
    logs = []
    for own, prior in ((counts[1], _RANDOM_PRIOR), (counts[0], _WORD_PRIOR)):
        table = own.reshape(_STATES, _STATES) + prior / _STATES
        logs.append(np.log(table / table.sum(axis=1, keepdims=True)))
    return (logs[0] - logs[1]).ravel()


def train(docs: DataFrame) -> np.ndarray:
    """The models' log ratio of each transition: one number per pair of characters."""
    counts = np.zeros((2, _STATES * _STATES))
    learned = docs.select("text").mapInArrow(_learn, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    for row in learned.collect():  # at most two rows for each pair of characters
        counts[row.label, row.cell] = row.n
    return log_ratio(counts)


def markov_spans(text: str, taken: list[tuple[int, int, int, str]], ratio: np.ndarray) -> list[Span]:
    """Spans (start, kind, end) of words that look random and touch none that is taken."""
    out = []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, _, e, _ in taken):
            continue
        code = _CODES[np.frombuffer(m[0].encode(), np.uint8)]
        total = float(ratio[code[:-1] * _STATES + code[1:]].sum())
        if total >= MIN_RATIO and total >= MIN_RATIO_PER_CHAR * (end - start):
            out.append((start, 3, end))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    rows = docs.select("doc_id", "text")
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]
    kinds = [T.LongType()] * 3 + [T.StringType()] * 2 + [T.LongType()]
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                own = [s[:3] for s in base]
                more = markov_spans(text, base, sent.value)
                count = [sum(k == kind for _, k, _ in own) for kind in range(3)]
                digest = hashlib.sha256(_joined(own).encode()).hexdigest()
                found.append((*count, digest, _joined(own + more), len(more)))
            columns = list(zip(*found, strict=True)) if found else [()] * len(names)
            arrays = [pa.array(c, pa.int64() if k == T.LongType() else pa.string()) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *names])

    return rows.mapInArrow(run, schema)
