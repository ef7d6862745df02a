"""Token counts of whole texts with a shortcut for pre-tokens that are one token.

Before any text is read, the driver proves with the tokenizer library itself

* which vocabulary strings, encoded alone, are a single token: pre-tokens equal to one of them
  count one without any merging;
* for every code point below ``PLAIN_END``, how the library's normaliser and pre-tokenizer treat
  it (letter, number, white space or other, and its lower case), so that texts made of proven code
  points can be split here.

Other pre-tokens are merged by the library, each distinct one once for a while; texts with
unproven code points are encoded whole by the library. Special strings inside a text count one
token each, as the library's default has it. Null texts count as empty. One row per row, equal rows included.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.llm.common import pieces_of

LIMIT = 2048
#: Code points that are tried one by one; none below U+0300 combines with another.
PLAIN_END = 0x250
#: Merged pre-tokens kept in a task's memory.
KEPT = 200_000
_CHARS = 2 << 20


@dataclass(frozen=True)
class Proof:
    """What has been proven about a tokenizer file; small, whatever the data's size."""

    path: str
    whole: frozenset[str]
    split: str
    unproven: str
    special: str | None


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _class(chars: Iterable[str]) -> str:
    return "[" + "".join(f"\\u{ord(c):04x}" for c in sorted(chars)) + "]"


def prove(path: str) -> Proof:
    """Facts about a tokenizer whose pre-tokens are contractions, letter runs, digits and the rest."""
    tokenizer = _load(path)
    parts = lambda text: len(tokenizer.pre_tokenizer.pre_tokenize_str(text))
    kinds: dict[str, set[str]] = {"letter": set(), "number": set(), "other": set(), "space": set()}
    proven = set()
    for c in map(chr, range(PLAIN_END)):
        seen, lower = tokenizer.normalizer.normalize_str(c), c.lower()
        if parts(seen) == 0 and parts(lower) == 0:
            kind = "space"
        elif seen != lower or len(lower) != 1 or ord(lower) >= PLAIN_END:
            continue
        elif parts(f"a{lower}a") == 1:
            kind = "letter"
        else:
            kind = "number" if parts(lower * 2) == 2 else "other"
        kinds[kind].add(lower)
        proven.add(c)
    contractions = [c for c in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d") if parts(f"a{c}") == 2]
    split = "|".join([*map(re.escape, contractions), _class(kinds["letter"]) + "+", _class(kinds["number"]), _class(kinds["other"]) + "+"])
    added = tokenizer.get_added_tokens_decoder().values()
    # strings that the library takes out of the raw text first; others would need its own search
    simple = all(not (t.normalized or t.single_word or t.lstrip or t.rstrip) for t in added)
    strings = sorted({t.content for t in added}, key=len, reverse=True)
    special = "|".join(map(re.escape, strings)) if simple else None
    plain = re.compile(split)
    words = set()
    for piece in tokenizer.get_vocab():
        word = tokenizer.decoder.decode([piece]).strip() if tokenizer.decoder else piece
        words.add(word.removesuffix("</w>").lower())
    tried = sorted(w for w in words if w and proven.issuperset(w) and plain.fullmatch(w) and w not in strings)
    encoded = tokenizer.encode_batch(tried, add_special_tokens=False)
    whole = frozenset(w for w, e in zip(tried, encoded, strict=True) if len(e.ids) == 1)
    return Proof(path, whole, split, "[^" + _class(proven)[1:], special)


class Counter:
    """Counts tokens as the library does; made once in each task."""

    def __init__(self, proof: Proof) -> None:
        self.tokenizer = _load(proof.path)
        self.whole = dict.fromkeys(proof.whole, 1)
        self.cost = dict(self.whole)
        self.find = re.compile(proof.split).findall
        self.unproven = re.compile(proof.unproven).search
        self.special = None if proof.special is None else re.compile(proof.special or r"(?!)")

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def counts(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        plain: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.special is None or (not text.isascii() and self.unproven(text)):
                out[i] = self._encoded([text])[0]
                continue
            parts = self.special.split(text)
            out[i] = len(parts) - 1
            plain += [(i, self.find(p.lower())) for p in parts]
        missing = set().union(*(words for _, words in plain)).difference(self.cost)
        if len(self.cost) + len(missing) > len(self.whole) + KEPT:
            self.cost = dict(self.whole)
            missing = set().union(*(words for _, words in plain)).difference(self.cost)
        if missing:
            rest = list(missing)
            self.cost.update(zip(rest, self._encoded(rest), strict=True))
        price = self.cost.__getitem__
        for i, words in plain:
            out[i] += sum(map(price, words))
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(prove(path))
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found: list[int] = []
            for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
                found += counter.counts(texts[a:b])
            n = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
