"""Quality classifier: importance resampling of raw text towards a target.

Two generative models over hashed word n-grams (orders one and two), one of the labelled good
text and one of all text, give every document the log of p_target / p_raw. Adding standard
Gumbel noise to it and keeping the k largest draws k documents without replacement with
probability in proportion to the ratio.

* Both models are smoothed with the same expected pseudo-counts, and a document's own grams are
  taken out of both before it is weighed (leave one out), so a gram that no other document has
  weighs nothing and labelled documents have no advantage.
* A token next to itself counts as the bigram "repeated", whatever the token is: invented junk
  repeats words that no other document has.
* The raw model counts all grams of all documents, the target model those of all documents that are
  labelled good; the labels go to every task only while they are small.
* k is the share of labelled documents whose quality is 1, plus two standard errors, of all
  documents: when the estimate is off, junk stays rather than good text going.

Null or empty texts have no grams, hence weight 1 (log 0). Without labels everything is kept.
Equal rows get equal noise and stay or go together. Extra columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.llm import grams
from claimweft.llm.common import fresh, kth_largest, pieces_of, stage_table

#: Buckets of each order of n-gram.
BUCKETS = 1 << 16
#: Pseudo-counts of a bucket in both models.
SMOOTHING = 100.0
SEED = 20240611
_CHARS = 1 << 20
#: Good labels, one long each, that go to every task; more are joined, which shuffles the texts.
BROADCAST_ROWS = 6_000_000


def _buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every gram of the texts."""
    uni, offsets = grams.tokens(texts, grams.WORDS_AND_SYMBOLS, lower=False)
    bi, bi_offsets = grams.ngrams(uni, offsets, 2)
    one = np.repeat(np.arange(len(texts)), np.diff(offsets))
    two = np.repeat(np.arange(len(texts)), np.diff(bi_offsets))
    if len(uni):
        # each bigram starts at a token; the last token of a text starts one only if it is alone
        starts = np.arange(len(bi)) + np.repeat(offsets[:-1] - bi_offsets[:-1], np.diff(bi_offsets))
        follower = np.append(uni[1:], np.uint64(0))[starts]
        alone = np.repeat(np.diff(offsets) == 1, np.diff(bi_offsets))
        bi = np.where((uni[starts] == follower) & ~alone, np.uint64(0), bi)
    size = np.uint64(BUCKETS)
    bucket = np.concatenate([uni % size, bi % size + size]).astype(np.int64)
    return np.concatenate([one, two]), bucket


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    return pieces_of([len(t or "") for t in texts], _CHARS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for batch in batches:
        texts, good = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        for a, b in _parts(texts):
            doc, bucket = _buckets(texts[a:b])
            raw += np.bincount(bucket, minlength=2 * BUCKETS)
            target += np.bincount(bucket[good[a:b][doc]], minlength=2 * BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
    )


def good_documents(labels: DataFrame) -> DataFrame:
    """The documents that are labelled good and not toxic (_doc long)."""
    return (
        labels.select(F.col("doc_id").alias("_doc"), F.col("quality").alias("q"), F.col("toxic").alias("t"))
        .dropna(subset=["_doc"])
        .groupBy("_doc")
        .agg(F.min("q").alias("q"), F.max("t").alias("t"))
        .filter("q = 1 and coalesce(t, 0) = 0")
        .select("_doc")
    )


def good_share(labels: DataFrame) -> float:
    """Share of labelled documents with quality 1, plus two standard errors."""
    row = labels.filter("quality is not null").agg(
        F.count("*").alias("n"), F.sum((F.col("quality") == 1).cast("int")).alias("good")
    ).first()
    if not row.n:
        return 1.0
    p = row.good / row.n
    return min(1.0, p + 2 * math.sqrt(p * (1 - p) / row.n) + 1 / row.n)


def _flagged(docs: DataFrame, good: DataFrame, name: str) -> DataFrame:
    """``docs`` with a boolean column: whether their number is among ``good``."""
    marks = good.select("_doc", F.lit(True).alias(name)).withColumnRenamed("_doc", f"{name}_doc")
    if good.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    joined = docs.join(marks, docs["doc_id"] == marks[f"{name}_doc"], "left").drop(f"{name}_doc")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def fit(docs: DataFrame, good: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(raw, target) gram counts by bucket: two arrays of fixed size."""
    rows = _flagged(docs.select("doc_id", "text"), good, "_good").select("text", "_good")
    counts = rows.mapInArrow(_count, "bucket int, raw long, target long").groupBy("bucket")
    found = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    at = found.column("bucket").to_numpy()
    raw[at], target[at] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    return raw, target


def _log_weights(texts: list[str | None], good: np.ndarray, raw: np.ndarray, target: np.ndarray, smoothing: float) -> np.ndarray:
    out = np.zeros(len(texts))
    ratio = target.sum() / max(raw.sum(), 1.0)
    for a, b in _parts(texts):
        doc, bucket = _buckets(texts[a:b])
        cell, own = np.unique(doc * (2 * BUCKETS) + bucket, return_counts=True)
        doc, bucket = np.divmod(cell, 2 * BUCKETS)
        seen = target[bucket] - own * good[a:b][doc]
        expected = (raw[bucket] - own) * ratio
        weight = own * np.log((seen + smoothing) / (expected + smoothing))
        out[a:b] = np.bincount(doc, weights=weight, minlength=b - a)
    return out


def sortable(x: np.ndarray) -> np.ndarray:
    """Doubles as longs in the same order."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def score(docs: DataFrame, good: DataFrame, model: tuple[np.ndarray, np.ndarray], columns: list[str], smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """The given columns of ``docs`` with log_weight, gumbel_score and the score's order as a long.

    The three new columns take names that ``docs`` does not have; they come last.
    """
    weight, noisy, order, flag, noise, text = fresh(docs, "log_weight", "gumbel_score", "score_order", "score_good", "score_noise", "score_text")
    extra = [] if "text" in columns else [F.col("text").alias(text)]  # texts go to Python once
    rows = _flagged(docs, good, flag).select(
        *[f"`{c}`" for c in columns],
        flag,
        F.xxhash64(F.lit(seed), "doc_id", "text").alias(noise),
        *extra,
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)
    n = len(columns)
    at = n + 2 if extra else columns.index("text")
    schema = T.StructType([
        *docs.select(*[f"`{c}`" for c in columns]).schema.fields,
        T.StructField(weight, T.DoubleType()), T.StructField(noisy, T.DoubleType()), T.StructField(order, T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = sent.value
        for batch in batches:
            good_here = batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)
            w = _log_weights(batch.column(at).to_pylist(), good_here, raw, target, smoothing)
            u = ((batch.column(n + 1).to_numpy().view(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
            s = w - np.log(-np.log(u))
            new = [pa.array(w), pa.array(s), pa.array(sortable(s))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], [*batch.schema.names[:n], weight, noisy, order])

    return rows.mapInArrow(run, schema)


def resample(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The documents that the Gumbel top-k draw keeps, with their weights.

    Columns: those named (default all of ``docs``), then log_weight and gumbel_score. The narrow
    scores are staged once to find the k-th largest; wide rows are scored again on their way
    out, which needs no shuffle and no copy of the texts.
    """
    good = stage_table(good_documents(labels), "good-labels")
    model = fit(docs, good)
    scored = stage_table(score(docs, good, model, ["doc_id"]), "importance")
    k = math.ceil(scored.count() * good_share(labels))
    cut = kth_largest(scored, scored.columns[-1], k)
    wanted = columns or docs.columns
    out = scored if wanted == ["doc_id"] else score(docs, good, model, wanted)
    order = out.columns[-1]
    return out.filter(F.col(order) >= cut).drop(order) if cut is not None else out.drop(order)
