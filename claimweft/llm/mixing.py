"""Mixing sources to target weights by blocks of words.

The words of each source, in a pseudorandom order of its documents, are packed into blocks of
fixed length. Every output shard draws how many of its slots each source fills from a multinomial;
a slot's running number within its source goes through a pseudorandom permutation of the source's
blocks (a new one for every pass over them), and slots meet words by block number.

* Targets share all words by weight; a source's target stops at ``cap`` times its words and what
  is over is shared again by weight.
* A shard's draw is the residual form: the whole part of slots x share is given, the rest is
  drawn, so each count has the multinomial's mean with less scatter, and totals stay near target.
* No block is used in more than ``cap`` passes: slots beyond them stay empty.
* Sources are ordered by code point, null last (a source of its own). Null texts have no words.
  Documents without words are never taken. An empty table gives an empty result.
* Everything follows from hashes of documents and the seed, so reruns agree. Equal rows are
  interchangeable: together they take the same words in every run.

Per-source totals and the shard draws are small (sources, sources x shards); the order within a
source is cut into 4,096 cells by hash, so no source is numbered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.llm.common import fresh, stage_table

WEIGHTS = (1, 2, 3)
CAP = 3
#: Words of a block; slots of an output shard.
BLOCK_WORDS, SHARD_SLOTS = 32, 4096
SEED = 7
#: Slots that a task makes.
TASK_SLOTS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> list[float]:
    """Words wanted of each source, sources in their order."""
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n]
    left = float(sum(sizes))
    while open_:
        unit = left / sum(weight[i] for i in open_)
        over = [i for i in open_ if unit * weight[i] > cap * sizes[i]]
        for i in over or open_:
            out[i] = float(cap * sizes[i]) if over else unit * weight[i]
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in over] if over else []
    return out


def _source_table(sized: DataFrame) -> tuple[list[tuple[str | None, int, float]], DataFrame]:
    """(source, words, target) in order, and the same as a table; as many rows as sources."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    wanted = targets([r.size for r in rows])
    found = [(r.source, r.size, t) for r, t in zip(rows, wanted, strict=True)]
    numbered = [(i, *x) for i, x in enumerate(found)]
    return found, sized.sparkSession.createDataFrame(numbered, "source_no int, source string, source_size long, target double")


def place_words(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's first word number in its source (start), sources without words included.

    A running sum in two steps: within a hash cell of the source, and over the source's cells.
    """
    rows = docs.join(F.broadcast(sources), docs["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    cells = rows.groupBy(F.col("source_no").alias("s"), F.shiftright("h", 52).alias("c")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage_table(cells.select("s", "c", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")), "mix-offsets")
    inside = Window.partitionBy("source_no", "cell").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("cell", F.shiftright("h", 52)).withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(offsets, (F.col("source_no") == F.col("s")) & (F.col("cell") == F.col("c"))).withColumn(
        "start", F.col("offset") + F.col("inner")
    ).drop("s", "c", "cell", "inner", "offset")


def draw_counts(n_slots: int, shares: np.ndarray, shard: int, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> np.ndarray:
    """Slots of one output shard by source."""
    slots = min(shard_slots, n_slots - shard * shard_slots)
    expected = slots * shares
    counts = np.floor(expected + 1e-9).astype(np.int64)
    rest = np.maximum(expected - counts, 0)
    left = slots - int(counts.sum())
    if left > 0 and rest.sum() > 0:
        counts += np.random.Generator(np.random.Philox(key=seed, counter=shard)).multinomial(left, rest / rest.sum())
    return counts


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of each index under the keyed pseudorandom permutation of range(size).

    Four Feistel rounds on the next even number of bits; images beyond the range go round again.
    """
    u = np.uint64
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(u)
    mask = (u(1) << half) - u(1)
    out, todo = index.astype(u), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(u)
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            f = (right + u((r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) ^ k
            f = (f ^ (f >> u(30))) * u(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> u(27))) * u(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> u(31))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(u)]
    return out.astype(np.int64)


@F.pandas_udf(T.LongType())
def block_of(index: pd.Series, blocks: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(index.to_numpy(), blocks.to_numpy(), key.to_numpy()))


def mixed_slots(sources: DataFrame, found: Sequence[tuple[str | None, int, float]], block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix: (out_shard, source_no, pass_no, block) for every slot that is filled."""
    spark = sources.sparkSession
    wanted = np.array([t for _, _, t in found], float)
    n_slots = int(round(wanted.sum() / block_words))
    shards = -(-n_slots // shard_slots)
    shares = wanted / wanted.sum() if n_slots else wanted

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [(j, draw_counts(n_slots, shares, j, shard_slots, seed)) for j in batch.column(0).to_pylist()]
            shard = np.repeat([j for j, _ in drawn], len(shares)).astype(np.int64)
            source = np.tile(np.arange(len(shares), dtype=np.int32), len(drawn))
            count = np.concatenate([c for _, c in drawn]) if drawn else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(source), pa.array(count)], ["out_shard", "source_no", "count"])

    counts = spark.range(shards).mapInArrow(draw, "out_shard long, source_no int, count long")
    earlier = Window.partitionBy("source_no").orderBy("out_shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0))).filter("count > 0")
    # counts are few, the slots that each task makes of them are not
    counts = counts.repartition(max(1, -(-n_slots // TASK_SLOTS)), "source_no", "out_shard")
    blocks = sources.select("source_no", F.ceil(F.col("source_size") / F.lit(block_words)).cast("long").alias("blocks"))
    slots = counts.join(F.broadcast(blocks), "source_no").withColumn(
        "slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1))
    )
    in_pass = slots.select(
        "out_shard", "source_no", "blocks",
        F.expr("slot div blocks").alias("pass_no"), (F.col("slot") % F.col("blocks")).alias("index"),
    ).filter(F.col("pass_no") < CAP)
    key = F.xxhash64(F.lit(seed), "source_no", "pass_no")
    return in_pass.select("out_shard", "source_no", "pass_no", block_of("index", "blocks", key).alias("block"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, h, size, source_size, target, taken) for every row of ``docs``."""
    sized = stage_table(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("h")), "mix-sizes"
    )
    found, sources = _source_table(sized)
    placed = stage_table(place_words(sized, sources), "mix-placed")
    last = F.expr(f"(start + size - 1) div {block_words}")
    pieces = placed.filter("size > 0").select(
        "source_no", "start", "size", F.explode(F.sequence(F.expr(f"start div {block_words}"), last)).alias("block")
    )
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    used = mixed_slots(sources, found, block_words).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    taken = (
        pieces.select("source_no", "start", "block", (end - begin).alias("words"))
        .join(used, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    # documents without words share their start with the one that follows
    with_words = F.when(F.col("size") > 0, F.col("start"))
    return (
        placed.withColumn("start", with_words)
        .join(taken, ["source_no", "start"], "left")
        .select("doc_id", "source", "h", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def apply_mix(docs: DataFrame) -> DataFrame:
    """``docs`` with every row repeated (or left out) as the mix takes it, columns unchanged.

    Rows come as often as taken / size says, rounded up or down by a hash so that the expected
    words are those taken; no row comes more than ``CAP`` times.
    """
    ratios = stage_table(
        mix(docs).filter("taken > 0").groupBy(F.col("source").alias("s"), F.col("h").alias("k")).agg(
            (F.sum("taken") / F.sum("size")).alias("r")
        ),
        "mix-ratios",
    )
    h, ratio, copies, s, k = fresh(docs, "h", "ratio", "copies", "s", "k")
    keyed = docs.withColumn(h, F.xxhash64("doc_id", "text"))
    some = ratios.select(F.col("s").alias(s), F.col("k").alias(k), F.col("r").alias(ratio))
    joined = keyed.join(some, (F.col(h) == F.col(k)) & F.col("source").eqNullSafe(F.col(s)))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), h), 11) / F.lit(2.0**53)
    times = F.floor(F.col(ratio) + draw).cast("int")
    return joined.withColumn(copies, F.explode(F.array_repeat(F.lit(1), times))).select(*[f"`{c}`" for c in docs.columns])
