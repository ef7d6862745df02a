"""Ranked lexical search by dense blocked matrix products, exact in whole numbers.

The score of a document for an item is a sum of w(term) * impact(term, document) over the item's terms.
Items go through in groups of a bounded number of terms. For each group

* every document is reduced once to its frequencies of the group's terms (written out), and their
  document frequencies are counted over all documents;
* the group's items are dealt into tiles of ``TILE_ITEMS`` items and ``TILE_TERMS`` distinct terms,
  whose compact term x item matrix of weights is multiplied with document x term tiles of impacts
  (float64 BLAS). An entry is below ``CAP`` and an impact below ``IMPACT``, so every partial sum is
  a whole number below 2^53 and exact whatever the order of addition; heavier weights are split into
  a high and a low matrix, added as 64-bit integers;
* each task keeps a list of the best per item, equal scores by document number, and the lists meet
  in two steps.

No document is left out, and no text is cut: a task's memory is a few tiles, its lists and one text.

Null texts have no terms, in documents and in items; items without terms have no results. Equal
items (number and text) count once; items of one number with different texts have a list each.
Repeated documents count each; null document numbers come last among equal scores. Terms are known by 64-bit
hashes. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.llm import grams
from claimweft.llm.common import pieces_of, stage_table

TOP = 10
#: Distinct terms by item that one group of items adds up to; a longer item is a group of its own.
GROUP_TERMS = 1 << 17
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 128, 2048, 512
#: No impact reaches this: 10^9 * tf / (1000 * tf + 8 * m) with m > 0.
IMPACT = 10**6
#: Weights of an item in one matrix entry; TILE_TERMS * CAP * IMPACT stays below 2^53.
CAP = 2**53 // IMPACT // TILE_TERMS
#: Tasks whose lists meet first.
FAN = 256
_CHARS = 1 << 20


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of runs of ASCII letters, digits and whatever is not ASCII; only A-Z lower-cased."""

    def lower(text: str) -> str:
        return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")

    return grams.tokens([t and lower(t) for t in texts], lower=False)


def _counted(texts: list[str | None], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each text, offsets, places in the vocabulary, frequencies)."""
    hashes, at = terms(texts)
    if not len(vocabulary):
        nothing = np.empty(0, np.int64)
        return np.diff(at), np.zeros(len(at), np.int64), nothing, nothing
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[place] == hashes
    owner = np.repeat(np.arange(len(texts)), np.diff(at))[known]
    codes, tf = np.unique(owner * len(vocabulary) + place[known], return_counts=True)
    offsets = np.searchsorted(codes, np.arange(len(texts) + 1) * len(vocabulary))
    return np.diff(at), offsets, codes % len(vocabulary), tf


@dataclass(frozen=True)
class Block:
    """Some terms (places in the vocabulary, ascending) by the items of a tile; counts ``factor`` times."""

    terms: np.ndarray
    weights: np.ndarray
    factor: int


@dataclass(frozen=True)
class Tile:
    items: np.ndarray
    blocks: tuple[Block, ...]


def tiles_of(items: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> list[Tile]:
    """Tiles of items, each given by its places in the vocabulary (``n_terms`` long) and whole weights."""
    out: list[Tile] = []
    order = sorted(range(len(items)), key=lambda i: len(items[i][0]))
    start = 0
    while start < len(order):
        seen, stop = np.zeros(n_terms, bool), start
        while stop < len(order) and stop - start < TILE_ITEMS:
            seen_now = seen.copy()
            seen_now[items[order[stop]][0]] = True
            if stop > start and seen_now.sum() > TILE_TERMS:
                break
            seen, stop = seen_now, stop + 1
        chosen, used = order[start:stop], np.flatnonzero(seen)
        blocks = []
        for a in range(0, len(used), TILE_TERMS):
            part = used[a : a + TILE_TERMS]
            weights = np.zeros((len(part), len(chosen)), np.int64)
            for column, i in enumerate(chosen):
                places, w = items[i]
                inside = (places >= part[0]) & (places <= part[-1])
                weights[np.searchsorted(part, places[inside]), column] = w[inside]
            high, low = np.divmod(weights, CAP)
            blocks += [Block(part, m.astype(float), f) for m, f in ((low, 1), (high, CAP)) if m.any()]
        out.append(Tile(np.array(chosen), tuple(blocks)))
        start = stop
    return out


def scores(tile: Tile, owner: np.ndarray, place: np.ndarray, impact: np.ndarray, n: int) -> np.ndarray:
    """(n, items) whole scores of ``n`` documents, given by entries (document, place, impact)."""
    total = np.zeros((n, len(tile.items)), np.int64)
    for block in tile.blocks:
        column = np.minimum(np.searchsorted(block.terms, place), len(block.terms) - 1)
        hit = block.terms[column] == place
        dense = np.zeros((n, len(block.terms)))
        dense[owner[hit], column[hit]] = impact[hit]
        total += (dense @ block.weights).astype(np.int64) * block.factor
    return total


class Best:
    """The best ``k`` documents for each item of a tile, equal scores by document number, null last."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.item = self.score = self.doc = np.empty(0, np.int64)
        self.none = np.empty(0, bool)
        self.least = np.ones(n_items, np.int64)  # only scores above 0 count

    def add(self, found: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        row, item = np.nonzero(found >= self.least)
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, found[row, item[len(self.item) :]]])
        doc, none = np.concatenate([self.doc, doc[row]]), np.concatenate([self.none, none[row]])
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[nth < self.k]
        last = order[nth == self.k - 1]
        self.least[item[nth == self.k - 1]] = score[last]
        self.item, self.score, self.doc, self.none = item[nth < self.k], score[kept], doc[kept], none[kept]


_FOUND = pa.schema([("slot", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms and their counts by item, with the running number of terms in this task."""
    total = 0
    for batch in batches:
        hashes, at = terms(batch.column(1).to_pylist())
        sets = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
        upto = total + np.cumsum([len(u) for u, _ in sets], dtype=np.int64)
        total = int(upto[-1]) if len(upto) else total
        columns = [pa.array([u.view(np.int64).tolist() for u, _ in sets], pa.list_(pa.int64())), pa.array([c.tolist() for _, c in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(upto, pa.int64())], ["item_id", "terms", "counts", "upto"])


def grouped_items(items: DataFrame, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, terms, counts, slot, part): items in parts of about ``group_terms`` terms; slot names an item."""
    rows = items.select("item_id", "text").distinct()
    lists = [T.StructField(name, T.ArrayType(T.LongType())) for name in ("terms", "counts")]
    schema = T.StructType([rows.schema["item_id"], *lists, T.StructField("upto", T.LongType())])
    counted = stage_table(rows.mapInArrow(_items, schema).withColumn("slot", F.monotonically_increasing_id()).withColumn("task", F.spark_partition_id()), "items")
    # one row a task
    held = counted.groupBy("task").agg(F.max("upto").alias("held"))
    before = held.select("task", (F.sum("held").over(Window.orderBy("task")) - F.col("held")).alias("before"))
    part = F.floor((F.col("before") + F.col("upto") - F.size("terms")) / group_terms).cast("long")
    return stage_table(counted.filter(F.size("terms") > 0).join(F.broadcast(before), "task").select("item_id", "terms", "counts", "slot", part.alias("part")), "items")


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, places, tfs): for every document the number of its terms and those of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
                n, at, place, tf = _counted(texts[a:b], sent.value)
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int32())) for v in (place, tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n, pa.int64()), *lists], ["doc_id", "n", "places", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, places array<int>, tfs array<int>")


def _rank(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_group(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(slot, doc_id, score): the best of FAN tasks each, for the items ``rows`` of one part."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([np.array(r.terms, np.int64).view(np.uint64) for r in rows]))
    counted = stage_table(postings(docs, vocabulary), "postings")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for place, n in counted.select(F.explode("places").alias("place")).groupBy("place").count().collect():
        df[place] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    items = []
    for r in rows:
        places = np.searchsorted(vocabulary, np.array(r.terms, np.int64).view(np.uint64))
        items.append((places, np.array(r.counts, np.int64) * weight[places]))
    sent = spark.sparkContext.broadcast((tiles_of(items, len(vocabulary)), np.array([r.slot for r in rows], np.int64), n_docs, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, slots, n_docs, n_terms = sent.value
        best = [Best(len(t.items), k) for t in tiles]
        for batch in batches:
            ids = batch.column(0)
            none = np.asarray(ids.is_null())
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            m = np.array([25 + 75 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64) if n_terms else np.zeros(len(doc), np.int64)
            at = batch.column(2).offsets.to_numpy()
            place = batch.column(2).values.to_numpy(zero_copy_only=False)
            tf = batch.column(3).values.to_numpy(zero_copy_only=False).astype(np.int64)
            filled = np.flatnonzero(np.diff(at))
            for a in range(0, len(filled), TILE_DOCS):
                some = filled[a : a + TILE_DOCS]
                lengths = at[some + 1] - at[some]
                owner = np.repeat(np.arange(len(some)), lengths)
                # documents without any known term hold no entries, so the block's entries are neighbours
                entries = slice(at[some[0]], at[some[-1] + 1])
                impact = (10**9 * tf[entries] // (1000 * tf[entries] + 8 * m[some][owner])).astype(float)
                for tile, found in zip(tiles, best, strict=True):
                    found.add(scores(tile, owner, place[entries], impact, len(some)), doc[some], none[some])
        for tile, found in zip(tiles, best, strict=True):
            ids = pa.array(found.doc, pa.int64(), mask=found.none)
            yield pa.RecordBatch.from_arrays([pa.array(slots[tile.items[found.item]], pa.int64()), ids, pa.array(found.score, pa.int64())], schema=_FOUND)

    lists = counted.select("doc_id", "n", "places", "tfs").mapInArrow(run, "slot long, doc_id long, score long")
    lists = lists.withColumn("fan", F.floor(F.spark_partition_id() / FAN))
    return stage_table(_rank(lists, k, "slot", "fan").select("slot", "doc_id", "score"), "found")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, scores above 0 only."""
    spark = docs.sparkSession
    parted = grouped_items(items, group_terms)
    found = spark.createDataFrame([], "slot long, doc_id long, score long")
    last = parted.agg(F.max("part")).first()[0]
    for part in range(0 if last is None else last + 1):
        rows = parted.filter(F.col("part") == part).collect()  # bounded by group_terms and one item
        if rows:
            found = found.unionByName(_search_group(docs, rows, k))
    ranked = _rank(found, k, "slot").join(parted.select("slot", "item_id"), "slot")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
