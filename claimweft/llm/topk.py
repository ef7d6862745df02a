"""Exact top-k by inner product with bounds from segment statistics at several resolutions.

A vector is cut into segments; with the mean and the deviation of each, Cauchy-Schwarz bounds the
distance of two vectors from below and so their inner product from above (the norms are known).
Few long segments are tried first, more and shorter ones for the pairs that are left, and only
pairs that no bound rules out are multiplied out, in integers.

Queries and candidates meet in a grid of cells: a candidate belongs to one lane, a query goes to
every lane, and with many queries both are divided once more, so a cell holds a few thousand rows
of each whatever the table's size. Each cell keeps its k best of every query, and the best of
those are the result.

Rows with a null vec_id or vector, or with a null, NaN or infinite component, take no part. Equal
rows count once, unless ``every_row`` counts each and ranks all rows of a query's vec_id in one list. A query's own row is any with its vec_id. Vectors of other lengths are compared
as if filled up with zeros. Ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm.common import stage_table

K = 5
#: Segments of a vector, coarse to fine.
RESOLUTIONS = (4, 16)
CELL_ROWS = 4096
MIN_LANES = 64
_QUERIES_AT_ONCE = 128
_FOUND = "query_id long, query_key long, vec_id long, score long, copies long"


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    out[row, np.arange(len(row)) - np.repeat(starts, lengths)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations by segment, scaled so that rows' dot products bound inner products.

    For a segment of length L, sum(a*b) <= L*(mean_a*mean_b + dev_a*dev_b).
    """
    edges = np.unique(np.linspace(0, x.shape[1], segments + 1).astype(int))
    lengths = np.diff(edges)
    sums = np.add.reduceat(x, edges[:-1], axis=1)
    squares = np.add.reduceat(x * x, edges[:-1], axis=1)
    mean = sums / lengths
    dev = np.sqrt(np.maximum(squares / lengths - mean * mean, 0))
    return np.hstack([mean, dev]) * np.sqrt(np.tile(lengths, 2))


def _exact(a: np.ndarray, b: np.ndarray, fits: bool) -> np.ndarray:
    if fits:
        return np.einsum("ij,ij->i", a, b)
    whole = [sum(map(int.__mul__, x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, v)) for v in whole], np.int64)


def best_in_cell(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int = K, resolutions: Sequence[int] = RESOLUTIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, candidate index, score) of each query's k best candidates of the cell."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    fits = top < 2.0**62
    qf, cf = q.astype(float), c.astype(float)
    levels = [(segment_statistics(qf, s), segment_statistics(cf, s)) for s in resolutions]
    slack = 1e-9 * max(top, 1.0)
    parts = []
    for start in range(0, len(q), _QUERIES_AT_ONCE):
        ids = qid[start : start + _QUERIES_AT_ONCE]
        bound = levels[0][0][start : start + _QUERIES_AT_ONCE] @ levels[0][1].T
        bound[ids[:, None] == cid[None, :]] = -np.inf
        # exact scores of the k likeliest candidates set what the others have to reach
        need = np.full(len(ids), -np.inf)
        if len(c) > k:
            likely = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            rows = np.repeat(np.arange(len(ids)), k)
            seed = _exact(q[start + rows], c[likely.ravel()], fits).reshape(-1, k).astype(float)
            seed[np.take_along_axis(bound, likely, 1) == -np.inf] = -np.inf
            need = seed.min(axis=1)
        qi, ci = np.nonzero((bound >= need[:, None] - slack) & (bound > -np.inf))
        for of_query, of_row in levels[1:]:
            fine = np.einsum("ij,ij->i", of_query[start + qi], of_row[ci])
            alive = fine >= need[qi] - slack
            qi, ci = qi[alive], ci[alive]
        score = _exact(q[start + qi], c[ci], fits)
        order = np.lexsort((cid[ci], ~score, qi))
        qi, ci, score = qi[order], ci[order], score[order]
        first = np.searchsorted(qi, np.arange(len(ids)))
        keep = np.arange(len(qi)) - first[qi] < k
        parts.append((qi[keep] + start, ci[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, int),) * 3


def _cell(rows: pa.Table, k: int) -> pa.Table:
    asks = rows.column("asks").to_numpy().astype(bool)
    width = max(1, pa.compute.max(pa.compute.list_value_length(rows.column("vec"))).as_py() or 0)
    vec, vec_id, key = _matrix(rows.column("vec"), width), rows.column("vec_id").to_numpy(), rows.column("key").to_numpy()
    qid, qkey, cid, copies = vec_id[asks], key[asks], vec_id[~asks], rows.column("copies").to_numpy()
    qi, ci, score = best_in_cell(qid, vec[asks], cid, vec[~asks], k)
    return pa.table({"query_id": qid[qi], "query_key": qkey[qi], "vec_id": cid[ci], "score": score, "copies": copies[asks][qi] * copies[~asks][ci]})


def integer_vector(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(256.0)))


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return embedding.isNotNull() & ~bad


def top_k(rows: DataFrame, is_query: Column, k: int = K, every_row: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``rows`` (vec_id, embedding) that asks.

    Equal rows go through the cells once, with the number of their copies, of which a list has
    room for k.
    """
    vectors = (
        rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select(F.col("vec_id").cast("long").alias("vec_id"), integer_vector(F.col("embedding")).alias("vec"), is_query.alias("asks"))
        .groupBy("vec_id", "vec").agg(F.max("asks").alias("asks"), F.count("*").alias("n"))
        .select("vec_id", "vec", "asks", F.xxhash64("vec_id", "vec").alias("key"), (F.least("n", F.lit(k)) if every_row else F.lit(1)).cast("long").alias("copies"))
    )
    vectors = stage_table(vectors, "vectors")
    sizes = vectors.agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).first()
    lanes = max(MIN_LANES, -(-sizes.n // CELL_ROWS))
    groups = max(1, -(-sizes.asking // CELL_ROWS))
    lane = F.pmod("key", F.lit(lanes))
    group = F.pmod(F.xxhash64("key"), F.lit(groups))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    candidates = vectors.select(F.lit(False).alias("asks"), "vec_id", "key", "vec", "copies", lane.alias("lane"), every(groups).alias("group"))
    queries = vectors.filter("asks").select(F.lit(True).alias("asks"), "vec_id", "key", "vec", "copies", every(lanes).alias("lane"), group.alias("group"))

    def cell(rows: pa.Table) -> pa.Table:
        return _cell(rows, k)

    found = candidates.unionByName(queries).groupBy("lane", "group").applyInArrow(cell, _FOUND)
    if every_row:
        copies = F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))
        found = found.withColumn("copy", F.explode(copies))
    best = Window.partitionBy("query_id", *([] if every_row else ["query_key"])).orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
