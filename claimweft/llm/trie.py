"""Prefix trie of conversations with totals of every subtree, rolled up in bands of depth.

A conversation is its turns in order; every distinct sequence of first d turns (role and text) is a
node of depth d, from the textless root. Conversations that start with it are its members. A node is
named by its smallest member and its depth, and known inside by two 60-bit halves of digests, folded
over the turns.

Turns are numbered and folded in ranges of (conversation, turn), so that one conversation may hold
any share of the rows: each range works on its own part and then adds what the ranges before hold of
the conversation that it goes on with (one row a range).

Subtree totals: a node hands its own values to its ancestors inside its band of ``BAND`` depths, so
a node explodes to ``BAND`` rows at most. The tops of the bands form a smaller tree of their own,
with their band's totals as values, which is rolled up in the same way; then each completed top hands
its total to the last band of its path above. A trie of depth D takes log(D) / log(BAND) levels.

Turns are ordered by turn (null first); equal turns by role, then text. Null roles and texts are
empty. Rows without a conv_id take no part. Equal rows are separate turns. An empty table has no
nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm.common import stage_table

#: Depths of a band.
BAND = 16
#: A conversation takes its first turns from the one that its number rounds down to.
FAMILY, HEADS = 20, 4
#: Numbers of a list that are digested as one row.
_CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "k1", "k2"]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running count and running xor of k1, k2 within each conv_id of a sorted range."""
    last, seen, folded = None, 0, [np.int64(0), np.int64(0)]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        goes_on = last is not None and conv[0] == last
        lengths = np.diff(np.append(starts, n))
        place = np.arange(1, n + 1) - np.repeat(starts, lengths)
        place[: lengths[0]] += seen * goes_on
        out = {"place": pa.array(place, pa.int64())}
        for i, name in enumerate(("k1", "k2")):
            own = batch.column(name).to_numpy(zero_copy_only=False)
            running = np.bitwise_xor.accumulate(own)
            before = np.where(starts > 0, running[starts - 1], 0)
            running ^= np.repeat(before, lengths)
            if goes_on:
                running[: lengths[0]] ^= folded[i]
            folded[i] = running[-1]
            out[name] = pa.array(running, pa.int64())
        last, seen = conv[-1], place[-1]
        names = batch.schema.names
        columns = [out.get(c, batch.column(c)) for c in names if c != "place"]
        yield pa.RecordBatch.from_arrays([*columns, out["place"]], [c for c in names if c != "place"] + ["place"])


def _running(rows: DataFrame, order: Sequence[Column | str], keep: Sequence[Column | str]) -> DataFrame:
    """``keep`` (conv_id, k1, k2 among it) with place in the conversation and k1, k2 folded up to it."""
    ranged = rows.repartitionByRange("conv_id", *order[:-1]).sortWithinPartitions("conv_id", *order).select(*keep)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema) + ", place long"
    local = ranged.mapInArrow(_fold, schema).withColumn("range", F.spark_partition_id())
    local = stage_table(local, "turns")
    held = local.groupBy("conv_id", "range").agg(F.max("place").alias("n"), F.max_by(F.struct("k1", "k2"), "place").alias("end"))
    ranges = Window.partitionBy("conv_id")
    before = ranges.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # at most one conversation of a range goes on from another one, so there is one row a range
    carried = (
        held.groupBy("conv_id").agg(F.count("*").alias("ranges")).filter("ranges > 1").select("conv_id").join(held, "conv_id")
        .select("conv_id", "range", F.sum("n").over(before).alias("n0"), F.bit_xor("end.k1").over(before).alias("x1"), F.bit_xor("end.k2").over(before).alias("x2"))
        .filter("n0 is not null")
    )
    zero = F.lit(0).cast("long")
    whole = local.join(F.broadcast(carried), ["conv_id", "range"], "left")
    return whole.select(
        *[c for c in local.columns if c not in ("k1", "k2", "place", "range")],
        F.col("k1").bitwiseXOR(F.coalesce("x1", zero)).alias("k1"), F.col("k2").bitwiseXOR(F.coalesce("x2", zero)).alias("k2"),
        (F.col("place") + F.coalesce("n0", zero)).alias("place"),
    )


def _halves(*parts: Column) -> list[Column]:
    """Two 60-bit numbers from the digest of texts, each with its length before it."""
    text = F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])
    digest = F.md5(text.cast("binary"))
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "k1"), (16, "k2"))]


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, t1, t2, words): every turn with its place (from 1) and its digest's halves."""
    empty = F.lit("")
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    # a range's limits hold no long texts; rows that agree so far stay together and are sorted whole
    rows = rows.withColumn("role_start", F.substring("role", 1, 64)).withColumn("text_start", F.substring("text", 1, 64))
    words = F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")
    keep = ["conv_id", *[c.alias(n) for c, n in zip(_halves(F.col("role"), F.col("text")), ("t1", "t2"), strict=True)], words]
    order = [F.col("turn").asc_nulls_first(), "role_start", "text_start", F.struct("role", "text")]
    zero = F.lit(0).cast("long")
    return _running(rows, order, [*keep, zero.alias("k1"), zero.alias("k2")]).select("conv_id", "place", "t1", "t2", "words")


def share_heads(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Each conversation c begins with the first h turns of c - c % family, then goes on with its own after its h-th.

    h = crc32(decimal c) % heads. Conversations that have no turns left are one row with place 0.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    names = ["conv_id", "place", "t1", "t2", "words"]
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", head)
    ids = ids.withColumn("source", F.col("conv_id") - F.col("conv_id") % family)
    sizes = ids.select(F.col("conv_id").alias("source"), F.col("own").alias("has"))
    ids = ids.join(sizes, "source", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
    ids = stage_table(ids.select("conv_id", "source", "own", "h", "taken"), "conversations")
    first = turns.filter((F.col("place") < heads) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "source")
    borrowed = ids.select("conv_id", "source", "h").join(first, "source").filter("place <= h").select(*names)
    own = turns.filter(F.col("place") > head)
    short = ids.filter("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"))
    own = own.join(short, "conv_id", "left").withColumn("place", F.col("place") - F.coalesce("less", F.lit(0))).select(*names)
    zero = F.lit(0).cast("long")
    bare = ids.filter((F.col("taken") == 0) & (F.col("own") <= F.col("h"))).select("conv_id", *[zero.alias(c) for c in names[1:]])
    return stage_table(own.unionByName(borrowed).unionByName(bare), "rebuilt")


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, words): the nodes along every conversation, its root's child first.

    p1, p2 are the parent's halves; the root's are 0. The root itself is not among the rows.
    """
    own = turns.filter("place > 0").select("conv_id", F.col("place").alias("depth"), "words", *_halves(*[F.col(c).cast("string") for c in ("place", "t1", "t2")]))
    folded = _running(own.withColumn("last", F.lit(0)), ["depth", "last"], ["conv_id", "depth", "words", F.col("k1").alias("o1"), F.col("k2").alias("o2"), "k1", "k2"])
    parent = [F.col(f"k{i}").bitwiseXOR(F.col(f"o{i}")).alias(f"p{i}") for i in (1, 2)]
    return folded.select("conv_id", "depth", "k1", "k2", *parent, "words")


def _level(steps: DataFrame, nodes: DataFrame, deepest: int, unit: int, values: Sequence[str]) -> DataFrame:
    """``nodes`` (conv_id, key, values) with the values summed over subtrees; depths are multiples of ``unit``.

    ``steps`` (conv_id, key) are the nodes of these depths along every conversation.
    """
    height = unit * BAND
    band = F.floor(F.col("depth") / height)
    sums = [F.sum(v).alias(v) for v in values]
    banded = steps.withColumn("band", band)
    upwards = Window.partitionBy("conv_id", "band").orderBy("depth")
    chains = banded.select("conv_id", "depth", F.collect_list(F.struct(*_KEY)).over(upwards).alias("chain"))
    given = nodes.join(chains, ["conv_id", "depth"]).select(F.explode("chain").alias("at"), *values)
    inside = stage_table(given.select("at.*", *values).groupBy(*_KEY).agg(*sums), "band-totals")
    if deepest < height:
        return inside
    tops = nodes.filter(F.col("depth") % height == 0).select("conv_id", *_KEY).join(inside, _KEY)
    whole = _level(steps.filter(F.col("depth") % height == 0), stage_table(tops, "band-tops"), deepest, height, values)
    ends = whole.filter("depth > 0").join(tops.select("conv_id", *_KEY), _KEY).select("conv_id", (band - 1).alias("band"), *values)
    above = ends.join(banded, ["conv_id", "band"]).select(*_KEY, *values)
    return stage_table(inside.unionByName(above).groupBy(*_KEY).agg(*sums), "totals")


def subtree_totals(steps: DataFrame, nodes: DataFrame, deepest: int, values: Sequence[str]) -> DataFrame:
    """(depth, k1, k2, values): each value of ``nodes`` (conv_id, depth, k1, k2, values) summed over its subtree.

    A node's conv_id is one of the conversations whose ``steps`` (conv_id, depth, k1, k2; from depth 0)
    lead to it.
    """
    return _level(steps.select("conv_id", *_KEY), nodes, deepest, 1, values)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted numbers of a key as texts of many numbers, comma-joined."""
    for batch in batches:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in _KEY]
        ids = batch.column("conv_id").to_pylist()
        change = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), len(ids)] if ids else [0]
        pieces = [(a, min(a + _CHUNK, e)) for s, e in zip(starts, starts[1:]) for a in range(s, e, _CHUNK)]
        at = np.array([a for a, _ in pieces], np.int64)
        columns = [pa.array(k[at], pa.int64()) for k in keys]
        columns += [pa.array([ids[a] for a, _ in pieces], pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in pieces], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*_KEY, "first", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from its texts in order; only the running digest is held."""
    names = [*_KEY, "digest"]
    at, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for *key, text in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "text")], strict=True):
            if key != at:
                if state is not None:
                    done.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], _DIGEST)
    if state is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*at, state.hexdigest()), strict=True))], _DIGEST)


_DIGEST = pa.schema([*[(c, pa.int64()) for c in _KEY], ("digest", pa.string())])


def digest_of_lists(rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, digest): SHA-256 of each key's conv_ids, ascending and comma-joined.

    Lists are cut into texts of numbers in ranges of (key, number); only these texts meet by key.
    """
    ranged = rows.select(*_KEY, "conv_id").repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    texts = ranged.mapInArrow(_chunks, "depth long, k1 long, k2 long, first long, text string")
    sorted_texts = texts.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return sorted_texts.mapInArrow(_digests, "depth long, k1 long, k2 long, digest string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, k1, k2.

    saved_tokens sums, over the node's subtree, (n_convs - 1) times the words of each node's last text;
    ends_sha256 digests the members that end at the node.
    """
    return trie_of(share_heads(turns_in_order(conversations)))


def trie_of(turns: DataFrame) -> DataFrame:
    """``prefix_trie`` of turns (conv_id, place, t1, t2, words), place 0 for conversations without turns."""
    below = paths(turns)
    zero = F.lit(0).cast("long")
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("length"))
    roots = lengths.select("conv_id", *[zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "words")])
    steps = stage_table(below.unionByName(roots), "steps")
    deepest = steps.agg(F.max("depth")).first()[0]
    merged = steps.groupBy(*_KEY, "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"))
    parents = merged.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    nodes = merged.join(parents.agg(F.count("*").alias("n_children")), _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = stage_table(nodes, "nodes")
    own = nodes.select(
        "conv_id", *_KEY, (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    )
    totals = subtree_totals(steps, own, deepest or 0, ["n_leaves", "saved_tokens"])
    ended = lengths.withColumnRenamed("length", "depth").join(steps, ["conv_id", "depth"])
    ends = digest_of_lists(ended)
    named = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(named, ["depth", "p1", "p2"], "left").join(totals, _KEY).join(ends, _KEY, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("digest", nobody).alias("ends_sha256"), "k1", "k2"
    )
