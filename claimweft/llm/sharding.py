"""Sharding by histogram sort: shards of nearly equal bytes, all in DataFrame functions.

Rows are ordered by the pair (hash of the text, hash of number and text). Candidate boundaries
are the edges of evenly spaced cells of that order: the exact bytes below each are counted in
all partitions, the cell that holds a wanted boundary is divided again, and this goes on until
every boundary is within the tolerance or can't be divided. Only then do the rows move, once.

Equal texts are neighbours in the order. A boundary falls inside a group of equal texts only if
none outside it is near enough, as for a group larger than the tolerance. A null text has the
size of an empty one and counts as equal to other nulls. Rows equal in number and text stay in
one shard. An empty table gives an empty result. Extra columns pass through; the new ones take
free names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm.common import fresh, stage_table

SHARDS = 40
#: Allowed distance of a boundary, as a share of a shard's bytes.
TOLERANCE = 0.002
#: Bytes of a row besides its text.
OVERHEAD = 16
LOWEST = -(1 << 63)
_STEPS = [("h1", 48), ("h1", 32), ("h1", 16), ("h1", 0), ("h2", 48), ("h2", 32), ("h2", 16), ("h2", 0)]

Key = tuple[int, int]


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def order_hashes(doc_id: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(doc_id, text)


def _edges(step: int, node: tuple[int | None, int]) -> tuple[Key, Key | None]:
    """First keys of a cell and of what follows it (null at the very end)."""
    h1, p = node
    shift = _STEPS[step][1]
    low, high = p << shift, (p + 1) << shift
    end = 1 << 63
    if h1 is None:
        return (low, LOWEST), None if high == end else (high, LOWEST)
    if high < end:
        return (h1, low), (h1, high)
    return (h1, low), None if h1 + 1 == end else (h1 + 1, LOWEST)


def _inside(step: int, nodes: set[tuple[int | None, int]]) -> Column:
    """Rows of the given cells of a step (at most one for each boundary)."""
    name, shift = _STEPS[step]
    if name == "h1":
        return F.shiftright("h1", shift).isin([p for _, p in nodes])
    return reduce(lambda a, b: a | b, [(F.col("h1") == h1) & (F.shiftright("h2", shift) == p) for h1, p in nodes])


def find_splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Key]:
    """Boundaries of ``keys`` (h1, h2, size): rows from a boundary on belong to the next shards.

    The driver gets cell counts only, at most 65,536 for the first step and for each boundary
    that is still open.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    found: dict[int, Key] = {}
    # boundary -> (cell that holds it, bytes before that cell)
    pending: dict[int, tuple[tuple[int | None, int] | None, int]] = {i: (None, 0) for i in range(1, shards) if total}
    for step, (name, shift) in enumerate(_STEPS):
        if not pending:
            break
        parents = {node for node, _ in pending.values()}
        rows = keys if None in parents else keys.filter(_inside(step - 1, parents))
        # cells of the second hash belong to one value of the first
        first = F.col("h1") if name == "h2" else F.lit(None).cast("long")
        cells = rows.groupBy(first.alias("a"), F.shiftright(name, shift).alias("p")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"),
            (F.min("h1") == F.max("h1")).alias("one_text"),
            ((F.min("h1") == F.max("h1")) & (F.min("h2") == F.max("h2"))).alias("one_key"),
        )
        children: dict[tuple[int | None, int] | None, list] = {}
        for cell in sorted(cells.collect(), key=lambda c: (c.a or 0, c.p)):
            if step == 0:
                parent = None
            elif name == "h1":
                parent = (None, cell.p >> 16)
            elif _STEPS[step - 1][0] == "h1":
                parent = (None, cell.a)
            else:
                parent = (cell.a, cell.p >> 16)
            children.setdefault(parent, []).append(cell)
        still: dict[int, tuple[tuple[int | None, int] | None, int]] = {}
        for i, (node, below) in pending.items():
            target = i * total / shards
            for cell in children[node]:
                if below + cell.size >= target:
                    break
                below += cell.size
            low, high = _edges(step, (cell.a, cell.p))
            before, after = target - below, below + cell.size - target
            done = min(before, after) <= allowed or cell.one_key or step == len(_STEPS) - 1
            if done:
                edge = low if before <= after else high
                if edge is not None:
                    found[i] = edge
            else:
                still[i] = ((cell.a, cell.p), below)
        pending = still
    return [found[i] for i in sorted(found)]


def shard_of(h1: Column, h2: Column, splitters: list[Key]) -> Column:
    """Number of boundaries at or before the key."""
    passed = [((h1 > a) | ((h1 == a) & (h2 >= b))).cast("int") for a, b in splitters]
    return reduce(lambda x, y: x + y, passed, F.lit(0))


def histogram_sort(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with shard and slot (0, 1, ... within the shard), moved once.

    A shard is numbered in 4,096 parts by the second hash, in parallel: a row's slot is the
    count of rows in earlier parts plus its place in its own. The narrow keys are staged, so
    texts are read twice, for the keys and for the exchange, however many steps it takes.
    """
    h1n, h2n, part, place, before, shard, slot, shard_key, part_key = fresh(
        docs, "h1", "h2", "part", "place", "before", "shard", "slot", "shard_key", "part_key"
    )
    h1, h2 = order_hashes(F.col("doc_id"), F.col("text"))
    keys = stage_table(docs.select(h1.alias("h1"), h2.alias("h2"), text_size(F.col("text")).alias("size")), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    in_part = F.shiftright("h2", 52)
    counts = keys.groupBy(shard_of(F.col("h1"), F.col("h2"), splitters).alias(shard_key), in_part.alias(part_key)).count()
    earlier = Window.partitionBy(shard_key).orderBy(part_key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage_table(
        counts.select(shard_key, part_key, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(before)), "shard-offsets"
    )
    keyed = docs.withColumns({h1n: h1, h2n: h2})
    placed = keyed.withColumns({
        shard: shard_of(F.col(h1n), F.col(h2n), splitters), part: F.shiftright(h2n, 52),
    }).withColumn(place, F.row_number().over(Window.partitionBy(shard, part).orderBy(h2n, h1n, "doc_id")))
    joined = placed.join(offsets, (F.col(shard) == F.col(shard_key)) & (F.col(part) == F.col(part_key)))
    return joined.select(
        *[f"`{c}`" for c in docs.columns],
        shard,
        (F.col(before) + F.col(place) - 1).alias(slot),
    )
