"""Near-duplicate classes by BagMinHash signatures, banding and exact multiset overlap.

A document is the multiset of its runs of five words (lower case; letters, digits and whatever is
not ASCII make words; a text of fewer words is one run). Two documents are linked if the weighted
Jaccard similarity of their multisets, sum(min) / sum(max), is 0.8 or more; a class is what links
connect. Texts with equal words are one node from the start, so copies are never paired.

Candidates share one of the signature's 50 bands of 8 (two documents at 0.8 do with a probability of
0.9999, while documents that have a third of their words in common do with 0.007). Every document of
a bucket meets the bucket's leader, which collapses a group of near copies with one pair a document.

Documents of the buckets that are still divided among several classes are then searched without
loss by their rarest runs. Two documents of x and y runs are linked only if they share 4 / 9 (x + y) of
them; so, with all runs in one order, rarest first, they share one of the first x - 4 / 9 (x + y) + 1 runs
of the first document and of as many of the second. Sizes are dealt into narrow classes, and
documents meet under (class, class, run), classes 4 : 5 or more apart never. A passage common to many
documents is among these runs only where it alone nearly makes them copies, which the leaders have
collapsed. Under each such key the documents outside its largest class are compared with all others, in
cells of at most about CELL by CELL documents dealt out by a hash, which return only links. So no
bucket or key is gathered in one task, and pairs are never listed.

Null texts have no class but themselves. Texts without words are copies only of equal texts.
Repeated rows are copies. A class is named by its smallest doc_id. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm import grams
from claimweft.llm.common import fresh, pieces_of, stage_table
from claimweft.llm.minhash import band_keys, signatures

RUN = 5
#: Similarity as a fraction, compared in whole numbers.
SIMILAR = (4, 5)
#: Documents on either side of a cell.
CELL = 256
#: Side of documents that meet all others under a key of one size class.
BOTH = 2
#: Sizes up to this are told apart, larger ones to one part in as many.
FINE = 64
#: Characters, and runs, handled at a time.
_CHARS, _RUNS = 1 << 20, 1 << 16


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
            part = texts[a:b]
            words, word_at = grams.tokens(part)
            runs, run_at = grams.ngrams(words, word_at, RUN)
            sets = [np.unique(runs[s:e], return_counts=True) for s, e in zip(run_at[:-1], run_at[1:], strict=True)]
            owner = np.repeat(np.arange(b - a), [len(u) for u, _ in sets])
            keys = band_keys(signatures(b - a, owner, np.concatenate([u for u, _ in sets]), np.concatenate([c for _, c in sets])))
            prints, bands = [], []
            for i, text in enumerate(part):
                own = words[word_at[i] : word_at[i + 1]]
                if len(own):
                    prints.append(hashlib.md5(own.tobytes()).hexdigest())
                    bands.append(keys[i])
                else:
                    prints.append(None if text is None else f"raw {hashlib.md5(text.encode('utf-8', 'surrogatepass')).hexdigest()}")
                    bands.append(keys[i][:0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(prints, pa.string()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "row_id", "print", "bands"],
            )


def _multiset(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(grams.ngrams(*grams.tokens([text]), RUN)[0], return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of minima, sum of maxima) of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common, int(a[1].sum() + b[1].sum()) - common


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, multiset = None, None
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            if multiset is None or x.as_py() != last:
                last, multiset = x.as_py(), _multiset(x.as_py())
            low, high = overlap(multiset, _multiset(y.as_py()))
            ok.append(low * SIMILAR[1] >= high * SIMILAR[0] and high > 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "linked"])


def components(edges: DataFrame) -> DataFrame:
    """(node, part) for the nodes of ``edges`` (a, b): the smallest node connected to each.

    Every node hooks to its smallest neighbour, chains are shortened to their roots, edges are
    redrawn between roots, and again until none is left; each step is written to the shared folder.
    """
    whole = None
    while True:
        edges = stage_table(edges.filter("a <> b").distinct(), "edges")
        if edges.isEmpty():
            return whole if whole is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("part"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stage_table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("part")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("part"), F.col("part").alias("above"))
            longer = stage_table(hooks.join(up, "part").select("node", F.col("above").alias("part"), (F.col("above") != F.col("part")).alias("moved")), "hooks")
            hooks = longer.select("node", "part")
            if longer.filter("moved").isEmpty():
                break
        if whole is None:
            whole = hooks
        else:
            later = hooks.select(F.col("node").alias("part"), F.col("part").alias("root"))
            whole = stage_table(whole.join(later, "part", "left").select("node", F.coalesce("root", "part").alias("part")), "parts")
        edges = relabel(edges, hooks)


def relabel(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) between parts instead of nodes."""
    a = parts.select(F.col("node").alias("a"), F.col("part").alias("pa"))
    b = parts.select(F.col("node").alias("b"), F.col("part").alias("pb"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))


def _with_parts(rows: DataFrame, parts: DataFrame | None, *names: str) -> DataFrame:
    """``rows`` with the part of each named node column so far, as ``<name>_part``."""
    for name in names:
        part = f"{name}_part"
        if parts is None:
            rows = rows.withColumn(part, F.col(name))
        else:
            known = parts.select(F.col("node").alias(name), F.col("part").alias(part))
            rows = rows.join(known, name, "left").withColumn(part, F.coalesce(part, name))
    return rows


class _Linker:
    """Compares pairs of nodes and keeps the links, the pairs that failed, and the parts."""

    def __init__(self, texts: DataFrame) -> None:
        self.texts = texts
        self.failed: DataFrame | None = None
        self.parts: DataFrame | None = None

    def candidates(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different parts that have not failed, written out."""
        pairs = _with_parts(pairs, self.parts, "a", "b").filter("a_part <> b_part").drop("a_part", "b_part")
        if self.failed is not None:
            pairs = pairs.join(self.failed, ["a", "b"], "left_anti")
        return stage_table(pairs, "candidates")

    def compare(self, pairs: DataFrame) -> None:
        """Verify staged candidates by their texts and join the parts of those that are linked."""
        if pairs.isEmpty():
            return
        x = self.texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
        y = self.texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
        checked = stage_table(
            pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long, linked boolean"), "pairs"
        )
        failed = checked.filter("not linked").select("a", "b")
        self.failed = failed if self.failed is None else self.failed.unionByName(failed)
        self.join_parts(checked.filter("linked").select("a", "b"))

    def join_parts(self, links: DataFrame) -> None:
        """The parts of linked nodes (a, b) become one."""
        if links.isEmpty():
            return
        if self.parts is None:
            self.parts = components(links)
        else:
            later = components(relabel(links, self.parts)).select(F.col("node").alias("part"), F.col("part").alias("root"))
            known = self.parts.join(later, "part", "left").select("node", F.coalesce("root", "part").alias("part"))
            new = later.select(F.col("part").alias("node"), F.col("root").alias("part")).join(self.parts, "node", "left_anti")
            self.parts = stage_table(known.unionByName(new), "parts")


def _divided(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """``members`` (bucket, node, ...) of buckets with several parts, with node_part, minor, all and minors.

    ``minor`` says whether a node is outside its bucket's largest part, ``minors`` how many are, of ``all``.
    """
    rows = _with_parts(members, parts, "node")
    sizes = rows.groupBy("bucket", "node_part").agg(F.count("*").alias("n"))
    tops = sizes.groupBy("bucket").agg(F.max(F.struct("n", "node_part")).alias("top"), F.sum("n").alias("all"))
    tops = tops.filter(F.col("all") > F.col("top.n")).select("bucket", F.col("top.node_part").alias("main"), "all", (F.col("all") - F.col("top.n")).alias("minors"))
    return rows.join(tops, "bucket").withColumn("minor", F.col("node_part") != F.col("main")).drop("main")


def _meet_leaders(members: DataFrame, linker: _Linker) -> None:
    """Compare every member (bucket, node) with its buckets' leaders.

    A bucket's leader is its node with most companions over all its buckets: of a group of near copies
    that were each changed elsewhere, it is the one that the others are like.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    degrees = members.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = stage_table(members.join(degrees, "node"), "degrees")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("minus"))).alias("top"))
    leaders = leaders.select("bucket", (-F.col("top.minus")).alias("leader"))
    met = ranked.join(leaders, "bucket").filter("leader <> node").groupBy("leader", "node").agg(F.count("*").alias("shared"))
    met = stage_table(_with_parts(met, linker.parts, "leader", "node").filter("leader_part <> node_part").select("leader", "node", "shared"), "met")
    pair = [F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")]
    # at first each document meets only the leader it shares most buckets with
    best = Window.partitionBy("node").orderBy(F.desc("shared"), "leader")
    first = met.withColumn("nth", F.row_number().over(best)).filter("nth = 1")
    linker.compare(linker.candidates(first.select(*pair).distinct()))
    linker.compare(linker.candidates(met.select(*pair).distinct()))


def _elements(runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The multiset's elements: a repeated run is several, told apart by a number."""
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return grams.mix(np.repeat(runs, counts) ^ grams.mix(nth.astype(np.uint64)))


def _linked_in_cell(minors: list[dict], others: list[dict]) -> set[tuple[int, int]]:
    """(minor, part of another) wherever the two are similar enough, on the two sides of a key."""
    sets = [np.frombuffer(o["elements"], np.uint64) for o in others]
    size = np.array([len(s) for s in sets])
    everything = np.concatenate(sets)
    order = np.argsort(everything, kind="stable")
    everything, owner = everything[order], np.repeat(np.arange(len(sets)), size)[order]
    part, side = np.array([o["node_part"] for o in others]), np.array([o["side"] for o in others])
    found = set()
    for m in minors:
        own = np.frombuffer(m["elements"], np.uint64)
        first, last = np.searchsorted(everything, own, "left"), np.searchsorted(everything, own, "right")
        at = np.arange(int((last - first).sum())) + np.repeat(first - (np.cumsum(last - first) - (last - first)), last - first)
        common = np.bincount(owner[at], minlength=len(sets))
        near = common * SIMILAR[1] >= (size + len(own) - common) * SIMILAR[0]
        near &= (part != m["node_part"]) & ((side == BOTH) | (side != m["side"]))
        found.update((m["node"], p) for p in np.unique(part[near]).tolist())
    return found


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the cells (bucket, i, j) in a sorted stream of rows; minors come before the others."""

    def links(rows: list[dict]) -> pa.RecordBatch:
        minors = [r for r in rows if r["role"] == 0]
        found = sorted(_linked_in_cell(minors, rows[len(minors) :])) if 0 < len(minors) < len(rows) else []
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    cell, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["bucket"], row["i"], row["j"])
            if key != cell:
                yield links(rows)
                cell, rows = key, []
            rows.append(row)
    yield links(rows)


def _meet_all(keys: DataFrame, sets: DataFrame, linker: _Linker) -> None:
    """Settle all pairs of ``keys`` (bucket, node, side): of one part, or compared by ``sets`` (node, elements)."""
    open_keys = stage_table(_divided(keys, linker.parts), "open-keys")
    minor_cells, all_cells = (F.ceil(F.col(c) / CELL).cast("int") for c in ("minors", "all"))
    cell = F.xxhash64("node", F.lit("cell"))
    columns = ["bucket", "node", "node_part", "side"]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = open_keys.filter("minor").select(*columns, F.lit(0).alias("role"), F.pmod(cell, minor_cells).cast("int").alias("i"), every(all_cells).alias("j"))
    right = open_keys.select(*columns, F.lit(1).alias("role"), F.pmod(cell, all_cells).cast("int").alias("j"), every(minor_cells).alias("i"))
    rows = left.unionByName(right).join(sets, "node")
    dealt = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "role")
    linker.join_parts(stage_table(dealt.mapInArrow(_cells, "a long, b long"), "cell-links"))


def size_class(n: np.ndarray) -> np.ndarray:
    """Classes of sizes: each of its own up to FINE, then neighbours within a part in FINE."""
    n = np.asarray(n, np.int64)
    return np.where(n <= FINE, n, FINE + np.floor(np.log(np.maximum(n, FINE) / FINE) / np.log1p(1 / FINE) + 1e-9)).astype(np.int64)


def least_size(k: np.ndarray) -> np.ndarray:
    """A size that none of class ``k`` is below."""
    k = np.asarray(k, np.int64)
    return np.where(k <= FINE, k, np.floor(FINE * (1 + 1 / FINE) ** (k - FINE) - 1e-6)).astype(np.int64)


def rare_keys(elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sides): hashes of two size classes and an element, under which a multiset meets any that may be linked to it.

    ``elements`` stand in the common order. Under a key of two classes only documents of different sides meet.
    """
    low, high = SIMILAR
    total = len(elements)
    own = int(size_class(total))
    classes = np.arange(int(size_class(-(-total * low // high))), int(size_class(total * high // low)) + 1)
    common = -(-low * (total + least_size(classes)) // (low + high))
    prefix = np.clip(total - common + 1, 0, total)
    pair = np.minimum(classes, own).astype(np.uint64) << np.uint64(32) | np.maximum(classes, own).astype(np.uint64)
    keys = [grams.mix(elements[:p] ^ c) for p, c in zip(prefix.tolist(), grams.mix(pair), strict=True)]
    side = np.where(classes == own, BOTH, np.where(classes > own, 0, 1))
    return np.concatenate(keys).view(np.int64), np.repeat(side, prefix)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows), kind))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        for a, b in pieces_of(pa.compute.binary_length(texts).to_pylist(), _CHARS):
            sets = [_multiset(t) for t in texts[a:b].to_pylist()]
            columns = [_lists([x.view(np.int64) for x, _ in sets], pa.int64()), _lists([n for _, n in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *columns], ["node", "runs", "counts"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        at, cells = lists.offsets.to_numpy(), lists.values
        df, run, n = (cells.field(c).to_numpy(zero_copy_only=False) for c in ("df", "run", "n"))
        for a, b in pieces_of(np.diff(at).tolist(), _RUNS):
            elements, found = [], []
            for first, last in zip(at[a:b].tolist(), at[a + 1 : b + 1].tolist(), strict=True):
                order = first + np.lexsort((run[first:last], df[first:last]))
                own = _elements(run[order].view(np.uint64), n[order])
                elements.append(own.tobytes())
                found.append(rare_keys(own))
            columns = [pa.array(elements, pa.binary()), _lists([k for k, _ in found], pa.int64()), _lists([s for _, s in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *columns], ["node", "elements", "keys", "sides"])


def by_rare_runs(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, node, side): keys under which any two of ``texts`` (node, text) that may be linked meet; (node, elements)."""
    sets = stage_table(texts.mapInArrow(_runs, "node long, runs array<long>, counts array<long>"), "runs")
    each = sets.select("node", F.explode(F.arrays_zip("runs", "counts")).alias("x")).select("node", F.col("x.runs").alias("run"), F.col("x.counts").alias("n"))
    counted = each.join(each.groupBy("run").agg(F.count("*").alias("df")), "run")
    rows = counted.groupBy("node").agg(F.collect_list(F.struct("df", "run", "n")).alias("rows"))  # as long as the text
    keyed = stage_table(rows.mapInArrow(_keys, "node long, elements binary, keys array<long>, sides array<int>"), "rare-keys")
    keys = keyed.select("node", F.explode(F.arrays_zip("keys", "sides")).alias("x")).select(F.col("x.keys").alias("bucket"), "node", F.col("x.sides").alias("side"))
    met = keys.groupBy("bucket").agg(F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
    met = met.filter(F.col("n") > 1).filter((F.col("low") < F.col("high")) | (F.col("low") == BOTH)).select("bucket")
    return stage_table(keys.join(met, "bucket"), "met-keys"), keyed.select("node", "elements")


def _link(members: DataFrame, linker: _Linker) -> None:
    """Settle all pairs of ``members`` (bucket, node) that can be linked."""
    _meet_leaders(members, linker)
    open_nodes = stage_table(_divided(members, linker.parts).select("node").distinct(), "open")
    if open_nodes.isEmpty():
        return
    keys, sets = by_rare_runs(linker.texts.join(open_nodes, "node", "left_semi"))
    _meet_all(keys, sets, linker)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, row_id, class_id, keeper) for every row.

    ``row_id`` is a hash of number and text; ``keeper`` says whether the row (or one of its
    repetitions) is the one of its class that deduplication keeps.
    """
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_id"), "text")
    signed = stage_table(rows.mapInArrow(_sign, "doc_id long, row_id long, print string, bands array<long>"), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first")
    nodes = stage_table(
        signed.filter("print is not null").groupBy("print").agg(first, F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = stage_table(banded.join(shared, "bucket", "left_semi"), "members")
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "first.doc_id", "first.row_id")
    same = rows["row_id"].eqNullSafe(wanted["row_id"]) & rows["doc_id"].eqNullSafe(wanted["doc_id"])
    texts = stage_table(rows.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "texts")
    linker = _Linker(texts)
    _link(members, linker)
    whole = nodes.select("print", "node", "first")
    whole = whole.withColumn("part", F.col("node")) if linker.parts is None else whole.join(linker.parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    heads = whole.groupBy("part").agg(F.min("first").alias("head"))
    classes = stage_table(whole.join(heads, "part").select("print", "head"), "classes")
    known = signed.select("doc_id", "row_id", "print").join(classes, "print", "left")
    alone = F.col("print").isNull()
    keeper = alone | (F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.row_id") == F.col("row_id")))
    return known.select(
        "doc_id", "row_id", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"), keeper.alias("keeper")
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest doc_id; columns unchanged.

    Rows with null texts all stay. Only rows that are repeated are numbered, so the other texts are not shuffled for it.
    """
    row_id, nth, doc, row = fresh(docs, "row_id", "nth", "doc", "row")
    kept = near_duplicates(docs).filter("keeper").groupBy(F.col("doc_id").alias(doc), F.col("row_id").alias(row)).agg(F.count("*").alias("n"))
    kept = stage_table(kept, "kept")
    repeated = stage_table(kept.filter("n > 1").select(doc, row), "kept-repeated")  # its own size decides how it is joined
    keyed = docs.withColumn(row_id, F.xxhash64("doc_id", "text"))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(row_id) == F.col(row))
    single = keyed.join(kept.filter("n = 1"), same, "left_semi").drop(row_id)
    once = Window.partitionBy("doc_id", row_id).orderBy(F.lit(0))
    copies = keyed.join(repeated, same, "left_semi").withColumn(nth, F.row_number().over(once))
    return single.unionByName(copies.filter((F.col(nth) == 1) | F.col("text").isNull()).drop(row_id, nth))
