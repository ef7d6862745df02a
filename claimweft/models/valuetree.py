"""Entropy decision tree grown by counting: rows and hits per (node, feature, value), level by level.

Spark ML keeps a bin of every value of the widest column in each task and sends them as dense arrays. Here
each level is one grouping of the rows, so only values that a node has are counted, and columns may have any
number of values. Every value is a place to split: a numeric feature's in their order, a nominal one's in the
order of their share of hits, which holds the best set for two classes. Numeric values are counted by bin first;
single values are only looked at in bins that may hold a better split than the best one found, so not all of
them go through a shuffle. Running counts go over ranges of places and inside a range or bin, so no task orders a
column. The driver sees one row a node; the values that
a nominal split sends left stay a table, which is saved with the model and joined where a column has many.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from claimweft.session import drop_staged, in_passes, stage_table

#: Most values of a nominal feature whose left sets are listed in the projection instead of joined.
SMALL = 1024
#: Bins of a numeric feature, and rows whose single values are looked at in one go, if not half of all.
BINS, LOOK_ROWS = 1024, 1_000_000
#: Gains up to this are rounding.
_LEAST = 1e-12


class ValueTreeModel(Model, HasInputCols, MLReadable, MLWritable):
    """Adds leaf (numbered from left to right) and probability (of either class)."""

    nodes = Param(Params._dummy(), "nodes", "nodes by number as JSON; the children of i are 2i and 2i + 1", typeConverter=TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "number of values of each nominal feature, 0 for numeric ones", typeConverter=TypeConverters.toListInt)
    maxBins = Param(Params._dummy(), "maxBins", "values of the widest nominal feature, unknown ones included", typeConverter=TypeConverters.toInt)

    def __init__(self, left: DataFrame | None = None) -> None:
        super().__init__()
        #: (node, value) that nominal splits send left
        self.left = left

    def getMaxBins(self) -> int:  # noqa: N802
        return self.getOrDefault(self.maxBins)

    def tree(self) -> dict[int, dict]:
        return {int(k): v for k, v in json.loads(self.getOrDefault(self.nodes)).items()}

    @property
    def numNodes(self) -> int:  # noqa: N802
        return len(self.tree())

    @property
    def depth(self) -> int:
        return max(self.tree()).bit_length() - 1

    def importances(self) -> dict[str, float]:
        """Share of each feature in the gains of all splits, weighed by rows; features in use only."""
        names, out = self.getInputCols(), {}
        for v in self.tree().values():
            if "feature" in v:
                out[names[v["feature"]]] = out.get(names[v["feature"]], 0.0) + v["gain"] * v["n"]
        total = sum(out.values())
        return {k: v / total for k, v in out.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tree = self.tree()
        leaves = _leaves(tree, 1)
        shares = {k: tree[k]["hits"] / tree[k]["n"] if tree[k]["n"] else 0.0 for k in leaves}
        routed = route(dataset, tree, self.left, self.getInputCols(), self.getOrDefault(self.sizes))
        at = F.create_map(*[F.lit(x) for i, k in enumerate(leaves) for x in (k, float(i))])
        hit = F.create_map(*[F.lit(x) for k in leaves for x in (k, shares[k])])
        p = F.element_at(hit, F.col("_node"))
        return routed.withColumns({"leaf": F.element_at(at, F.col("_node")), "probability": F.array(1 - p, p)}).drop("_node")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ValueTreeModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.left.write.parquet(f"{path}/left")


class _Reader(MLReader):
    def load(self, path: str) -> ValueTreeModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ValueTreeModel(spark.read.parquet(f"{path}/left"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _leaves(tree: dict[int, dict], node: int) -> list[int]:
    if "feature" not in tree[node]:
        return [node]
    return _leaves(tree, 2 * node) + _leaves(tree, 2 * node + 1)


def route(rows: DataFrame, tree: dict[int, dict], left: DataFrame | None, inputs: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """``rows`` with the number of the node that each one ends in, as ``_node``."""
    nominal = {k: v["feature"] for k, v in tree.items() if "feature" in v and sizes[v["feature"]]}
    few = [k for k, f in nominal.items() if sizes[f] <= SMALL]
    listed: dict[int, list[float]] = {k: [] for k in few}
    for r in left.filter(F.col("node").isin(few)).collect() if few else []:
        listed[r.node].append(r.value)
    for f in sorted({f for k, f in nominal.items() if k not in listed}):
        own = [k for k, g in nominal.items() if g == f]
        sets = left.filter(F.col("node").isin(own)).groupBy(F.col("value").alias("_value")).agg(F.collect_set("node").alias(f"_left_{f}"))
        rows = rows.join(sets, F.col(inputs[f]) == F.col("_value"), "left").drop("_value")

    def below(node: int) -> Column:
        split = tree[node]
        if "feature" not in split:
            return F.lit(node)
        f = split["feature"]
        if not sizes[f]:
            goes = F.col(inputs[f]) <= F.lit(split["threshold"])
        elif node in listed:
            goes = F.col(inputs[f]).isin(listed[node])
        else:
            goes = F.coalesce(F.array_contains(f"_left_{f}", F.lit(node)), F.lit(False))
        return F.when(goes, below(2 * node)).otherwise(below(2 * node + 1))

    return rows.withColumn("_node", below(1)).drop(*[f"_left_{f}" for f in range(len(inputs))])


def _entropy(n: Column, hits: Column) -> Column:
    """Entropy in bits times the rows."""
    part = lambda x: F.when(x > 0, -x * F.log2(x / n)).otherwise(0.0)
    return part(hits) + part(n - hits)


def _gain(n: Column, hits: Column, ln: Column, lh: Column) -> Column:
    return (_entropy(n, hits) - _entropy(ln, lh) - _entropy(n - ln, hits - lh)) / n


def _best(splits: DataFrame) -> DataFrame:
    """The best split of each node: the first feature and the fewest rows to the left on ties."""
    known = splits.filter(F.col("ln") < F.col("all_n")).withColumn("gain", _gain(*[F.col(c) for c in ("all_n", "all_hits", "ln", "lh")]))
    split = F.struct("feature", "place", "high", "ln", "lh", "gain")
    return known.groupBy("node").agg(F.max_by(split, F.struct("gain", -F.col("feature"), -F.col("ln"))).alias("s")).select("node", "s.*")


def _steps(counts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Rows and hits up to each place of a feature in a node, staged: bins of a numeric feature, shares of hits of a nominal one.

    Gain is convex along values of the same share, so the best split is not inside them.
    """
    nominal = [i for i, n in enumerate(sizes) if n]
    place = F.when(F.col("feature").isin(nominal), F.col("hits") / F.col("n")).otherwise(F.col("key")) if nominal else F.col("key")
    groups = ["node", "feature"]
    places = counts.groupBy(*groups, place.alias("place")).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"))
    ranged = stage_table(places.repartitionByRange(*groups, "place").withColumn("_range", F.spark_partition_id()), "tree-places", tidy=True)
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*groups, "_range").agg(F.sum("n").alias("sn"), F.sum("hits").alias("sh"))
    upto = [F.coalesce(F.sum(s).over(before), F.lit(0)).alias(o) for s, o in (("sn", "on"), ("sh", "oh"))]
    whole = Window.partitionBy(*groups)
    offsets = sums.select(*groups, "_range", *upto, F.sum("sn").over(whole).alias("all_n"), F.sum("sh").over(whole).alias("all_hits"))
    inside = Window.partitionBy(*groups, "_range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.select("*", F.sum("n").over(inside).alias("cn"), F.sum("hits").over(inside).alias("ch")).join(offsets, [*groups, "_range"])
    ends = [(F.col("cn") + F.col("on")).alias("ln"), (F.col("ch") + F.col("oh")).alias("lh")]
    out = stage_table(running.select(*groups, "place", "n", "hits", "low", "high", "all_n", "all_hits", *ends), "tree-steps", tidy=True)
    drop_staged(ranged)
    return out


def _open_bins(steps: DataFrame, numeric: Sequence[int], best: dict[int, Row], limit: int) -> DataFrame:
    """Bins of several values that may hold a better split than the best so far, dealt to chunks of about ``limit`` rows.

    Up to any value of a bin, its rows and hits lie between none and all; gain is convex, so it is at most the one at
    a corner: hits first, the others first, none or all.
    """
    n, hits, all_n, all_hits = (F.col(c) for c in ("n", "hits", "all_n", "all_hits"))
    ln, lh = F.col("ln") - n, F.col("lh") - hits
    corners = [(ln, lh), (F.col("ln"), F.col("lh")), (ln + hits, lh + hits), (ln + n - hits, lh)]
    bound = F.greatest(*[_gain(all_n, all_hits, x, y) for x, y in corners])
    wide = steps.filter(F.col("feature").isin(*numeric) & (F.col("low") < F.col("high")))
    wide = wide.select("node", "feature", F.col("place").alias("key"), "n", "all_n", "all_hits", ln.alias("ln0"), lh.alias("lh0"), bound.alias("bound"))
    order = Window.orderBy(F.col("bound").desc(), "node", "feature", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most BINS rows a node and feature
    dealt = wide.filter(_may_gain(best)).withColumn("chunk", F.floor((F.sum("n").over(order) - F.col("n")) / limit))
    return stage_table(dealt, "tree-open", tidy=True)


def _may_gain(best: dict[int, Row]) -> Column:
    known = F.create_map(*[F.lit(x) for k, b in best.items() for x in (k, float(b.gain))]) if best else F.create_map().cast("map<int,double>")
    return F.col("bound") > F.greatest(F.coalesce(F.try_element_at(known, F.col("node")), F.lit(0.0)) - _LEAST, F.lit(_LEAST))


def _counted(parts: Sequence[DataFrame], cells: Column, keys: Sequence[str], ends: Sequence[tuple[str, str]] = (), bins: DataFrame | None = None) -> DataFrame:
    """Rows and hits by ``keys`` of the routed rows' cells, staged: one part of the rows after the other, then in all.

    ``ends`` are (name, function) of the cells' values; with ``bins`` only cells of those count.
    """

    def counts(rows: DataFrame, n: Column, hits: Column, at: str = "{}") -> DataFrame:
        more = [F.expr(f"{function}({at.format(name)})").alias(name) for name, function in ends]
        return rows.groupBy(*keys).agg(n.alias("n"), hits.alias("hits"), *more)

    staged = []
    for part in parts:
        long = part.select(F.col("_node").alias("node"), "hit", F.explode(cells).alias("c")).select("node", "hit", "c.*")
        long = long if bins is None else long.join(F.broadcast(bins), ["node", "feature", "key"])
        staged.append(stage_table(counts(long, F.count("*"), F.sum("hit"), "value"), "tree-values", tidy=True))
    if len(staged) == 1:
        return staged[0]
    out = stage_table(counts(reduce(DataFrame.unionAll, staged), F.sum("n"), F.sum("hits")), "tree-values", tidy=True)
    for part in staged:
        drop_staged(part)
    return out


def _within(counts: DataFrame) -> DataFrame:
    """Rows and hits up to each value of its bin; a task orders a bin at a time."""
    inside = Window.partitionBy("node", "feature", "key").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ends = [(F.col("ln0") + F.sum("n").over(inside)).alias("ln"), (F.col("lh0") + F.sum("hits").over(inside)).alias("lh")]
    return counts.select("node", "feature", F.col("key").alias("place"), F.col("value").alias("high"), "all_n", "all_hits", *ends)


def _collected(splits: DataFrame) -> list[Row]:
    """One row a node; the shuffle files behind it go at once."""
    staged = stage_table(splits, "tree-best", tidy=True)
    rows = staged.collect()
    drop_staged(staged)
    return rows


def _better(best: dict[int, Row], found: Sequence[Row]) -> dict[int, Row]:
    out = dict(best)
    for b in found:
        if b.node not in out or (b.gain, -b.feature, -b.ln) > (out[b.node].gain, -out[b.node].feature, -out[b.node].ln):
            out[b.node] = b
    return out


def _in_bins(rows: DataFrame, inputs: Sequence[str], numeric: Sequence[int]) -> DataFrame:
    """``rows`` with the bin of each numeric feature. Bins are cut at approximate quantiles: they only tell where to look closer."""
    if not numeric:
        return rows
    probs = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(F.col(inputs[i]), probs, 10 * BINS).alias(f"q{i}") for i in numeric]).first()
    edges = {i: sorted({e for e in found[f"q{i}"] or [] if math.isfinite(e)}) or [0.0] for i in numeric}
    splits = [[-math.inf, *edges[i], math.inf] for i in numeric]
    return Bucketizer(splitsArray=splits, inputCols=[inputs[i] for i in numeric], outputCols=[f"_bin_{i}" for i in numeric]).transform(rows)


def grow(rows: DataFrame, inputs: Sequence[str], sizes: Sequence[int], label: str, depth: int) -> ValueTreeModel:
    """A tree over double columns without NULL; ``sizes`` tells each nominal feature's values, 0 for numeric ones.

    A node is split while some split gains. ``rows`` are read once a level, and once more for every chunk of bins that may
    hold the best split.
    """
    spark = rows.sparkSession
    hit = (F.col(label) == 1).cast("long")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(hit), F.lit(0)).alias("hits")).first()
    tree: dict[int, dict] = {1: {"n": total.n, "hits": total.hits}}
    left = spark.createDataFrame([], "node int, value double")
    numeric = [i for i, n in enumerate(sizes) if not n]
    limit = max(LOOK_ROWS, total.n // 2)
    binned = _in_bins(rows, inputs, numeric)
    cell = lambda i, key: F.struct(F.lit(i).alias("feature"), F.col(key).alias("key"), F.col(inputs[i]).alias("value"))
    closer = F.array(*[cell(i, f"_bin_{i}") for i in numeric])
    cells = F.array(*[cell(i, f"_bin_{i}" if i in numeric else c) for i, c in enumerate(inputs)])
    for level in range(depth):
        still = [k for k, v in tree.items() if k >> level == 1 and 0 < v["hits"] < v["n"]]
        if not still:
            break
        def routed(some: DataFrame, still: list[int] = still, left: DataFrame = left) -> list[DataFrame]:
            here = [route(p, tree, left, inputs, sizes) for p in in_passes(some, inputs, total.n)]
            return [p.filter(F.col("_node").isin(still)).withColumn("hit", hit) for p in here]

        counts = _counted(routed(binned), cells, ["node", "feature", "key"], [("low", "min"), ("high", "max")])
        steps = _steps(counts, sizes)
        best = _better({}, _collected(_best(steps)))
        if numeric:
            bins = _open_bins(steps, numeric, best, limit)
            for chunk in range((bins.agg(F.max("chunk")).first()[0] or 0) + 1):
                hopeful = bins.filter((F.col("chunk") == chunk) & _may_gain(best)).select("node", "feature", "key", "all_n", "all_hits", "ln0", "lh0")
                listed: dict[int, list[float]] = {}
                for r in hopeful.select("feature", "key").distinct().collect():  # at most BINS a feature
                    listed.setdefault(r.feature, []).append(r.key)
                if listed:
                    some = binned.filter(reduce(Column.__or__, [F.col(f"_bin_{i}").isin(keys) for i, keys in listed.items()]))
                    values = _counted(routed(some), closer, [*hopeful.columns, "value"], bins=hopeful)
                    best = _better(best, _collected(_best(_within(values))))
                    drop_staged(values)
            drop_staged(bins)
        drop_staged(steps)
        sets = []
        for b in best.values():
            if b.gain <= _LEAST:
                continue
            own = tree[b.node]
            own |= {"feature": b.feature, "gain": b.gain}
            tree[2 * b.node] = {"n": b.ln, "hits": b.lh}
            tree[2 * b.node + 1] = {"n": own["n"] - b.ln, "hits": own["hits"] - b.lh}
            if sizes[b.feature]:
                sets.append((F.col("node") == b.node) & (F.col("feature") == b.feature) & (F.col("hits") / F.col("n") <= F.lit(b.place)))
            else:
                own["threshold"] = b.high
        if sets:
            chosen = sets[0]
            for s in sets[1:]:
                chosen = chosen | s
            before, left = left, stage_table(left.unionByName(counts.filter(chosen).select("node", F.col("key").alias("value"))), "tree-sets", tidy=True)
            drop_staged(before)
        drop_staged(counts)
    model = ValueTreeModel(left)
    return model._set(inputCols=list(inputs), nodes=json.dumps(tree), sizes=list(sizes), maxBins=max([32, *(n + 1 for n in sizes if n)]))
