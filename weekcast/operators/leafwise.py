"""Boosted regression trees that grow leaf by leaf, for one model or one a series.

Every feature is cut into bins once.  A tree is grown from histograms: for each
leaf, feature and bin the number of rows and the sum of their residuals, summed
by Spark with the model in the key, so that thousands of series share each pass
over the rows.  Of the two sides of a split the smaller is counted and the other
is what remains of the parent.

The best split of a leaf depends on its rows alone.  So all leaves of a depth
are taken in one pass, down to the greatest depth, and then the tree that
best-first growth would have made is chosen among them: always the leaf with
the highest gain, up to ``leaves`` of them.

Residuals are whole numbers of small units.  Their sums are exact, whatever the
partitioning, so a fit can be repeated anywhere and a series gets the model that
it would get alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, floor, log2
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SERIES, TARGET
from ..session import Scratch, scratch

if TYPE_CHECKING:
    from .model import ModelParams

MODEL = "_model"
UNIT_BITS = 20  # residuals in millionths, fewer bits where the sums wouldn't fit
QUANTILE_ACCURACY = 20_000
ROWS_PER_TASK = 50_000  # a fit is a chain of short jobs: a task should be worth its start
_NODE = "struct<node:int,feature:int,bin:int,value:double>"
_SPLIT = ("node", "feature", "bin", "gain", "n_left", "s_left", "n", "s")


@dataclass(frozen=True)
class LeafwiseModel:
    """``trees``: ``_model, tree, nodes``, a row for each tree, whose nodes have
    a ``feature`` and a ``threshold`` (rows up to it go to node 2 k, the others to
    2 k + 1) or, as leaves, a ``value``.  ``bases``: ``_model, base``, where a
    prediction starts.  Both are tables in ``path``."""

    trees: DataFrame
    bases: DataFrame
    features: list[str]
    scope: str
    depth: int
    path: str


def drawn_features(count: int, share: float, seed: int, tree: int) -> list[int]:
    """The columns of one tree, drawn once for it."""
    wanted = max(1, min(count, ceil(share * count - 1e-9)))
    draw = np.random.RandomState((seed * 1_000_003 + tree) % (1 << 32))
    return sorted(draw.permutation(count)[:wanted].tolist())


def _keyed(frame: DataFrame, scope: str) -> DataFrame:
    return frame.withColumn(MODEL, F.col(SERIES) if scope == "series" else F.lit("all"))


def _beside(rows: DataFrame, of_model: DataFrame, scope: str) -> DataFrame:
    """Rows with what their model has.  A pooled model is one row of known size;
    of many models the join is left to statistics and adaptive execution."""
    return rows.join(F.broadcast(of_model) if scope == "pooled" else of_model, MODEL)


def _units(value: Column, bits: int) -> Column:
    return F.floor(value * float(1 << bits) + 0.5).cast("long")


def _edges(frame: DataFrame, features: Sequence[str], bins: int) -> DataFrame:
    """``_model, edges``: for each feature the distinct upper ends of its bins
    but the last, at even shares of the rows."""
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    accuracy = F.lit(max(QUANTILE_ACCURACY, 50 * bins))
    cut = [F.array_distinct(F.percentile_approx(name, shares, accuracy)).alias(name) for name in features]
    return frame.groupBy(MODEL).agg(*cut).select(MODEL, F.array(*features).alias("edges"))


def _binned(frame: DataFrame, edges: DataFrame, features: Sequence[str], scope: str) -> DataFrame:
    """``_model, y, bins``: a bin is the number of edges below the value."""

    def place(k: int, name: str) -> Column:
        return F.size(F.filter(F.col("edges")[k], lambda edge: edge < F.col(name)))

    bins = F.array(*[place(k, name) for k, name in enumerate(features)]).alias("bins")
    return _beside(frame, edges, scope).select(MODEL, F.col(TARGET).alias("y"), bins)


def _histogram(rows: DataFrame, columns: Sequence[int]) -> DataFrame:
    """``_model, node, feature, bin, n, s`` over rows with ``node`` and ``r``."""
    bins = F.array(*[
        F.struct(F.lit(k).alias("feature"), F.col("bins")[k].alias("bin")) for k in columns
    ])
    each = rows.select(MODEL, "node", "r", F.explode(bins).alias("at")).select(MODEL, "node", "r", "at.*")
    return each.groupBy(MODEL, "node", "feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("r").alias("s")
    )


def _best_splits(histogram: DataFrame, min_rows: int) -> DataFrame:
    """For every node the cut with the highest gain, of equal ones the first
    feature and the lowest bin.

    The gain is that of the squared error.  A cut must leave ``min_rows`` on both
    sides and move the sum of a side by a unit.
    """
    of_feature = Window.partitionBy(MODEL, "node", "feature")
    up_to = of_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cut = histogram.select(
        MODEL, "node", "feature", "bin",
        F.sum("n").over(up_to).alias("n_left"), F.sum("s").over(up_to).alias("s_left"),
        F.sum("n").over(of_feature).alias("n"), F.sum("s").over(of_feature).alias("s"),
    )
    n, left = F.col("n"), F.col("n_left")
    moved = F.col("s_left").cast("double") - F.col("s").cast("double") * left / n
    allowed = cut.where((left >= min_rows) & (n - left >= min_rows)).withColumn("moved", moved)
    scored = allowed.where(F.abs("moved") >= 1).withColumn(
        "gain", F.col("moved") * F.col("moved") / left * n / (n - left)
    )
    best = F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), *_SPLIT[4:]))
    return scored.groupBy(MODEL, "node").agg(best.alias("best")).select(
        MODEL, "node", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin"),
        "best.gain", *[f"best.{name}" for name in _SPLIT[4:]],
    )


def _at_node(steps: int) -> Column:
    """The node a row is in after so many splits."""
    at = "try_element_at(splits, n)"
    return F.expr(
        f"aggregate(sequence(1, {steps}), 1, (n, k) -> CASE WHEN {at} IS NULL THEN n "
        f"ELSE 2 * n + IF(bins[{at}.feature] > {at}.bin, 1, 0) END)"
    )


def _as_map(entries: DataFrame, key: str, *values: str) -> DataFrame:
    """``_model, splits``: the rows of each model, a few dozen, as a map."""
    pairs = F.collect_list(F.struct(key, F.struct(*values)))
    return entries.groupBy(MODEL).agg(F.map_from_entries(pairs).alias("splits"))


def _next_histogram(rows: DataFrame, columns: Sequence[int], splits: DataFrame, before: DataFrame, depth: int, scope: str, min_rows: int) -> DataFrame:
    """The histogram of the nodes of ``depth`` that can be split again, from all
    ``splits`` above and the histogram of their parents."""
    side = F.when(2 * F.col("n_left") <= F.col("n"), 0).otherwise(1)
    large = F.greatest(F.col("n_left"), F.col("n") - F.col("n_left"))
    open_ = splits.where((large >= 2 * min_rows) & (F.col("node") >= 1 << (depth - 1))).select(
        MODEL, F.col("node").alias("parent"), (2 * F.col("node") + side).alias("node")
    )
    placed = _beside(rows, _as_map(splits, "node", "feature", "bin"), scope).withColumn("node", _at_node(depth))
    small = _histogram(placed.where(F.col("node") >= 1 << depth), columns)
    counted = small.join(open_, [MODEL, "node"], "left_semi")
    parent = before.withColumnRenamed("node", "parent").join(open_, [MODEL, "parent"])
    own = counted.select(MODEL, "node", "feature", "bin", F.col("n").alias("n_small"), F.col("s").alias("s_small"))
    rest = parent.join(own, [MODEL, "node", "feature", "bin"], "left").select(
        MODEL, F.col("node").bitwiseXOR(F.lit(1)).alias("node"), "feature", "bin",
        (F.col("n") - F.coalesce("n_small", F.lit(0))).alias("n"),
        (F.col("s") - F.coalesce("s_small", F.lit(0))).alias("s"),
    ).where("n > 0")
    return counted.unionByName(rest)


def best_first(splits: list[dict], leaves: int) -> dict[int, dict]:
    """The nodes that are split when always the open leaf with the highest gain
    is, until there are ``leaves`` leaves; of equal gains the lower node's."""
    found = {s["node"]: s for s in splits}
    open_ = [(-found[1]["gain"], 1)] if 1 in found else []
    chosen: dict[int, dict] = {}
    while open_ and len(chosen) < leaves - 1:
        _, node = heapq.heappop(open_)
        chosen[node] = found[node]
        for child in (2 * node, 2 * node + 1):
            if child in found:
                heapq.heappush(open_, (-found[child]["gain"], child))
    return chosen


def tree_nodes(splits: list[dict], leaves: int, rate: float, bits: int) -> list[tuple]:
    """``node, feature, bin, value`` of the chosen splits and the leaves between
    them; a leaf's value is the share ``rate`` of its mean residual."""
    chosen = best_first(splits, leaves)
    nodes: list[tuple] = []
    for node, s in sorted(chosen.items()):
        nodes.append((node, s["feature"], s["bin"], None))
        sides = ((s["n_left"], s["s_left"]), (s["n"] - s["n_left"], s["s"] - s["s_left"]))
        for child, (n, total) in zip((2 * node, 2 * node + 1), sides):
            if child not in chosen:
                nodes.append((child, None, None, rate * (float(total) / n) / (1 << bits)))
    return nodes


def _chosen(made: DataFrame, leaves: int, rate: float, bits: int) -> DataFrame:
    """``_model, nodes`` of one tree: a model's splits, 63 for depth 6, are a row."""

    @F.pandas_udf(f"array<{_NODE}>")
    def choose(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in lists:
            yield pd.Series([
                [dict(zip(("node", "feature", "bin", "value"), x)) for x in tree_nodes(list(one), leaves, rate, bits)]
                for one in some
            ])

    gathered = made.groupBy(MODEL).agg(F.collect_list(F.struct(*_SPLIT)).alias("all"))
    return gathered.select(MODEL, choose("all").alias("nodes"))


def _grown(rows: DataFrame, columns: Sequence[int], params: ModelParams, scope: str, work: Scratch) -> DataFrame:
    """All splits of one tree down to the greatest depth.

    The histograms of all depths are kept, a row for each bin; what is split
    where follows from them and is worked out again where it is needed.
    """
    histogram = work.keep(_histogram(rows.withColumn("node", F.lit(1)), columns))
    kept = histogram
    for depth in range(1, params.depth):
        splits = _best_splits(kept, params.min_leaf_rows)
        histogram = work.keep(
            _next_histogram(rows, columns, splits, histogram, depth, scope, params.min_leaf_rows)
        )
        if histogram.isEmpty():
            break
        kept = kept.unionByName(histogram)
    return _best_splits(kept, params.min_leaf_rows)


def _size(frame: DataFrame) -> tuple[int, int]:
    """Rows, and as many bits of a unit as let the sum of any model's residuals
    fit in a long, with room."""
    size = F.sum(F.abs(F.col(TARGET)) + 1)
    sizes = frame.groupBy(MODEL).agg(size.alias("size"), F.count(F.lit(1)).alias("rows"))
    most, rows = sizes.agg(F.max("size"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    return rows, max(0, min(UNIT_BITS, floor(60 - log2(most or 1.0))))


def fit(frame: DataFrame, params: ModelParams, features: Sequence[str], scope: str = "pooled") -> LeafwiseModel:
    """Fit on a complete training frame.

    ``scope="series"`` gives every series a model of its own, all in the same
    passes.  A prediction starts from the mean and each tree adds the share
    ``rate`` of its leaves' mean residuals.  A model whose tree finds no split is
    finished; an empty frame gives a model without predictions.
    """
    if scope not in ("pooled", "series"):
        raise ValueError(f"scope must be 'pooled' or 'series', not {scope!r}")
    if params.depth > 30:
        raise ValueError("nodes are numbered in 32 bits: depth is at most 30")
    spark = frame.sparkSession
    kept = Scratch(spark, "leafwise")
    features = list(features)
    with scratch(spark, "leafwise-fit") as work:
        given = work.keep(_keyed(frame, scope).select(MODEL, TARGET, *features))
        count, bits = _size(given)
        tasks = max(1, ceil(count / ROWS_PER_TASK))
        mean = F.sum(_units(F.col(TARGET), bits)).cast("double") / F.count(F.lit(1)) / (1 << bits)
        bases = kept.keep(given.groupBy(MODEL).agg(mean.alias("base")))
        edges = work.keep(_edges(given, features, params.bins))
        residual = _units(F.col("y") - F.col("fitted"), bits).alias("r")
        start = _beside(_binned(given, edges, features, scope), bases, scope)
        state = work.keep(start.withColumnRenamed("base", "fitted").select("*", residual).coalesce(tasks))
        made: list[DataFrame] = []
        for tree in range(1, params.trees + 1):
            columns = drawn_features(len(features), params.feature_share, params.seed, tree)
            with scratch(spark, "leafwise-tree") as steps:
                splits = _grown(state, columns, params, scope, steps)
                nodes = work.keep(_chosen(splits, params.leaves, params.rate, bits))
            if nodes.isEmpty():
                break
            made.append(nodes.withColumn("tree", F.lit(tree)))
            if tree < params.trees:
                # Rows of a model without a tree end here.
                found = _as_map(nodes.select(MODEL, F.inline("nodes")), "node", "feature", "bin", "value")
                placed = _beside(state, found, scope).withColumn("at", _leaf(params.depth))
                fitted = (F.col("fitted") + F.col("at.value")).alias("fitted")
                state = work.keep(placed.select(MODEL, "y", "bins", fitted).select("*", residual).coalesce(tasks))
        trees = kept.keep(_with_thresholds(made, edges, spark))
    return LeafwiseModel(trees, bases, features, scope, params.depth, kept.path)


def _leaf(depth: int) -> Column:
    """The leaf of a tree that a row falls into."""
    at = "try_element_at(splits, n)"
    return F.expr(
        f"try_element_at(splits, aggregate(sequence(1, {depth}), 1, (n, k) -> CASE WHEN {at}.feature IS NULL THEN n "
        f"ELSE 2 * n + IF(bins[{at}.feature] > {at}.bin, 1, 0) END))"
    )


def _with_thresholds(made: list[DataFrame], edges: DataFrame, spark) -> DataFrame:
    """The trees with the values at which their splits cut, in place of bins."""
    if not made:
        nodes = "array<struct<node:int,feature:int,threshold:double,value:double>>"
        return spark.createDataFrame([], f"{MODEL} string, tree int, nodes {nodes}")
    whole = made[0]
    for more in made[1:]:
        whole = whole.unionByName(more)
    cut = F.transform("nodes", lambda x: F.struct(
        x["node"].alias("node"), x["feature"].alias("feature"),
        F.col("edges")[x["feature"]][x["bin"]].alias("threshold"), x["value"].alias("value"),
    ))
    return whole.join(edges, MODEL).select(MODEL, "tree", cut.alias("nodes"))


def predict(model: LeafwiseModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction``; NULL where the rows' series has no model."""
    def as_map(tree: Column) -> Column:
        return F.map_from_entries(F.transform(tree["nodes"], lambda x: F.struct(
            x["node"].alias("key"),
            F.struct(*[x[name].alias(name) for name in ("feature", "threshold", "value")]).alias("value"),
        )))

    ordered = F.array_sort(F.collect_list(F.struct("tree", "nodes")))
    trees = model.trees.groupBy(MODEL).agg(F.transform(ordered, as_map).alias("_trees"))
    whole = model.bases.withColumnRenamed("base", "_base").join(trees, MODEL, "left")
    at = "try_element_at(t, n)"
    leaf = (
        f"aggregate(sequence(1, {model.depth}), 1, (n, k) -> CASE WHEN {at}.feature IS NULL THEN n "
        f"ELSE 2 * n + IF(_x[{at}.feature] > {at}.threshold, 1, 0) END)"
    )
    summed = f"aggregate(coalesce(_trees, array()), _base, (sum, t) -> sum + try_element_at(t, {leaf}).value)"
    keyed = _keyed(rows, model.scope).withColumn("_x", F.array(*[F.col(c).cast("double") for c in model.features]))
    of_model = F.broadcast(whole) if model.scope == "pooled" else whole
    return (
        keyed.join(of_model, MODEL, "left")
        .withColumn("prediction", F.expr(summed))
        .drop(MODEL, "_x", "_base", "_trees")
    )
