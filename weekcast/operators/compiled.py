"""Fitted trees as one column expression.

A tree is nested ``CASE WHEN feature <= threshold``, an ensemble the sum of its
trees.  The text reads the feature columns themselves, so scoring needs neither
a vector column nor the library that fitted the trees, and any engine that
speaks SQL can score with it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from .leafwise import LeafwiseModel


@dataclass(frozen=True)
class Split:
    """Rows whose ``feature`` is at most ``threshold`` go ``low``."""

    feature: str
    threshold: float
    low: Split | float
    high: Split | float


def _number(value: float) -> str:
    """A double in Spark's SQL and others': with an exponent, exact to the last digit."""
    return f"{value:.17e}"


def tree_sql(tree: Split | float, quote: str) -> str:
    if not isinstance(tree, Split):
        return _number(tree)
    name = f"{quote}{tree.feature}{quote}"
    low, high = tree_sql(tree.low, quote), tree_sql(tree.high, quote)
    return f"CASE WHEN {name} <= {_number(tree.threshold)} THEN {low} ELSE {high} END"


def _of_pipeline(model: PipelineModel) -> list[Split | float]:
    """The trees of a Spark ML ensemble, leaves multiplied by the tree's weight."""
    names, ensemble = model.stages[0].getInputCols(), model.stages[-1]

    def read(node, weight: float) -> Split | float:
        if node.subtreeDepth() == 0:
            return node.prediction() * weight
        cut = node.split()
        sides = (read(node.leftChild(), weight), read(node.rightChild(), weight))
        return Split(names[cut.featureIndex()], cut.threshold(), *sides)

    return [read(t._java_obj.rootNode(), w) for t, w in zip(ensemble.trees, ensemble.treeWeights)]


def _of_leafwise(model: LeafwiseModel) -> list[Split | float]:
    """The base and the trees of a pooled model."""
    if model.scope != "pooled":
        raise ValueError("a model per series is scored by its table of trees, not by one expression")
    start = model.bases.first()
    if start is None:
        raise ValueError("a model fitted on no rows has no expression")
    trees: list[Split | float] = [start.base]
    for row in model.trees.orderBy("tree").collect():
        nodes = {n.node: n for n in row.nodes}

        def read(at: int, nodes: dict = nodes) -> Split | float:
            own = nodes[at]
            if own.feature is None:
                return own.value
            return Split(model.features[own.feature], own.threshold, read(2 * at), read(2 * at + 1))

        trees.append(read(1))
    return trees


def model_trees(model: PipelineModel | LeafwiseModel) -> list[Split | float]:
    """The driver's copy of the trees, some thousand nodes at any size of the data."""
    read: Callable = _of_leafwise if isinstance(model, LeafwiseModel) else _of_pipeline
    return read(model)


def model_sql(model: PipelineModel | LeafwiseModel, quote: str = '"') -> str:
    """The prediction as SQL text over the feature columns, none of them NULL."""
    return " + ".join(tree_sql(t, quote) for t in model_trees(model))


def compiled(model: PipelineModel | LeafwiseModel) -> Column:
    """The prediction as a column; NULL features go high, so mask those rows."""
    return F.expr(model_sql(model, "`"))
