"""Boosted regression trees: fit, score, backtest.

Trees grow level by level with Spark ML or, if the parameters bound the number
of ``leaves``, leaf by leaf from histograms.  One model is pooled over all series
of the frame; grown leaf by leaf, every series can have its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clamp_at_zero
from ..schema import FEATURES, TARGET
from ..session import cut_lineage, ensure_checkpoint_dir
from . import leafwise
from .leafwise import LeafwiseModel
from .metrics import regression_metrics
from .split import chronological_split

FIT_ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class ModelParams:
    """The size of the model and its seed.

    Rows are not sampled per tree.  ``rate`` is the share of the mean residual
    that a tree adds.  With ``leaves`` a tree grows leaf by leaf, always where
    the gain is highest, to that many leaves and at most ``depth``; the columns
    are drawn once for a tree and the model starts from the mean.  Without,
    trees grow level by level to ``depth``, columns are drawn for every node,
    and the first tree is the model's start and counts in full.
    """

    trees: int = 200
    depth: int = 6
    rate: float = 0.05
    min_leaf_rows: int = 30
    feature_share: float = 0.8
    bins: int = 255
    seed: int = 42
    checkpoint_every: int = 25
    leaves: int | None = None


#: Fixed value: the number of leaves that goes with the other defaults.
LEAFWISE = ModelParams(leaves=31)

Model = PipelineModel | LeafwiseModel


def fit_forecaster(
    frame: DataFrame,
    params: ModelParams = ModelParams(),
    features: Sequence[str] = FEATURES,
    scope: str = "pooled",
) -> Model:
    """Fit on a complete training frame.

    ``scope="series"`` fits a model for every series side by side; that takes
    trees grown leaf by leaf (``params.leaves``).

    With Spark ML, boosting adds to the lineage of the running residuals with every tree, so
    it is checkpointed every few trees into the shared folder.  A fit is a long
    chain of short jobs, one per tree level: the frame is counted and dealt out
    so that each task has enough rows to be worth its start.
    """
    if params.leaves is not None:
        return leafwise.fit(frame, params, features, scope)
    if scope != "pooled":
        raise ValueError(f"scope {scope!r} takes trees grown leaf by leaf: set leaves")
    ensure_checkpoint_dir(frame.sparkSession)
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=TARGET,
        predictionCol="prediction",
        maxIter=params.trees,
        maxDepth=params.depth,
        # The library fits trees to the loss's gradient, twice the residual.
        stepSize=params.rate / 2,
        minInstancesPerNode=params.min_leaf_rows,
        featureSubsetStrategy=str(params.feature_share),
        subsamplingRate=1.0,
        maxBins=params.bins,
        maxMemoryInMB=1024,
        seed=params.seed,
        checkpointInterval=params.checkpoint_every,
    )
    rows = frame.select(*features, TARGET)
    tasks = max(1, ceil(rows.count() / FIT_ROWS_PER_TASK))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, trees]).fit(rows.coalesce(tasks))


def features_of(model: Model) -> list[str]:
    if isinstance(model, LeafwiseModel):
        return model.features
    return list(model.stages[0].getInputCols())


def _predicted(model: Model, rows: DataFrame) -> DataFrame:
    """Rows without missing features, with ``prediction``."""
    if isinstance(model, LeafwiseModel):
        return leafwise.predict(model, rows)
    return model.transform(rows).drop("features")


def score(
    model: Model, rows: DataFrame, clamp: bool = False, missing: str = "strict"
) -> DataFrame:
    """Add ``prediction`` and ``status`` in one pass.

    A row that lacks a feature gets no prediction and the status
    ``insufficient_history``; with ``missing="parity"`` the lacking feature
    counts as 0.0, which is what a library makes of a value it never saw
    missing in training, and the status is ``missing_feature``.  ``clamp`` is
    for forecasts, which count cases and cannot be negative.  A series that a
    model per series hasn't seen gets no prediction.
    """
    if missing not in ("strict", "parity"):
        raise ValueError(f"missing must be 'strict' or 'parity', not {missing!r}")
    features = features_of(model)
    complete = F.lit(True)
    for name in features:
        complete = complete & F.col(f"_given.{name}").isNotNull()
    filled = rows.withColumn("_given", F.struct(*features)).withColumns(
        {name: F.coalesce(F.col(name), F.lit(0.0)) for name in features}
    )
    usable = complete if missing == "strict" else F.lit(True)
    lacking = "insufficient_history" if missing == "strict" else "missing_feature"
    prediction = F.when(usable, F.col("prediction"))
    return (
        _predicted(model, filled)
        .withColumns({name: F.col(f"_given.{name}") for name in features})
        .withColumns(
            {
                "prediction": clamp_at_zero(prediction) if clamp else prediction,
                "status": F.when(complete, "ok").otherwise(lacking),
            }
        )
        .drop("_given")
    )


class Backtest(NamedTuple):
    model: Model
    features: list[str]
    metrics: DataFrame
    frame: DataFrame  # the training frame with its split, fixed as files
    unseen: DataFrame  # validation rows as predicted by the model that did not see them


def backtest(
    frame: DataFrame,
    params: ModelParams = ModelParams(),
    by: tuple[str, ...] = ("split",),
    scope: str = "series",
    layout: str = "auto",
    features: Sequence[str] = FEATURES,
    models: str = "pooled",
) -> Backtest:
    """Fit on the earlier part, measure both parts, then refit on everything.

    Both fits and the metrics read the frame several times, so it is written
    once instead of being derived again each time.  A frame that has ``split``
    already is taken to be fixed and is used as it is.

    ``models="series"`` fits a model for every series (see ``fit_forecaster``).

    The two fits do not depend on each other and are submitted side by side.
    Series so short that none has an earlier part leave nothing for a trial:
    the metrics are then NULL over 0 rows, and the final fit is still made.
    """
    parts = frame
    if "split" not in frame.columns:
        parts = cut_lineage(chronological_split(frame, scope=scope, layout=layout))
    early = parts.where(F.col("split") == "train")
    fit = inheritable_thread_target(frame.sparkSession)(
        lambda rows: fit_forecaster(rows, params, features, models)
    )
    if early.isEmpty():
        final = fit(parts)
        none = F.lit(None).cast("double")
        tried = parts.withColumns({"prediction": none, "status": F.lit("untrained")})
        metrics = parts.groupBy(*by).agg(
            F.max(none).alias("rmse"), F.max(none).alias("r2"), F.lit(0).cast("long").alias("n")
        )
    else:
        ensure_checkpoint_dir(frame.sparkSession)
        with ThreadPoolExecutor(2) as pool:
            trial, final = pool.map(fit, [early, parts])
        tried = score(trial, parts)
        metrics = regression_metrics(tried, TARGET, "prediction", by)
    unseen = tried.where(F.col("split") == "validation")
    return Backtest(final, list(features), metrics, parts, unseen)
