"""Empirical prediction intervals and the one-week-ahead forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clamp_at_zero
from ..schema import INTERVAL, RESIDUAL_ROWS, SERIES, TARGET, WEEK_START, YEAR_LAG
from .features import forecast_point_features, training_frame
from .model import Model, score
from .order import newest_rows


def residual_interval(
    scored: DataFrame,
    points: DataFrame,
    n: int = RESIDUAL_ROWS,
    q: tuple[float, float] = INTERVAL,
    y: str = TARGET,
    yhat: str = "prediction",
) -> DataFrame:
    """Add ``ci_lower`` and ``ci_upper`` to ``points`` (which has ``predicted_ili``).

    The bounds are the exact, interpolated quantiles of y - yhat over the
    newest ``n`` rows of each series.  Only the lower one is clamped at zero,
    so an interval may be inverted or miss its point: see ``interval_ok``.
    """
    recent = newest_rows(scored, n)
    share = F.array(*[F.lit(float(x)) for x in q])
    spans = recent.groupBy(SERIES).agg(
        F.percentile(F.col(y) - F.col(yhat), share).alias("_span")
    )
    point = F.col("predicted_ili")
    return (
        points.join(spans, SERIES, "left")
        .withColumn("ci_lower", clamp_at_zero(point + F.col("_span")[0]))
        .withColumn("ci_upper", point + F.col("_span")[1])
        .withColumn("interval_ok", point.between(F.col("ci_lower"), F.col("ci_upper")))
        .drop("_span")
    )


def next_forecast(
    model: Model,
    panel: DataFrame,
    frame: DataFrame | None = None,
    mode: str = "parity",
    layout: str = "auto",
    strict: bool = False,
    residuals: DataFrame | None = None,
    missing: str = "parity",
) -> DataFrame:
    """One row per series for the week after its newest one.

    ``frame`` is the training frame when the caller has it already.  The
    interval comes from the model's own fit of its newest rows; pass scored
    rows as ``residuals`` to take it from elsewhere.  A series of fewer than 53
    rows, or without a single training row to take residuals from, gets the
    status ``insufficient_history`` and no numbers.  A longer one whose newest
    rows lack a value is forecast with status ``missing_feature`` (see
    ``score``); ``missing="strict"`` gives it no numbers either.
    """
    if residuals is None:
        if frame is None:
            frame = training_frame(panel, layout, strict)
        residuals = score(model, newest_rows(frame, RESIDUAL_ROWS))
    points = forecast_point_features(panel, mode, strict, rows_name="_rows")
    enough = F.col("_rows") > YEAR_LAG
    ahead = score(model, points, clamp=True, missing=missing).select(
        SERIES,
        WEEK_START,
        F.when(enough, F.col("prediction")).alias("predicted_ili"),
        F.col("status").alias("_status"),
    )
    bounded = residual_interval(residuals, ahead)
    usable = F.col("ci_upper").isNotNull()
    return bounded.select(
        SERIES,
        WEEK_START,
        *[F.when(usable, F.col(c)).alias(c) for c in ("predicted_ili", "ci_lower", "ci_upper")],
        "interval_ok",
        F.when(usable, F.col("_status")).otherwise("insufficient_history").alias("status"),
    )
