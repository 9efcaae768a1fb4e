"""Past forecasts against the actuals that have arrived since."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed0
from ..schema import ALERT_THRESHOLD, FORECAST_COLUMNS, SERIES, TARGET, WEEK_START
from .order import order_columns


def forecast_actual_lookup(
    ledger: DataFrame, panel: DataFrame, strict: bool = False
) -> DataFrame:
    """Add ``actual_ili`` and ``status`` to ledger rows.

    ``matched``, ``pending`` (the week is not in the panel) or ``null_actual``
    (it is, without a value).  Where the panel repeats a week its first row
    counts.  ``strict`` tells ``stale`` from ``pending``: the series already
    has a later week, so this one may never come.

    Repeated weeks are folded on the map side, so a heavy week costs one row
    per task.  Spark moves the semi join below that fold when the ledger is
    small enough to broadcast, and leaves it above otherwise.
    """
    wanted = ledger.select(SERIES, WEEK_START).distinct()
    within = [c for c in order_columns(panel) if c != WEEK_START]
    # NULL sorts first inside a struct, but last in the panel's row order.
    keys = [x for c in within for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    actuals = (
        panel.groupBy(SERIES, WEEK_START)
        .agg(F.min(F.struct(*keys))[TARGET].alias("actual_ili"), F.lit(True).alias("_seen"))
        .join(wanted, [SERIES, WEEK_START], "left_semi")
    )
    found = ledger.join(actuals, [SERIES, WEEK_START], "left")
    absent = F.lit("pending")
    if strict:
        newest = panel.groupBy(SERIES).agg(F.max(WEEK_START).alias("_newest"))
        found = found.join(newest, SERIES, "left")
        absent = F.when(F.col("_newest") > F.col(WEEK_START), "stale").otherwise("pending")
    status = (
        F.when(F.col("_seen").isNull(), absent)
        .when(F.col("actual_ili").isNull(), "null_actual")
        .otherwise("matched")
    )
    return found.withColumn("status", status).select(*ledger.columns, "actual_ili", "status")


def forecast_accuracy(matched: DataFrame) -> DataFrame:
    """Deviation, interval hit and direction of every matched forecast.

    The deviation is relative to the actual and has no value, with the
    ``accuracy`` flag ``undefined``, when the actual is zero.  A forecast that
    is exactly right counts as ``under-predicted``.
    """
    predicted, actual = F.col("predicted_ili"), F.col("actual_ili")
    off = F.abs(predicted - actual)
    return (
        matched.where(F.col("status") == "matched")
        .withColumn("abs_deviation", off)
        .withColumn("deviation_pct", F.try_divide(off, actual) * 100)
        .withColumn("in_interval", actual.between(F.col("ci_lower"), F.col("ci_upper")))
        .withColumn(
            "direction",
            F.when(predicted > actual, "over-predicted").otherwise("under-predicted"),
        )
        .withColumn("accuracy", F.when(actual == 0, "undefined").otherwise("ok"))
    )


def deviation_alerts(
    accuracy: DataFrame, new_forecasts: DataFrame, threshold: float = ALERT_THRESHOLD
) -> DataFrame:
    """Forecasts that were off by more than ``threshold``, as the text and
    numbers of a notice, next to the new forecast of the same series."""
    upcoming = new_forecasts.where(F.col("predicted_ili").isNotNull()).select(
        SERIES, *[F.col(c).alias(f"next_{c}") for c in FORECAST_COLUMNS if c != SERIES]
    )
    pct = F.col("deviation_pct")
    return (
        accuracy.where(pct > F.lit(threshold * 100))
        .select(
            SERIES,
            WEEK_START,
            "predicted_ili",
            "ci_lower",
            "ci_upper",
            "actual_ili",
            "abs_deviation",
            "deviation_pct",
            "direction",
            F.initcap(F.replace("direction", F.lit("-"), F.lit(" "))).alias("direction_label"),
            "in_interval",
            F.when(F.col("in_interval"), "Yes — actual fell within the 95% PI")
            .otherwise("No — actual was outside the 95% PI")
            .alias("interval_status"),
            F.concat(
                F.lit("Prediction Accuracy — "),
                F.col(SERIES),
                F.lit(": "),
                F.col("direction"),
                F.lit(" by "),
                fixed0(pct),
                F.lit("%"),
            ).alias("subject"),
            F.lit(threshold * 100).alias("threshold_pct"),
        )
        .join(upcoming, SERIES, "left")
    )


# What a run does with a series, by lookup status.
RETRAIN, SKIP = "retrain", "skip"


def refresh_gate(
    panel: DataFrame,
    latest: DataFrame,
    strict: bool = False,
    looked_up: DataFrame | None = None,
) -> DataFrame:
    """Which series to retrain.

    ``latest`` is the newest valid ledger row per series.  A series without one
    starts cold; one whose forecast week has arrived is retrained; all others
    wait.  ``strict`` also retrains stale series, which would wait for ever.  A
    series of the ledger that the panel lacks is reported as ``no_data``.
    ``looked_up`` is the lookup of ``latest`` when the caller has it already.
    """
    if looked_up is None:
        looked_up = forecast_actual_lookup(latest, panel, strict)
    known = panel.select(SERIES).distinct().withColumn("_here", F.lit(True))
    found = looked_up.select(SERIES, F.col("status").alias("_status"))
    arrived = F.coalesce(F.col("_status"), F.lit("cold_start"))
    reason = F.when(F.col("_here"), arrived).otherwise("no_data")
    act = F.when(reason.isin("cold_start", "matched", "stale"), RETRAIN).otherwise(SKIP)
    return known.join(found, SERIES, "full").select(
        SERIES, act.alias("action"), reason.alias("reason")
    )
