"""One scheduled run over a panel: compare, retrain what is due, forecast."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.blocks import settled
from ..operators.features import training_frame
from ..operators.interval import next_forecast
from ..operators.model import ModelParams, backtest
from ..operators.reconcile import (
    RETRAIN,
    SKIP,
    deviation_alerts,
    forecast_accuracy,
    forecast_actual_lookup,
    refresh_gate,
)
from ..operators.split import chronological_split
from ..schema import ALERT_THRESHOLD, FEATURES, FORECAST, OBSERVATION_COLUMNS, SERIES, WEEK_START
from ..session import Scratch
from ..sources.ledger import ledger_append, ledger_errors, ledger_latest_valid, read_ledger
from ..sources.observations import coverage_stats
from ..sources.run_log import RunLog
from ..sources.sinks import (
    alert_outputs,
    chart_frame,
    forecast_csv,
    summary_lines,
    write_lines,
)

_FORECASTS = T.StructType(
    [
        *FORECAST.fields,
        T.StructField("interval_ok", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)


class WeeklyRun(dict):
    """Results of a run by name, as lazy tables over its intermediate files.

    ``remove()`` deletes those files; as a context manager it does so when the
    block succeeds.  What the run wrote to ``out_path`` and the ledger stays.
    """

    def __init__(self, work: Scratch):
        super().__init__()
        self._work = work

    def remove(self) -> None:
        self._work.remove()

    def __enter__(self) -> WeeklyRun:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.remove()


def weekly_run(
    panel: DataFrame,
    ledger: str | RunLog,
    as_of: datetime | str,
    threshold: float = ALERT_THRESHOLD,
    out_path: str | None = None,
    params: ModelParams = ModelParams(),
    mode: str = "parity",
    strict: bool = False,
    layout: str = "auto",
    ledger_format: str = "parquet",
    title: str = "Weekly Forecast Summary",
    interval_from: str = "training",
    per_series_files: bool = False,
    missing: str = "parity",
    errors: DataFrame | dict[str, DataFrame] | None = None,
    features: Sequence[str] = FEATURES,
    models: str = "pooled",
) -> WeeklyRun:
    """Run every series of ``panel``, a table at rest, through its own path.

    cold start   no valid ledger row: train and forecast, nothing to compare
    waiting      the forecast week has not arrived: nothing trained or written
    reconcile    it has: compare, alert, train and forecast

    The ledger is read and fixed before anything else and appended to last, so
    a run that fails half-way is simply run again, and a second run on the same
    data finds every series waiting.  Alerts, accuracy and scheduler keys are
    written whenever a forecast was compared, the other outputs and the ledger
    when one was made; a run that did neither writes nothing but errors.

    ``ledger`` is the path of a ledger, or a ``RunLog``.  With the latter, the
    run's tables and its forecasts are published together by one commit: a run
    that stops before has published nothing, and is repeated as if it hadn't
    been.  ``out_path``, if given too, gets its files after the commit.

    ``errors`` are what the caller found unusable before the run, a table or
    several by name; they are written with the results, as are ``ledger_errors``,
    ledger rows that can't count as a forecast.  Neither stops a run.

    ``models="series"`` fits a model for every series (see ``fit_forecaster``).
    ``interval_from="validation"`` takes the interval from errors on weeks the
    model had not seen instead of from its own fit.  ``per_series_files`` writes
    the summary and the scheduler keys as one text folder per series, for panels
    of some hundreds; without it summaries share files and keys are a table.
    """
    if interval_from not in ("training", "validation"):
        raise ValueError(f"interval_from must be 'training' or 'validation', not {interval_from!r}")
    spark = panel.sparkSession
    panel = panel.select(*OBSERVATION_COLUMNS)
    work = Scratch(spark, "weekly")
    if isinstance(ledger, RunLog):
        before = ledger.commit()
        latest, unusable = ledger.latest_valid(before), ledger.errors(before)
    else:
        stored = read_ledger(spark, ledger, ledger_format)
        latest, unusable = ledger_latest_valid(stored), ledger_errors(stored)
    latest = work.keep(latest)
    looked_up = work.keep(forecast_actual_lookup(latest, panel, strict))
    accuracy = forecast_accuracy(looked_up)
    gate = work.keep(refresh_gate(panel, latest, strict, looked_up))

    retrain = gate.where(F.col("action") == RETRAIN).select(SERIES)
    due = panel.join(retrain, SERIES, "left_semi")
    results = WeeklyRun(work)
    results["coverage"] = coverage_stats(panel)
    results["gate"] = gate
    results["accuracy"] = accuracy
    results["standing"] = latest.join(gate.where(F.col("action") == SKIP), SERIES, "left_semi")
    results["forecasts"] = spark.createDataFrame([], _FORECASTS)
    found = errors if isinstance(errors, dict) else {"errors": errors}
    found = {name: table for name, table in found.items() if table is not None}
    found["ledger_errors"] = work.keep(unusable)
    results |= found
    if not retrain.isEmpty():
        layout = settled(due, layout)
        frame = training_frame(due, layout, strict)
        if layout == "auto":
            frame = work.keep(frame)  # the split measures it
        parts = work.keep(chronological_split(frame, layout=layout))
        if parts.isEmpty():
            # Nothing to learn from: every due series is too short.
            ahead = due.groupBy(SERIES).agg(
                F.date_add(F.max(WEEK_START), 7).alias(WEEK_START),
                F.lit("insufficient_history").alias("status"),
            )
            results["forecasts"] = results["forecasts"].unionByName(ahead, allowMissingColumns=True)
        else:
            trained = backtest(parts, params, features=features, models=models)
            results["metrics"] = trained.metrics
            unseen = trained.unseen if interval_from == "validation" else None
            results["forecasts"] = work.keep(
                next_forecast(trained.model, due, parts, mode, layout, strict, unseen, missing)
            )
    forecasts = results["forecasts"]
    results["alerts"] = deviation_alerts(accuracy, forecasts, threshold)
    results["summary"] = summary_lines(forecasts, accuracy, as_of, title)
    results["chart"] = chart_frame(due, forecasts, accuracy)
    results["outputs"] = alert_outputs(accuracy, threshold)

    compared = not accuracy.isEmpty()
    forecast = not forecasts.where(F.col("predicted_ili").isNotNull()).isEmpty()
    faults = [name for name, table in found.items() if not table.isEmpty()]
    if isinstance(ledger, RunLog):
        tables = {name: results[name] for name in [*faults, *_due(results, compared, forecast)]}
        if tables or forecast:
            ledger.publish(tables, as_of, forecasts if forecast else None, before)
    if out_path is not None:
        _write(results, out_path, per_series_files, compared, forecast, faults)
    if forecast and not isinstance(ledger, RunLog):
        ledger_append(forecasts, ledger, as_of, ledger_format)
    return results


def _due(results: WeeklyRun, compared: bool, forecast: bool) -> list[str]:
    """The tables that a run which did so much gives out."""
    names = ["alerts", "accuracy", "outputs"] if compared else []
    names += ["forecasts", "summary", "chart"] if forecast else []
    names += ["gate", "standing", "coverage", "metrics"] if names else []
    return [name for name in names if name in results]


def _write(
    results: WeeklyRun, out_path: str, per_series: bool, compared: bool, forecast: bool, faults: list[str]
) -> None:
    """Files for people and schedulers; what is due, as tables but for the
    forecasts (CSV), the summary (text) and, on demand, the scheduler keys."""
    due = [*faults, *_due(results, compared, forecast)]
    if compared and per_series:
        pairs = F.concat_ws("=", "key", "value")
        write_lines(results["outputs"], f"{out_path}/outputs", pairs, [WEEK_START, "key"], True)
        due.remove("outputs")
    # Alerts come first: a notice must go out even if nothing can be forecast.
    for name in due:
        if name not in ("forecasts", "summary"):
            results[name].write.mode("overwrite").parquet(f"{out_path}/{name}")
    if forecast:
        made = results["forecasts"].where(F.col("predicted_ili").isNotNull())
        forecast_csv(made, f"{out_path}/prediction")
        write_lines(
            results["summary"], f"{out_path}/summary", F.col("line"), ["line_no"], per_series
        )
