"""What a run hands over: CSV, summary text, chart data, scheduler keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed0, fixed1
from ..operators.order import newest_rows
from ..schema import ALERT_THRESHOLD, CHART_WEEKS, FORECAST_COLUMNS, SERIES, TARGET, WEEK_START
from .ledger import as_utc


def forecast_csv(forecasts: DataFrame, path: str) -> None:
    """Forecast rows as CSV with a header."""
    forecasts.select(*FORECAST_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def _present(entries: list[Column]) -> Column:
    """The entries that are not NULL, as an array."""
    return F.filter(F.array(*entries), lambda entry: entry.isNotNull())


def _day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def summary_lines(
    forecasts: DataFrame,
    accuracy: DataFrame | None = None,
    as_of: datetime | str = "1970-01-01T00:00:00Z",
    title: str = "Weekly Forecast Summary",
) -> DataFrame:
    """The text summary of every forecast, one row per line.

    The comparison block appears for series that have a matched row in
    ``accuracy``; it shows the one of the newest week.  Labels and number
    formats are fixed values.
    """
    ahead = forecasts.where(F.col("predicted_ili").isNotNull()).select(*FORECAST_COLUMNS)
    comparison = []
    if accuracy is not None:
        compared = ["week_start", "predicted_ili", "actual_ili", "deviation_pct"]
        matched = (
            accuracy.where(F.col("status") == "matched")
            .groupBy(SERIES)
            .agg(F.max(F.struct(*compared)).alias("prior"))
        )
        ahead = ahead.join(matched, SERIES, "left")
        # Concatenation with a missing prior is NULL, which drops the line.
        deviation = F.concat(fixed1(F.col("prior.deviation_pct")), F.lit("%"))
        known = F.col("prior").isNotNull()
        comparison = [
            F.when(known, F.lit("Prior Prediction Comparison:")),
            F.concat(F.lit("  Week: "), _day("prior.week_start")),
            F.concat(F.lit("  Predicted: "), fixed0(F.col("prior.predicted_ili"))),
            F.concat(F.lit("  Actual:    "), fixed0(F.col("prior.actual_ili"))),
            F.when(
                known, F.concat(F.lit("  Deviation: "), F.coalesce(deviation, F.lit("undefined")))
            ),
            F.when(known, F.lit("")),
        ]
    bounds = [fixed0(F.col("ci_lower")), F.lit(", "), fixed0(F.col("ci_upper"))]
    lines = _present(
        [
            F.lit(title),
            F.lit(f"Generated: {as_utc(as_of):%Y-%m-%d %H:%M:%S} UTC"),
            F.concat(F.lit("State: "), F.col(SERIES)),
            F.lit(""),
            *comparison,
            F.lit("Next Week Prediction:"),
            F.concat(F.lit("  Week Starting: "), _day(WEEK_START)),
            F.concat(F.lit("  Predicted ILI: "), fixed0(F.col("predicted_ili"))),
            F.concat(F.lit("  95% PI: ["), *bounds, F.lit("]")),
        ]
    )
    return ahead.select(SERIES, F.posexplode(lines).alias("line_no", "line"))


def chart_frame(
    panel: DataFrame,
    forecasts: DataFrame,
    accuracy: DataFrame | None = None,
    n: int = CHART_WEEKS,
) -> DataFrame:
    """The data of the forecast chart in long form, one layer per mark type.

    Each input is read once: the three marks of a comparison come out of one row.
    """
    none = F.lit(None).cast("double")

    def mark(layer: str, value: Column, lo: Column = none, hi: Column = none) -> Column:
        return F.struct(
            F.lit(layer).alias("layer"),
            F.col(WEEK_START).alias(WEEK_START),
            value.alias("value"),
            lo.alias("lo"),
            hi.alias("hi"),
        )

    def marks(df: DataFrame, *layers: Column) -> DataFrame:
        return df.select(SERIES, F.inline(F.array(*layers)))

    predicted, actual = F.col("predicted_ili"), F.col("actual_ili")
    chart = marks(newest_rows(panel, n), mark("history", F.col(TARGET))).unionByName(
        marks(
            forecasts.where(predicted.isNotNull()),
            mark("forecast", predicted, F.col("ci_lower"), F.col("ci_upper")),
        )
    )
    if accuracy is None:
        return chart
    both = marks(
        accuracy.where(F.col("status") == "matched"),
        mark("prior_forecast", predicted),
        mark("actual", actual),
        mark(
            "difference",
            actual - predicted,
            F.least(predicted, actual),
            F.greatest(predicted, actual),
        ),
    )
    return chart.unionByName(both)


def alert_outputs(accuracy: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Key/value rows for the scheduler; the key names are fixed values.

    Every comparison reports whether it alerts and the deviation; alerting
    ones add week, prediction and actual.  A comparison with an actual of zero
    has no deviation: it reports ``undefined`` and the same three.
    """
    compared = accuracy.where(F.col("status") == "matched")
    deviation = F.col("deviation_pct")
    undefined = deviation.isNull()
    alert = deviation > F.lit(threshold * 100)
    answer = F.when(undefined, "undefined").when(alert, "true").otherwise("false")

    def pair(key: str, value: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(key).alias("key"), value.alias("value")))

    told = undefined | alert
    pairs = _present(
        [
            pair("comparison_alert", answer, F.lit(True)),
            pair("comparison_week", _day(WEEK_START), told),
            pair("comparison_predicted", fixed0(F.col("predicted_ili")), told),
            pair("comparison_actual", fixed0(F.col("actual_ili")), told),
            pair("comparison_deviation_pct", fixed1(deviation), ~undefined),
        ]
    )
    return compared.select(SERIES, WEEK_START, F.inline(pairs))


def write_lines(
    lines: DataFrame, path: str, line: Column, order: list[str], per_series: bool
) -> None:
    """Text files with one line per row, in order within each series.

    ``per_series`` makes a folder for each series, which suits some hundreds of
    them; otherwise the files hold many series one after the other.  All lines
    of a series come out of one input row, hence sit in one task, so sorting
    there is enough.
    """
    text = (
        lines.select(SERIES, *order, line.alias("value"))
        .sortWithinPartitions(SERIES, *order)
        .select(SERIES, "value")
    )
    if per_series:
        text.write.mode("overwrite").partitionBy(SERIES).text(path)
    else:
        text.select("value").write.mode("overwrite").text(path)
