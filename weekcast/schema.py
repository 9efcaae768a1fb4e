"""Column names, row types and the fixed feature list.

Every table is a *panel*: many weekly series in one DataFrame, told apart by
``series``.  A panel that holds one series is the single-series case.
"""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = "series"
WEEK_START = "week_start"
WEEK = "week"
TARGET = "ilitotal"

OBSERVATION = T.StructType(
    [
        T.StructField(SERIES, T.StringType()),
        T.StructField(WEEK_START, T.DateType()),
        T.StructField(WEEK, T.IntegerType()),
        T.StructField(TARGET, T.DoubleType()),
        T.StructField("total_patients", T.DoubleType()),
        T.StructField("percent_ili", T.DoubleType()),
    ]
)
OBSERVATION_COLUMNS = OBSERVATION.fieldNames()

# Everything inside a record is read as text, so that the casts in
# ``sources.observations`` are the only place where values are interpreted.
PAYLOAD = T.StructType(
    [
        T.StructField("result", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField(
            "epidata",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("week_start", T.StringType()),
                        T.StructField("epiweek", T.StringType()),
                        T.StructField("num_ili", T.StringType()),
                        T.StructField("num_patients", T.StringType()),
                        T.StructField("ili", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

FORECAST = T.StructType(
    [
        T.StructField(SERIES, T.StringType()),
        T.StructField(WEEK_START, T.DateType()),
        T.StructField("predicted_ili", T.DoubleType()),
        T.StructField("ci_lower", T.DoubleType()),
        T.StructField("ci_upper", T.DoubleType()),
    ]
)
FORECAST_COLUMNS = FORECAST.fieldNames()

LEDGER = T.StructType([*FORECAST.fields, T.StructField("generated_at", T.TimestampType())])

# The shape of the feature set.
LAGS = (1, 2, 3, 4, 5, 6, 7, 8)
WINDOWS = (2, 4, 8, 12)
YEAR_LAG = 52
TREND_SPAN = 5
SEASON_WEEKS = 52
RESIDUAL_ROWS = 30
INTERVAL = (0.025, 0.975)
TRAIN_SHARE = 0.8
CHART_WEEKS = 52
ALERT_THRESHOLD = 0.2
HISTORY_YEARS = 8

LAG_FEATURES = [f"lag_{k}" for k in LAGS]
ROLLING_FEATURES = [f"roll_{stat}_{k}" for k in WINDOWS for stat in ("mean", "std")]
SEASON_FEATURES = ["week_sin", "week_cos"]
FEATURES = [*LAG_FEATURES, *ROLLING_FEATURES, *SEASON_FEATURES, f"lag_{YEAR_LAG}", "trend_4w"]
