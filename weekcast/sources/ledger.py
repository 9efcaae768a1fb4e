"""The forecast ledger: every run appends its forecasts, reads rank them.

JSON lines or Parquet below one path, laid out by forecast week.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FORECAST_COLUMNS, LEDGER, SERIES, WEEK_START

CORRUPT = "_corrupt"
REQUIRED = ("week_start", "predicted_ili", "ci_lower", "ci_upper")

# Fixed value: the form of generated_at, always UTC.
_JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timeZone": "UTC"}


def as_utc(as_of: datetime | str) -> datetime:
    """The run's instant in UTC; a value without a zone is taken to be UTC."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    return as_of.replace(tzinfo=as_of.tzinfo or timezone.utc).astimezone(timezone.utc)


def ledger_rows(forecasts: DataFrame, as_of: datetime | str) -> DataFrame:
    """Forecasts as ledger rows.  Rows without a prediction are not forecasts."""
    made = f"{as_utc(as_of):%Y-%m-%dT%H:%M:%SZ}"
    return (
        forecasts.where(F.col("predicted_ili").isNotNull())
        .select(*FORECAST_COLUMNS)
        .withColumn("generated_at", F.lit(made).cast("timestamp"))
    )


def ledger_append(
    forecasts: DataFrame, path: str, as_of: datetime | str, fmt: str = "parquet"
) -> None:
    """Add one row per forecast."""
    writer = ledger_rows(forecasts, as_of).write.mode("append").partitionBy(WEEK_START)
    if fmt == "json":
        writer.options(ignoreNullFields="false", **_JSON_TIME).json(path)
    else:
        writer.format(fmt).save(path)


def read_ledger(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All ledger rows; an absent path is an empty ledger.

    Lines that are not JSON come back with only ``_corrupt`` filled.
    """
    schema = T.StructType([*LEDGER.fields, T.StructField(CORRUPT, T.StringType())])
    try:
        if fmt == "json":
            options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **_JSON_TIME}
            return spark.read.schema(schema).options(**options).json(path).select(*schema.names)
        stored = spark.read.schema(LEDGER).format(fmt).load(path)
        return stored.withColumn(CORRUPT, F.lit(None).cast("string")).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ledger_quarantine(ledger: DataFrame) -> DataFrame:
    """Rows that cannot count as a forecast: unreadable lines, most of which
    carry no series, and rows without one of the required fields.

    All columns are kept, because JSON is parsed only for the columns in use
    and a line counts as corrupt for those alone.
    """
    bad = F.col(CORRUPT).isNotNull()
    for name in REQUIRED:
        bad = bad | F.col(name).isNull()
    return ledger.where(bad)


def ledger_newest(ledger: DataFrame) -> DataFrame:
    """The newest row of every series, complete or not, with all columns.

    ``generated_at`` may be NULL and then ranks last; of equal instants the row
    with the latest week and the highest numbers is taken.  Spark cuts the rank
    to one row per series before the shuffle.
    """
    newest = Window.partitionBy(SERIES).orderBy(
        F.col("generated_at").desc_nulls_last(),
        *[F.col(c).desc_nulls_first() for c in REQUIRED],
    )
    ranked = ledger.where(F.col(SERIES).isNotNull()).withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def ledger_latest_valid(ledger: DataFrame | str, fmt: str = "parquet") -> DataFrame:
    """The newest row of every series, if that row is complete.

    ``ledger`` is a table or the path of one.  An incomplete newest row leaves
    the series without a forecast (cold start); older rows are not consulted.
    """
    if isinstance(ledger, str):
        ledger = read_ledger(SparkSession.active(), ledger, fmt)
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in ledger.columns else F.lit(False)
    newest = ledger_newest(ledger.select(*LEDGER.names, broken.alias("_broken")))
    return newest.where(~F.col("_broken")).dropna(subset=list(REQUIRED)).drop("_broken")


def ledger_errors(ledger: DataFrame) -> DataFrame:
    """``series, generated_at, error, record`` of the quarantined rows: what is
    wrong with each, and the line or the row as JSON."""
    missing = F.array_join(
        F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]), lambda c: c.isNotNull()), ", "
    )
    unreadable = F.col(CORRUPT).isNotNull()
    row = F.to_json(F.struct(*LEDGER.names), {"ignoreNullFields": "false"})
    return ledger_quarantine(ledger).select(
        SERIES,
        "generated_at",
        F.when(unreadable, "not a ledger line").otherwise(F.concat(F.lit("missing: "), missing)).alias("error"),
        F.when(unreadable, F.col(CORRUPT)).otherwise(row).alias("record"),
    )
