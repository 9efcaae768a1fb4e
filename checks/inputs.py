"""Panels, ledgers, payloads and forecasts derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekcast.functions import clamp_at_zero, epiweek_of, sunday_of
from weekcast.operators import (
    forecast_point_features,
    residual_interval,
    rolling_features,
    training_frame,
)
from weekcast.schema import LEDGER, SERIES, TARGET, WEEK_START
from weekcast.sources import payload_rows


# The columns in use; a given schema spares each read the inference job.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


BY_REGION = ("r_name",)
BY_SEGMENT = ("n_name", "c_mktsegment")


def weekly_panel(
    spark: SparkSession, sf_dir: str, key: tuple[str, ...] = BY_SEGMENT
) -> DataFrame:
    """One row per series and Sunday week: urgent orders, all orders, share.

    A series is a nation's market segment (125 of them), so that the panel grows
    with ``orders`` up to the calendar's bound; a week without orders has no row.
    """
    day = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        sunday_of(day).alias(WEEK_START),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    home = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.concat_ws("-", *key).alias(SERIES))
    )
    urgent, total = F.col(TARGET), F.col("total_patients")
    counted = (
        orders.join(home, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(SERIES, WEEK_START)
        .agg(
            F.sum("urgent").cast("double").alias(TARGET),
            F.count(F.lit(1)).cast("double").alias("total_patients"),
        )
    )
    week = F.year(WEEK_START) * 100 + F.floor((F.dayofyear(WEEK_START) - 1) / 7) + 1
    return counted.select(
        SERIES,
        WEEK_START,
        week.cast("int").alias("week"),
        TARGET,
        "total_patients",
        (F.lit(100) * urgent / total).alias("percent_ili"),
    )


def scored_frame(panel: DataFrame) -> DataFrame:
    """The training frame with the four-week mean as its prediction."""
    return training_frame(panel, layout="series").withColumn("prediction", F.col("roll_mean_4"))


def baseline_forecasts(panel: DataFrame) -> DataFrame:
    """Next week by the four-week mean, with the residual interval."""
    points = forecast_point_features(panel).select(
        SERIES, WEEK_START, F.col("roll_mean_4").alias("predicted_ili")
    )
    return residual_interval(scored_frame(panel), points)


def ledger(panel: DataFrame) -> DataFrame:
    """A ledger with every kind of series.

    Each week with a full four-week window gets the forecast mean ± 2 standard
    deviations, made the day before.  FURNITURE series also have a forecast for
    the week after their last one (pending), the newest rows of BUILDING lack a
    bound (invalid), MACHINERY has no rows (cold start), and MOON is a series
    that the panel lacks (no data).
    """
    segment = F.substring_index(SERIES, "-", -1)
    rolled = rolling_features(panel, windows=(4,), layout="series").where(
        F.col("roll_mean_4").isNotNull() & (segment != "MACHINERY")
    )
    mean, half = F.col("roll_mean_4"), 2 * F.col("roll_std_4")
    rows = rolled.select(
        SERIES,
        WEEK_START,
        mean.alias("predicted_ili"),
        clamp_at_zero(mean - half).alias("ci_lower"),
        (mean + half).alias("ci_upper"),
        F.date_sub(WEEK_START, 1).cast("timestamp").alias("generated_at"),
        F.max(WEEK_START).over(Window.partitionBy(SERIES)).alias("_last"),
    )
    newest = F.col(WEEK_START) == F.col("_last")
    ahead = rows.where(newest & segment.isin("FURNITURE", "BUILDING")).select(
        SERIES,
        F.date_add(WEEK_START, 7).alias(WEEK_START),
        "predicted_ili",
        F.when(segment == "FURNITURE", F.col("ci_lower")).alias("ci_lower"),
        "ci_upper",
        F.date_add(WEEK_START, 6).cast("timestamp").alias("generated_at"),
    )
    made = rows.select(*LEDGER.names)
    lost = made.where(F.col(SERIES) == "NATION_1-HOUSEHOLD").withColumn(SERIES, F.lit("MOON"))
    return made.unionByName(ahead).unionByName(lost)


def gappy_panel(panel: DataFrame) -> DataFrame:
    """The panel without a target in every twentieth epiweek, and in the newest
    row but one of AUTOMOBILE series."""
    recent = F.row_number().over(Window.partitionBy(SERIES).orderBy(F.desc(WEEK_START)))
    gone = (F.col("week") % 20 == 0) | (
        F.col(SERIES).endswith("AUTOMOBILE") & (F.col("_recent") == 2)
    )
    return (
        panel.withColumn("_recent", recent)
        .withColumn(TARGET, F.when(~gone, F.col(TARGET)))
        .drop("_recent")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event, as JSON text.

    Errors carry result -1, half of them without a message; cheap events carry
    no records; the others two, for the event's week and the one after.  Views
    give no dates, and counts above 95 are spelt out.
    """
    sunday = sunday_of(F.to_date("ts"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        sunday.alias("first"),
        F.date_add(sunday, 7).alias("second"),
    )
    dated = events.select(
        "*", epiweek_of(F.col("first")).alias("week_1"), epiweek_of(F.col("second")).alias("week_2")
    )
    k, value = F.col("k"), F.col("value")

    def record(day: str, week: str, factor: int) -> Column:
        return F.struct(
            F.when(F.col("event_type") != "view", F.col(day).cast("string")).alias("week_start"),
            F.col(week).alias("epiweek"),
            F.when(k > 95, "n/a").otherwise(k.cast("string")).alias("num_ili"),
            (k * 20 * factor).alias("num_patients"),
            value.alias("ili"),
        )

    records = F.when(value >= 1, F.array(record("first", "week_1", 1), record("second", "week_2", 2)))
    failed = F.col("event_type") == "error"
    envelope = F.struct(
        F.when(failed, -1).otherwise(1).alias("result"),
        F.when(failed & (value >= 10), "bad request").alias("message"),
        F.coalesce(records, F.array().cast(RECORDS)).alias("epidata"),
    )
    return dated.select(
        F.col("event_id").alias("payload_id"),
        F.col("event_type").alias(SERIES),
        F.to_json(envelope).alias("payload"),
    )


RECORDS = "array<struct<week_start:string,epiweek:int,num_ili:string,num_patients:int,ili:double>>"


def faulty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads' records with some that can't be read: clicks lack an
    epiweek or have one that is no number, purchases have a day that is none."""
    k = F.col("payload_id") % 50
    kind = F.col(SERIES)
    return payload_rows(payloads(spark, sf_dir)).withColumns(
        {
            "epiweek": F.when((kind == "click") & (k == 7), None)
            .when((kind == "click") & (k == 8), F.concat("epiweek", F.lit(".5")))
            .when((kind == "click") & (k == 9), F.concat(F.lit("week "), "epiweek"))
            .otherwise(F.col("epiweek")),
            "week_start": F.when((kind == "purchase") & (k == 11), "2024-02-30").otherwise(F.col("week_start")),
        }
    )


def epiweeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the epiweek of its date."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", epiweek_of(F.to_date("o_orderdate")).alias("epiweek")
    )


def repeating_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel that repeats weeks: one row per region, week, priority and segment.

    Many rows are equal in every column, and a series grows with ``orders``.
    """
    day = F.to_date("o_orderdate")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    home = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_mktsegment", F.col("r_name").alias(SERIES))
    )
    count = F.count(F.lit(1)).cast("double")
    return (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderpriority", sunday_of(day).alias(WEEK_START))
        .join(home, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(SERIES, WEEK_START, "o_orderpriority", "c_mktsegment")
        .agg(count.alias(TARGET))
        .select(
            SERIES,
            WEEK_START,
            epiweek_of(F.col(WEEK_START)).alias("week"),
            TARGET,
            (F.col(TARGET) * 20).alias("total_patients"),
            F.lit(5.0).alias("percent_ili"),
        )
    )
