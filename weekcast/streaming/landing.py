"""Scheduled fetch as a file stream: each run takes what has landed since.

A landed file holds one JSON line per fetch: ``{series, fetched_at, payload}``
with the payload envelope as text.  Envelopes are appended to the landing table
as they are, refused ones included; ``sources.payloads.newest_fetch`` picks the
newest of each series and only those are parsed.  Nothing is kept as state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

LANDED = "series string, fetched_at timestamp, payload string"


def payload_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).json(landing)
    )


def land_payloads(
    spark: SparkSession, landing: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Append all new envelopes to ``table`` and stop.

    The file sink commits each batch once, so a lost executor or a restarted
    run neither drops nor repeats envelopes.
    """
    return (
        payload_stream(spark, landing)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def landed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Envelopes from landed files, or from the table that ``land_payloads`` fills."""
    return spark.read.schema(LANDED).format(fmt).load(path)
