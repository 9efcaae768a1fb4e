"""Positional windows over series of any length.

``Window.partitionBy("series")`` puts a whole series into one task.  That is
right for weekly data with one row per week, where the calendar bounds a
series, and it needs a single shuffle.  A series that repeats weeks has no such
bound and may hold a large part of all rows; it is numbered and cut into
blocks here, each block carrying the rows before it that its windows look at.
The result is the same row for row.

``layout`` chooses between the two:

``series``  the caller knows that every series fits one task: with one row per
            week it cannot outgrow it, since dates span fewer than 522,000 weeks
``blocks``  the caller knows that they do not
``auto``    one aggregate finds the long series, and only those are cut
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schema import SERIES
from ..session import cut_lineage
from .order import oldest_first

SERIES_ROWS_PER_TASK = 1_000_000
BLOCK_ROWS = 50_000
LISTED_SERIES = 10_000  # so many names of long series may be broadcast

Step = Callable[[DataFrame], DataFrame]


def long_series(df: DataFrame) -> list:
    """Names of the series that do not fit one task, at most one over the limit."""
    sizes = df.groupBy(SERIES).agg(F.count(F.lit(1)).alias("rows"))
    long = sizes.where(F.col("rows") > SERIES_ROWS_PER_TASK).select(SERIES)
    return long.limit(LISTED_SERIES + 1).collect()


def settled(df: DataFrame, layout: str) -> str:
    """``series`` where ``auto`` would find nothing to cut in ``df``.

    For callers that apply several operators to the same series: measuring
    once spares each of them the aggregate.
    """
    return "series" if layout == "auto" and not long_series(df) else layout


def by_length(df: DataFrame, layout: str, whole: Step, cut: Step) -> DataFrame:
    """``whole`` for the series that fit one task, ``cut`` for the others."""
    if layout == "series":
        return whole(df)
    if layout == "blocks":
        return cut(df)
    if layout != "auto":
        raise ValueError(f"layout must be 'auto', 'series' or 'blocks', not {layout!r}")
    names = long_series(df)
    if not names:
        return whole(df)
    if len(names) > LISTED_SERIES:
        return cut(df)
    listed = F.broadcast(df.sparkSession.createDataFrame(names, df.select(SERIES).schema))
    return whole(df.join(listed, SERIES, "left_anti")).unionByName(
        cut(df.join(listed, SERIES, "left_semi"))
    )


def numbered_runs(df: DataFrame) -> DataFrame:
    """Equal rows collapsed to ``_copies``, with the zero-based position of the
    first copy in its series (``_first``) and the series length (``_total``).

    Rows are range-partitioned by the full order, a block's rows to a range, and
    carry their range's number; positions are then counted within a range and
    shifted by the ranges before it.  No task sees more than one range.
    """
    runs = cut_lineage(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")))
    n = max(1, math.ceil(runs.count() / BLOCK_ROWS))
    ranges = cut_lineage(
        runs.repartitionByRange(n, F.col(SERIES), *oldest_first(df)).withColumn(
            "_range", F.spark_partition_id()
        )
    )
    along = Window.partitionBy(SERIES).orderBy("_range")
    shifts = (
        ranges.groupBy(SERIES, "_range")
        .agg(F.sum("_copies").alias("_rows"))
        .select(
            SERIES,
            "_range",
            (F.sum("_rows").over(along) - F.col("_rows")).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(SERIES)).alias("_total"),
        )
    )
    inside = Window.partitionBy(SERIES, "_range").orderBy(*oldest_first(df))
    upto = F.sum("_copies").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("_upto", upto)
        .join(shifts, [SERIES, "_range"])
        .withColumn("_first", F.col("_before") + F.col("_upto") - F.col("_copies"))
        .drop("_range", "_upto", "_before")
    )


def spread(runs: DataFrame, history: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Runs -> rows with ``_block`` and ``_pos``.

    A row is copied into the following block when it is among the ``history``
    rows that come before it.  A long run of equal rows first becomes one piece
    per block and is unrolled only after the pieces are on their own tasks.
    """
    last = F.col("_first") + F.col("_copies") - 1
    blocks = F.sequence(
        F.floor(F.col("_first") / block_rows), F.floor((last + history) / block_rows)
    )
    start = F.col("_block") * block_rows
    own = F.sequence(
        F.greatest(F.col("_first"), start - history), F.least(last, start + block_rows - 1)
    )
    return (
        runs.withColumn("_block", F.explode(blocks))
        .repartition(SERIES, "_block")
        .withColumn("_pos", F.explode(own))
        .drop("_first", "_copies")
    )


def over_series(
    df: DataFrame,
    features: Callable[[WindowSpec], dict[str, Column]],
    history: int,
    layout: str = "auto",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``features``, which look back at most ``history`` rows.

    All columns share one window specification, hence one shuffle and one sort.
    """
    size = max(block_rows, history)

    def whole(part: DataFrame) -> DataFrame:
        made = features(Window.partitionBy(SERIES).orderBy(*oldest_first(part)))
        return part.select("*", *[c.alias(name) for name, c in made.items()])

    def cut(part: DataFrame) -> DataFrame:
        rows = spread(numbered_runs(part), history, size)
        made = features(Window.partitionBy(SERIES, "_block").orderBy("_pos"))
        return (
            rows.select("*", *[c.alias(name) for name, c in made.items()])
            .where(F.col("_pos") >= F.col("_block") * size)
            .select(*part.columns, *made)
        )

    return by_length(df, layout, whole, cut)
