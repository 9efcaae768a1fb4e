"""The one row order all positional operators share.

Weeks first, then the week label, then the measures, then whatever other
columns a frame has.  Only rows that are equal in every column are left tied,
and those are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import OBSERVATION_COLUMNS, SERIES


def order_columns(df: DataFrame) -> list[str]:
    observed = [c for c in OBSERVATION_COLUMNS if c in df.columns]
    return [c for c in dict.fromkeys([*observed, *df.columns]) if c != SERIES]


def oldest_first(df: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_columns(df)]


def newest_first(df: DataFrame) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in order_columns(df)]


def ranked_newest(df: DataFrame, n: int, name: str = "_rank") -> DataFrame:
    """The newest ``n`` rows of every series, numbered from 1.

    The limit on ``row_number`` is applied before the shuffle too, so a series
    of any length sends at most ``n`` rows per input task.
    """
    newest = Window.partitionBy(SERIES).orderBy(*newest_first(df))
    return df.withColumn(name, F.row_number().over(newest)).where(F.col(name) <= n)


def newest_rows(df: DataFrame, n: int) -> DataFrame:
    return ranked_newest(df, n).drop("_rank")
