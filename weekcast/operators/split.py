"""Chronological train / validation split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SERIES, TRAIN_SHARE, WEEK_START
from .blocks import by_length, numbered_runs, spread
from .order import oldest_first


def chronological_split(
    df: DataFrame,
    share: float = TRAIN_SHARE,
    scope: str = "series",
    layout: str = "auto",
) -> DataFrame:
    """Add ``split``: the first int(share * n) rows are ``train``, the rest
    ``validation``.

    ``scope="series"`` counts rows within each series.  ``scope="global"`` cuts
    every series at the same week, so that no series is trained on weeks that
    another is validated on; n is then the number of distinct weeks.
    """
    if scope == "global":
        return _split_by_week(df, share)

    def whole(part: DataFrame) -> DataFrame:
        all_rows = Window.partitionBy(SERIES)
        place = F.row_number().over(all_rows.orderBy(*oldest_first(part)))
        total = F.count(F.lit(1)).over(all_rows)
        return part.withColumn("split", _label(place <= _first_part(total, share)))

    def cut(part: DataFrame) -> DataFrame:
        train = F.col("_pos") < _first_part(F.col("_total"), share)
        rows = spread(numbered_runs(part))
        return rows.withColumn("split", _label(train)).select(*part.columns, "split")

    return by_length(df, layout, whole, cut)


def _first_part(total: Column, share: float) -> Column:
    return F.floor(total * F.lit(float(share)))


def _label(train: Column) -> Column:
    return F.when(train, "train").otherwise("validation")


def _split_by_week(df: DataFrame, share: float) -> DataFrame:
    """The cut is one date, a scalar subquery over the distinct weeks, which the
    calendar bounds."""
    weeks = df.select(WEEK_START).distinct()
    ordered = weeks.agg(F.sort_array(F.collect_list(WEEK_START)).alias("weeks"))
    kept = F.floor(F.size("weeks") * F.lit(float(share))).cast("int")
    cut = ordered.select(F.try_element_at("weeks", kept + 1)).scalar()
    return df.withColumn("split", _label(F.col(WEEK_START) < cut))
