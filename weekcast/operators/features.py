"""Lag, rolling, seasonal and trend features.

Positions, not dates: a lag of k is the k-th row before, also across a missing
week (``coverage_stats`` reports gaps).  No feature of a row sees its target.

``layout`` says how long a series may be, see ``operators.blocks``: any panel
aggregated by week may pass "series"; "auto" measures first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions import following_week
from ..functions.dates import week_number
from ..schema import (
    FEATURES,
    LAGS,
    OBSERVATION_COLUMNS,
    SEASON_WEEKS,
    SERIES,
    TARGET,
    TREND_SPAN,
    WEEK,
    WEEK_START,
    WINDOWS,
    YEAR_LAG,
)
from .blocks import over_series
from .order import ranked_newest

Y = TARGET


def _lags(w: WindowSpec, lags: Sequence[int]) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(Y, k).over(w) for k in lags}


def _rolling(w: WindowSpec, windows: Sequence[int]) -> dict[str, Column]:
    """Mean and sample deviation of the k rows before; NULL unless all k are there."""
    made = {}
    for k in windows:
        before = w.rowsBetween(-k, -1)
        full = F.count(Y).over(before) == k
        made[f"roll_mean_{k}"] = F.when(full, F.avg(Y).over(before))
        made[f"roll_std_{k}"] = F.when(full, F.stddev_samp(Y).over(before))
    return made


def _trend(w: WindowSpec) -> dict[str, Column]:
    return {"trend_4w": F.lag(Y, 1).over(w) - F.lag(Y, TREND_SPAN).over(w)}


def _season(week: Column, period: int = SEASON_WEEKS) -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * week / F.lit(period)
    return {"week_sin": F.sin(angle), "week_cos": F.cos(angle)}


def lag_features(
    df: DataFrame, lags: Sequence[int] = (*LAGS, YEAR_LAG), layout: str = "auto"
) -> DataFrame:
    """The target 1..8 and 52 rows back."""
    return over_series(df, lambda w: _lags(w, lags), max(lags), layout)


def rolling_features(
    df: DataFrame, windows: Sequence[int] = WINDOWS, layout: str = "auto"
) -> DataFrame:
    """Mean and sample deviation of the previous 2, 4, 8 and 12 rows."""
    return over_series(df, lambda w: _rolling(w, windows), max(windows), layout)


def trend_feature(df: DataFrame, layout: str = "auto") -> DataFrame:
    """The previous value less the value five rows back."""
    return over_series(df, _trend, TREND_SPAN, layout)


def seasonal_features(
    df: DataFrame, period: int = SEASON_WEEKS, strict: bool = False
) -> DataFrame:
    """Sine and cosine of the week's place in the year.

    ``week`` is used as it stands, also when it is YYYYWW; ``strict`` reduces
    it to the week number first.
    """
    week = week_number(F.col(WEEK)) if strict else F.col(WEEK)
    return df.withColumns(_season(week, period))


def training_frame(
    panel: DataFrame, layout: str = "auto", strict: bool = False
) -> DataFrame:
    """The panel with all 20 features; rows with any missing cell are dropped."""
    base = panel.select(*OBSERVATION_COLUMNS)
    made = over_series(
        base,
        lambda w: {**_lags(w, (*LAGS, YEAR_LAG)), **_rolling(w, WINDOWS), **_trend(w)},
        YEAR_LAG,
        layout,
    )
    return (
        seasonal_features(made, strict=strict)
        .select(*OBSERVATION_COLUMNS, *FEATURES)
        .dropna()
    )


def forecast_point_features(
    panel: DataFrame, mode: str = "parity", strict: bool = False, rows_name: str | None = None
) -> DataFrame:
    """One row per series: the features of the week after its newest row.

    ``rows_name`` adds a column with the rows found, at most 53: with fewer, the
    history is too short for all features.

    ``parity`` leaves the newest value out of the rolling windows and uses the
    population deviation, 0.0 when fewer than two values are left.
    ``consistent`` uses the windows of ``training_frame``.

    Only the newest 53 rows of a series travel; the group-by that folds them
    into one row reuses the window's partitioning.
    """
    if mode not in ("parity", "consistent"):
        raise ValueError(f"mode must be 'parity' or 'consistent', not {mode!r}")
    newest = ranked_newest(panel.select(*OBSERVATION_COLUMNS), YEAR_LAG + 1)
    rank, y = F.col("_rank"), F.col(Y)

    def nth(k: int) -> Column:
        return F.max(F.when(rank == k, y))

    made = {f"lag_{k}": nth(k) for k in (*LAGS, YEAR_LAG)}
    for k in WINDOWS:
        inside = rank.between(2, k + 1) if mode == "parity" else rank.between(1, k)
        value = F.when(inside, y)
        rows, known = F.count(F.when(inside, 1)), F.count(value)
        made[f"roll_mean_{k}"] = F.when(known == k, F.avg(value))
        if mode == "parity":
            made[f"roll_std_{k}"] = F.when(rows < 2, 0.0).when(known == rows, F.stddev_pop(value))
        else:
            made[f"roll_std_{k}"] = F.when(known == k, F.stddev_samp(value))
    made["trend_4w"] = nth(1) - nth(TREND_SPAN)
    folded = newest.groupBy(SERIES).agg(
        F.max(WEEK_START).alias("_last_start"),
        F.count(F.lit(1)).alias("_rows"),
        F.max(F.when(rank == 1, F.col(WEEK))).alias("_last_week"),
        *[c.alias(name) for name, c in made.items()],
    )
    upcoming = following_week(F.col("_last_week"), F.col("_last_start"), strict)
    found = [F.col("_rows").alias(rows_name)] if rows_name else []
    return folded.withColumns(_season(upcoming)).select(
        SERIES, F.date_add("_last_start", 7).alias(WEEK_START), *FEATURES, *found
    )
