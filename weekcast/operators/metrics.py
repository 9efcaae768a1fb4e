"""Regression metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, y: str, yhat: str, by: Sequence[str] = ("split",)
) -> DataFrame:
    """RMSE, R² (1 - SSres / SStot) and row count per group.

    Rows without a prediction do not count.  R² is NULL where the target does
    not vary.  All parts are partial sums, so a large group costs no shuffle.
    """
    actual, predicted = F.col(y), F.col(yhat)
    squared = F.pow(actual - predicted, 2)
    spread = F.regr_sxx(predicted, actual)
    return (
        df.where(actual.isNotNull() & predicted.isNotNull())
        .groupBy(*by)
        .agg(
            F.sqrt(F.avg(squared)).alias("rmse"),
            F.when(spread > 0, 1 - F.sum(squared) / spread).alias("r2"),
            F.count(F.lit(1)).alias("n"),
        )
    )
