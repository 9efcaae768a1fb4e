"""Numeric Column expressions that keep NULL the only missing value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_double(text: Column) -> Column:
    """Lenient number: unparseable, NaN and infinite text all become NULL.

    NaN sorts above every number, so one range test removes all three.
    """
    value = text.try_cast("double")
    return F.when((value > float("-inf")) & (value < float("inf")), value)


def clamp_at_zero(value: Column) -> Column:
    """max(0, value) that stays NULL for NULL (``greatest`` would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))
