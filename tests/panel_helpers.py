"""Rows and panels that several test modules build on."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np

from weekcast.schema import OBSERVATION


def sample_rows(series: str = "ca", n: int = 70) -> list[tuple]:
    """Weekly rows from 2023-01-02 with a seeded random target.

    Fixed values: the golden numbers of the tests belong to this recipe.
    """
    draw = np.random.RandomState(42)
    target = draw.randint(800, 3000, size=70).astype(float)[:n]
    days = [date(2023, 1, 2) + timedelta(weeks=i) for i in range(n)]
    return [
        (series, d, d.isocalendar()[1], float(y), float(y) * 20, 5.0) for d, y in zip(days, target)
    ]


def make_panel(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION)


def collected(df):
    """Rows as dicts, in a stable order."""
    return sorted((r.asDict() for r in df.collect()), key=str)
