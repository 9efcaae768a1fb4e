from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from weekcast.functions import (
    epiweek_of,
    epiweek_to_date,
    finite_double,
    fixed0,
    fixed1,
    following_week,
    mmwr_week_start,
    weeks_in_year,
)


def sunday_before(day: date) -> date:
    return day - timedelta(days=(day.weekday() + 1) % 7)


def leap(year: int) -> bool:
    return year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)


def dates(spark, epiweeks, fn):
    df = spark.createDataFrame([(w,) for w in epiweeks], "w int")
    return {r.w: r.d for r in df.select("w", fn(F.col("w")).alias("d")).collect()}


def test_epiweek_to_date_known_values(spark):
    want = {
        202352: date(2023, 12, 24),
        202401: date(2024, 1, 7),
        202402: date(2024, 1, 14),
        202452: date(2024, 12, 29),
        202501: date(2024, 12, 29),
        202053: date(2020, 12, 27),
        202101: date(2021, 1, 3),
        200152: date(2001, 12, 30),
        200201: date(2001, 12, 30),
    }
    assert dates(spark, want, epiweek_to_date) == want


def test_week_rules_over_four_centuries(spark):
    years = range(1900, 2301)
    weeks = [y * 100 + n for y in years for n in (1, 27, 52)]
    start, shifted = dates(spark, weeks, mmwr_week_start), dates(spark, weeks, epiweek_to_date)
    for w in weeks:
        year, number = divmod(w, 100)
        plain = sunday_before(date(year, 1, 4)) + timedelta(weeks=number - 1)
        prior = date(year - 1, 1, 1).weekday()
        late = prior == 6 or (leap(year - 1) and prior == 5)
        assert start[w] == plain
        assert shifted[w] == plain + timedelta(weeks=1 if late else 0)


def test_years_with_53_weeks(spark):
    df = spark.range(1997, 2027).select(
        F.col("id").cast("int").alias("y"), weeks_in_year(F.col("id").cast("int")).alias("n")
    )
    assert [r.y for r in df.orderBy("y").collect() if r.n == 53] == [1997, 2003, 2008, 2014, 2020, 2025]


def test_epiweek_of_inverts_week_start(spark):
    day = F.date_add(F.lit(date(1999, 1, 1)), F.col("id").cast("int"))
    df = spark.range(12000).select(day.alias("d"), epiweek_of(day).alias("w"))
    back = df.select("d", mmwr_week_start(F.col("w")).alias("start"))
    assert back.where(F.date_diff("d", "start").between(0, 6)).count() == 12000


@pytest.mark.parametrize(
    "week, strict, want",
    [
        (10, False, 11),
        (51, False, 52),
        (52, False, 1),
        (202401, False, 1),
        (202401, True, 2),
        (202352, True, 1),
        (202052, True, 53),
        (202053, True, 1),
        (9, True, 10),
        (52, True, 53),
    ],
)
def test_following_week(spark, week, strict, want):
    start = date(2020, 12, 20) if week < 100 else date(2000, 1, 2)
    df = spark.createDataFrame([(week, start)], "w int, d date")
    assert df.select(following_week(F.col("w"), F.col("d"), strict)).first()[0] == want


def test_number_texts_equal_python(spark):
    draw = random.Random(7)
    values = [k / 20 for k in range(400)] + [k / 2 for k in range(100)]
    values += [0.05, 0.15, 0.25, 0.35, 2.675, 1e-9, 99.95, 0.95, 1e9 + 0.25, 123456789.05]
    values += [draw.uniform(0, 10 ** draw.randint(0, 9)) for _ in range(4000)]
    values += [round(draw.uniform(0, 500), 2) for _ in range(4000)] + [-0.25, -3.35, -1.05]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for r in df.select("x", fixed0(F.col("x")).alias("a"), fixed1(F.col("x")).alias("b")).collect():
        assert r.b == f"{r.x:.1f}"
        if r.x >= 0:
            assert r.a == f"{r.x:.0f}"


def test_number_texts_of_null_are_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(df.select(fixed0(F.col("x")), fixed1(F.col("x"))).first()) == (None, None)


def test_finite_double_knows_one_missing_value(spark):
    texts = ["1.5", " 2 ", "1e3", "n/a", "", "NaN", "Infinity", "-inf", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(finite_double(F.col("t"))).collect()]
    assert got == [1.5, 2.0, 1000.0, None, None, None, None, None, None]
