"""Epidemiological (Sunday-start) week arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUNDAY = 1  # as numbered by dayofweek()


def sunday_of(day: Column) -> Column:
    """The Sunday that opens the week ``day`` lies in."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def _year_and_number(epiweek: Column) -> tuple[Column, Column]:
    whole = epiweek.cast("int")
    return F.floor(whole / 100).cast("int"), F.pmod(whole, F.lit(100))


def mmwr_week_start(epiweek: Column) -> Column:
    """YYYYWW -> first day; week 1 is the week that contains January 4."""
    year, number = _year_and_number(epiweek)
    return F.date_add(sunday_of(_day(year, 1, 4)), (number - 1) * 7)


def epiweek_to_date(epiweek: Column) -> Column:
    """YYYYWW -> first day by the source's rule.

    The rule moves a whole year one week later when the year before it either
    begins or ends on a Sunday, so two epiweeks can share a date (202452 and
    202501).  ``mmwr_week_start`` is the calendar without that shift.
    """
    before = F.floor(epiweek.cast("int") / 100).cast("int") - 1
    sunday_edge = (F.dayofweek(_day(before, 1, 1)) == SUNDAY) | (
        F.dayofweek(_day(before, 12, 31)) == SUNDAY
    )
    return F.date_add(mmwr_week_start(epiweek), F.when(sunday_edge, 7).otherwise(0))


def epiweek_of(day: Column) -> Column:
    """Date -> YYYYWW; the inverse of ``mmwr_week_start``.

    The Wednesday decides which year a week belongs to: a week with four or
    more January days is week 1.
    """
    first = sunday_of(day)
    year = F.year(F.date_add(first, 3))
    since = F.date_diff(first, sunday_of(_day(year, 1, 4)))
    return (year * 100 + F.floor(since / 7).cast("int") + 1).cast("int")


def weeks_in_year(year: Column) -> Column:
    """52 or 53."""
    span = F.date_diff(sunday_of(_day(year + 1, 1, 4)), sunday_of(_day(year, 1, 4)))
    return F.floor(span / 7).cast("int")


def following_week(week: Column, week_start: Column, strict: bool = False) -> Column:
    """Week index used for the seasonal features of the next, unseen week.

    Default: ``week`` is taken as it stands and everything from 52 on wraps to
    1, which for YYYYWW values means always 1.  ``strict`` works on the week
    number within the year and wraps after the year's true last week.
    """
    if not strict:
        return F.when(week >= 52, F.lit(1)).otherwise(week + 1)
    number = week_number(week)
    year = F.when(week > 99, F.floor(week / 100).cast("int")).otherwise(
        F.year(F.date_add(sunday_of(week_start), 3))
    )
    return F.when(number >= weeks_in_year(year), F.lit(1)).otherwise(number + 1)


def week_number(week: Column) -> Column:
    """1..53 from either a plain week number or YYYYWW."""
    return F.when(week > 99, F.pmod(week, F.lit(100))).otherwise(week)
