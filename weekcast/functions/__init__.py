"""Column expressions; none of them needs Python at run time."""

from .dates import (
    epiweek_of,
    epiweek_to_date,
    following_week,
    mmwr_week_start,
    sunday_of,
    weeks_in_year,
)
from .numbers import clamp_at_zero, finite_double
from .text import fixed0, fixed1

__all__ = [
    "clamp_at_zero",
    "epiweek_of",
    "epiweek_to_date",
    "finite_double",
    "fixed0",
    "fixed1",
    "following_week",
    "mmwr_week_start",
    "sunday_of",
    "weeks_in_year",
]
