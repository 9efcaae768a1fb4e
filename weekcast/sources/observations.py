"""Records -> typed weekly observations; scoping and coverage."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epiweek_to_date, finite_double
from ..schema import HISTORY_YEARS, OBSERVATION_COLUMNS, SERIES, TARGET, WEEK, WEEK_START


FAULT = "fault"
RECORD = ["week_start", "epiweek", "num_ili", "num_patients", "ili"]


def tagged_observations(raw: DataFrame) -> DataFrame:
    """Every payload record renamed and typed, with its ``fault`` (NULL if it has
    none) and the ``record`` as it came, in one pass without a shuffle.

    A record needs an epiweek that is a whole number (``202401.0`` is one), and a
    date that is given must be one; a cell that isn't is NULL.  The three
    measures are always lenient.  A record without a date gets it from its
    epiweek.  Columns of ``raw`` that are not part of a record are kept.
    """
    number = F.col("epiweek").try_cast("decimal(18,6)")
    week = F.when(number == F.floor(number), number).try_cast("int")
    given = F.col("week_start").try_cast("date")
    fault = F.when(
        week.isNull(), F.concat(F.lit("not an epiweek: "), F.coalesce("epiweek", F.lit("null")))
    ).when(
        F.col("week_start").isNotNull() & given.isNull(), F.concat(F.lit("not a date: "), F.col("week_start"))
    )
    named = raw.select(
        *[F.col(c) for c in raw.columns if c not in RECORD and c != SERIES],
        F.col(SERIES),
        given.alias(WEEK_START),
        week.alias(WEEK),
        finite_double(F.col("num_ili")).alias(TARGET),
        finite_double(F.col("num_patients")).alias("total_patients"),
        finite_double(F.col("ili")).alias("percent_ili"),
        fault.alias(FAULT),
        F.struct(*RECORD).alias("record"),
    )
    return named.withColumn(
        WEEK_START, F.coalesce(F.col(WEEK_START), epiweek_to_date(F.col(WEEK)))
    )


def observations(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rename and type the payload records.

    A record with a fault (see ``tagged_observations``) fails the job if
    ``strict``, else its faulty cell is NULL.
    """
    tagged = tagged_observations(raw)
    names = [SERIES, WEEK_START, WEEK, TARGET, "total_patients", "percent_ili"]
    names += [c for c in ("fetched_at",) if c in raw.columns]
    if strict:
        # In the columns that are cast, so that no projection drops the check.
        raised = F.raise_error(F.col(FAULT))
        tagged = tagged.withColumns(
            {c: F.when(F.col(FAULT).isNull(), F.col(c)).otherwise(raised) for c in (WEEK, WEEK_START)}
        )
    return tagged.select(*names)


def sound_observations(tagged: DataFrame, faulty: str = "series") -> DataFrame:
    """The rows of ``tagged_observations`` that a run can use.

    One bad record makes a fetch unusable, so with ``faulty="series"`` a series
    that has one is left out as a whole; with ``"record"`` only the record is.
    The other series don't notice either.
    """
    if faulty not in ("series", "record"):
        raise ValueError(f"faulty must be 'series' or 'record', not {faulty!r}")
    fine = tagged.where(F.col(FAULT).isNull())
    if faulty == "series":
        spoilt = tagged.where(F.col(FAULT).isNotNull()).select(SERIES).distinct()
        fine = fine.join(spoilt, fine[SERIES].eqNullSafe(spoilt[SERIES]), "left_anti")
    return fine.drop(FAULT, "record")


def observation_errors(tagged: DataFrame) -> DataFrame:
    """The faulty rows of ``tagged_observations``: what else the payload had
    (series, key, time of the fetch), the ``error`` and the ``record`` as JSON."""
    own = [c for c in tagged.columns if c not in (*OBSERVATION_COLUMNS, FAULT, "record")]
    as_json = F.to_json("record", {"ignoreNullFields": "false"})
    return tagged.where(F.col(FAULT).isNotNull()).select(
        SERIES, *own, F.col(FAULT).alias("error"), as_json.alias("record")
    )


def scope_filter(
    df: DataFrame, regions: str | Iterable[str], as_of: date | datetime | str
) -> DataFrame:
    """Rows of the wanted series from eight years before ``as_of`` to one year after.

    Both predicates compare a bare column with literals, so a Parquet scan
    prunes partitions on ``series`` and row groups on ``week``.
    """
    wanted = [regions] if isinstance(regions, str) else list(regions)
    year = int(as_of[:4]) if isinstance(as_of, str) else as_of.year
    first = (year - HISTORY_YEARS) * 100 + 1
    last = (year + 1) * 100 + 52
    return df.where(F.col(SERIES).isin(wanted) & F.col(WEEK).between(first, last))


def coverage_stats(df: DataFrame) -> DataFrame:
    """Rows, first and last week per series, plus what positional lags do not
    see: weeks that are missing and rows that repeat a week.

    Counting per week first keeps a long series spread over many tasks.
    """
    weeks = df.groupBy(SERIES, WEEK_START).agg(F.count(F.lit(1)).alias("rows"))
    span = F.floor(F.date_diff(F.max(WEEK_START), F.min(WEEK_START)) / 7) + 1
    return weeks.groupBy(SERIES).agg(
        F.sum("rows").alias("n_rows"),
        F.min(WEEK_START).alias("first_week"),
        F.max(WEEK_START).alias("last_week"),
        (span - F.count(WEEK_START)).cast("long").alias("missing_weeks"),
        (F.sum("rows") - F.count(F.lit(1))).alias("repeated_rows"),
        (span > F.count(WEEK_START)).alias("is_gap"),
    )
