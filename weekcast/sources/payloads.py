"""JSON payload envelopes ``{result, message, epidata: [...]}``, one per line.

Lines keep the input splittable.  Both functions are stateless, so they take
streaming DataFrames as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PAYLOAD, SERIES

NO_DATA = "No data returned"
UNKNOWN = "unknown error"


def _problem(envelope: Column) -> Column:
    """Why an envelope is unusable, or NULL.  Unreadable JSON has no result."""
    refused = ~envelope["result"].eqNullSafe(F.lit(1))
    empty = F.coalesce(F.size(envelope["epidata"]), F.lit(0)) <= 0
    return F.when(refused, F.coalesce(envelope["message"], F.lit(UNKNOWN))).when(
        empty, F.lit(NO_DATA)
    )


def _from_envelope(col: str, use: Callable[[Column], Column]) -> Column:
    """An array with ``use(envelope)`` as its only element.

    Binding the envelope as a lambda variable keeps the parse single: a filter
    on a parsed column is pushed below the projection, and the text would be
    parsed once for every field the filter and the projection look at.
    """
    return F.transform(F.array(F.from_json(F.col(col), PAYLOAD)), use)


def payload_rows(payloads: DataFrame, col: str = "payload", strict: bool = False) -> DataFrame:
    """One row per record of every usable envelope; other columns are kept.

    Unusable envelopes give no rows and show up in ``payload_errors``.  With
    ``strict`` the first one fails the job instead.
    """
    kept = [F.col(c) for c in payloads.columns if c != col]

    def records(envelope: Column) -> Column:
        problem = _problem(envelope)
        usable = F.when(problem.isNull(), envelope["epidata"])
        return usable.otherwise(F.raise_error(problem)) if strict else usable

    return payloads.select(*kept, F.inline(F.flatten(_from_envelope(col, records))))


def payload_errors(
    payloads: DataFrame, col: str = "payload", key: str = "payload_id"
) -> DataFrame:
    """The unusable envelopes with the reason, for a quarantine table."""
    problems = F.filter(_from_envelope(col, _problem), lambda problem: problem.isNotNull())
    return payloads.select(F.col(key), F.explode(problems).alias("error"))


def newest_fetch(landed: DataFrame, col: str = "payload") -> DataFrame:
    """The newest envelope of every series in an append-only landing table.

    A fetch always carries the whole history, so the newest one replaces all
    earlier ones, revisions included; older envelopes are never parsed.  If the
    newest one is an error the series has no data, and ``payload_errors`` says
    why.  The maximum is taken in every task before the shuffle.
    """
    newest = F.max(F.struct("fetched_at", col)).alias("newest")
    return landed.groupBy(SERIES).agg(newest).select(SERIES, "newest.fetched_at", f"newest.{col}")
