"""Runs that take effect all at once, and a ledger whose state stays small.

Below one path::

    runs/<run>/ledger      the forecasts a run made
    runs/<run>/<output>    what else it published
    state/<run>            the newest ledger row of every series, up to some run
    commits/<number>.json  which state, and which runs after it, count

A run writes into a folder of its own.  It counts when the next commit file
names it; that file appears by one rename, so outputs and ledger are published
together or not at all.  A run that stops before leaves a folder that nothing
reads, and is run again.  Of two runs that started from the same commit one
finds its number taken and fails.

Readers take the last commit.  The ledger's state is then its snapshot and the
few runs since, whatever the length of the history; every so many runs they are
folded into a new snapshot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LEDGER
from ..session import names_in, publish_text, read_text
from .ledger import CORRUPT, as_utc, ledger_errors, ledger_latest_valid, ledger_newest, ledger_rows

RUNS_BETWEEN_SNAPSHOTS = 16


class TakenError(RuntimeError):
    """Another run committed first; start again from its commit."""


class Commit(NamedTuple):
    number: int = 0  # before the first one
    run: str | None = None
    as_of: str | None = None
    outputs: tuple[str, ...] = ()  # tables of the run besides its ledger rows
    state: str | None = None
    since: tuple[str, ...] = ()  # runs with forecasts that the state doesn't hold


class RunLog:
    """The runs below ``path``, in any store that Hadoop's file systems reach."""

    def __init__(self, spark: SparkSession, path: str, snapshot_every: int = RUNS_BETWEEN_SNAPSHOTS):
        self.spark, self.path, self.snapshot_every = spark, path.rstrip("/"), snapshot_every

    def _numbers(self) -> list[int]:
        names = names_in(self.spark, f"{self.path}/commits")
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())

    def _file(self, number: int) -> str:
        return f"{self.path}/commits/{number:010d}.json"

    def _publish(self, commit: Commit) -> None:
        """The commit's file under its number, unless there is one already."""
        if not publish_text(self.spark, self._file(commit.number), json.dumps(commit._asdict())):
            raise TakenError(f"commit {commit.number} of {self.path} is taken")

    def commit(self, number: int | None = None) -> Commit:
        """The last commit, or the one of that number; number 0 if there is none."""
        if number is None:
            number = max(self._numbers(), default=0)
        if number == 0:
            return Commit()
        found = json.loads(read_text(self.spark, self._file(number)))
        return Commit(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})

    def commits(self) -> list[Commit]:
        return [self.commit(n) for n in self._numbers()]

    def output(self, name: str, commit: Commit | None = None) -> DataFrame | None:
        """A table that the last run published; None if it published none of that name."""
        commit = commit or self.commit()
        if name not in commit.outputs:
            return None
        return self.spark.read.parquet(f"{self.path}/runs/{commit.run}/{name}")

    def _ledgers(self, runs: tuple[str, ...], state: str | None = None) -> DataFrame:
        paths = [f"{self.path}/runs/{run}/ledger" for run in runs]
        paths += [f"{self.path}/state/{state}"] if state else []
        if not paths:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*paths)

    def newest(self, commit: Commit | None = None) -> DataFrame:
        """The newest ledger row of every series, complete or not.  Reads the
        snapshot and the runs since."""
        commit = commit or self.commit()
        return ledger_newest(self._ledgers(commit.since, commit.state))

    def latest_valid(self, commit: Commit | None = None) -> DataFrame:
        """As ``ledger_latest_valid`` over all history."""
        commit = commit or self.commit()
        return ledger_latest_valid(self._ledgers(commit.since, commit.state))

    def history(self) -> DataFrame:
        """All ledger rows of all runs that count, none of those that don't."""
        return self._ledgers(tuple(c.run for c in self.commits() if c.run and "ledger" in c.outputs))

    def errors(self, commit: Commit | None = None) -> DataFrame:
        """What is wrong with newest rows that cannot count as a forecast."""
        return ledger_errors(self.newest(commit).withColumn(CORRUPT, F.lit(None).cast("string")))

    def publish(
        self,
        tables: Mapping[str, DataFrame],
        as_of: datetime | str,
        forecasts: DataFrame | None = None,
        after: Commit | None = None,
    ) -> Commit:
        """Write a run's tables and the ledger rows of its forecasts, then make
        them count together, as the next commit after ``after``."""
        rows = None if forecasts is None else ledger_rows(forecasts, as_of)
        return self.publish_rows(tables, as_of, rows, after)

    def publish_rows(
        self,
        tables: Mapping[str, DataFrame],
        as_of: datetime | str,
        rows: DataFrame | None = None,
        after: Commit | None = None,
    ) -> Commit:
        """As ``publish``, with rows that have their ``generated_at``."""
        before = after or self.commit()
        made = as_utc(as_of)
        run = f"{made:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        for name, table in tables.items():
            table.write.parquet(f"{self.path}/runs/{run}/{name}")
        outputs, since, state = tuple(tables), before.since, before.state
        if rows is not None:
            rows.select(*LEDGER.names).write.parquet(f"{self.path}/runs/{run}/ledger")
            outputs, since = (*outputs, "ledger"), (*since, run)
        if len(since) >= self.snapshot_every:
            folded = ledger_newest(self._ledgers(since, state))
            folded.write.parquet(f"{self.path}/state/{run}")
            since, state = (), run
        commit = Commit(before.number + 1, run, f"{made:%Y-%m-%dT%H:%M:%SZ}", outputs, state, since)
        self._publish(commit)
        return commit
