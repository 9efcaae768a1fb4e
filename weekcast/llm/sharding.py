"""Shards of equal size by histogram sort.

Rows are ordered by a key, here the hash of the text, so that equal texts lie
side by side.  Candidate boundaries between shards are probed: every task
counts exactly the bytes it holds between neighbouring probes, and the sums
tell for each boundary which two probes it lies between.  New probes refine
that stretch until a boundary has the wanted bytes below it within the
tolerance.  Then every row's place is known and rows are exchanged once.

A boundary is put between two keys where that meets the tolerance.  Only a
group too large for it (one text that makes up a third of all rows) is cut
inside, by a hash of the row number.  Nothing but probes and their sums reaches
the driver, and no task ever holds a whole shard: a shard of many rows consists
of several ranges, and boundaries between them are found in the same way, by
rows below instead of bytes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import map_batches

TOLERANCE = 0.005  # of a shard's size
RANGE_ROWS = 500_000  # rows that one task sorts
PROBES = 24  # per boundary and round, fewer where there are many boundaries
POINTS = 50_000  # probes of all boundaries together
LEAST = -(1 << 63)

KEY, ROW, SIZE, RANGE = "_shard_key", "_shard_row", "_shard_size", "_shard_range"
Point = tuple[int, int]  # key, hashed row number; a boundary lies before it


@dataclass(frozen=True)
class Stretch:
    """Rows between two boundaries: bytes below it and in it, rows, its first and last row."""

    low: Point
    below: int
    size: int
    rows: int
    first: Point
    last: Point

    def probes(self, count: int = PROBES) -> list[Point]:
        """Between keys while it holds several, then between rows of one key."""
        (k0, r0), (k1, r1) = self.first, self.last
        if k0 != k1:
            return sorted({(k0 + max(1, (k1 - k0) * j // count), LEAST) for j in range(1, count + 1)})
        return sorted({(k0, r0 + max(1, (r1 - r0) * j // count)) for j in range(1, count + 1)})


def _places(points: list[Point], keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many of the sorted points are at or before each row."""
    point_keys = np.array([k for k, _ in points], np.int64)
    point_rows = np.array([r for _, r in points], np.int64)
    place = np.searchsorted(point_keys, keys, "left")
    upto = np.searchsorted(point_keys, keys, "right")
    for k in np.unique(place[upto > place]):
        same = (place == k) & (upto > k)
        end = upto[same][0]
        place[same] = k + np.searchsorted(point_rows[k:end], rows[same], "right")
    return place


def _placed(table: DataFrame, points: list[Point], wanted: list[int] | None = None) -> DataFrame:
    """``table`` with the range each row lies in; ``wanted`` ranges alone if given."""
    names = table.columns
    at = [names.index(KEY), names.index(ROW)]
    chosen = None if wanted is None else np.array(wanted)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _places(points, *(batch[n].to_numpy(zero_copy_only=False) for n in at))
            made = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int64())], names=[*names, RANGE]
            )
            yield made if chosen is None else made.filter(pa.array(np.isin(place, chosen)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return map_batches(table, step, f"{fields}, {RANGE} long")


def _histogram(
    table: DataFrame, points: list[Point], wanted: list[int] | None = None
) -> dict[int, tuple[int, int, Point, Point]]:
    """Exact bytes, rows, first and last row of each range between the points."""
    row = F.struct(KEY, ROW)
    summed = _placed(table.select(KEY, ROW, SIZE), points, wanted).groupBy(RANGE).agg(
        F.sum(SIZE).alias("size"), F.count(F.lit(1)).alias("rows"),
        F.min(row).alias("first"), F.max(row).alias("last"),
    )
    return {r[RANGE]: (r.size, r.rows, tuple(r.first), tuple(r.last)) for r in summed.collect()}


def splitters(table: DataFrame, targets: list[int], tolerances: list[int]) -> list[Point]:
    """For every target a boundary with that many bytes below it, give or take
    its tolerance, or the nearest there is."""
    whole = _histogram(table, [])[0]
    start = Stretch((LEAST, LEAST), 0, *whole)
    open_targets: dict[int, Stretch] = dict.fromkeys(range(len(targets)), start)
    found: dict[int, Point] = {}
    end: Point = ((1 << 63) - 1, (1 << 63) - 1)
    while open_targets:
        stretches = sorted(set(open_targets.values()), key=lambda s: s.low)
        each = max(2, min(PROBES, POINTS // len(stretches)))
        probed = {s: s.probes(each) for s in stretches}
        points = sorted({p for s in stretches for p in (s.low, *probed[s], _after(s.last))})
        number = {p: n + 1 for n, p in enumerate(points)}
        wanted = [number[p] for s in stretches for p in (s.low, *probed[s])]
        counted = _histogram(table, points, wanted)
        pieces: dict[Stretch, list[Stretch]] = {}
        for s in stretches:
            below, pieces[s] = s.below, []
            for low in (s.low, *probed[s]):
                piece = counted.get(number[low])
                if piece:
                    pieces[s].append(Stretch(low, below, *piece))
                    below += piece[0]
        for n, s in list(open_targets.items()):
            # Each piece's first row is where a boundary before the piece lies.
            edges = [(p.below, p.first) for p in pieces[s]]
            edges.append((s.below + s.size, _after(s.last)))
            best = min(edges, key=lambda e: (abs(e[0] - targets[n]), e[0]))
            inside = [p for p in pieces[s] if p.below < targets[n] < p.below + p.size]
            if abs(best[0] - targets[n]) <= tolerances[n] or not inside:
                found[n] = best[1]
            elif inside[0].first == inside[0].last:
                found[n] = best[1]
            else:
                open_targets[n] = inside[0]
                continue
            del open_targets[n]
    return [min(found[n], end) for n in range(len(targets))]


def _with_ranges(table: DataFrame, edges: list[Point], counted: dict, range_rows: int) -> list[Point]:
    """The edges of shards and, in shards of more than ``range_rows`` rows,
    boundaries that cut them into ranges of about equal rows."""
    targets, slack, below = [], [], 0
    for shard_number in range(len(edges) + 1):
        rows = counted[shard_number][1] if shard_number in counted else 0
        parts = max(1, -(-rows // range_rows))
        targets += [below + rows * n // parts for n in range(1, parts)]
        slack += [max(0, rows // parts // 4)] * (parts - 1)
        below += rows
    if not targets:
        return edges
    one = table.withColumn(SIZE, F.lit(1).cast("long"))
    return sorted([*edges, *(set(splitters(one, targets, slack)) - set(edges))])


def _shards_of(edges: list[Point], points: list[Point]) -> list[int]:
    """The shard of every range between ``points``.  Shards that are cut at one
    place are empty but the last."""
    edges = sorted(edges)
    return [bisect_right(edges, low) for low in [(LEAST, LEAST), *points]]


def _after(point: Point) -> Point:
    top = (1 << 63) - 1
    return (point[0], point[1] + 1) if point[1] < top else (min(point[0] + 1, top), LEAST)


def shard(
    rows: DataFrame,
    shards: int,
    key: Column,
    size: Column,
    tolerance: float = TOLERANCE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """All rows and columns of ``rows`` with ``shard`` (0 to ``shards`` - 1) and
    ``slot``, the row's place in its shard, gapless from 0.

    ``key`` is a long by which rows are ordered and grouped, ``size`` a long;
    null counts as 0 in both.  Sizes of shards differ by the tolerance on either
    side, or by one row where a row is larger than that; without any sizes all
    rows go to shard 0.  Repeated rows get a slot each.  An empty table gives an
    empty result.  Columns called ``shard`` or ``slot`` are replaced.

    ``rows`` is written to the shared folder first: rows are numbered there, and
    every round reads three narrow columns of that table.
    """
    spark = rows.sparkSession
    given = [c for c in rows.columns if c not in ("shard", "slot")]
    number = F.xxhash64(F.monotonically_increasing_id())
    zero = F.lit(0).cast("long")
    table = Scratch(spark, "shards").keep(
        rows.select(
            *given, F.coalesce(key, zero).alias(KEY), F.coalesce(size, zero).alias(SIZE)
        ).withColumn(ROW, number)
    )
    total, count = table.agg(F.sum(SIZE), F.count(F.lit(1))).first()
    edges: list[Point] = []
    if total:
        tight = int(total / shards * tolerance)
        edges = splitters(table, [total * n // shards for n in range(1, shards)], [tight] * (shards - 1))
    counted = _histogram(table, edges) if count else {}
    points = _with_ranges(table, edges, counted, range_rows)
    if len(points) > len(edges):
        counted = _histogram(table, points)
    before, seen, last = [], 0, 0
    for n, own in enumerate(_shards_of(edges, points)):
        seen, last = 0 if own != last else seen, own
        before.append((n, own, seen))
        seen += counted[n][1] if n in counted else 0
    # As many rows as there are ranges, whatever the documents hold.
    starts = spark.createDataFrame(before, f"{RANGE} long, shard int, _shard_before long")
    inside = Window.partitionBy(RANGE).orderBy(KEY, ROW)
    return (
        _placed(table, points)
        .withColumn("_shard_slot", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(starts), RANGE)
        .select(*given, "shard", (F.col("_shard_before") + F.col("_shard_slot")).alias("slot"))
    )
