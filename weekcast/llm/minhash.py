"""Near-duplicates by circulant MinHash.

Every distinct set of word shingles gets a signature of ``BANDS * ROWS``
coordinates from two permutations, the second of them shifted by one place more
for every coordinate.  Sets that agree in a band of coordinates are candidates:
at the threshold of 0.75 a pair shares no band with a probability of about
(1 - 0.75^6)^96 = 7e-9.

Candidates are confirmed on full sets.  In every band's bucket the first set is
the pivot, and sets are brought together with their pivots, each set once for
all buckets that have this pivot.  Inside such a bin an inverted index counts
the exact overlap of all sets that can still reach the threshold and reports
only links that join something new.  A bin larger than one task should hold is
cut into blocks that have the pivot each, which takes as many rows as there are
members; only members that their block doesn't join to the pivot meet the other
blocks as well.  So no link between components is missed, pairs are never rows,
and no task grows with a group.

Sets that are equal are one set from the start, so that a text that makes up a
third of all rows is compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, scratch
from .common import DOC_ID, map_batches, slices, whole_texts
from .components import components
from .exact_dedup import digest
from .rolling import RunHashes
from .shingles import WORDS, CirculantMinHash, band_keys, shingle_set

BANDS, ROWS = 96, 6
PERCENT = 75
BLOCK_SETS, BLOCK_SHINGLES = 512, 250_000
OVERLAPS_AT_ONCE = 2_000_000
KEY = "text_key"  # tells texts apart that share an id, null ids included

_DESCRIBED = "doc_id long, text_key binary, set_hash binary, n_shingles long, bands array<long>"


def _set_hash(shingles: np.ndarray) -> bytes | None:
    return blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def describe(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_key, set_hash, n_shingles, bands`` per row of ``docs``.

    A task gives the bands of a set with the first row that has it.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, runs = CirculantMinHash(bands * rows), RunHashes()
        seen: set[bytes | None] = {None}
        for batch in batches:
            for part in slices(batch):
                hashes, sizes, keys = [], [], []
                for text in part[1].to_pylist():
                    shingles = shingle_set(text, words, runs)
                    own = _set_hash(shingles)
                    hashes.append(own)
                    sizes.append(len(shingles))
                    keys.append(None)
                    if own not in seen:
                        seen.add(own)
                        keys[-1] = band_keys(hashing.signature(shingles), rows).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part[0], part[2], pa.array(hashes, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", KEY, "set_hash", "n_shingles", "bands"],
                )

    return map_batches(whole_texts(docs, digest().alias(KEY)), step, _DESCRIBED)


def _overlaps(own: np.ndarray, begin: np.ndarray, size: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """How many of the shingles ``own`` each of ``n`` sets holds."""
    total = np.zeros(n, np.int64)
    steps = np.searchsorted(np.cumsum(size[own]), np.arange(0, size[own].sum(), OVERLAPS_AT_ONCE))
    for some in np.split(own, steps[1:]):
        if len(some):
            sizes = size[some]
            at = np.arange(sizes.sum()) + np.repeat(begin[some] - np.cumsum(sizes) + sizes, sizes)
            total += np.bincount(owners[at], minlength=n)
    return total


def links_within(ids: np.ndarray, ends: np.ndarray, values: np.ndarray, percent: int = PERCENT) -> list[tuple]:
    """Links that join the sets of a bin as far as they reach the threshold.

    ``values[ends[i]:ends[i + 1]]`` is set i.  A set drops out beforehand if too
    few of its shingles occur in any other set of the bin, given the smallest
    size its partner can have.
    """
    n = len(ids)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(n), sizes)
    _, shingle = np.unique(values, return_inverse=True)
    shared = np.bincount(shingle)[shingle] > 1
    support = np.bincount(owner, weights=shared, minlength=n)
    # percent * |union| <= 100 * overlap, with |union| = both sizes - overlap
    partner = np.maximum(sizes.min(), sizes * percent / 100)
    alive = (100 + percent) * support >= percent * (sizes + partner)
    if alive.sum() < 2:
        return []
    keep = alive[owner] & shared
    owner, shingle = owner[keep], shingle[keep]
    order = np.argsort(shingle, kind="stable")
    owners = owner[order]
    size = np.bincount(shingle)
    begin = np.cumsum(size) - size
    first = np.searchsorted(owner, np.arange(n + 1))

    root = np.arange(n)
    found = []
    for x in np.flatnonzero(alive).tolist():
        if (root[alive] == root[x]).all():
            break
        overlap = _overlaps(shingle[first[x] : first[x + 1]], begin, size, owners, n)
        enough = 100 * overlap >= percent * (sizes + sizes[x] - overlap)
        for y in np.flatnonzero(enough & (root != root[x])).tolist():
            if root[y] != root[x]:
                found.append((int(ids[min(x, y)]), int(ids[max(x, y)])))
                low, high = sorted((root[x], root[y]))
                root[root == high] = low
    return found


def near_links(docs: DataFrame, described: DataFrame, work: Scratch, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``left, right``: rows of ``described`` (by ``row``) whose sets are linked,
    enough of them to connect whatever is connected.

    ``described`` is ``describe(docs)`` with a stable number ``row``.
    """
    hashed = described.where("n_shingles > 0")
    firsts = work.keep(
        hashed.groupBy("set_hash").agg(
            F.min(F.struct("row", DOC_ID, KEY, "n_shingles")).alias("first")
        ).select("set_hash", "first.*")
    )
    # Rows of equal sets are told apart here only by the task they come from.
    keyed = hashed.where("bands IS NOT NULL").select("row", F.explode("bands").alias("band"))
    # Written, so that the join with it is dealt out anew and a hot band is split.
    pivots = work.keep(
        keyed.groupBy("band").agg(F.min("row").alias("pivot"), F.max("row").alias("last"))
        .where("pivot < last").select("band", "pivot")
    )
    stars = work.keep(keyed.join(pivots, "band").where("pivot <> row").select("row", "pivot").distinct())
    of_set = work.keep(
        hashed.where("bands IS NOT NULL").select("row", "set_hash")
        .join(firsts.select("set_hash", F.col("row").alias("first")), "set_hash")
        .select("row", "first")
    )
    bins = work.keep(
        stars.join(of_set, "row").select("pivot", F.col("first").alias("row"))
        .join(of_set.withColumnRenamed("row", "pivot"), "pivot")
        .select(F.col("first").alias("pivot"), "row").where("pivot <> row").distinct()
    )
    wanted = bins.select("row").unionByName(bins.select(F.col("pivot").alias("row"))).distinct()
    sets = work.keep(_sets(docs, wanted.join(firsts, "row"), words))
    # Written, so that the join with it is dealt out anew and a hot pivot is split.
    parts = work.keep(
        bins.join(sets.select("row", "n_shingles"), "row").groupBy("pivot").agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
            ).cast("int").alias("parts")
        )
    )
    block = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("block")
    placed = work.keep(bins.join(parts, "pivot").select("pivot", "row", block, "parts"))

    # Every block of a bin with the pivot: as much work as there are members.
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block")
    with_pivot = placed.select("pivot", "block", "row").unionByName(
        parts.select("pivot", every, F.col("pivot").alias("row"))
    )
    first = work.keep(_confirmed(with_pivot.withColumn("guests", F.lit(0)), sets, percent))
    links = first.where("right IS NOT NULL").select("left", "right")
    if parts.where("parts > 1").isEmpty():
        return links

    # Members that their block doesn't join to the pivot meet the other blocks too.
    alone = first.where("right IS NULL").join(parts.where("parts > 1"), "pivot").select(
        "pivot", F.col("left").alias("row"), "parts"
    )
    alone = work.keep(alone)
    shares = work.keep(
        alone.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("shares"))
    )
    guest = alone.join(shares, "pivot").select(
        "pivot", "row", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("own"),
        F.pmod(F.xxhash64("row", F.lit(1)), F.col("shares")).cast("int").alias("guests"), "parts",
    )
    guest = guest.select("pivot", every, "row", "guests", "own").where("block <> own").drop("own")
    host = placed.join(shares, "pivot").select(
        "pivot", "block", "row", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("guests")
    )
    rest = _confirmed(host.unionByName(guest), sets, percent)
    return links.unionByName(rest.where("right IS NOT NULL").select("left", "right"))


def _joined_to(pivot: int, rows: np.ndarray, found: list[tuple]) -> set[int]:
    """The rows that links join to the pivot."""
    near: dict[int, list[int]] = {}
    for a, b in found:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    seen, open_ = {pivot}, [pivot]
    while open_:
        for other in near.get(open_.pop(), []):
            if other not in seen:
                seen.add(other)
                open_.append(other)
    return seen


def _confirmed(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pivot, left, right`` of the links among the rows of each block and its
    guests; members not joined to the pivot there have themselves as ``left``
    and no ``right``."""

    def confirm(table: pa.Table) -> pa.Table:
        lists = table["shingles"].combine_chunks()
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy()[ends[0] : ends[-1]]
        rows, pivot = table["row"].to_numpy(), table["pivot"][0].as_py()
        found = links_within(rows, ends - ends[0], values, percent)
        joined = _joined_to(pivot, rows, found)
        pairs = [*found, *[(row, None) for row in rows.tolist() if row not in joined]]
        columns = list(zip(*pairs)) or [(), ()]
        return pa.table([pa.array([pivot] * len(pairs), pa.int64()), *[pa.array(c, pa.int64()) for c in columns]],
                        names=["pivot", "left", "right"])

    rows = met.join(sets, "row").select("pivot", "block", "guests", "row", "shingles")
    schema = "pivot long, left long, right long"
    return rows.groupBy("pivot", "block", "guests").applyInArrow(confirm, schema)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``row, n_shingles, shingles`` of the wanted rows, from their texts again;
    cheaper than keeping the sets of all documents."""
    texts = whole_texts(docs, digest().alias(KEY))
    named = wanted.select(F.col(DOC_ID).alias("_id"), F.col(KEY).alias("_key"), "row")
    same = [texts[DOC_ID].eqNullSafe(named["_id"]), texts[KEY] == named["_key"]]
    asked = texts.join(named, same).select("text", "row")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of repeated rows a task gives one
        runs = RunHashes()
        for batch in batches:
            for part in slices(batch):
                rows, found = [], []
                for text, row in zip(part[0].to_pylist(), part[1].to_pylist()):
                    if row not in seen:
                        seen.add(row)
                        rows.append(row)
                        found.append(shingle_set(text, words, runs).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array([len(s) for s in found], pa.int64()),
                     pa.array(found, pa.list_(pa.int64()))],
                    names=["row", "n_shingles", "shingles"],
                )

    made = map_batches(asked, step, "row long, n_shingles long, shingles array<long>")
    return made.dropDuplicates(["row"])


def _grouped(docs: DataFrame, work: Scratch, words: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles`` per row of ``docs`` and ``first``, the
    ``doc_id``, ``row`` and ``text_key`` of the first row of its component: the
    least id, no id last, then the least row.  Null for a row without words.
    """
    described = work.keep(
        describe(docs, words).withColumn("row", F.monotonically_increasing_id())
    )
    with scratch(docs.sparkSession, "minhash-links") as steps:
        links = work.keep(near_links(docs, described, steps, words, percent))
        joined = work.keep(components(links, steps))
    narrow = described.select("row", DOC_ID, KEY, "set_hash", "n_shingles")
    rank = F.struct(F.col(DOC_ID).isNull().alias("no_id"), DOC_ID, "row", KEY)
    sets = narrow.where("n_shingles > 0").groupBy("set_hash").agg(
        F.min("row").alias("row"), F.min(rank).alias("least")
    )
    # The first row of a component, over all rows of all its sets.
    grouped = sets.join(joined.withColumnRenamed("node", "row"), "row", "left").select(
        "set_hash", "least", F.coalesce("component", "row").alias("component")
    )
    whole = work.keep(grouped.groupBy("component").agg(F.min("least").alias("first")))
    of_set = work.keep(grouped.join(whole, "component").select("set_hash", "first"))
    return narrow.join(of_set, "set_hash", "left").select(DOC_ID, KEY, "n_shingles", "first")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Two documents are linked if their sets have a Jaccard similarity of at least
    ``percent`` / 100; ``component_id`` is the smallest ``doc_id`` reachable.
    A document with fewer words than a shingle is one shingle; one without
    words, null included, is linked with nothing.  Rows that share a ``doc_id``
    are judged by their own texts, and of repeated rows each is kept or none.
    Other columns of ``docs`` are neither read nor returned.
    """
    work = Scratch(docs.sparkSession, "minhash")
    own = _grouped(docs, work, words, percent)
    component = F.coalesce("first.doc_id", F.col(DOC_ID))
    return own.select(
        DOC_ID,
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col(DOC_ID)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of the rows of a component exactly one stays, that with the least ``doc_id``
    (one without an id only if none has one) and then the least row; where
    several rows share its ``doc_id`` and text, any one of them does.  Rows
    without words all stay.
    """
    work = Scratch(docs.sparkSession, "minhash")
    own = _grouped(docs, work, words, percent).where(F.col("first").isNotNull())
    first = F.col(DOC_ID).eqNullSafe(F.col("first.doc_id")) & (F.col(KEY) == F.col(f"first.{KEY}"))
    gone = own.where(~first).select(F.col(DOC_ID).alias("_gone_id"), F.col(KEY).alias("_gone_key"))
    again = work.keep(
        own.where(first).groupBy(F.col(DOC_ID).alias("_again_id"), F.col(KEY).alias("_again_key"))
        .count().where("count > 1").drop("count")
    )
    mine = ["_near_id", "_near_key"]

    def same(rows: DataFrame, keys: DataFrame) -> list:
        one, two = keys.columns
        return [rows[mine[0]].eqNullSafe(keys[one]), rows[mine[1]] == keys[two]]

    marked = docs.withColumns({mine[0]: F.col(DOC_ID), mine[1]: digest()})
    gone = gone.distinct()
    left = marked.join(gone, same(marked, gone), "left_anti")
    if not again.isEmpty():
        one = left.join(again, same(left, again), "left_semi").dropDuplicates(mine)
        left = left.join(again, same(left, again), "left_anti").unionByName(one)
    return left.select(*docs.columns)
