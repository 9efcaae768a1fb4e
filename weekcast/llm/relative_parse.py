"""Duplicate passages by relative Lempel-Ziv parsing against the whole corpus.

The reference is the corpus itself, every document against those of smaller id.
It is indexed in blocks that lie in the partitions of two tables, and documents
are written as factors that point into it.

Phrases.  Every window of 50 words belongs to one of its 31 runs of 20 words,
the one with the least hash.  Neighbouring windows of one run are a phrase, 50
to 80 words that begin and end where the text itself says so.  The first index
has every distinct phrase with the smallest id it occurs in.  A phrase of a
document that has a smaller id there is matched as a whole, and phrases that
follow each other join into long factors.

Boundaries.  Where the words around a match differ, so do the phrases, and
windows at the ends of a factor would be missed.  They share their run of 20
words with another phrase.  So of every distinct phrase whose run occurs with
other phrases of other documents the single windows are looked up too, in the
second index: all such windows with the smallest id.

Phrases and windows are counted before they meet, a passage in a third of all
documents is one row of the index, and no group of documents is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, scratch
from .common import DOC_ID, SPACES, TEXT, map_batches, slices
from .exact_dedup import digest
from .rolling import RunHashes

WINDOW, GRAM = 50, 20
NO_ID = (1 << 63) - 1  # a document without an id comes after all others
AT_ONCE = 1 << 16

_PHRASES = "row long, id long, place long, gram long, one long, two long"
_WINDOWS = "one long, two long, phrase long, id long, at int"
_PRESSED = "id long, digest binary, data binary"
PRESSED_AT_ONCE = 2 << 20  # bytes of compressed texts that a task unpacks together
_FACTOR = "struct<start:long,words:long,source:long>"
_PARSED = f"digest binary, id long, n_words long, n_removed long, factors array<{_FACTOR}>, kept_sha256 string"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def owners(grams: np.ndarray, inside: int) -> np.ndarray:
    """For every window of ``inside`` neighbouring grams where its least one
    lies, the first of equal ones."""
    view = np.lib.stride_tricks.sliding_window_view(grams, inside)
    found = [view[i : i + AT_ONCE].argmin(axis=1) for i in range(0, len(view), AT_ONCE)]
    return np.concatenate(found) + np.arange(len(view))


def _pressed(texts: DataFrame) -> DataFrame:
    """The words of every text, compressed, for joins that move texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch):
                data = [press.compress(b" ".join(words_of(text))) for text in part[2].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part[0], part[1], pa.array(data, pa.binary())], names=["id", "digest", "data"]
                )

    return map_batches(texts, step, _PRESSED)


def _unpressed(column: pa.Array) -> Iterator[list[bytes]]:
    unpress = zstandard.ZstdDecompressor()
    for data in column:
        yield unpress.decompress(data.as_py()).split()


def _first_texts(docs: DataFrame) -> DataFrame:
    """``row, id, digest, data``: every distinct text with its smallest id."""
    ids = F.coalesce(DOC_ID, F.lit(NO_ID)).alias("id")
    texts = docs.select(ids, digest().alias("digest"), F.coalesce(TEXT, F.lit("")).alias("text"))
    least = texts.groupBy("digest").agg(F.min("id").alias("id"))
    firsts = _pressed(texts).join(least, ["digest", "id"], "left_semi").dropDuplicates(["digest"])
    return firsts.select(F.monotonically_increasing_id().alias("row"), "id", "digest", "data")


def _phrases(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """The phrases of every text: ``place`` is 64 times the first window's
    number plus the number of windows."""
    inside = window - gram + 1

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = RunHashes()
        for batch in batches:
            for part in slices(batch, PRESSED_AT_ONCE):
                made: list[tuple[np.ndarray, ...]] = []
                for row, number, words in zip(part[0].to_pylist(), part[1].to_pylist(), _unpressed(part[2])):
                    many = len(words) - window + 1
                    if many < 1:
                        continue
                    sums = hashing.sums(hashing.words(words))
                    at = np.arange(len(words) - gram + 1)
                    grams = hashing.runs(sums, at, at + gram, slice(0, 1))[:, 0]
                    owner = owners(grams, inside)
                    first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
                    count = np.diff(np.concatenate([first, [many]]))
                    whole = hashing.runs(sums, first, first + count + window - 1)
                    same = np.ones(len(first), np.int64)
                    made.append((row * same, number * same, first * 64 + count, grams[owner[first]].view(np.int64),
                                 whole[:, 0].view(np.int64), whole[:, 1].view(np.int64)))
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(column)) for column in zip(*made)],
                        names=["row", "id", "place", "gram", "one", "two"],
                    )

    return map_batches(texts.select("row", "id", "data"), step, _PHRASES)


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """The single windows of the phrases in ``wanted``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = RunHashes()
        for batch in batches:
            for part in slices(batch, PRESSED_AT_ONCE):
                made = []
                for words, wanted in zip(_unpressed(part[0]), part[1]):
                    place, phrase, number = (wanted.values.field(k).to_numpy() for k in range(3))
                    first, count = place >> 6, place & 63
                    sums = hashing.sums(hashing.words(words))
                    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start = np.repeat(first, count) + at
                    found = hashing.runs(sums, start, start + window).view(np.int64)
                    made.append((found[:, 0], found[:, 1], np.repeat(phrase, count),
                                 np.repeat(number, count), at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(column)) for column in zip(*made)],
                    names=["one", "two", "phrase", "id", "at"],
                )

    return map_batches(texts.select("data", "wanted"), step, _WINDOWS)


def _index(texts: DataFrame, phrases: DataFrame, window: int, work: Scratch) -> DataFrame:
    """``one, two, phrase, id, mask, source``: the distinct phrases that match
    for some document.  Documents after ``id`` match the whole phrase, the one
    with ``id`` itself the windows in ``mask``, found in ``source`` or before."""
    distinct = work.keep(
        phrases.groupBy("gram", "one", "two").agg(
            F.min("id").alias("id"), F.max("id").alias("last"),
            F.min_by("row", "id").alias("row"), F.min_by("place", "id").alias("place"),
        ).withColumn("phrase", F.monotonically_increasing_id())
    )
    # Written, so that the joins are dealt out anew and a hot key is split.
    varied = work.keep(
        distinct.groupBy("gram").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most").select("gram")
    )
    asked = work.keep(distinct.join(varied, "gram").select("row", F.struct("place", "phrase", "id").alias("want")))
    wanted = asked.groupBy("row").agg(F.collect_list("want").alias("wanted"))
    windows = work.keep(_windows(texts.select("row", "data").join(wanted, "row"), window))
    known = work.keep(
        windows.groupBy("one", "two").agg(F.min("id").alias("source"), F.max("id").alias("most"))
        .where("source < most").select("one", "two", "source")
    )
    masks = work.keep(
        windows.join(known, ["one", "two"]).where("source < id").groupBy("phrase").agg(
            F.sum(F.expr("shiftleft(1L, at)")).alias("mask"), F.min("source").alias("source")
        )
    )
    found = distinct.join(masks, "phrase", "left").where("id < last OR mask IS NOT NULL")
    return found.select("one", "two", "id", "mask", F.coalesce("source", "id").alias("source"))


def _matches(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """``row, matched``: the matched windows of every text that has any."""
    every = F.expr("shiftleft(1L, cast(place & 63 as int)) - 1")
    first = F.col("index.id")
    later = F.col("own.id") > first
    met = phrases.drop("gram").alias("own").join(index.alias("index"), ["one", "two"]).select(
        "row",
        F.shiftright("place", 6).alias("first"),
        F.when(later, every).otherwise(F.col("mask")).alias("mask"),
        F.when(later, first).otherwise(F.col("source")).alias("source"),
    )
    return met.where("mask IS NOT NULL").groupBy("row").agg(
        F.collect_list(F.struct("first", "mask", "source")).alias("matched")
    )


def factors_of(many: int, first: np.ndarray, mask: np.ndarray, source: np.ndarray, window: int) -> list[dict]:
    """The factors of a text with ``many`` windows: as long as the next window
    matches in the same source, the factor goes on."""
    at = np.full(max(0, many), -1, np.int64)
    for bit in range(int(mask.max(initial=0)).bit_length()):
        held = (mask >> bit) & 1 == 1
        at[first[held] + bit] = source[held]
    edge = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1, [len(at)]])
    return [
        {"start": a, "words": b - a + window - 1, "source": int(at[a])}
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())
        if b > a and at[a] >= 0
    ]


def _left(words: list[bytes], factors: list[dict]) -> bytes:
    """The words outside of all factors, with one space between them."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, [f["start"] for f in factors], 1)
    np.add.at(edges, [f["start"] + f["words"] for f in factors], -1)
    kept = (np.cumsum(edges[:-1]) == 0).tolist()
    return b" ".join([word for word, keep in zip(words, kept) if keep])


def _parsed(texts: DataFrame, window: int) -> DataFrame:
    """The factors of every text, and what they leave of it."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(),
                 "factors": pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "words", "source")])),
                 "kept_sha256": pa.string()}
        for batch in batches:
            for part in slices(batch, PRESSED_AT_ONCE):
                made = {name: [] for name in kinds}
                for words, matched in zip(_unpressed(part[2]), part[3]):
                    found: list[dict] = []
                    if matched.is_valid:
                        parts = (matched.values.field(k).to_numpy() for k in range(3))
                        found = factors_of(len(words) - window + 1, *parts, window)
                    rest = _left(words, found)
                    made["n_words"].append(len(words))
                    made["n_removed"].append(len(words) - len(rest.split()))
                    made["factors"].append(found)
                    made["kept_sha256"].append(sha256(rest).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part[0], part[1], *[pa.array(made[name], kind) for name, kind in kinds.items()]],
                    names=["digest", "id", *kinds],
                )

    return map_batches(texts.select("digest", "id", "data", "matched"), step, _PARSED)


def _by_text(docs: DataFrame, window: int, gram: int, work: Scratch) -> DataFrame:
    """The parse of every distinct text, for the document it occurs in first."""
    if not 0 < gram <= window or window - gram > 62:
        raise ValueError("a phrase holds up to 63 windows")
    with scratch(docs.sparkSession, "parse-steps") as steps:
        texts = steps.keep(_first_texts(docs))
        phrases = steps.keep(_phrases(texts, window, gram))
        index = steps.keep(_index(texts, phrases, window, steps))
        matches = steps.keep(_matches(phrases, index))
        return work.keep(_parsed(texts.join(matches, "row", "left"), window))


def _judged(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The parse of every row of ``docs``, with its digest.

    A row whose text another document of smaller id has too is one factor.
    """
    results = _by_text(docs, window, gram, Scratch(docs.sparkSession, "parse"))
    # Dealt by id first: the join then deals by digest in an exchange of its
    # own, whose partition of a hot text adaptive execution can split.
    ids = docs.select(DOC_ID, digest().alias("digest")).repartition(DOC_ID)
    copy = (F.coalesce(DOC_ID, F.lit(NO_ID)) > F.col("id")) & (F.col("n_words") >= window)
    start = F.lit(0).cast("long").alias("start")
    whole = F.array(F.struct(start, F.col("n_words").alias("words"), F.col("id").alias("source")))
    return ids.join(results, "digest").select(
        DOC_ID,
        "digest",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, whole).otherwise(F.col("factors")).alias("factors"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def parse(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, factors, kept_sha256``, a row for every row
    of ``docs``.

    ``factors`` are the parts of a document, ``words`` words from word ``start``
    on, that consist of windows of ``window`` words which also start in a
    document of smaller id; ``source`` is such a document's.  Factors are
    maximal for their source; they overlap where windows across their boundary
    match elsewhere.  ``kept_sha256`` is that of the words in no factor.

    Repeats within a document and among rows that share an id don't count, a
    missing id is larger than all others, and a null text is an empty one.
    Texts with fewer words than a window have no factors.  Other columns are
    neither read nor returned.
    """
    return _judged(docs, window, gram).drop("digest")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with all columns; texts that have factors lose them, and what is
    left of those has one space between words.  Nothing else changes."""
    mine = ["_parse_id", "_parse_digest", "_parse_factors"]
    found = _judged(docs, window, gram).where(F.size("factors") > 0).dropDuplicates([DOC_ID, "digest"])
    factors = found.select(*[F.col(c).alias(name) for c, name in zip((DOC_ID, "digest", "factors"), mine)])
    own = docs.withColumn("_digest_of_text", digest())
    same = [own[DOC_ID].eqNullSafe(factors[mine[0]]), own["_digest_of_text"] == factors[mine[1]]]
    inside = "exists(_parse_factors, f -> i >= f.start and i < f.start + f.words)"
    words = f"filter(regexp_extract_all({TEXT}, r'[^{SPACES}]+', 0), (w, i) -> not {inside})"
    left = F.when(F.col(mine[2]).isNotNull(), F.expr(f"array_join({words}, ' ')")).otherwise(F.col(TEXT))
    return own.join(factors, same, "left").withColumn(TEXT, left).select(*docs.columns)
