"""Ranked lexical search by dense blocked matrix products.

The items (queries) give a compact vocabulary.  One pass over the texts keeps,
of every document, its length and how often it holds each term of the
vocabulary; sums over these give the weights.  Then tiles of documents, as dense
matrices of impacts, are multiplied by tiles of items, as dense matrices of
weights.  Impacts and weights are whole numbers in float64, and a tile has so
few terms that every partial sum stays below 2^53: the products are exact.
A task keeps the best rows of each item, by score and then by id, and the best
of all tasks are ranked in two steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, scratch
from .common import DOC_ID, TEXT, map_batches, slices, whole_texts

BEST = 50
IMPACT = 1_000_000  # above every impact
EXACT = 1 << 53
TILE_TERMS, TILE_DOCUMENTS = 1024, 1024
GROUP_TERMS = 500_000  # items whose terms, counted by item, are at the driver at once
SALTS = 256

_OUT = "item int, item_id long, doc_id long, score long"

#: ASCII letters and digits stay, as does all that isn't ASCII; A-Z are lowered.
_FOLD = bytes(
    c if c >= 0x80 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() else 0x20
    for c in range(256)
)


def terms(text: str) -> list[bytes]:
    """All terms of a text, in order, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item_id, terms``: the distinct terms of every item that has any."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch[1].to_pylist()]
            whole = pa.RecordBatch.from_arrays(
                [batch[0], pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"]
            )
            yield whole.filter(pa.array([bool(f) for f in found], pa.bool_()))

    rows = items.select(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit("")))
    return map_batches(rows, step, "item_id long, terms array<binary>")


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times`` of every document with a term: its length in
    terms, and of the vocabulary's terms in it the places and the counts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, size = vocabulary.get, len(vocabulary)
        for batch in batches:
            for part in slices(batch):
                lengths, found = [], []
                for text in part[1].to_pylist():
                    words = terms(text)
                    lengths.append(len(words))
                    found.append(np.fromiter((place(w, -1) for w in words), np.int64, len(words)))
                length = np.array(lengths, np.int64)
                owner = np.repeat(np.arange(len(found)), length)
                places = np.concatenate([*found, np.zeros(0, np.int64)])
                known = places >= 0
                both, times = np.unique(owner[known] * size + places[known], return_counts=True)
                ends = np.searchsorted(both, np.arange(len(found) + 1) * size).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                    for values in ((both % max(1, size)).astype(np.int32), times.astype(np.int64))
                ]
                whole = pa.RecordBatch.from_arrays(
                    [part[0], pa.array(length), *lists], names=["doc_id", "n", "terms", "times"]
                )
                yield whole.filter(pa.array(length > 0))

    return map_batches(
        whole_texts(docs), step, "doc_id long, n long, terms array<int>, times array<long>"
    )


def _counts(postings: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary; summed by task first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch[0].flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "documents"]
        )

    parts = map_batches(postings.select("terms"), step, "term int, documents long")
    counts = np.zeros(size, np.int64)
    for row in parts.groupBy("term").agg(F.sum("documents").alias("documents")).collect():
        counts[row.term] = row.documents
    return counts


class Corpus(NamedTuple):
    documents: int  # N, those with a term
    terms: int  # L, of all documents, with repeats


def weight(corpus: Corpus, holding: int) -> int:
    return math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * holding + 1)))


@dataclass(frozen=True)
class Tile:
    """Some items: for each chunk of their vocabulary the terms' places in the
    whole vocabulary and a matrix of weights, terms by items."""

    items: list[int]
    chunks: list[tuple[np.ndarray, np.ndarray]]


def tiles(wanted: list[list[int]], weights: np.ndarray, tile_terms: int = TILE_TERMS) -> list[Tile]:
    """Items are taken in turn as long as their joint vocabulary is small; an
    item with more terms than a tile holds has several chunks."""
    heaviest = int(weights.max(initial=1)) or 1
    at_once = max(1, min(tile_terms, (EXACT - 1) // (heaviest * IMPACT)))
    made: list[Tile] = []
    items: list[int] = []
    together: set[int] = set()

    def close() -> None:
        if items:
            order = np.array(sorted(together), np.int64)
            chunks = []
            for at in range(0, len(order), at_once):
                some = order[at : at + at_once]
                held = np.stack([np.isin(some, wanted[i]) for i in items], axis=1)
                chunks.append((some, held * weights[some, None].astype(np.float64)))
            made.append(Tile(items.copy(), chunks))
            items.clear()
            together.clear()

    for item, own in enumerate(wanted):
        if len(together.union(own)) > at_once:
            close()
        items.append(item)
        together.update(own)
    close()
    return made


def impacts(times: np.ndarray, lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Of each count of a term in a document of that length."""
    if 50 * int(lengths.max(initial=0)) * corpus.documents < 1 << 63:
        m = 50 + 50 * lengths * corpus.documents // corpus.terms
    else:
        m = np.array([50 + 50 * n * corpus.documents // corpus.terms for n in lengths.tolist()], np.int64)
    return 1_000_000_000 * times // (1000 * times + 20 * m)


class Best:
    """The best documents of some items so far: the highest scores above 0, of
    equal ones the smallest ids, no id last."""

    def __init__(self, items: int, best: int):
        self.best = best
        self.least = np.zeros(items, np.int64)  # no lower score gets in
        none = np.zeros(0, np.int64)
        self.rows = [(none, none, np.zeros(0, bool)) for _ in range(items)]

    def take(self, at: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores`` of the items from ``at`` on: documents by items."""
        enter = (scores > 0) & (scores >= self.least[at : at + scores.shape[1]])
        for column in np.flatnonzero(enter.any(axis=0)).tolist():
            some, item = enter[:, column], at + column
            whole = [
                np.concatenate(pair)
                for pair in zip(self.rows[item], (scores[some, column], ids[some], no_id[some]))
            ]
            order = np.lexsort((whole[1], whole[2], -whole[0]))[: self.best]
            self.rows[item] = tuple(values[order] for values in whole)
            if len(order) == self.best:
                self.least[item] = self.rows[item][0][-1]


def _candidates(postings: DataFrame, made: list[Tile], ids: list[int | None], corpus: Corpus, size: int, best: int) -> DataFrame:
    """The best documents of each item in each task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = [item for tile in made for item in tile.items]
        found = Best(len(order), best)
        spots = []  # of every chunk, the column of each term of the vocabulary
        for tile in made:
            for some, _ in tile.chunks:
                spot = np.full(size, -1, np.int32)
                spot[some] = np.arange(len(some))
                spots.append(spot)
        for whole in batches:
            for start in range(0, whole.num_rows, TILE_DOCUMENTS):
                batch = whole.slice(start, TILE_DOCUMENTS)
                term = batch[2].flatten().to_numpy()
                owner = np.repeat(np.arange(batch.num_rows), batch[2].value_lengths().to_numpy())
                impact = impacts(batch[3].flatten().to_numpy(), batch[1].to_numpy()[owner], corpus)
                no_id = batch[0].is_null().to_numpy(zero_copy_only=False)
                doc_id = batch[0].fill_null(0).to_numpy()
                at, chunk = 0, 0
                for tile in made:
                    scores = np.zeros((batch.num_rows, len(tile.items)), np.int64)
                    for some, weights in tile.chunks:
                        column = spots[chunk][term]
                        held = column >= 0
                        dense = np.zeros((batch.num_rows, len(some)))
                        dense[owner[held], column[held]] = impact[held]
                        scores += (dense @ weights).astype(np.int64)
                        chunk += 1
                    found.take(at, scores, doc_id, no_id)
                    at += len(tile.items)
        for item, (scores, docs, none) in zip(order, found.rows):
            many = len(scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(many, item), pa.int32()), pa.array([ids[item]] * many, pa.int64()),
                 pa.array(docs, mask=none), pa.array(scores)],
                names=["item", "item_id", "doc_id", "score"],
            )

    return map_batches(postings, step, _OUT)


def _ranked(candidates: DataFrame, best: int) -> DataFrame:
    """The best of all tasks: first among some tasks, then among those."""
    highest = [F.desc("score"), F.asc_nulls_last(DOC_ID)]
    salted = candidates.withColumn("salt", F.spark_partition_id() % SALTS)
    some = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*highest))
    narrowed = salted.withColumn("rank", some).where(F.col("rank") <= best).drop("rank", "salt")
    whole = F.row_number().over(Window.partitionBy("item").orderBy(*highest))
    ranked = narrowed.withColumn("rank", whole).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", DOC_ID, "score")


def _group(docs: DataFrame, some: list, corpus: Corpus | None, best: int, work: Scratch) -> tuple[DataFrame, Corpus]:
    """The ranking for items that the driver holds."""
    vocabulary = {term: place for place, term in enumerate(sorted({bytes(t) for r in some for t in r.terms}))}
    postings = work.keep(_postings(docs, vocabulary))
    if corpus is None:
        sums = postings.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        corpus = Corpus(sums.n, sums.l)
    counts = _counts(postings, len(vocabulary))
    weights = np.array([weight(corpus, c) for c in counts.tolist()], np.int64)
    wanted = [[vocabulary[bytes(t)] for t in r.terms] for r in some]
    ids = [r.item_id for r in some]
    made = tiles(wanted, weights)
    return work.keep(_ranked(_candidates(postings, made, ids, corpus, len(vocabulary), best), best)), corpus


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    key: str = "item_id",
    text: str = TEXT,
    group_terms: int = GROUP_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item with
    a score above 0, equal scores by ``doc_id``, no id last.

    Every row of ``items`` is ranked for itself, also where ids repeat or are
    null, and every row of ``docs`` is a document, also where ids or texts
    repeat.  A null text has no terms; an item without terms and empty tables
    give no rows.  Other columns are neither read nor returned.

    Items are taken in groups whose terms number about ``group_terms``; each
    group reads all documents once, so that the driver and the tasks hold the
    vocabulary of one group at a time.
    """
    spark = docs.sparkSession
    found = Scratch(spark, "ranked")
    with scratch(spark, "search") as work:
        numbered = work.keep(_item_terms(items, key, text).withColumn("row", F.monotonically_increasing_id()))
        total = numbered.agg(F.sum(F.size("terms")).alias("terms")).first().terms or 0
        groups = max(1, math.ceil(total / group_terms))
        corpus, results = None, []
        for group in range(groups):
            mine = numbered.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == group)
            some = mine.select("item_id", "terms").collect()
            if some:
                ranked, corpus = _group(docs, some, corpus, best, work)
                results.append(found.keep(ranked))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole
