"""Toxicity scores from a linear classifier over scaled character n-grams.

Every document is the set of its character n-grams (three to five code points
of the lower-case text).  A feature's value is its naive Bayes log-count ratio,
r = log((p + 1) / |p|) - log((q + 1) / |q|), where p and q count the toxic and
the clean labelled documents that contain it, and a logistic regression is
fitted on those values.

Counts and regression are fitted on at most ``TRAINING_ROWS`` labelled rows,
those with the smallest hash of their id, and on the ``FEATURES`` n-grams that
tell the classes apart best, of those that at least ``MIN_DOCUMENTS`` of the
rows contain.  All n-grams of the rows are counted by their full hash, so that
neither the choice nor a long clean text meets another n-gram by collision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import DOC_ID, TEXT, map_batches, slices, whole_texts
from .shingles import mixed

LOWEST, LONGEST = 3, 5
BITS = 20
TRAINING_ROWS = 20_000
FEATURES = 1_000
MIN_DOCUMENTS = 3
COUNTED_AT_ONCE = 2_000_000
PENALTY = 1e-5
ITERATIONS = 100


def grams(text: str) -> np.ndarray:
    """64-bit hashes of all n-grams, with repeats.

    A text shorter than an n-gram lacks that length; an empty one has none.
    """
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    code = points.astype(np.uint64)
    made = [np.zeros(0, np.uint64)]
    rolled = code
    for n in range(2, LONGEST + 1):
        if len(points) < n or not text:
            break
        rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :]
        if n >= LOWEST:
            made.append(mixed(rolled * np.uint64(2 * n + 1)))
    return np.concatenate(made)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


class Chosen:
    """A set of n-grams and where each stands in it."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.there = np.zeros(1 << BITS, bool)
        self.there[bucket(self.hashes)] = True

    def places(self, text: str) -> np.ndarray:
        """Sorted places of the chosen n-grams that a text holds."""
        found = grams(text)
        found = np.unique(found[self.there[bucket(found)]])
        if not len(found) or not len(self.hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        return at[self.hashes[at] == found]


@dataclass(frozen=True)
class ToxicityModel:
    """Chosen n-grams with their weights, coefficients times ratios."""

    chosen: Chosen
    weights: np.ndarray
    intercept: float

    @staticmethod
    def empty(intercept: float) -> ToxicityModel:
        return ToxicityModel(Chosen(np.zeros(0, np.uint64)), np.zeros(0), intercept)

    def probability(self, text: str) -> float:
        margin = self.intercept + float(self.weights[self.chosen.places(text)].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -40.0, 40.0))))


_COUNTS = "gram long, toxic long, clean long"


def gram_counts(labelled: DataFrame, label: str) -> DataFrame:
    """``gram, toxic, clean``: how many documents of each class have an n-gram,
    for all n-grams by their full hash.

    Each task adds up ``COUNTED_AT_ONCE`` n-grams at a time, so a frequent one
    is a few rows per task and no task holds all it has seen.
    """

    def added(held: tuple[list, list]) -> Iterator[pa.RecordBatch]:
        gram, at = np.unique(np.concatenate(held[0] + held[1]), return_inverse=True)
        clean = np.bincount(at[: sum(map(len, held[0]))], minlength=len(gram))
        yield from _count_rows(gram.view(np.int64), np.bincount(at, minlength=len(gram)) - clean, clean)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = ([], []), 0
        for batch in batches:
            for part in slices(batch):
                for text, mark in zip(part[0].to_pylist(), part[1].to_pylist()):
                    held[mark].append(np.unique(grams(text)))
                    size += len(held[mark][-1])
                    if size >= COUNTED_AT_ONCE:
                        yield from added(held)
                        held, size = ([], []), 0
        if size:
            yield from added(held)

    each = map_batches(labelled.select(TEXT, label), step, _COUNTS)
    return each.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _count_rows(gram: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(gram), 50_000):
        columns = [pa.array(c[at : at + 50_000].astype(np.int64)) for c in (gram, toxic, clean)]
        yield pa.RecordBatch.from_arrays(columns, names=["gram", "toxic", "clean"])


def _best(counts: DataFrame, toxic: int, clean: int, limit: int) -> list:
    """The n-grams whose share of toxic documents is furthest from
    the average for their number (a chi-square statistic)."""
    n = F.col("toxic") + F.col("clean")
    expected = n * F.lit(toxic / (toxic + clean))
    gap = (F.col("toxic") - expected) ** 2 / (expected * (1 - expected / n))
    ranked = counts.where(n >= MIN_DOCUMENTS).withColumn("gap", gap)
    return ranked.orderBy(F.desc("gap"), "gram").limit(limit).collect()


def _gram_rows(labelled: DataFrame, label: str, chosen: Chosen) -> DataFrame:
    """Training rows as lists of their places among the chosen n-grams."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [chosen.places(text) for text in part[0].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.list_(pa.int64())), part[1].cast(pa.float64())],
                    names=["places", "label"],
                )

    return map_batches(labelled.select(TEXT, label), step, "places array<long>, label double")


def _vectors(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """The lists as sparse vectors whose entries are the n-grams' ratios."""
    names = [str(n) for n in range(len(ratios))]
    ones = CountVectorizerModel.from_vocabulary(names, "names", "ones", minTF=1.0, binary=True)
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense(ratios.tolist()), inputCol="ones", outputCol="features"
    )
    named = rows.select(F.col("places").cast("array<string>").alias("names"), "label")
    return scaled.transform(ones.transform(named)).select("features", "label")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    training_rows: int = TRAINING_ROWS,
    features: int = FEATURES,
) -> ToxicityModel:
    """Fit on the texts of ``docs`` that ``labels`` (``doc_id`` and a column of
    0 or 1) marks.

    Rows without a label are left out.  Without rows of both classes the model
    gives every text the share of toxic rows, a half if there are none.

    The labels to learn from are at most ``training_rows`` and are broadcast, so
    the documents are read where they lie and only those few are kept.
    """
    work = Scratch(docs.sparkSession, "toxicity")
    marks = labels.select(F.col(DOC_ID), F.col(label).cast("int").alias("label"))
    order = [F.xxhash64(DOC_ID), F.col(DOC_ID), F.col("label")]
    marks = marks.where("label in (0, 1)").orderBy(*order).limit(training_rows)
    rows = work.keep(whole_texts(docs).join(F.broadcast(marks), DOC_ID).select(TEXT, "label"))
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    share = toxic / (toxic + clean) if toxic + clean else 0.5
    plain = ToxicityModel.empty(float(np.log(share + 1e-9) - np.log(1 - share + 1e-9)))
    if not toxic or not clean:
        work.remove()
        return plain

    counts = work.keep(gram_counts(rows, "label"))
    total = counts.agg(F.sum("toxic").alias("p"), F.sum("clean").alias("q")).first()
    best = _best(counts, toxic, clean, features)
    if not best:
        work.remove()
        return plain
    best.sort(key=lambda r: r.gram % (1 << 64))  # as unsigned numbers
    chosen = Chosen(np.array([r.gram for r in best], np.int64).view(np.uint64))
    ratios = np.log([(r.toxic + 1.0) / total.p for r in best]) - np.log(
        [(r.clean + 1.0) / total.q for r in best]
    )
    vectors = _vectors(work.keep(_gram_rows(rows, "label", chosen)), ratios)
    model = LogisticRegression(
        regParam=PENALTY, elasticNetParam=0.0, standardization=False, maxIter=ITERATIONS
    ).fit(vectors)
    work.remove()
    return ToxicityModel(chosen, model.coefficients.toArray() * ratios, float(model.intercept))


def score(docs: DataFrame, model: ToxicityModel, *more: str) -> DataFrame:
    """``doc_id``, ``score`` from 0 to 1 and the columns named in ``more``.

    Every row gets a score from its whole text and nothing else; a null text is
    an empty one, whose score is that of a text without known n-grams.
    """
    probability = model.probability
    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long", *[f"`{c}` {kinds[c]}" for c in more], "score double"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [probability(text) for text in part[1].to_pylist()]
                kept = [part[0], *part.columns[2:], pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(kept, names=["doc_id", *more, "score"])

    return map_batches(whole_texts(docs, *more), step, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, all columns kept."""
    probability = model.probability
    place = docs.columns.index(TEXT)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part[place].to_pylist()
                stays = [probability(text or "") < threshold for text in texts]
                yield part.filter(pa.array(stays, pa.bool_()))

    return map_batches(docs, step, docs.schema)
