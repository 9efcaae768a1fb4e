"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows, scaled to whole numbers, are written once as blocks.  Every step then
makes one pass over the blocks that multiplies the centred rows Y by a vector
and by their own transpose: a left vector ``u = Y c`` is never stored, only the
short ``c`` is, so that a pass can recompute all earlier left vectors of its own
rows for the full reorthogonalisation and a lost executor loses nothing.  The
driver holds a few vectors as long as a row and the small bidiagonal matrix,
whose singular values and vectors are the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .common import map_batches

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_BYTES = 4 << 20
LARGEST = 1 << 52  # whole numbers beyond are held at it
CONVERGED = 1e-15  # of the largest singular value
NO_SPREAD = 1e-10  # of the largest singular value: a component below has no deviation to divide by
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """``components`` has a unit column for each component, ``deviations`` the
    square roots of their eigenvalues; ``floors`` and ``rest`` add up to the mean."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n / self.n for s in self.sums])


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    entries = F.col(vector)
    finite = F.forall(entries, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(entries.isNotNull() & finite)


def _matrix(lists: pa.Array) -> np.ndarray:
    """The rows of a list column whose lists have one length."""
    width = len(lists[0]) if len(lists) else 0
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)


def scaled(rows: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000, as whole numbers."""
    return np.clip(np.floor(SCALE * rows) + SHIFT, -LARGEST, LARGEST).astype(np.int64)


def _blocks(vectors: DataFrame, vector: str) -> DataFrame:
    """``dims, n_rows, block``: rows of equal length, packed."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch[0]
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes).tolist():
                rows = scaled(_matrix(lists.filter(pa.array(sizes == dims))))
                at_once = max(1, BLOCK_BYTES // max(1, 8 * dims))
                parts = [rows[i : i + at_once] for i in range(0, len(rows), at_once)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dims] * len(parts), pa.int32()), pa.array([len(p) for p in parts], pa.int64()),
                     pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["dims", "n_rows", "block"],
                )

    return map_batches(vectors.select(vector), step, "dims int, n_rows long, block binary")


def _totals(blocks: DataFrame, dims: int, numbers: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """``numbers(block)``, flat arrays of one length, summed over the blocks of
    each task.

    There is a task for each core of the cluster, so that a pass has no shuffle
    and the driver gets a short array from every core, however many rows there are.
    """
    cores = max(2, blocks.sparkSession.sparkContext.defaultParallelism)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch[0]:
                found = numbers(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dims))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([total.dtype.str])],
                                             names=["total", "kind"])

    parts = map_batches(blocks.select("block").coalesce(cores), step, "total binary, kind string")
    return [np.frombuffer(bytes(r.total), r.kind) for r in parts.collect()]


def _sums(blocks: DataFrame, dims: int) -> list[int]:
    """Exact sums by dimension: the low and the high halves fit in a task's long."""

    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)])

    both = sum(part.astype(object) for part in _totals(blocks, dims, halves)).tolist()
    return [low + (high << 32) for low, high in zip(both[:dims], both[dims:])]


def _beside(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What of ``w`` is orthogonal to the columns of ``basis``, taken twice."""
    for _ in range(2):
        w = w - basis @ (basis.T @ w)
    return w


def bidiagonalise(
    product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]],
    dims: int,
    wanted: int,
    seed: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, largest first, and right vectors of a matrix Y that is
    known by ``product(c, C)`` alone: with u = Y c, the projections of u on the
    columns of Y C, the square of u's length, and the transpose of Y times u.

    Y V = U B with B upper bidiagonal.  A vector that brings nothing new gives
    way to a random one beside all others; that finds repeated singular values,
    and then all ``dims`` steps are made.
    """
    draw = np.random.RandomState(seed)

    def fresh(basis: np.ndarray) -> np.ndarray:
        w = _beside(draw.standard_normal(dims), basis)
        return w / np.linalg.norm(w)

    right = np.zeros((dims, 0))  # V
    short = np.zeros((dims, 0))  # C: U = Y C
    back = np.zeros((dims, 0))  # the transpose of Y times U
    diagonal, above = [], []
    v, beta, whole = fresh(right), 0.0, False
    while True:
        right = np.column_stack([right, v])
        c = v - beta * short[:, -1] if beta else v
        seen, square, z = product(c, short)
        c, z = c - short @ seen, z - back @ seen
        alpha = float(np.sqrt(max(0.0, square - seen @ seen)))
        scale = max([alpha, *diagonal, *above])
        if alpha <= 1e-13 * scale or scale == 0:
            alpha, c, z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            c, z = c / alpha, z / alpha
        short, back = np.column_stack([short, c]), np.column_stack([back, z])
        diagonal.append(alpha)
        small = np.diag(diagonal) + (np.diag(above, 1) if above else 0)
        left, values, turned = np.linalg.svd(small)
        if len(diagonal) == dims:
            break
        w = _beside(z - alpha * v, right)
        beta = float(np.linalg.norm(w))
        if beta <= 1e-13 * scale or alpha == 0:
            beta, v, whole = 0.0, fresh(right), True
        else:
            v = w / beta
        open_ends = beta * np.abs(left[-1, :wanted])
        if not whole and len(diagonal) >= wanted and (open_ends <= CONVERGED * values[0]).all():
            break
        above.append(beta)
    vectors = right @ turned.T
    return values, vectors / np.linalg.norm(vectors, axis=0)


def fit(vectors: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable rows; None if there are none.

    Rows of another length than most are left out (of equally many, the longer
    ones stay).  Components without spread are left out, so fewer than
    ``wanted`` come back where the rows don't differ in as many directions.
    """
    with scratch(vectors.sparkSession, "whitening") as work:
        packed = work.keep(_blocks(usable(vectors, vector), vector))
        sizes = packed.groupBy("dims").agg(F.sum("n_rows").alias("n")).where("dims > 0")
        most = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
        if most is None:
            return None
        n, dims = most.n, most.dims
        blocks = packed.where(F.col("dims") == dims)
        sums = _sums(blocks, dims)
        mean = Whitening(n, tuple(sums), np.zeros((dims, 0)), np.zeros(0), np.zeros(0), 0.0)
        floors, rest = mean.floors, mean.rest

        def product(c: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
            def numbers(x: np.ndarray) -> np.ndarray:
                y = (x - floors) - rest
                u = y @ c
                return np.concatenate([(y @ short).T @ u, [u @ u], y.T @ u])

            found = np.sum(_totals(blocks, dims, numbers), axis=0)
            at = short.shape[1]
            return found[:at], float(found[at]), found[at + 1 :]

        values, right = bidiagonalise(product, dims, wanted)
        kept = int((values[:wanted] > NO_SPREAD * values[0]).sum()) if values[0] > 0 else 0
        components, deviations = right[:, :kept], values[:kept] / np.sqrt(n)

        def spread(x: np.ndarray) -> np.ndarray:
            y = (x - floors) - rest
            w = y @ (components / deviations)
            return np.concatenate([[(y * y).sum()], w.sum(axis=0), (w.T @ w).ravel()])

        found = np.sum(_totals(blocks, dims, spread), axis=0) / n
        trace, means = found[0], found[1 : 1 + kept]
        covariance = found[1 + kept :].reshape(kept, kept) - np.outer(means, means)
        error = float(np.abs(covariance - np.eye(kept)).max()) if kept else 0.0
        explained = deviations**2 / trace if kept else np.zeros(0)
    return Whitening(n, tuple(sums), components, deviations, explained, error)


def _deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The sum of (n x - S)^2 by row, exactly; None where it doesn't fit a long."""
    furthest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if furthest * furthest * len(sums) < 1 << 63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = n * x.astype(object) - np.array(sums, object)
    return [t if t < 1 << 63 else None for t in (exact * exact).sum(axis=1)]


def whiten(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for every usable row of the model's length and every component:
    ``key, component, n, deviation, whitened, explained, identity_error``.

    Left out are null vectors and those with a null or an entry that is not
    finite.  Rows are not told apart by ``key``: repeated and null keys come
    back as often as they are.  An empty table, and one whose rows don't differ,
    gives no rows.  ``deviation`` is NULL where it doesn't fit a long.  Other
    columns are neither read nor returned.
    """
    kind = vectors.schema[key].dataType.simpleString()
    if model is None or not model.components.shape[1]:
        return vectors.sparkSession.createDataFrame([], f"`{key}` {kind}, {OUT}")
    dims, count = model.components.shape
    rows = usable(vectors, vector).where(F.size(vector) == dims).select(key, vector)
    n, sums, floors, rest = model.n, model.sums, model.floors, model.rest
    onto = model.components / model.deviations
    explained, error = model.explained, model.identity_error

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, dims):
                x = scaled(_matrix(part[1]))
                white = ((x - floors) - rest) @ onto
                again = np.repeat(np.arange(len(x)), count)
                apart = pa.array(_deviation(x, n, sums), pa.int64())
                many = len(again)
                yield pa.RecordBatch.from_arrays(
                    [part[0].take(pa.array(again)), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                     pa.array(np.full(many, n), pa.int64()), apart.take(pa.array(again)), pa.array(white.ravel()),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(many, error))],
                    names=[key, *[c.split()[0] for c in OUT.split(", ")]],
                )

    return map_batches(rows, step, f"`{key}` {kind}, {OUT}")


def _slices(batch: pa.RecordBatch, dims: int) -> Iterator[pa.RecordBatch]:
    at_once = max(1, BLOCK_BYTES // (8 * dims))
    for at in range(0, batch.num_rows, at_once):
        yield batch.slice(at, at_once)
