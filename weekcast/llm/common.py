"""What the corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC_ID, TEXT = "doc_id", "text"

#: Words of the corpus contracts are runs of characters other than these.
SPACES = "\\x20\\x09-\\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_texts(docs: DataFrame, *more: str) -> DataFrame:
    """Id and text alone, so that no other column can clash or be shipped; a
    null text is an empty one."""
    return docs.select(DOC_ID, F.coalesce(F.col(TEXT), F.lit("")).alias(TEXT), *more)


def map_batches(
    frame: DataFrame,
    step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` whose tasks can import this package also where only the
    driver was started from the repository."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    frame.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", root)
    return frame.mapInArrow(step, schema)


def slices(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts together hold about ``limit`` bytes, so that
    what a task unpacks at once doesn't depend on how long the documents are."""
    if batch.num_rows < 2 or batch.nbytes <= limit:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), limit)
    yield from slices(batch.slice(half), limit)
