"""Session helpers: where intermediate tables go and how lineage is cut.

Intermediate tables are Parquet files in a folder all executors share.  Unlike
row checkpoints they keep column statistics and a size, so that later reads
prune columns and Spark can tell a small join side by itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then uses a folder
    below the warehouse, because there the driver and the executors share a disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """For Spark ML, which checkpoints the running residuals of long fits."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


_NAMED: list[str] = []  # folders that this process named and didn't remove


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, for a table that is written and read back."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _NAMED.append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes, when the block succeeds, the tables in the shared folder that
    operators made in it, also those that their results still read: write what
    is to be kept to a place of its own inside the block."""
    before = set(_NAMED)
    yield
    for path in [path for path in _NAMED if path not in before]:
        remove(spark, path)


def _hadoop(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``run_dir`` in whatever store it lies."""
    folder, store = _hadoop(spark, path)
    store.delete(folder, True)
    if path in _NAMED:
        _NAMED.remove(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    file, store = _hadoop(spark, path)
    if not store.exists(file):
        return None
    stream = store.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears as a whole, by a rename; False if there
    is one of that name already, which then stays as it is.

    Stores that refuse to rename onto a file settle which of two writers comes
    first; on a local disk only a look beforehand does.
    """
    target, store = _hadoop(spark, path)
    draft, _ = _hadoop(spark, f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}")
    out = store.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.exists(target) and store.rename(draft, target):
        return True
    store.delete(draft, False)
    return False


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies in a folder, none if there is no such folder."""
    path, store = _hadoop(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(path)) if store.exists(path) else []


def cut_lineage(df: DataFrame, label: str = "table", path: str | None = None) -> DataFrame:
    """Fix ``df`` as Parquet in the shared folder, so a lost executor re-reads it
    instead of recomputing it from inputs that may have changed since."""
    path = path or run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one run, below one folder of the shared one."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.made = spark, run_dir(spark, label), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return cut_lineage(df, path=f"{self.path}/{self.made:03d}")

    def remove(self) -> None:
        remove(self.spark, self.path)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Scratch]:
    """Removed when the block succeeds; after a failure the files stay for a look."""
    made = Scratch(spark, label)
    yield made
    made.remove()
