"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text.  A batch
of new documents is first reduced to one row per digest (map-side, so a text
that makes up a third of all rows is one row per task), then a sort-merge
anti-join drops the digests that are known and the rest is appended.  The index
side of that join is read bucket by bucket and is never shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, names_in, publish_text, read_text, run_dir
from .common import DOC_ID, TEXT

_COLUMNS = "digest binary, keep_id long, group_size long, batch string"


def digest(text: str = TEXT):
    """SHA-256 of the text as it stands, in UTF-8; a null text is an empty one."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


BUCKETS = "_buckets"  # a file of the index, which readers of the table skip


class DigestIndex:
    """The texts seen so far, below ``path``; an index that exists is reopened.

    The number of buckets is fixed when the index is made (the session's shuffle
    partitions if none is given; a bucket should be some hundred MB at the size
    the index will reach) and stored with it: a row's bucket follows from that
    number, so another one is refused.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        self.buckets = self._settled(buckets)
        spark.sql(
            f"CREATE TABLE {self.table} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def _settled(self, buckets: int | None) -> int:
        file = f"{self.path}/{BUCKETS}"
        if read_text(self.spark, file) is None:
            if any(not name.startswith(("_", ".")) for name in names_in(self.spark, self.path)):
                raise ValueError(f"{self.path} holds files of an index without its number of buckets")
            own = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            publish_text(self.spark, file, str(own))
        stored = int(read_text(self.spark, file))
        if buckets not in (None, stored):
            raise ValueError(f"{self.path} has {stored} buckets, not {buckets}")
        return stored

    def add(self, docs: DataFrame, batch: str | None = None) -> str:
        """Append the texts of ``docs`` that are not known; returns the batch's name.

        Of equal texts within a batch the row with the largest ``doc_id`` is
        kept; a text of an earlier batch keeps the row it has.  A batch that was
        added before, in whole or in part, can be added again under its name:
        what is there stays, what is missing is appended, and its rows are
        judged as the first time.
        """
        batch = batch or uuid.uuid4().hex
        # Written, because Spark would move the anti-join below the aggregate
        # and then bring all copies of a hot text together for it.
        steps = Scratch(self.spark, "digest-groups")
        groups = steps.keep(
            docs.groupBy(digest().alias("digest")).agg(
                F.max(DOC_ID).alias("keep_id"), F.count(F.lit(1)).alias("group_size")
            )
        )
        known = self.spark.table(self.table).select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti").withColumn("batch", F.lit(batch))
        # One task and so one sorted file per bucket.
        ready = fresh.repartition(self.buckets, "digest")
        writer = ready.write.bucketBy(self.buckets, "digest").sortBy("digest")
        writer.mode("append").format("parquet").saveAsTable(self.table)
        self.spark.catalog.refreshTable(self.table)
        steps.remove()
        return batch

    def groups(self) -> DataFrame:
        """Digest, the document that stays, the size of its group in the batch
        that brought it, and that batch.

        Read as plain files: a join with documents then deals both sides out
        anew, and adaptive execution splits the partition of a hot text.
        """
        return self.spark.read.schema(_COLUMNS).parquet(self.path)

    def close(self) -> None:
        """Forget the table's name in this session; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def judge(docs: DataFrame, index: DigestIndex, *batches: str) -> DataFrame:
    """One row per row of ``docs``, which were added as ``batches``: ``doc_id``,
    ``digest``, ``keep_id``, ``group_size`` (rows of ``docs`` with the text), ``kept``.

    Null and empty texts are equal to each other.  Of rows that share text and
    ``doc_id`` one is kept.  A text known from a batch before those keeps nothing.
    Other columns of ``docs`` are neither read nor returned.
    """
    # Dealt by id first: the joins below then deal by digest in an exchange of
    # their own, whose partition of a hot text adaptive execution can split.
    ids = docs.select(DOC_ID, digest().alias("digest")).repartition(DOC_ID)
    rows = ids.groupBy(DOC_ID, "digest").agg(F.count(F.lit(1)).alias("copies"))
    sizes = docs.groupBy(digest().alias("digest")).agg(F.count(F.lit(1)).alias("group_size"))
    known = index.groups().drop("group_size").join(sizes, "digest")
    stays = F.col(DOC_ID).eqNullSafe(F.col("keep_id")) & F.col("batch").isin(list(batches))
    return (
        rows.join(known, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            DOC_ID, "digest", "keep_id", "group_size", (stays & (F.col("copy") == 1)).alias("kept")
        )
    )


def drop_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row stays if it has the largest ``doc_id`` of its text; where several
    rows share text and ``doc_id``, any one of them does.
    """
    spark = docs.sparkSession
    own = index or DigestIndex(spark, run_dir(spark, "digests"))
    batch = own.add(docs)
    keys = ["_stays_digest", "_stays_id"]
    stays = own.groups().where(F.col("batch") == batch).select(
        F.col("digest").alias(keys[0]), F.col("keep_id").alias(keys[1])
    )
    marked = docs.withColumns({keys[0]: digest(), keys[1]: F.col(DOC_ID)})
    same = [marked[keys[0]] == stays[keys[0]], marked[keys[1]].eqNullSafe(stays[keys[1]])]
    left = marked.join(stays, same, "left_semi")
    if not docs.groupBy(DOC_ID).count().where("count > 1").isEmpty():  # reads ids only
        left = left.dropDuplicates(keys)
    if index is None:
        own.close()
    return left.select(*docs.columns)
