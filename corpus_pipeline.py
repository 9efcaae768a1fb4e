"""Documents to packed training sequences in five stages.

toxicity     documents scored as toxic go
exact_dedup  of equal texts one document stays
near_dedup   of linked near-duplicates one document stays
secrets      credentials in the texts are replaced; every document stays
packing      texts become token sequences of power-of-two lengths

Each stage works on all its predecessor kept, written as Parquet in the shared
folder and read again, so that a lost executor repeats one stage's tasks alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weekcast.llm import exact_dedup, minhash, packing, secrets, toxicity
from weekcast.llm.common import documents
from weekcast.llm.queries import training_labels, vocabulary
from weekcast.session import cut_lineage, intermediates, remove, run_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, training_labels(spark, sf_dir))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_copies(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", remove_secrets),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are no SQL; tests hold the stages
#: against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stage wrote is removed when the next has written; the documents
    that the last stage reads stay."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = run_dir(spark, name)
        with intermediates(spark):
            docs = cut_lineage(stage(spark, docs, sf_dir), path=path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
