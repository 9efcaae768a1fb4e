"""One registered query per corpus operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir
from . import (
    exact_dedup,
    minhash,
    oracles,
    packing,
    quality,
    ranked_search,
    relative_parse,
    secrets,
    sentencepiece_codec,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
    whitening,
)
from .common import DOC_ID, TEXT, documents

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Where this machine's public tokenizers lie; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def _span_list(spans: str):
    texts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", texts)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.fit(docs))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        DOC_ID,
        *[count(kind) for kind in secrets.KINDS],
        F.sha2(_span_list("base"), 256).alias("base_sha256"),
        _span_list("found").alias("spans"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))
    return packed.select(
        DOC_ID, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two batches, the newer half by id first, so that of
    equal texts the largest id is known when the older half is held against it."""
    docs = documents(spark, sf_dir)
    middle = docs.agg(F.percentile_approx(DOC_ID, 0.5)).first()[0] or 0
    newer = F.coalesce(F.col(DOC_ID) > middle, F.lit(False))
    index = exact_dedup.DigestIndex(spark, run_dir(spark, "digests"))
    batches = [index.add(docs.where(part), name) for name, part in (("newer", newer), ("older", ~newer))]
    judged = exact_dedup.judge(docs, index, *batches)
    index.close()  # the index stays as files, which the result reads
    return judged.select(
        DOC_ID, "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col(TEXT), F.lit(""))
    narrow = documents(spark, sf_dir).select(
        DOC_ID,
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )
    return sharding.shard(narrow, 40, F.col("text_key"), F.col("size")).select(
        DOC_ID, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge(pages, url_filter.fit(pages)).drop("url")


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows that are not held out."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())


def held_out():
    return F.crc32(F.col(DOC_ID).cast("string")) % 5 == 0


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit(documents(spark, sf_dir), training_labels(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir), toxicity_model(spark, sf_dir))
    return scored.select(
        DOC_ID,
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(documents(spark, sf_dir)).drop("clean_text")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked_search.search(documents(spark, sf_dir), items)


def op13_relative_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_parse.parse(documents(spark, sf_dir)).drop("factors")


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_minhash": op9_minhash,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_ranked_search": op12_ranked_search,
    "op13_relative_parse": op13_relative_parse,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": oracles.EXACT,
    "op5_suffix_dedup": oracles.REPEATS,
    "op9_minhash": oracles.NEAR,
    "op10_quality": oracles.quality(quality.BOILERPLATE, quality.FURNITURE_WORDS),
    "op12_ranked_search": oracles.RANKED,
    "op13_relative_parse": oracles.PASSAGES,
}
