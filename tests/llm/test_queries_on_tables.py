"""Columns of registered queries without SQL, against plain Python on whole tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.llm.queries import QUERIES, vocabulary

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def test_op1_ids_are_the_librarys(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    rows = result(spark, "op1_sentencepiece")
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert list(r.ids) == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
    assert all(r.round_trip for r in rows)


def test_op2_counts_and_spans(spark, texts):
    rows = result(spark, "op2_secrets")
    assert len(rows) == len(texts)
    for r in rows:
        base = brute.base_spans(texts[r.doc_id])
        kinds = [k for k, _, _ in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert [s for s in spans if s[0] != "format"] == [(k, str(a), str(b)) for k, a, b in base]
        taken = [(a, b) for _, a, b in base]
        for kind, a, b in spans:
            if kind == "format":
                a, b = int(a), int(b)
                assert re.fullmatch(r"[A-Za-z0-9+/_.=-]{8,}", texts[r.doc_id][a:b])
                assert all(b <= c or d <= a for c, d in taken)


def test_op3_pieces(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    pieces, sequences = {}, {}
    for r in result(spark, "op3_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for own in sequences.values():
        assert sorted(p.offset for p in own)[0] == 0 and sum(p.length for p in own) <= 4096
        assert len(own) == 1 and own[0].length & (own[0].length - 1) == 0


def test_op6_shards(spark, texts):
    rows = result(spark, "op6_sharding")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, slots = [0] * 40, [[] for _ in range(40)]
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    mean, largest = sum(sizes) / 40, max(r.size for r in rows)
    assert max(abs(s - mean) for s in sizes) <= max(0.02 * mean, largest)


def test_op7_rules(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()}
    rows = result(spark, "op7_url_filter")
    assert {r.page_id for r in rows} == set(urls) and len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = brute.url_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict == ("block" if r.block_score >= 0.5 else "allow")


def test_op8_scores(spark, texts):
    rows = result(spark, "op8_toxicity")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    same = {}
    for r in rows:  # nothing but the text decides
        assert same.setdefault(texts[r.doc_id], r.score) == r.score


def test_op12_ranks_every_item(spark):
    rows = QUERIES["op12_ranked_search"](spark, SF_DIR)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert rows.select("item_id").distinct().count() == items.count()
    assert rows.groupBy("item_id").agg(F.max("rank").alias("n"), F.count("*").alias("c")).where("n <> c").isEmpty()
