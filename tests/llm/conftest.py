from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from corpus_helpers import prose  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Texts -> a documents table with ids 0, 1, ... dealt over some partitions."""

    def make(texts, ids=None, partitions=3):
        rows = [
            (i, t, "en", "s", None if t is None else len(t))
            for i, t in zip(ids or range(len(texts)), texts)
        ]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, ties, many languages, very long lines."""
    long = prose("long", 9000)
    return [
        None, "", " \t\n", "one", "One two three four", prose(1), prose(1), prose(2), "x" * 5000, "ab" * 4000,
        prose(3) + "\n" + prose(4) + "\r\n" + prose(3), "日本語のテキスト。" * 60, "naïve café ½ 🙂 \x1c İstanbul ΣΑΣ ".strip() * 30,
        long, long + " tail", "\n".join(["same line here."] * 60), prose(5) + " " + "-" * 300, "it's don't we'll <|endoftext|> 3.14",
    ]
