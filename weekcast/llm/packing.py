"""Packing by power-of-two decomposition.

A document of n tokens is cut into its full 4096-token pieces and then into one
piece for every binary digit of what is left, longest first.  Every piece is a
sequence of its own: its length is a power of two, so nothing is padded, and no
sequence holds tokens of two documents.  Sequences of equal length form a
bucket, which a loader reads as one batch shape (``write_buckets``).

No row leaves its task: lengths alone decide how a document is cut, so packing
needs no shuffle and a hot source or a very long document skews nothing.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, whole_texts

MAX_LENGTH = 4096
END_ID = 2
CACHED_WORDS = 500_000

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long"
)

# Letters of the fast path: they are their own NFC form, lower-case one to one
# and belong to the same Unicode classes in every library.
_SAFE = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ«»“”‘’…–—•€£©®°·¡¿]*")
# Fixed value: the split rule stated in the vocabulary file, over lower case.
_WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_MARKS = ("<|startoftext|>", "<|endoftext|>")


class WordEncoder:
    """Texts -> little-endian 32-bit ids, exactly as the tokenizer gives them.

    The vocabulary splits a text into words before it merges anything, so a
    word's ids never depend on its neighbours and are looked up once.  Texts
    with other characters than those of ``_SAFE`` go to the tokenizer whole.
    The table of words is bounded and starts anew when it is full.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, words: Iterable[str]) -> None:
        letters = [w for w in words if w.isalpha()]
        for at in range(0, len(letters), 2000):
            part = letters[at : at + 2000]
            raw = self._ids(" ".join(part))
            cuts = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1) * 4
            if len(cuts) != len(part):  # a word whose last piece is no word end
                self.known.update((w, self._ids(w)) for w in part)
                continue
            begin = 0
            for word, end in zip(part, cuts.tolist()):
                self.known[word] = raw[begin:end]
                begin = end
        self.known.update((w, self._ids(w)) for w in words if not w.isalpha())

    def encode(self, texts: list[str]) -> list[bytes]:
        split: list[list[str] | None] = []
        needed: set[str] = set()
        for text in texts:
            plain = _SAFE.fullmatch(text) and not any(mark in text for mark in _MARKS)
            words = _WORD.findall(text.lower()) if plain else None
            split.append(words)
            needed.update(words or ())
        missing = needed.difference(self.known)
        if len(self.known) + len(missing) > self.limit:
            self.known = {}
            missing = needed
        self._learn(missing)
        get = self.known.__getitem__
        return [
            self._ids(text) if words is None else b"".join(map(get, words))
            for text, words in zip(texts, split)
        ]


_ENCODERS: dict[str, WordEncoder] = {}  # one per Python worker, kept between tasks


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def piece_lengths(tokens: int, longest: int = MAX_LENGTH) -> list[int]:
    """Full pieces, then the binary digits of the rest."""
    rest = tokens % longest
    digits = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    return [longest] * (tokens // longest) + digits


def pack(
    docs: DataFrame, vocabulary: str, longest: int = MAX_LENGTH, end_id: int = END_ID
) -> DataFrame:
    """One row per piece of every document, which is one sequence.

    Columns: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset, bucket`` (the length's exponent).

    A document's tokens are those of its whole text and then ``end_id``.  A
    null or empty text is the single token ``end_id``.  Repeated rows are
    packed each.  Other columns of ``docs`` are neither read nor returned.
    ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest sequence must be a power of two, not {longest}")
    end = np.array([end_id], dtype="<u4").tobytes()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch):
                rows: list[tuple] = []
                for doc_id, ids in zip(part[0].to_pylist(), words.encode(part[1].to_pylist())):
                    ids += end
                    begin, total = 0, len(ids) // 4
                    for length in piece_lengths(total, longest):
                        piece = ids[4 * begin : 4 * (begin + length)]
                        rows.append((doc_id, begin, length, piece, total))
                        begin += length
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(whole_texts(docs), step, PIECES).select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per sequence length, for loaders that batch equal lengths."""
    packed.write.partitionBy("bucket").parquet(path)


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()
