"""Line-first cleaning.

Every line is judged by itself, lines that fail are removed, and a document
that loses more than half of its words with them is rejected.  A line fails

* punctuation: it has ten words or more and no sentence end anywhere, or the
  shouted or decorated kind of punctuation in every other word;
* navigation: it is a row of menu entries, words between bars, arrows or dots;
* boilerplate: it is short and holds a phrase of page furniture.

A legal notice or a menu on top of a good text costs that line and not the
text.  The base rules of the corpus contract are counted in the same pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, whole_texts

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST_PERCENT = 50
LONG_LINE = 10
MAX_DECORATED_SHARE = 0.5
MIN_MENU_BARS = 3
MAX_WORDS_PER_BAR = 4

FURNITURE_WORDS = 20  # a longer line that names the privacy policy is about something

# Phrases of page furniture in four languages, compared in lower case.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "click here to",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "terms of use",
    "use cookies",
    "todos los derechos reservados",
    "aceptar cookies",
    "política de privacidad",
    "términos de uso",
    "tous droits réservés",
    "accepter les cookies",
    "politique de confidentialité",
    "mentions légales",
    "alle rechte vorbehalten",
    "cookies akzeptieren",
    "datenschutzerklärung",
    "nutzungsbedingungen",
)
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SENTENCE_END = re.compile(r"[.!?…。！？؟।][\"'”’»)\]]*(?:[\x20\x09-\x0D]|$)")
_DECORATED = re.compile(r"(?:[#*$%&<>|~^=_]{2,}|!{2,}|\?{2,})[.,;:]?$")
_BARS = {"|", "»", "«", "›", "‹", "·", "•", ">", "/", "\\", "::", "->"}

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, lost_words long, clean_text string"
)


def failed_rule(line: str) -> str | None:
    """The rule a line breaks, or None; a line without words breaks none."""
    words = _WORD.findall(line)
    if not words:
        return None
    if len(words) <= FURNITURE_WORDS:
        lowered = line.lower()
        if any(phrase in lowered for phrase in BOILERPLATE):
            return "boilerplate"
    bars = sum(1 for word in words if word in _BARS)
    if bars >= MIN_MENU_BARS and len(words) - bars <= MAX_WORDS_PER_BAR * (bars + 1):
        return "navigation"
    decorated = sum(1 for word in words if _DECORATED.search(word))
    if decorated > MAX_DECORATED_SHARE * len(words):
        return "punctuation"
    if len(words) >= LONG_LINE and not _SENTENCE_END.search(line):
        return "punctuation"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that the text holds twice or more."""
    if len(words) < 4:
        return 0
    code, distinct = pd.factorize(np.array(words, dtype=object))
    n = len(distinct)
    if n < 2_000_000:
        window = (code[:-2] * n + code[1:-1]) * n + code[2:]
    else:
        pair = pd.factorize(code[:-1] * n + code[1:])[0]
        window = pair[:-1] * n + code[2:]
    place = pd.factorize(window)[0]
    twice = np.bincount(place)[place] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : len(words) - 2 + shift] |= twice
    return int(inside.sum())


def judge(text: str) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII spaces alone
    n_words = len(words)
    lines = text.split("\n")
    worded = [line for line in lines if line.strip(" \t\n\v\f\r")]
    repeated = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n_words
    clean = [line for line in lines if failed_rule(line) is None]
    lost = n_words - sum(len(line.encode("utf-8", "surrogatepass").split()) for line in clean)
    return (
        n_words,
        len(re.sub(r"[ \t-\r]+", "", text)),
        len(_SYMBOLS.findall(text)),
        len(worded) - len(set(worded)),
        repeated,
        base_failed,
        not base_failed and 100 * lost <= MAX_LOST_PERCENT * n_words,
        lost,
        "\n".join(clean),
    )


def clean_lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its counts, ``kept``, the words lost with
    failed lines and ``clean_text``, the text without them.

    A null text is an empty one; an empty text fails the base rules.  Repeated
    rows are judged each.  Other columns are neither read nor returned.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64(), pa.string()]
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            for part in slices(batch):
                rows = [judge(text) for text in part[1].to_pylist()]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([part[0].cast(pa.int64()), *columns], names=names)

    return map_batches(whole_texts(docs), step, RESULT)


def keep_clean(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents that are kept, without their failed lines."""
    return clean_lines(docs).where("kept").select("doc_id", F.col("clean_text").alias("text"))
