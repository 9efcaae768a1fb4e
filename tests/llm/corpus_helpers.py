"""Made texts and results by id, for several test modules."""

from __future__ import annotations

import random

WORDS = "the of and river stone walked under bright winter morning letters carry seven old bridges home".split()


def prose(seed, n=120, ends=True):
    draw = random.Random(seed)
    words = [draw.choice(WORDS) + draw.choice(["", "s", "ed", "ly", "a", "o"]) + draw.choice("aeiou") for _ in range(n)]
    return " ".join(words) + ("." if ends else "")


def by_id(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.doc_id, []).append(r)
    return rows
