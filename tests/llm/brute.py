"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ASSIGN = re.compile(
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"
    r"|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_spans(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    for kind, rule, least in (("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)):
        found += [(kind, *m.span()) for m in re.finditer(rule, text) if len(m[0]) >= least]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def repeats_removed(texts, least=200):
    """Per text: bytes removed, runs, hash of the rest."""
    data = [t.encode() for t in texts]
    starts = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - least + 1):
            if starts[d[i : i + least]] > 1:
                gone[i : i + least] = [True] * least
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=5):
    words = WORD.findall(text.translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_components(texts):
    """Index of a text -> least index reachable, by all pairs that share a shingle."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def quality_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    earlier = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), earlier, len(inside), failed,
    )


def best_segmentation(text, scores, unknown):
    """The best total score over all ways to write the text with the pieces."""
    longest = max(map(len, scores))
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        if text[end - 1] not in scores:
            best[end] = best[end - 1] + unknown
        for start in range(max(0, end - longest), end):
            if text[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[text[start:end]])
    return best[-1]


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(url):
    """The rules."""
    rules = {
        "org/": "allow", "example.org/es/": "block", "example.org/en/1": "block",
        "com/fr/": "allow", "com/de/": "block",
    }
    host, path = url_parts(url)
    fits = []
    for text in rules:
        name, _, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(text)
    best = max(fits, key=len, default=None)
    return host, path, best, rules.get(best)


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranking(texts, items, best=50):
    """Per item: (place of the text, score), best first."""
    found = [TERM.findall((t or "").translate(LOWER)) for t in texts]
    total = sum(map(len, found))
    documents = sum(map(bool, found))
    counts = [Counter(f) for f in found]
    holding = Counter(t for c in counts for t in c)
    out = []
    for item in items:
        scores = []
        for i, c in enumerate(counts):
            score = 0
            for term in set(TERM.findall((item or "").translate(LOWER))):
                if term in c:
                    m = 100 - 50 + (50 * len(found[i]) * documents) // total
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[term] + 1)))
                    score += w * ((1000000000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                scores.append((-score, i))
        out.append([(i, -s) for s, i in sorted(scores)[:best]])
    return out


def passages_removed(texts, ids, window=50):
    """Per text: words, words removed, hash of the rest."""
    words = [WORD.findall(t or "") for t in texts]
    rank = [float("inf") if i is None else i for i in ids]
    least = {}
    for w, r in zip(words, rank):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, r), r)
    out = []
    for w, r in zip(words, rank):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < r:
                gone |= set(range(i, i + window))
        rest = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out
