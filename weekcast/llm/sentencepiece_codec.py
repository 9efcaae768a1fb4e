"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads a text once.  At every position
the chain of output links lists all pieces that end there, longest first.  What
they do to that position depends on the vocabulary:

score   every piece relaxes the best score of a segmentation up to there
        (Viterbi).  This is how a vocabulary of log-probabilities is meant.
merges  where scores are ranks of merges, their sum means nothing.  The piece is
        taken whose pair with the last piece before it no merge would change;
        there is exactly one, and following it gives what merging in the order
        of ranks gives.

A character no piece covers becomes its UTF-8 bytes.

Where no piece reaches across a change from letters to digits or signs, nor
into the next word, the best segmentation of a text is that of such stretches
side by side (the vocabulary is searched for exceptions first).  So each
distinct stretch is solved once and looked up afterwards, and many are solved
side by side in arrays.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, slices, whole_texts

SPACE = "▁"  # fixed value: stands for a space inside pieces
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest score, for uncovered characters
CACHED_WORDS = 200_000
CACHED_PAIRS = 500_000
CELLS = 1 << 18  # characters that are solved side by side

ENCODED = "doc_id long, ids array<int>, n_tokens long, round_trip boolean"


class Automaton:
    """Trie over the pieces' characters with failure and output links, as arrays."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        self.alphabet = {c: n for n, c in enumerate(sorted(set().union(*pieces)))}
        self.width = len(self.alphabet) + 1  # the last code is a character of no piece
        self.code_of = np.full(0x110000, self.width - 1, np.int32)
        for char, code in self.alphabet.items():
            self.code_of[ord(char)] = code
        moves: list[dict[int, int]] = [{}]
        piece, score, length = [-1], [0.0], [0]
        for text, (number, value) in pieces.items():
            at = 0
            for char in text:
                code = self.alphabet[char]
                if code not in moves[at]:
                    moves[at][code] = len(moves)
                    moves.append({})
                    piece.append(-1)
                    score.append(0.0)
                    length.append(length[at] + 1)
                at = moves[at][code]
            piece[at], score[at] = number, value
        fail, link = [0] * len(moves), [0] * len(moves)
        waiting = deque(moves[0].values())
        while waiting:
            at = waiting.popleft()
            for code, child in moves[at].items():
                back = fail[at]
                while back and code not in moves[back]:
                    back = fail[back]
                fail[child] = moves[back].get(code, 0)
                waiting.append(child)
            link[at] = fail[at] if piece[fail[at]] >= 0 else link[fail[at]]
        edges = sorted(
            (at * self.width + code, child) for at, own in enumerate(moves) for code, child in own.items()
        )
        self.text = [""] * len(moves)
        for text in pieces:
            at = 0
            for char in text:
                at = moves[at][self.alphabet[char]]
            self.text[at] = text
        self.edge = np.array([e for e, _ in edges] + [len(moves) * self.width], np.int64)
        self.child = np.array([c for _, c in edges] + [0], np.int64)
        self.fail, self.link = np.array(fail), np.array(link)
        self.piece, self.length = np.array(piece), np.array(length)
        self.score = np.array(score)
        self.single = np.zeros(self.width, bool)
        for text in pieces:
            if len(text) == 1:
                self.single[self.alphabet[text]] = True

    def codes(self, words: list[str], size: np.ndarray) -> np.ndarray:
        """A column of codes for each word, filled up with the unknown code."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        table = np.full((int(size.max()), len(words)), self.width - 1, np.int64)
        column = np.repeat(np.arange(len(words)), size)
        row = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
        table[row, column] = self.code_of[points]
        return table

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next state of each row, by failure links where no edge fits."""
        after = np.zeros_like(state)
        open_rows = np.flatnonzero(code < self.width - 1)
        at = state[open_rows]
        while len(open_rows):
            wanted = at * self.width + code[open_rows]
            place = np.searchsorted(self.edge, wanted)
            fits = self.edge[place] == wanted
            after[open_rows[fits]] = self.child[place[fits]]
            left = ~fits & (at > 0)
            open_rows, at = open_rows[left], self.fail[at[left]]
        return after


# Signs of ASCII, Latin-1 and general punctuation.
_SIGNS = "\\x00-\\x1f!-/:-@\\[-`{-\\xa9\\xab-\\xb4\\xb6-\\xb9\\xbb-\\xbf\\u2000-\\u206f"
_KINDS = (f"[^0-9{_SIGNS}{SPACE}]", "[0-9]", f"[{_SIGNS}]")  # letters, digits, signs


def _cut_rule(pieces: Iterable[str]) -> re.Pattern:
    """Stretches of one kind of characters with the spaces before them, if that
    is how all pieces are made; else words; else the whole text."""
    one_kind = re.compile(f"{SPACE}*(?:{'|'.join(kind + '*' for kind in _KINDS)})")
    if all(one_kind.fullmatch(text) for text in pieces):
        return re.compile("|".join([*(f"{SPACE}*{kind}+" for kind in _KINDS), f"{SPACE}+"]))
    if not any(SPACE in text.lstrip(SPACE) for text in pieces):
        return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
    return re.compile("(?s).+")


class Merges:
    """Which pieces, and which pairs of them, are stable under all merges."""

    def __init__(self, automaton: Automaton, pieces: dict[str, tuple[int, float]]):
        self.text = automaton.text
        self.rank = {text: -score for text, (_, score) in pieces.items()}
        self.parts: dict[str, tuple[str, str] | None] = {}  # of the merge that makes a piece
        self.whole = np.array([bool(t) and self.merged(t) == [t] for t in self.text])
        self.left: dict[str, list[str] | None] = {}
        self.right: dict[str, list[str] | None] = {}
        self.known: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """All merges in the order of ranks, the leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == np.inf:
                break
            at = ranks.index(best)
            self.parts.setdefault(parts[at] + parts[at + 1], (parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, text: str, side: int) -> list[str] | None:
        """What stands at one end of a piece while it is merged, from its first
        character to itself; None if the ranks on the way do not rise."""
        made = (self.left, self.right)[side]
        if text not in made:
            way = [text]
            while len(way[-1]) > 1:
                way.append(self.parts[way[-1]][side])
            way.reverse()
            ranks = [self.rank[t] for t in way[1:]]
            made[text] = way if all(a < b for a, b in zip(ranks, ranks[1:])) else None
        return made[text]

    def pair(self, left: str, right: str) -> bool:
        """Whether merging both together never joins them.

        Their facing ends grow in the order of ranks; a merge across would have
        to come before either grows on, and of equal ranks the left one is first.
        """
        a, b = self.edge(left, 1), self.edge(right, 0)
        if a is None or b is None:
            return self.merged(left + right) == [left, right]
        i = j = 0
        while True:
            after = self.rank[a[i + 1]] if i + 1 < len(a) else np.inf
            other = self.rank[b[j + 1]] if j + 1 < len(b) else np.inf
            across = self.rank.get(a[i] + b[j], np.inf)
            if across < after and across <= other and across < np.inf:
                return False
            if after == other == np.inf:
                return True
            if after <= other:
                i += 1
            else:
                j += 1

    def stable(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether each pair of states stays as it is; 0 is an uncovered character."""
        keys, place = np.unique(before * len(self.text) + after, return_inverse=True)
        found = np.ones(len(keys), bool)
        for n, key in enumerate(keys.tolist()):
            known = self.known.get(key)
            if known is None:
                a, b = divmod(key, len(self.text))
                known = not a or self.pair(self.text[a], self.text[b])
                if len(self.known) >= CACHED_PAIRS:
                    self.known.clear()
                self.known[key] = known
            found[n] = known
        return found[place]


class Codec:
    """Encoder and decoder of one model file.

    ``rule`` is "score" or "merges"; by itself it follows from the file: merge
    models count their pieces' scores down (late additions share the lowest).
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS, rule: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model, self.limit = model, limit
        numbers = range(model.get_piece_size())
        texts = [model.id_to_piece(i) for i in numbers]
        self.bytes = {int(texts[i][1:-1], 16): i for i in numbers if model.is_byte(i)}
        plain = {
            texts[i]: (i, model.get_score(i))
            for i in numbers
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.automaton = Automaton(plain)
        self.sizes = {number: len(text) for text, (number, _) in plain.items()}
        self.unknown = model.unk_id()
        self.unknown_score = min(score for _, score in plain.values()) - UNKNOWN_PENALTY
        scores = [score for _, score in plain.values()]
        lowest = min(scores)
        ranks = [score for score in scores if score > lowest]
        counted = all(a - b >= 1 and a == int(a) for a, b in zip(ranks, ranks[1:]))
        rule = rule or ("merges" if counted else "score")
        self.merges = Merges(self.automaton, plain) if rule == "merges" else None
        self.cut = _cut_rule(plain)
        self.known: dict[str, bytes] = {}
        self.written = [
            bytes([int(text[1:-1], 16)]) if model.is_byte(i)
            else b"" if model.is_control(i)
            else " ⁇ ".encode() if model.is_unknown(i)
            else text.encode()
            for i, text in zip(numbers, texts)
        ]
        probe = model.normalize("a")
        self.prefixed = probe.startswith(SPACE)

    def words(self, text: str) -> list[str]:
        """The normalised text in stretches that no piece reaches across."""
        normal = self.model.normalize(text) if text else ""
        return self.cut.findall(normal)

    def solve(self, words: list[str]) -> list[bytes]:
        """Ids of each word, little-endian; words of like length side by side."""
        solved: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda n: len(words[n]))
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and (end + 1 - begin) * len(words[order[end]]) <= CELLS:
                end += 1
            some = order[begin:end]
            for n, ids in zip(some, self._viterbi([words[n] for n in some])):
                solved[n] = ids
            begin = end
        return solved

    def _viterbi(self, words: list[str]) -> Iterator[bytes]:
        a = self.automaton
        size = np.array([len(w) for w in words])
        longest = int(size.max())
        codes = a.codes(words, size)
        best = np.full((longest + 1, len(words)), -np.inf)
        best[0] = 0.0
        chosen = np.zeros((longest + 1, len(words)), np.int32)  # state of the last piece, 0: unknown
        state = np.zeros(len(words), np.int64)
        rows = np.arange(len(words))
        for i in range(longest):
            state = a.step(state, codes[i])
            out = np.where(a.piece[state] >= 0, state, a.link[state])
            here = rows[out > 0]
            out = out[here]
            if self.merges:
                self._take_stable(i, here, out, best, chosen)
                here = here[:0]
            while len(here):
                value = best[i + 1 - a.length[out], here] + a.score[out]
                better = value > best[i + 1, here]
                best[i + 1, here[better]] = value[better]
                chosen[i + 1, here[better]] = out[better]
                out = a.link[out]
                here, out = here[out > 0], out[out > 0]
            lone = rows[~a.single[codes[i]]]
            value = best[i, lone] + self.unknown_score
            better = value > best[i + 1, lone]
            best[i + 1, lone[better]] = value[better]
            chosen[i + 1, lone[better]] = 0
        # Follow the choices from the ends of all words at once.
        ids = np.full((len(words), longest), -1, np.int32)
        at, used, open_rows = size.copy(), np.zeros(len(words), np.int64), rows
        while len(open_rows):
            own = chosen[at[open_rows], open_rows]
            used[open_rows] += 1
            ids[open_rows, longest - used[open_rows]] = a.piece[own]
            at[open_rows] -= np.where(own > 0, a.length[own], 1)
            open_rows = open_rows[at[open_rows] > 0]
        spelled = (ids == -1).sum(axis=1) > longest - used
        for n, word in enumerate(words):
            found = ids[n, longest - used[n] :]
            yield self._spell(word, found.tolist()) if spelled[n] else found.tobytes()

    def _take_stable(
        self, i: int, here: np.ndarray, out: np.ndarray, best: np.ndarray, chosen: np.ndarray
    ) -> None:
        """The piece that ends after character ``i`` and that no merge changes."""
        a, merges = self.automaton, self.merges
        while len(here):
            start = i + 1 - a.length[out]
            whole = merges.whole[out]
            fits = whole & (start == 0)
            asked = whole & (start > 0)
            fits[asked] = merges.stable(
                chosen[start[asked], here[asked]].astype(np.int64), out[asked]
            )
            best[i + 1, here[fits]] = 0.0
            chosen[i + 1, here[fits]] = out[fits]
            here, out = here[~fits], a.link[out[~fits]]
            here, out = here[out > 0], out[out > 0]

    def _spell(self, word: str, pieces: list[int]) -> bytes:
        """Uncovered characters, marked -1, become their bytes."""
        ids, at = [], 0
        for piece in pieces:
            if piece >= 0:
                ids.append(piece)
                at += self.sizes[piece]
            else:
                ids += self._spelled(word[at])
                at += 1
        return np.array(ids, "<i4").tobytes()

    def _spelled(self, char: str) -> list[int]:
        raw = char.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if self.bytes else [self.unknown]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.words(text) for text in texts]
        needed = set().union(*split) if split else set()
        missing = needed.difference(self.known)
        if len(self.known) + len(missing) > self.limit:
            self.known = {}
            missing = needed
        todo = list(missing)
        self.known.update(zip(todo, self.solve(todo)))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<i4").tolist()
        raw = b"".join(map(self.written.__getitem__, numbers))
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefixed and text.startswith(" ") else text


_CODECS: dict[tuple, Codec] = {}  # one per Python worker, kept between tasks


def codec(path: str, rule: str | None = None) -> Codec:
    if (path, rule) not in _CODECS:
        _CODECS[path, rule] = Codec(path, rule=rule)
    return _CODECS[path, rule]


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encode(docs: DataFrame, model: str, rule: str | None = None) -> DataFrame:
    """``doc_id, ids, n_tokens`` and ``round_trip``, whether decoding gives the
    text back, one row per row of ``docs``.  ``rule`` as for ``Codec``.

    A null or empty text has no ids.  A text holding the piece mark itself, or
    one the model's normaliser changes, does not come back as it was.  Repeated
    rows are encoded each.  Other columns are neither read nor returned.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model, rule)
        for batch in batches:
            for part in slices(batch, 2 << 20):
                texts = part[1].to_pylist()
                ids = pieces.encode(texts)
                same = [pieces.decode(own) == text for own, text in zip(ids, texts)]
                sizes = pa.array([len(own) // 4 for own in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part[0], _lists(ids), sizes, pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "n_tokens", "round_trip"],
                )

    return map_batches(whole_texts(docs), step, ENCODED)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null or empty ids give an empty text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in batches:
            texts = [pieces.decode(np.array(i or [], "<i4").tobytes()) for i in batch[1].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return map_batches(encoded.select("doc_id", "ids"), step, "doc_id long, text string")
