"""Secret scan: base rules, and automata learned from the credentials they find.

The base rules of the corpus contract find credentials by their surroundings or
by a fixed form and thereby label them.  From a bounded sample of each kind a
prefix tree is built, and states of equal depth that are statistically
compatible are merged into a probabilistic automaton.  As only states of one
depth meet, the automaton keeps at which place a format has which characters
and where it ends.  Further automata are learned from strings of the corpus that
no rule calls a credential, short and long ones.

Every run of credential characters outside the base spans is a candidate: as it
stands, what follows a ``=`` in it, and both without the punctuation around
them.  It is scored by how much likelier it is under a kind's automaton than
under those of ordinary strings, and one that passes the threshold is reported
as ``format``.  It never replaces or overlaps a base span.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import TEXT, map_batches, slices, whole_texts

# The base rules.
KINDS = ("assign", "access", "hex")
FORMAT = "format"
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
_KEYS = ("passw", "secret", "token", "api")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32

MIN_RUN = 16
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
_ANY_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_ASSIGNED)
_DIGIT = re.compile(r"[0-9]")
_PUNCTUATION = "+/_.=-"
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")

SAMPLE_PER_KIND = 400  # labelled strings of a kind that its automaton is learned from
LEARNED = 256  # characters of a string that are learned from; the driver gets no more
COMPATIBLE = 0.05  # significance of the test for merging two states
THRESHOLD = 0.25  # natural-log units per character
EVIDENCE = 6.0  # and for the whole candidate, so that a short one needs more per character
OWN_CHARACTERS = 64.0  # visits from which a state's characters count more than their classes
SHARED = 2.0  # visits that the whole kind's shares count for in every state
ORDINARY = ("ordinary", "word", "number")  # by ordinary_kind
SHORTEST = {"assign": MIN_ASSIGNED, "access": MIN_ACCESS, "hex": MIN_HEX}
KEPT_VERDICTS = 200_000

Span = tuple[str, int, int]

# --- base rules ----------------------------------------------------------------


def _runs(text: str) -> Iterator[tuple[int, str]]:
    return ((m.start(), m[0]) for m in _RUN.finditer(text))


def base_spans(text: str) -> list[Span]:
    """By start, then kind as listed.  Positions are code points.

    Access keys and hex strings of the required length lie inside the long runs,
    so only those are searched for them.
    """
    found: list[Span] = []
    lowered = text.lower()
    if any(key in lowered for key in _KEYS):
        found += [
            ("assign", m.start(), m.end())
            for m in _ASSIGN.finditer(text)
            if len(m[2]) >= MIN_ASSIGNED
        ]
    for at, run in _runs(text):
        for kind, rule, least in (("access", _ACCESS, MIN_ACCESS), ("hex", _HEX, MIN_HEX)):
            found += [
                (kind, at + m.start(), at + m.end())
                for m in rule.finditer(run)
                if m.end() - m.start() >= least
            ]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def credential(text: str, span: Span) -> str:
    """The secret itself: what is assigned, or the whole match."""
    kind, start, end = span
    return _ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]


def outside(text: str, spans: Iterable[Span], least: int = MIN_ASSIGNED) -> list[tuple[int, str]]:
    """Runs of credential characters outside the base spans, also the parts of
    runs that a span covers in part, of ``least`` characters or more."""
    taken = sorted((start, end) for _, start, end in spans)
    free, k = [], 0
    for m in _ANY_RUN.finditer(text):
        at, stop = m.span()
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        n = k
        while n < len(taken) and taken[n][0] < stop:
            if taken[n][0] - at >= least:
                free.append((at, text[at : taken[n][0]]))
            at = max(at, taken[n][1])
            n += 1
        if stop - at >= least:
            free.append((at, text[at:stop]))
    return free


def candidates(run: str) -> Iterator[tuple[int, str]]:
    """A run and what it may hold: start within it, string."""
    forms = [(0, run)]
    after = run.rstrip("=").rfind("=") + 1
    if after:
        forms.append((after, run[after:]))
    for at, form in forms:
        yield at, form
        bare = form.strip(_PUNCTUATION)
        if bare != form:
            yield at + form.index(bare), bare


# --- automata --------------------------------------------------------------------


def _classes() -> dict[str, tuple[str, int]]:
    """Symbol of the automata and size of its class, for every run character."""
    groups = ["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ"]
    groups += list("+/_.=-")
    return {c: (group[0], len(group)) for group in groups for c in group}


_CLASS = _classes()
_SYMBOLS = len({symbol for symbol, _ in _CLASS.values()})


@dataclass
class State:
    visits: int = 0
    ends: int = 0
    moves: dict[str, "State"] = field(default_factory=dict)  # by class
    passed: dict[str, int] = field(default_factory=dict)  # strings that went on, by class
    chars: dict[str, int] = field(default_factory=dict)  # and by character


def _add(counts: dict[str, int], more: dict[str, int]) -> None:
    for key, times in more.items():
        counts[key] = counts.get(key, 0) + times


def prefix_tree(strings: Iterable[str]) -> State:
    root = State()
    for string in strings:
        here = root
        here.visits += 1
        for char in string[:LEARNED]:
            symbol = _CLASS[char][0]
            _add(here.passed, {symbol: 1})
            _add(here.chars, {char: 1})
            here = here.moves.setdefault(symbol, State())
            here.visits += 1
        here.ends += len(string) <= LEARNED
    return root


def _differ(f1: int, n1: int, f2: int, n2: int) -> bool:
    """Hoeffding's bound on two observed shares."""
    bound = math.sqrt(0.5 * math.log(2 / COMPATIBLE)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    return abs(f1 / n1 - f2 / n2) > bound


def _compatible(red: State, blue: State) -> bool:
    """Whether both states, and all that is reached from both, behave alike."""
    open_pairs = [(red, blue)]
    while open_pairs:
        a, b = open_pairs.pop()
        if _differ(a.ends, a.visits, b.ends, b.visits):
            return False
        for symbol in a.passed.keys() | b.passed.keys():
            if _differ(a.passed.get(symbol, 0), a.visits, b.passed.get(symbol, 0), b.visits):
                return False
        open_pairs += [(a.moves[s], b.moves[s]) for s in b.moves if s in a.moves]
    return True


def _fold(into: State, tree: State) -> None:
    """Add a tree's counts to a state and to what is reached from it."""
    open_pairs = [(into, tree)]
    while open_pairs:
        a, b = open_pairs.pop()
        a.visits += b.visits
        a.ends += b.ends
        _add(a.passed, b.passed)
        _add(a.chars, b.chars)
        for symbol, child in b.moves.items():
            if symbol in a.moves:
                open_pairs.append((a.moves[symbol], child))
            else:
                a.moves[symbol] = child


def merged(root: State) -> list[list[State]]:
    """The states of every depth.  Depth by depth, the most visited state first,
    each is merged into the first compatible one that is settled, or is settled
    itself."""
    layers = [[root]]
    while True:
        above, settled = layers[-1], []
        below = [(child.visits, -n, symbol) for n, state in enumerate(above) for symbol, child in state.moves.items()]
        for _, place, symbol in sorted(below, reverse=True):
            state = above[-place]
            child = state.moves[symbol]
            for other in settled:
                if _compatible(other, child):
                    state.moves[symbol] = other
                    _fold(other, child)
                    break
            else:
                settled.append(child)
        if not settled:
            return layers
        layers.append(settled)


@dataclass(frozen=True)
class Automaton:
    """Per state: character -> log-probability and next state.  Every character
    is possible; what a state hasn't seen leads to the busiest state of the next
    depth, and beyond the last depth a state without memory goes on."""

    moves: list[dict[str, tuple[float, int]]]
    ends: list[float]

    def likelihood(self, string: str) -> float:
        at, total, moves = 0, 0.0, self.moves
        for char in string:
            logp, at = moves[at][char]
            total += logp
        return total + self.ends[at]


def automaton(strings: Iterable[str]) -> Automaton:
    """States have the shares of their own characters, as far as they have been
    visited, then those of the characters' classes, then those of all strings."""
    layers = merged(prefix_tree(strings))
    number = {id(state): n for n, state in enumerate(s for layer in layers for s in layer)}
    beyond = len(number)
    every = [state for layer in layers for state in layer]
    total = sum(s.visits for s in every)
    shares = {symbol: (sum(s.passed.get(symbol, 0) for s in every) + 1.0) / (total + _SYMBOLS + 1)
              for symbol in {symbol for symbol, _ in _CLASS.values()}}
    end = (sum(s.ends for s in every) + 1.0) / (total + _SYMBOLS + 1)
    moves, ends = [], []
    for depth, layer in enumerate(layers):
        next_layer = layers[depth + 1] if depth + 1 < len(layers) else []
        busiest = number[id(max(next_layer, key=lambda s: s.visits))] if next_layer else beyond
        for state in layer:
            known = state.visits + SHARED
            row = {}
            for char, (symbol, size) in _CLASS.items():
                of_class = (state.passed.get(symbol, 0) + SHARED * shares[symbol]) / known / size
                seen = state.chars.get(char, 0) + OWN_CHARACTERS * of_class
                after = number[id(state.moves[symbol])] if symbol in state.moves else busiest
                row[char] = (math.log(seen / (state.visits + OWN_CHARACTERS)), after)
            stops = (state.ends + SHARED * end) / known
            moves.append(row)
            ends.append(math.log((state.ends + OWN_CHARACTERS * stops) / (state.visits + OWN_CHARACTERS)))
    moves.append({char: (math.log(shares[symbol] / size), beyond) for char, (symbol, size) in _CLASS.items()})
    return Automaton(moves, [*ends, math.log(end)])


@dataclass(frozen=True)
class SecretModel:
    """One automaton per kind that had labelled strings, and the ordinary ones."""

    kinds: dict[str, Automaton]
    ordinary: list[Automaton]
    threshold: float = THRESHOLD
    verdicts: dict[str, bool] = field(default_factory=dict, repr=False, compare=False)

    @property
    def least(self) -> int:
        """The shortest credential that a labelled kind can be."""
        return min(SHORTEST[kind] for kind in self.kinds)

    def gain(self, string: str) -> float:
        """How much likelier as a credential than as anything else."""
        plain = max((a.likelihood(string) for a in self.ordinary), default=-math.inf)
        return max((a.likelihood(string) for a in self.kinds.values()), default=-math.inf) - plain

    def is_secret(self, string: str) -> bool:
        found = self.verdicts.get(string)
        if found is None:
            if len(self.verdicts) >= KEPT_VERDICTS:
                self.verdicts.clear()
            found = self.gain(string) > max(EVIDENCE, self.threshold * len(string))
            self.verdicts[string] = found
        return found

    def extra_spans(self, text: str, base: list[Span]) -> list[Span]:
        if not self.kinds:
            return []
        least, spans = self.least, []
        for at, run in outside(text, base, least):
            found = [c for c in candidates(run) if len(c[1]) >= least and self.is_secret(c[1])]
            if found:
                best = max(found, key=lambda c: self.gain(c[1]) / len(c[1]))
                spans.append((FORMAT, at + best[0], at + best[0] + len(best[1])))
        return spans


def ordinary_kind(run: str) -> str:
    """Runs with a digit are learned for themselves, and so are short ones, or a
    bounded sample would hold hardly any of the rarer sort."""
    if _DIGIT.search(run):
        return "number"
    return "word" if len(run) < MIN_RUN else "ordinary"


def _place(kind: str, value: str) -> int:
    """Where a string stands in the order that the sample is taken from."""
    made = blake2b(f"{kind}:{value}".encode(), digest_size=8).digest()
    return int.from_bytes(made, "big") >> 1


def labelled_strings(docs: DataFrame, per_kind: int = SAMPLE_PER_KIND) -> DataFrame:
    """``kind, value``: of each kind the ``per_kind`` distinct strings that come
    first by hash, over all documents.  A task sends no more than that."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[str, list[tuple[int, str]]] = {kind: [] for kind in (*KINDS, *ORDINARY)}
        held: dict[str, set[str]] = {kind: set() for kind in first}

        def offer(kind: str, value: str) -> None:
            value = value[: LEARNED + 1]  # one more tells that it goes on
            heap = first[kind]
            if value in held[kind]:
                return
            entry = (-_place(kind, value), value)
            if len(heap) < per_kind:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                held[kind].discard(heapq.heapreplace(heap, entry)[1])
            else:
                return
            held[kind].add(value)

        for batch in batches:
            for part in slices(batch):
                for text in part[0].to_pylist():
                    base = base_spans(text)
                    for span in base:
                        offer(span[0], credential(text, span))
                    for _, run in outside(text, base):
                        offer(ordinary_kind(run), run)
        rows = [(kind, value, -place) for kind, heap in first.items() for place, value in heap]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows)], names=["kind", "value", "place"]
            )

    found = map_batches(whole_texts(docs).select(TEXT), step, "kind string, value string, place long")
    # There are few kinds: the first of each of 64 parts, then the first of those.
    first = found.distinct().withColumn("part", F.pmod("place", F.lit(64)))
    for keys in (["kind", "part"], ["kind"]):
        order = Window.partitionBy(*keys).orderBy("place", "value")
        ranked = first.withColumn("rank", F.row_number().over(order))
        first = ranked.where(F.col("rank") <= per_kind).drop("rank")
    return first.select("kind", "value")


def fit(docs: DataFrame, per_kind: int = SAMPLE_PER_KIND) -> SecretModel:
    """At most six times ``per_kind`` strings, of ``LEARNED`` characters and
    one, reach the driver."""
    strings: dict[str, list[str]] = {}
    for row in labelled_strings(docs, per_kind).orderBy("kind", "value").collect():
        strings.setdefault(row.kind, []).append(row.value)
    kinds = {kind: automaton(strings[kind]) for kind in KINDS if kind in strings}
    return SecretModel(kinds, [automaton(strings[kind]) for kind in ORDINARY if kind in strings])


# --- operators ---------------------------------------------------------------------

SPANS = "array<struct<kind: string, start: int, end: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``doc_id``, ``base`` (spans of the base rules) and ``found`` (those and
    the learned ones, by start), one row per row of ``docs``.

    A null text is an empty one and has no spans.  Repeated rows are scanned
    each.  Other columns are neither read nor returned.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {kind: n for n, kind in enumerate((*KINDS, FORMAT))}
        names = ("kind", "start", "end")
        for batch in batches:
            for part in slices(batch):
                base = [base_spans(text) for text in part[1].to_pylist()]
                every = [
                    sorted(own + model.extra_spans(text, own), key=lambda s: (s[1], order[s[0]]))
                    for text, own in zip(part[1].to_pylist(), base)
                ]
                arrays = [
                    pa.array([[dict(zip(names, s)) for s in row] for row in rows], _SPAN_TYPE)
                    for rows in (base, every)
                ]
                yield pa.RecordBatch.from_arrays([part[0], *arrays], names=["doc_id", "base", "found"])

    return map_batches(whole_texts(docs), step, f"doc_id long, base {SPANS}, found {SPANS}")


def redacted(text: str, spans: list[Span]) -> str:
    """Every stretch that spans cover becomes the name of its first kind."""
    pieces, at, end = [], 0, 0
    for kind, start, stop in sorted(spans, key=lambda s: s[1]):
        if start >= end:
            pieces += [text[end:start], f"[{kind} removed]"]
        end = max(end, stop)
    return "".join([*pieces, text[end:]])


def redact(docs: DataFrame, model: SecretModel) -> DataFrame:
    """All rows and columns of ``docs`` with secrets replaced in the text.

    ``n_chars``, where there is such a column, follows the text.  A text
    without secrets, a null one included, is unchanged.
    """
    place = docs.columns.index(TEXT)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = list(part.columns)
                texts = columns[place].to_pylist()
                sizes = columns[counted].to_pylist() if counted is not None else []
                for n, text in enumerate(texts):
                    base = base_spans(text or "")
                    spans = base + model.extra_spans(text or "", base)
                    if spans:
                        texts[n] = redacted(text, spans)
                        if counted is not None:
                            sizes[n] = len(texts[n])
                columns[place] = pa.array(texts, columns[place].type)
                if counted is not None:
                    columns[counted] = pa.array(sizes, columns[counted].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return map_batches(docs, step, docs.schema)
