"""Removal of long repeated strings, found in an enhanced suffix array.

Suffixes are sorted where a repeat must show.  Of all ``GRAM``-byte strings in a
window of 200 bytes the one with the least hash is the window's anchor; equal
windows have equal anchors at the same place, so repeats only need to be looked
for among suffixes that start at equal anchors.  An anchor's *context* is all
that windows with this anchor can reach to its left and right.

Anchors are dealt by their hash.  Contexts that are equal as a whole are one
leaf and repeat from end to end.  The different contexts of an anchor are
sorted by what follows it (the suffix array), neighbours give the common-prefix
array, and a scan with a stack visits every common-prefix interval.  Inside an
interval the sorted left extensions tell which members agree far enough to the
left for 200 bytes, and where they begin to differ: those classes are the
maximal repeat groups, with all their occurrences.

An anchor with more contexts than one task should hold is resolved by counting
its 200-byte strings instead, with sums in every task before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import DOC_ID, TEXT, map_batches, slices, whole_texts
from .shingles import mixed, span_hashes

MIN_BYTES = 200
GRAM = 80
GROUP_CONTEXTS = 50_000

KEY = "text_key"  # tells texts apart that share an id
_ANCHORS = (
    f"doc_id long, {KEY} long, anchor long, context long, at int, n_bytes int, "
    "repeats boolean, stop int"
)
_CONTEXTS = f"anchor long, doc_id long, {KEY} long, at int, n_bytes int, known boolean, before binary, after binary"
_SPANS = f"doc_id long, {KEY} long, start int, stop int"

# --- anchors -------------------------------------------------------------------


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors(data: bytes, least: int = MIN_BYTES, gram: int = GRAM) -> np.ndarray:
    """Where anchors of the windows of ``data`` start; all of equal least ones."""
    if len(data) < least:
        return np.zeros(0, np.int64)
    starts = np.arange(len(data) - gram + 1)
    hashes = span_hashes(data, starts, starts + gram)
    width = least - gram + 1
    minima = _sliding_min(hashes, width)
    edge = np.zeros(width - 1, np.uint64)
    # A gram is an anchor if it is as small as the largest minimum around it.
    around = ~_sliding_min(~np.concatenate([edge, minima, edge]), width)
    return np.flatnonzero(hashes == around)


def _reach(at: np.ndarray, size: int, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the contexts of anchors in a text of ``size`` bytes."""
    return np.maximum(at - (least - gram), 0), np.minimum(at + least, size)


def _anchor_rows(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """One row per anchor; a text that a task has seen already gives none.

    Of anchors that a batch holds with equal contexts, as periodic texts do in
    great numbers, one row is given, which ``repeats``.  The stretches of the
    others are given as they are, from ``at`` to ``stop``, under a number of
    their own as anchor.
    """
    names = [c.split()[0] for c in _ANCHORS.split(", ")]

    def described(doc_id: int | None, data: bytes, key: int, at: np.ndarray) -> tuple:
        begin, end = _reach(at, len(data), least, gram)
        n = len(at)
        # Where the anchor lies in its context is part of the context.
        context = span_hashes(data, begin, end) + (at - begin).astype(np.uint64)
        anchor = span_hashes(data, at, at + gram)
        return (
            np.full(n, doc_id if doc_id is not None else 0), np.full(n, doc_id is None),
            np.full(n, key), anchor.view(np.int64), context.view(np.int64), at, np.full(n, len(data)),
        )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, 4 << 20):
                made: list[tuple] = []
                for doc_id, text, key in zip(*(c.to_pylist() for c in part.columns)):
                    data = text.encode()
                    mark = hashlib.blake2b(data, digest_size=16).digest()
                    at = np.zeros(0, np.int64) if mark in seen else anchors(data, least, gram)
                    if len(at):
                        seen.add(mark)
                        made.append(described(doc_id, data, key, at))
                if made:
                    columns = _combined([np.concatenate(c) for c in zip(*made)], least, gram)
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = whole_texts(docs, F.xxhash64(F.coalesce(F.col(TEXT), F.lit(""))).alias(KEY))
    return map_batches(keyed, step, _ANCHORS)


def _combined(rows: list[np.ndarray], least: int, gram: int) -> list[pa.Array]:
    """Rows of equal anchor and context as one, and the others' stretches."""
    ids, missing, keys, anchor, context, at, size = rows
    order = np.lexsort((context, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (context[order][1:] != context[order][:-1])
    one = order[new]
    repeats = np.diff(np.append(np.flatnonzero(new), len(order))) > 1
    rest = np.sort(order[~new])  # by document and place
    begin, end = _reach(at[rest], size[rest], least, gram)
    # Neighbours of one document that touch are one stretch.
    apart = np.ones(len(rest), bool)
    apart[1:] = (ids[rest][1:] != ids[rest][:-1]) | (keys[rest][1:] != keys[rest][:-1])
    apart[1:] |= missing[rest][1:] != missing[rest][:-1]
    apart[1:] |= begin[1:] > end[:-1]
    start = np.flatnonzero(apart)
    last = np.append(start[1:], len(rest))[: len(start)] - 1
    some = rest[start]
    own = mixed((ids[some] * 31 + begin[start]).astype(np.uint64) ^ keys[some].view(np.uint64))
    both = lambda a, b: np.concatenate([a, b])
    no_stop = np.full(len(one), True)
    return [
        pa.array(both(ids[one], ids[some]), pa.int64(), mask=both(missing[one], missing[some])),
        pa.array(both(keys[one], keys[some])),
        pa.array(both(anchor[one], own.view(np.int64))),
        pa.array(both(context[one], own.view(np.int64))),
        pa.array(both(at[one], begin[start]).astype(np.int32)),
        pa.array(both(size[one], size[some]).astype(np.int32)),
        pa.array(both(repeats, np.full(len(some), True))),
        pa.array(
            both(np.zeros(len(one)), end[last]).astype(np.int32),
            mask=both(no_stop, np.full(len(some), False)),
        ),
    ]


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, key and the compressed text, for joins that move texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch):
                data = pa.array([press.compress(t.encode()) for t in part[1].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part[0], part[2], data], names=["doc_id", KEY, "data"])

    keyed = whole_texts(docs, F.xxhash64(F.coalesce(F.col(TEXT), F.lit(""))).alias(KEY))
    return map_batches(keyed, step, f"doc_id long, {KEY} long, data binary")


# --- the suffix array of one anchor ----------------------------------------------


def _common_prefixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order, and for each place the common prefix with the one before."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    width = max(len(s) for s in strings) + 1
    table = np.frombuffer(b"".join(strings[n].ljust(width, b"\0") for n in order), np.uint8)
    table = table.reshape(len(order), width)
    sizes = np.array([len(strings[n]) for n in order])
    differ = table[1:] != table[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    return np.array(order), np.concatenate([[0], common])


def intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals of at least ``least``: value, first, last place."""
    stack: list[tuple[int, int]] = []  # value, first place
    values = common.tolist()
    for place in range(1, len(values) + 1):
        value = values[place] if place < len(values) else 0
        first = place - 1
        while stack and stack[-1][0] > value:
            depth, first = stack.pop()
            if depth >= least:
                yield depth, first, place - 1
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def repeat_groups(
    before: list[bytes], after: list[bytes], least: int = MIN_BYTES
) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats around one anchor: bytes to its left, bytes from its start
    on, and all members that have them.

    ``before`` holds the reversed left extensions of the contexts, ``after`` what
    starts with the anchor.
    """
    order, common = _common_prefixes(after)
    left_order, left_common = _common_prefixes(before)
    place = np.empty(len(order), np.int64)
    place[left_order] = np.arange(len(order))
    for right, first, last in intervals(common, 1):
        need = max(0, least - right)
        members = np.sort(place[order[first : last + 1]])
        # Common left extension of neighbours among the members.
        edges = np.column_stack([members[:-1] + 1, members[1:] + 1]).ravel()
        padded = np.append(left_common, 0)
        shared = np.minimum.reduceat(padded, edges)[::2]
        begin = 0
        for cut in [*np.flatnonzero(shared < need).tolist(), len(shared)]:
            if cut > begin:
                own = members[begin : cut + 1]
                yield int(shared[begin:cut].min()), right, left_order[own].tolist()
                # Members that agree further to the left than their class.
                yield from _further(shared[begin:cut], own, left_order, right)
            begin = cut + 1


def _further(
    shared: np.ndarray, members: np.ndarray, left_order: np.ndarray, right: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Classes within a class that agree further to the left."""
    floor = int(shared.min())
    if int(shared.max()) == floor:
        return
    common = np.concatenate([[0], shared])
    for left, first, last in intervals(common, floor + 1):
        yield left, right, left_order[members[first : last + 1]].tolist()


def _two(before: list[bytes], after: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """The same for two contexts, without arrays."""
    left, right = (_agree(*pair) for pair in (before, after))
    if left + right >= least:
        yield left, right, [0, 1]


def _agree(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def covered(before: list[bytes], after: list[bytes], least: int = MIN_BYTES) -> list[tuple[int, int]]:
    """How far to the left and right of its anchor each context repeats."""
    reach = [(0, 0)] * len(before)
    find = _two if len(before) == 2 else repeat_groups
    for left, right, members in find(before, after, least):
        for n in members:
            reach[n] = (max(reach[n][0], left), max(reach[n][1], right))
    return reach


# --- operator ----------------------------------------------------------------------


def _contexts(docs: DataFrame, wanted: DataFrame, least: int, gram: int) -> DataFrame:
    """The bytes around the wanted anchors."""
    asked = wanted.groupBy(DOC_ID, KEY).agg(
        F.collect_list(F.struct("anchor", "at", "known")).alias("anchors")
    )
    asked = asked.select(F.col(DOC_ID).alias("_id"), F.col(KEY).alias("_key"), "anchors")
    same = F.col(DOC_ID).eqNullSafe(F.col("_id")) & (F.col(KEY) == F.col("_key"))
    texts = _packed(docs).join(asked, same).select(DOC_ID, KEY, "data", "anchors")
    names = [c.split()[0] for c in _CONTEXTS.split(", ")]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in slices(batch, 1 << 20):
                rows: list[tuple] = []
                for doc_id, key, data, found in zip(*(c.to_pylist() for c in part.columns)):
                    text = unpress.decompress(data)
                    for one in found:
                        at = one["at"]
                        begin, end = max(at - (least - gram), 0), min(at + least, len(text))
                        rows.append((one["anchor"], doc_id, key, at, len(text), one["known"],
                                     text[begin:at][::-1], text[at:end]))
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays(_columns(rows), names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(_columns(rows), names=names)

    return map_batches(texts, step, _CONTEXTS).dropDuplicates([DOC_ID, KEY, "at"])


_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)]


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one anchor after another, from batches sorted by anchor."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[0][0] != row[0]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _scan(contexts: DataFrame, least: int) -> DataFrame:
    """Spans that repeat, from all contexts of an anchor in one task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for group in _groups(batches):
            if len(group) > 1 and not all(row[5] for row in group):
                reach = covered([row[6] for row in group], [row[7] for row in group], least)
                made += [
                    (row[1], row[2], row[3] - left, row[3] + right)
                    for row, (left, right) in zip(group, reach)
                    if right and not row[5]
                ]
            if len(made) >= 20_000:
                yield _spans(made)
                made = []
        if made:
            yield _spans(made)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return map_batches(dealt, step, _SPANS)


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SPANS.split(", ")])


def _count(contexts: DataFrame, least: int) -> DataFrame:
    """The same spans by counting the strings of every context: for anchors
    whose contexts are too many for one task."""
    schema = f"doc_id long, {KEY} long, start int, one long, two long"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                data = row[6][::-1] + row[7]
                starts = np.arange(len(data) - least + 1)
                if len(starts):
                    middle = starts + least // 2
                    begin = row[3] - len(row[6])
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row[1]] * n, pa.int64()), pa.array(np.full(n, row[2])),
                         pa.array((starts + begin).astype(np.int32)),
                         pa.array(span_hashes(data, starts, middle).view(np.int64)),
                         pa.array(span_hashes(data, middle, starts + least).view(np.int64))],
                        names=["doc_id", KEY, "start", "one", "two"],
                    )

    strings = map_batches(contexts, step, schema).distinct()
    often = strings.groupBy("one", "two").count().where("count > 1").select("one", "two")
    return strings.join(often, ["one", "two"]).select(
        DOC_ID, KEY, "start", (F.col("start") + least).cast("int").alias("stop")
    )


def repeated_spans(
    docs: DataFrame,
    work: Scratch,
    least: int = MIN_BYTES,
    gram: int = GRAM,
    group_contexts: int = GROUP_CONTEXTS,
) -> DataFrame:
    """``doc_id, text_key, start, stop``: stretches of bytes that are covered by
    strings of ``least`` bytes which also start somewhere else in ``docs``.

    They may touch and overlap.  A text of several documents is given once, or
    once per task, as it repeats from end to end anyway.
    """
    together = Window.partitionBy("anchor").orderBy("context", DOC_ID, KEY, "at")
    whole = Window.partitionBy("anchor").orderBy("context").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before, after = F.lag("context").over(together), F.lead("context").over(together)
    first = F.coalesce(before != F.col("context"), F.lit(True))
    marked = _anchor_rows(docs, least, gram).withColumns(
        {
            "first": first,
            "known": F.col("repeats") | ~first | F.coalesce(after == F.col("context"), F.lit(False)),
            "varied": F.first("context").over(whole) != F.last("context").over(whole),
        }
    )
    found = work.keep(marked.where("known OR varied").drop("context"))
    left = F.greatest(F.col("at") - (least - gram), F.lit(0)).cast("int")
    right = F.least(F.col("at") + least, F.col("n_bytes")).cast("int")
    ready = F.col("stop").isNotNull()
    equal = found.where("known").select(
        DOC_ID, KEY, F.when(ready, F.col("at")).otherwise(left).alias("start"),
        F.coalesce("stop", right).alias("stop"),
    )
    wanted = found.where("varied AND first AND stop IS NULL").select("anchor", DOC_ID, KEY, "at", "known")
    contexts = work.keep(_contexts(docs, wanted, least, gram))
    large = work.keep(
        contexts.groupBy("anchor").count().where(F.col("count") > group_contexts).select("anchor")
    )
    spans = equal.unionByName(_scan(contexts.join(large, "anchor", "left_anti"), least))
    if not large.isEmpty():
        names = [c.split()[0] for c in _CONTEXTS.split(", ")]
        spans = spans.unionByName(_count(contexts.join(large, "anchor", "left_semi").select(*names), least))
    return spans


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted stretches without overlap; those that touch are one."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def remove_repeats(
    docs: DataFrame,
    least: int = MIN_BYTES,
    gram: int = GRAM,
    group_contexts: int = GROUP_CONTEXTS,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per row of
    ``docs``, its text taken as UTF-8.

    A byte is removed if it lies in a string of ``least`` bytes that also starts
    anywhere else in the input, the same document included.  A null text is an
    empty one; texts shorter than ``least`` keep everything; a longer text that
    several rows share loses everything.  Other columns are neither read nor
    returned.
    """
    work = Scratch(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col(TEXT), F.lit(""))
    rows = work.keep(
        docs.select(
            DOC_ID, F.xxhash64(text).alias(KEY), F.unhex(F.sha2(text, 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        )
    )
    steps = Scratch(docs.sparkSession, "suffix-spans")
    spans = repeated_spans(docs, steps, least, gram, group_contexts)
    gathered = spans.groupBy(DOC_ID, KEY).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")
    )
    gathered = gathered.select(F.col(DOC_ID).alias("_id"), F.col(KEY).alias("_key"), "spans")
    # Texts that several rows share need no look at their bytes.
    shared = rows.groupBy("digest").count().where("count > 1").select("digest", F.lit(True).alias("shared"))
    judged = work.keep(rows.join(shared, "digest", "left"))
    lone = judged.where("shared IS NULL").select(
        F.col(DOC_ID).alias("_lone"), F.col(KEY).alias("_lone_key")
    )
    mine = F.col("_id").eqNullSafe(F.col("_lone")) & (F.col("_key") == F.col("_lone_key"))
    asked = gathered.join(lone, mine, "left_semi")
    same = F.col(DOC_ID).eqNullSafe(F.col("_id")) & (F.col(KEY) == F.col("_key"))
    cut = work.keep(_cut(_packed(docs).join(asked, same).select(DOC_ID, KEY, "data", "spans")))
    steps.remove()
    found = cut.select(
        F.col(DOC_ID).alias("_id"), F.col(KEY).alias("_key"), "n_removed", "n_spans", "kept_sha256"
    )
    gone = F.col("shared") & (F.col("n_bytes") >= least)
    nothing = F.sha2(F.lit(""), 256)
    return judged.join(found, same, "left").select(
        DOC_ID,
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, nothing).otherwise(
            F.coalesce("kept_sha256", F.lower(F.hex("digest")))
        ).alias("kept_sha256"),
    )


def _cut(texts: DataFrame) -> DataFrame:
    schema = f"doc_id long, {KEY} long, n_removed long, n_spans long, kept_sha256 string"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in slices(batch, 2 << 20):
                made = []
                for data, spans in zip(part[2].to_pylist(), part[3].to_pylist()):
                    text = unpress.decompress(data)
                    gone = union_of([(s["start"], s["stop"]) for s in spans])
                    kept = hashlib.sha256()
                    at = 0
                    for start, stop in gone:
                        kept.update(text[at:start])
                        at = stop
                    kept.update(text[at:])
                    made.append((sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
                if made:
                    kinds = (pa.int64(), pa.int64(), pa.string())
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*made), kinds)]
                    yield pa.RecordBatch.from_arrays(
                        [part[0], part[1], *columns],
                        names=["doc_id", KEY, "n_removed", "n_spans", "kept_sha256"],
                    )

    return map_batches(texts, step, schema)
