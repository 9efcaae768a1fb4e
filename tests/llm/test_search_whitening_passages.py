"""Ranked search, whitening and the removal of passages."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from corpus_helpers import by_id, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from weekcast.llm import ranked_search, relative_parse, rolling, whitening
from weekcast.llm.queries import op11_whitening

SF_DIR = "/root/testdata/sf0.01"

# --- whitening -------------------------------------------------------------------


def table(spark, rows, more=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{more}").repartition(3)


def plain(vectors):
    """Scaled rows, eigenvalues and eigenvectors, largest first."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100000
    y = x - x.sum(axis=0) / len(x)
    values, turned = np.linalg.eigh(y.T @ y / len(x))
    return x, y, values[::-1], turned[:, ::-1]


def check(rows, ids, vectors, count=8):
    x, y, values, turned = plain(vectors)
    n = len(x)
    white = y @ turned[:, :count] / np.sqrt(values[:count])
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert len(rows) == n * count
    got = {(r.vec_id, r.component): r for r in rows}
    for place, i in enumerate(ids):
        for c in range(1, count + 1):
            r = got[i, c]
            assert r.n == n and r.deviation == deviation[place]
            assert r.explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            assert r.identity_error < 1e-9
    for c in range(1, count + 1):
        ours = np.array([got[i, c].whitened for i in ids])
        sign = np.sign(ours @ white[:, c - 1])
        assert np.allclose(ours, sign * white[:, c - 1], atol=1e-7)


def test_whitening_equals_an_eigendecomposition(spark):
    draw = np.random.RandomState(3)
    vectors = (draw.standard_normal((300, 20)) * np.geomspace(3, 0.05, 20)) @ draw.standard_normal((20, 20))
    vectors = (vectors + 5).astype(np.float32)
    odd = [(1000, None), (1001, []), (1002, [float("nan")] * 20), (1003, [1.0] * 19 + [None]),
           (1004, [float("inf")] * 20), (1005, [1.0, 2.0])]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + odd
    frame = table(spark, [(*r, 7, 7) for r in rows], ", component int, block long")
    found = whitening.whiten(frame, whitening.fit(frame)).collect()
    check(found, range(300), vectors)


def test_whitening_of_the_given_table(spark):
    rows = op11_whitening(spark, SF_DIR).collect()
    given_rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(rows, [r.vec_id for r in given_rows], [r.embedding for r in given_rows])


def test_repeated_and_null_ids_and_rows_without_spread(spark):
    rows = [(None, [1.0, 0.0, 4.0])] * 3 + [(5, [2.0, 1.0, 4.0])] * 2 + [(5, [0.0, 3.0, 4.0])]
    found = whitening.whiten(frame := table(spark, rows), whitening.fit(frame)).collect()
    assert len(found) == 6 * 2  # the rows differ in two directions
    assert sorted(r.component for r in found if r.vec_id is None) == [1, 1, 1, 2, 2, 2]
    same = table(spark, [(1, [1.0, 2.0])] * 4)
    assert whitening.whiten(same, whitening.fit(same)).isEmpty()
    one = table(spark, [(1, [1.0, 2.0])])
    assert whitening.whiten(one, whitening.fit(one)).isEmpty()
    for none in (table(spark, []), table(spark, [(1, None), (2, [])])):
        assert whitening.fit(none) is None
        assert whitening.whiten(none, None).columns[:3] == ["vec_id", "component", "n"]


def test_repeated_eigenvalues_are_all_found(spark):
    rows = [(2 * i + s, [(1 - 2 * s) * 4.0 * (i == j) for j in range(6)]) for i in range(6) for s in (0, 1)]
    frame = table(spark, rows)
    model = whitening.fit(frame, wanted=6)
    assert model.components.shape == (6, 6) and model.identity_error < 1e-9
    assert np.allclose(model.explained, 1 / 6)


def test_huge_entries_are_held_and_deviations_beyond_a_long_are_null(spark):
    frame = table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])])
    found = whitening.whiten(frame, whitening.fit(frame)).collect()
    assert found and all(r.deviation is None for r in found if r.vec_id < 3)


def test_bidiagonalisation_of_any_matrix():
    draw = np.random.RandomState(1)
    for shape in ((30, 5), (4, 9), (50, 50)):
        matrix = draw.standard_normal(shape) * np.geomspace(1, 1e-3, shape[1])

        def product(c, short):
            u = matrix @ c
            return (matrix @ short).T @ u, float(u @ u), matrix.T @ u

        values, right = whitening.bidiagonalise(product, shape[1], 3)
        want = np.linalg.svd(matrix)
        assert np.allclose(values[:3], want[1][:3], rtol=1e-10)
        assert np.allclose(np.abs((right[:, :3] * want[2][:3].T).sum(axis=0)), 1, atol=1e-8)


# --- ranked search -----------------------------------------------------------------


def items_of(spark, texts, ids=None):
    rows = [(i, t, 1) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "item_id long, text string, rank int")


def ranked(frame):
    rows = {}
    for r in sorted(frame.collect(), key=lambda r: r.rank):
        rows.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(rows[r.item_id])
    return rows


def test_terms_are_the_contracts():
    for text in ("Ab1_c-D é½ \x1c　x", "ΣΑΣ İ 日本 \x7f~{Z}", "", "\x00a\x00"):
        assert [t.decode() for t in ranked_search.terms(text)] == brute.TERM.findall(text.translate(brute.LOWER))


def test_ranking_equals_plain_scores(spark, docs, odd_texts):
    texts = odd_texts + [prose(f"doc {i % 25}", 10 + 7 * i % 60) for i in range(90)]
    wanted = [prose(2, 12), "one", None, "", "日本語のテキスト", "missing", prose("long", 300), "THE the River"]
    want = {i: w for i, w in enumerate(brute.ranking(texts, wanted)) if w}
    assert ranked(ranked_search.search(docs(texts), items_of(spark, wanted))) == want
    in_groups = ranked_search.search(docs(texts), items_of(spark, wanted), group_terms=9)
    assert ranked(in_groups) == want


def test_ties_go_by_id_and_no_id_comes_last(spark, docs):
    texts = ["red fox"] * 70 + [None, "blue"]
    ids = [None, None, 3, 3, *range(200, 130, -1)][:72]
    rows = ranked(ranked_search.search(docs(texts, ids=ids), items_of(spark, ["fox", "fox"], [None, 4])))
    least = sorted(i for i in ids[:70] if i is not None)[:50]
    assert [d for d, _ in rows[4]] == least and [d for d, _ in rows[None]] == least
    few = ranked(ranked_search.search(docs(texts, ids=ids), items_of(spark, ["fox"]), best=100))
    assert [d for d, _ in few[0]] == sorted(i for i in ids[:70] if i is not None) + [None, None]


def test_tiles_cut_long_items_and_stay_exact():
    weights = np.array([20000] * 40, np.int64)
    wanted = [list(range(30)), [1, 2], [3], list(range(20, 40))]
    made = ranked_search.tiles(wanted, weights, tile_terms=8)
    assert [i for t in made for i in t.items] == [0, 1, 2, 3]
    impact = np.arange(40) * 1000.0
    scores = {i: 0 for i in range(4)}
    for tile in made:
        for some, matrix in tile.chunks:
            assert len(some) <= 8
            for column, item in enumerate(tile.items):
                scores[item] += int(impact[some] @ matrix[:, column])
    assert scores == {i: sum(int(impact[t]) * 20000 for t in w) for i, w in enumerate(wanted)}


def test_search_in_nothing_and_for_nothing(spark, docs):
    assert ranked_search.search(docs([]), items_of(spark, ["a"])).isEmpty()
    assert ranked_search.search(docs([None, " "]), items_of(spark, ["a"])).isEmpty()
    assert ranked_search.search(docs(["a"]), items_of(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]


# --- passages ----------------------------------------------------------------------


def mixed_texts():
    """Passages at all offsets, cut short, joined, and within one text."""
    draw = random.Random(5)
    shared = [prose(f"shared {i}", n, ends=False).split() for i, n in enumerate((49, 50, 51, 64, 130, 400))]
    texts = []
    for i in range(70):
        words = []
        for k in range(3):
            words += prose(f"own {i} {k}", draw.randint(0, 70), ends=False).split() if draw.random() < 0.8 else []
            piece = draw.choice(shared)
            at = draw.randint(0, max(0, len(piece) - 50)) if draw.random() < 0.5 else 0
            words += piece[at : at + draw.choice((30, 50, 60, 1000))]
        texts.append(draw.choice((" ", "\n", "  \t")).join(words))
    return texts + ["a " * 300, "a " * 120, texts[3], texts[3].upper(), texts[0] + " " + texts[0]]


def judged(frame):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()}


@pytest.mark.parametrize("window, gram", [(50, 20), (8, 3), (5, 5)])
def test_passages_equal_plain_ones(docs, odd_texts, window, gram):
    texts = mixed_texts() + odd_texts
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    got = judged(relative_parse.parse(docs(texts, ids=ids), window, gram))
    want = dict(zip(ids, brute.passages_removed(texts, ids, window)))
    assert got == want


def test_factors_name_an_earlier_source(docs):
    one, two, extra = prose("one", 80, False), prose("two", 60, False), prose("extra", 10, False)
    texts = [f"{one} {extra}", two, f"{extra} {one} {two} end"]
    rows = by_id(relative_parse.parse(docs(texts)))
    assert [tuple(f) for f in rows[2][0].factors] == [(10, 80, 0), (90, 60, 1)]
    assert not rows[0][0].factors and not rows[1][0].factors
    left = by_id(relative_parse.remove_repeats(docs(texts)))
    assert left[2][0].text == f"{extra} end" and left[0][0].text == texts[0]
    assert left[2][0].n_chars == len(texts[2])


def test_rows_that_share_an_id_and_rows_without_one(docs):
    one, own = prose("one", 90, False), prose("own", 20, False)
    texts = [one, one, f"{own} {one}", f"{one} {own}", one, None, f"x {one}"]
    ids = [7, 7, 7, None, None, None, 2]
    rows = relative_parse.parse(docs(texts, ids=ids)).collect()
    found = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in rows)
    want = brute.passages_removed(texts, ids)
    assert found == sorted((str(i), n, gone) for i, (n, gone, _) in zip(ids, want))
    assert relative_parse.parse(docs([])).isEmpty()
    assert relative_parse.remove_repeats(docs([])).isEmpty()


def test_a_hot_passage_in_varied_surroundings(docs):
    hot = prose("hot", 70, False)
    texts = [f"{prose(f'left {i}', 5 + i % 9, False)} {hot} {prose(f'right {i}', i % 13, False)}" for i in range(300)]
    got = judged(relative_parse.parse(docs(texts)))
    assert got == dict(enumerate(brute.passages_removed(texts, range(300))))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"cc"]), min_size=6, max_size=60))
def test_equal_runs_have_equal_hashes(words):
    hashing = rolling.RunHashes()
    sums = hashing.sums(hashing.words(words))
    starts = np.arange(len(words) - 4)
    found = hashing.runs(sums, starts, starts + 5)
    seen = {}
    for i, h in enumerate(map(tuple, found.tolist())):
        assert seen.setdefault(h, words[i : i + 5]) == words[i : i + 5]
    assert len(seen) == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)})


def test_sequences_that_defeat_plain_polynomials_are_told_apart():
    """Thue-Morse words of 1,024 letters collide modulo 2^64 for every odd base."""
    one, other = ["a"], ["b"]
    for _ in range(10):
        one, other = one + other, other + one
    hashing = rolling.RunHashes()
    found = hashing.words(["".join(one).encode(), "".join(other).encode()])
    assert (found[0] != found[1]).all()
    short = [w[:64] for w in (one, other)]
    runs = [hashing.runs(hashing.sums(hashing.words([x.encode() for x in w])), np.array([0]), np.array([64])) for w in short]
    assert (runs[0] != runs[1]).all()


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr(rolling, "KEPT_WORDS", 2)
    hashing = rolling.RunHashes()
    words = [b"x", b"y", b"z", b"x"]
    first = hashing.words(words)
    assert (hashing.words(words) == first).all() and (first[0] == first[3]).all()
