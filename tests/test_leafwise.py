"""Trees grown leaf by leaf, one model per series, and fitted trees as SQL."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import duckdb
import numpy as np
import pytest
from panel_helpers import collected, make_panel
from pyspark.sql import functions as F

from weekcast.operators import (
    LEAFWISE,
    ModelParams,
    backtest,
    compiled,
    fit_forecaster,
    model_sql,
    next_forecast,
    score,
    training_frame,
)
from weekcast.operators.leafwise import best_first, drawn_features, tree_nodes
from weekcast.schema import FEATURES
from weekcast.session import cut_lineage

SMALL = ModelParams(trees=3, depth=3, leaves=5, rate=0.3, min_leaf_rows=10, bins=20, feature_share=0.5)
FEW = ["lag_1", "lag_2", "lag_8", "roll_mean_4", "week_sin", "lag_52"]


def seasonal(series, level, n):
    draw = random.Random(series)
    rows = []
    for i in range(n):
        y = round(level * (1.5 + math.sin(2 * math.pi * i / 52)) + draw.gauss(0, level / 20))
        rows.append((series, date(2015, 1, 4) + timedelta(weeks=i), 1 + i % 52, float(y), level * 10, 5.0))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    panel = make_panel(spark, seasonal("a", 100.0, 180) + seasonal("b", 900.0, 140) + seasonal("c", 40.0, 80))
    return cut_lineage(training_frame(panel, layout="series"))


def plain_fit(rows, params, features):
    """The same trees in plain Python: base and, for each tree, its nodes."""
    scale = 1 << 20
    y = [r.ilitotal for r in rows]
    base = sum(math.floor(v * scale + 0.5) for v in y) / len(y) / scale
    edges = []
    for name in features:
        ordered = sorted(r[name] for r in rows)
        found = {ordered[max(0, math.ceil(k / params.bins * len(ordered)) - 1)] for k in range(1, params.bins)}
        edges.append(sorted(found))
    bins = [[sum(e < r[name] for e in edges[k]) for k, name in enumerate(features)] for r in rows]
    fitted = [base] * len(rows)
    trees = []
    for tree in range(1, params.trees + 1):
        columns = drawn_features(len(features), params.feature_share, params.seed, tree)
        residual = [math.floor((a - b) * scale + 0.5) for a, b in zip(y, fitted)]

        def best(members):
            found = None
            n, s = len(members), sum(residual[i] for i in members)
            for f in columns:
                for cut in range(len(edges[f])):
                    left = [i for i in members if bins[i][f] <= cut]
                    if min(len(left), n - len(left)) < params.min_leaf_rows:
                        continue
                    moved = float(sum(residual[i] for i in left)) - float(s) * len(left) / n
                    if abs(moved) < 1:
                        continue
                    gain = moved * moved / len(left) * n / (n - len(left))
                    if found is None or gain > found[0]:
                        found = (gain, f, cut)
            return found

        members = {1: list(range(len(rows)))}
        open_ = {1: best(members[1])}
        split = {}
        while any(open_.values()) and len(split) < params.leaves - 1:
            node = min((n for n in open_ if open_[n]), key=lambda n: (-open_[n][0], n))
            _, f, cut = split[node] = open_.pop(node)
            for child, side in ((2 * node, True), (2 * node + 1, False)):
                members[child] = [i for i in members[node] if (bins[i][f] <= cut) == side]
                open_[child] = best(members[child]) if child.bit_length() <= params.depth else None
        if not split:
            break
        nodes = {n: (f, edges[f][cut], None) for n, (_, f, cut) in split.items()}
        for node in open_:
            own = members[node]
            nodes[node] = (None, None, params.rate * (float(sum(residual[i] for i in own)) / len(own)) / scale)
            for i in own:
                fitted[i] += nodes[node][2]
        trees.append(nodes)
    return base, trees, fitted


def fitted_trees(model, key="all"):
    rows = model.trees.where(F.col("_model") == key).orderBy("tree").collect()
    return [{n.node: (n.feature, n.threshold, n.value) for n in r.nodes} for r in rows]


@pytest.mark.parametrize("params", [SMALL, ModelParams(trees=2, depth=4, leaves=16, min_leaf_rows=4, bins=8)])
def test_trees_equal_plain_best_first_growth(frame, params):
    model = fit_forecaster(frame, params, FEW)
    rows = frame.collect()
    base, trees, fitted = plain_fit(rows, params, FEW)
    assert model.bases.first().base == base
    assert fitted_trees(model) == trees
    assert all(len(t) <= 2 * params.leaves - 1 for t in trees)
    want = sorted((r.series, r.week_start, p) for r, p in zip(rows, fitted))
    got = sorted((r.series, r.week_start, r.prediction) for r in score(model, frame).collect())
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_a_model_per_series_is_what_each_gets_alone(frame):
    together = fit_forecaster(frame, SMALL, FEW, scope="series")
    scored = {(r.series, r.week_start): r.prediction for r in score(together, frame).collect()}
    for series in ("a", "b", "c"):
        alone = frame.where(F.col("series") == series)
        model = fit_forecaster(alone, SMALL, FEW)
        assert fitted_trees(together, series) == fitted_trees(model)
        assert fitted_trees(model) == plain_fit(alone.collect(), SMALL, FEW)[1]
        for r in score(model, alone).collect():
            assert scored[r.series, r.week_start] == r.prediction


def test_the_same_trees_from_any_partitioning(frame):
    first = fit_forecaster(frame.repartition(7), SMALL, FEW)
    again = fit_forecaster(frame.repartition(2, "week_start").sortWithinPartitions(F.desc("lag_1")), SMALL, FEW)
    assert fitted_trees(first) == fitted_trees(again)


def test_a_series_without_rows_for_a_split_keeps_its_mean(spark, frame):
    params = ModelParams(trees=2, leaves=4, min_leaf_rows=40)
    model = fit_forecaster(frame, params, FEW, scope="series")
    assert fitted_trees(model, "c") == [] and fitted_trees(model, "a")
    small = frame.where("series = 'c'")
    mean = small.agg(F.avg("ilitotal")).first()[0]
    assert all(r.prediction == pytest.approx(mean) for r in score(model, small).collect())
    unseen = score(model, frame.withColumn("series", F.lit("new")))
    assert unseen.where("prediction IS NOT NULL").isEmpty()
    none = fit_forecaster(frame.limit(0), params, FEW, scope="series")
    assert none.trees.isEmpty() and score(none, frame).where("prediction IS NOT NULL").isEmpty()


def test_best_first_takes_the_highest_gain_and_numbers_break_ties():
    gains = {1: 10.0, 2: 1.0, 3: 5.0, 4: 9.0, 6: 5.0, 7: 5.0}
    splits = [{"node": n, "gain": g, "n_left": 1, "s_left": 1, "n": 2, "s": 2, "feature": 0, "bin": 0} for n, g in gains.items()]
    assert list(best_first(splits, 5)) == [1, 3, 6, 7]
    assert list(best_first(splits, 100)) == [1, 3, 6, 7, 2, 4]
    assert best_first([], 3) == {} and list(best_first(splits, 1)) == []
    leaves = [n for n in tree_nodes(splits, 3, 0.5, 0) if n[1] is None]
    assert [(n, v) for n, _, _, v in leaves] == [(2, 0.5), (6, 0.5), (7, 0.5)]


def test_columns_are_drawn_once_for_a_tree():
    draws = [drawn_features(20, 0.8, 42, t) for t in range(1, 30)]
    assert all(len(set(d)) == 16 for d in draws) and len({tuple(d) for d in draws}) > 20
    assert drawn_features(20, 0.8, 42, 5) == draws[4]
    assert drawn_features(3, 0.01, 1, 1) and drawn_features(3, 1.0, 1, 1) == [0, 1, 2]


def test_backtest_and_forecast_with_a_model_per_series(spark, frame):
    panel = make_panel(spark, seasonal("a", 100.0, 180) + seasonal("b", 900.0, 140))
    trained = backtest(training_frame(panel), SMALL, features=FEW, models="series")
    assert {r.split for r in trained.metrics.collect()} == {"train", "validation"}
    ahead = {r.series: r for r in next_forecast(trained.model, panel).collect()}
    assert ahead["a"].status == ahead["b"].status == "ok"
    assert ahead["b"].predicted_ili > 3 * ahead["a"].predicted_ili > 0


def test_parameters(frame):
    assert (LEAFWISE.leaves, LEAFWISE.depth, LEAFWISE.trees) == (31, 6, 200)
    with pytest.raises(ValueError):
        fit_forecaster(frame, ModelParams(trees=1), FEW, scope="series")
    with pytest.raises(ValueError):
        fit_forecaster(frame, SMALL, FEW, scope="all")


# --- fitted trees as one expression --------------------------------------------------


@pytest.mark.parametrize("params", [ModelParams(trees=12), SMALL])
def test_compiled_trees_equal_the_model_and_run_on_another_engine(spark, frame, params):
    model = fit_forecaster(frame, params, FEATURES)
    both = score(model, frame).withColumn("compiled", compiled(model)).toPandas()
    assert np.allclose(both.prediction, both.compiled, rtol=1e-12)
    with duckdb.connect() as db:
        db.register("frame", frame.select("series", "week_start", *FEATURES).toPandas())
        rows = db.execute(f"SELECT series, week_start, {model_sql(model)} FROM frame").fetchall()
    got = {(s, str(w)[:10]): p for s, w, p in rows}
    for r in both.itertuples():
        assert got[r.series, str(r.week_start)[:10]] == pytest.approx(r.prediction, rel=1e-12)


def test_compiled_scoring_needs_no_vectors(frame):
    model = fit_forecaster(frame, ModelParams(trees=3), FEW)
    plan = frame.select(compiled(model).alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "vector" not in plan.lower()
    per_series = fit_forecaster(frame, SMALL, FEW, scope="series")
    with pytest.raises(ValueError):
        compiled(per_series)


def test_forecasts_with_all_levels_equal_the_sql_text(spark, frame):
    """Trees of real depth through scoring and the forecast, by the model's own SQL."""
    panel = make_panel(spark, seasonal("a", 100.0, 180) + seasonal("b", 900.0, 140))
    model = fit_forecaster(frame, ModelParams(trees=8), FEATURES)
    ahead = next_forecast(model, panel)
    from weekcast.operators import forecast_point_features

    points = forecast_point_features(panel).toPandas()
    with duckdb.connect() as db:
        db.register("points", points)
        want = dict(db.execute(f"SELECT series, greatest(0, {model_sql(model)}) FROM points").fetchall())
    assert {r.series: pytest.approx(r.predicted_ili, rel=1e-12) for r in ahead.collect()} == want
    assert collected(ahead) == collected(next_forecast(model, panel))
