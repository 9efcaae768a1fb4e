from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from panel_helpers import collected, make_panel, sample_rows
from pyspark.sql import functions as F

from weekcast.operators import (
    ModelParams,
    backtest,
    chronological_split,
    fit_forecaster,
    next_forecast,
    regression_metrics,
    residual_interval,
    score,
    training_frame,
)
from weekcast.schema import FEATURES

SMALL = ModelParams(trees=5)


def seasonal_rows(series: str, level: float, n: int = 320) -> list[tuple]:
    draw = random.Random(series)
    rows = []
    for i in range(n):
        day = date(2015, 1, 4) + timedelta(weeks=i)
        y = level * (1.5 + math.sin(2 * math.pi * i / 52)) + draw.gauss(0, level / 50)
        rows.append((series, day, 1 + i % 52, y, level * 10, 5.0))
    return rows


@pytest.fixture(scope="module")
def seasons(spark):
    return make_panel(spark, seasonal_rows("a", 100.0) + seasonal_rows("b", 120.0)).persist()


# --- the 18 complete rows allow no split, so the model is the mean ------------------


def test_constant_model_backtest(sample):
    trained = backtest(training_frame(sample), SMALL)
    assert trained.features == FEATURES
    got = {r.split: r for r in trained.metrics.collect()}
    assert (got["train"].n, got["validation"].n) == (14, 4)
    assert got["train"].r2 == pytest.approx(0, abs=1e-9)
    assert got["validation"].rmse == pytest.approx(798.137957, abs=1e-6)
    assert got["validation"].r2 == pytest.approx(-0.238265, abs=1e-6)


def test_constant_model_forecast(sample):
    model = fit_forecaster(training_frame(sample), SMALL)
    row = next_forecast(model, sample).first()
    assert (row.week_start, row.status, row.interval_ok) == (date(2024, 5, 6), "ok", True)
    assert row.predicted_ili == pytest.approx(1695.944444, abs=1e-6)
    assert (row.ci_lower, row.ci_upper) == pytest.approx((922.225, 2827.575), abs=1e-3)


# --- learning -------------------------------------------------------------------------


def test_model_beats_the_mean_and_is_repeatable(seasons):
    frame = training_frame(seasons)
    params = ModelParams(trees=8)
    first, second = backtest(frame, params), backtest(frame, params)
    validation = {r.split: r for r in first.metrics.collect()}["validation"]
    assert 0.3 < validation.r2 < 0.999
    assert collected(first.metrics) == collected(second.metrics)
    assert collected(score(first.model, first.frame)) == collected(score(second.model, second.frame))


def test_leaves_respect_depth_and_size(seasons):
    trees = fit_forecaster(training_frame(seasons), SMALL).stages[-1].trees
    assert len(trees) == 5
    assert all(t.depth <= 6 and t.numNodes <= 2**7 - 1 for t in trees)


def test_default_params():
    p = ModelParams()
    assert (p.trees, p.depth, p.rate, p.min_leaf_rows, p.feature_share, p.seed) == (200, 6, 0.05, 30, 0.8, 42)


def test_rows_without_a_feature_get_no_prediction(seasons):
    frame = training_frame(seasons)
    holes = frame.withColumn("lag_3", F.when(F.col("series") == "a", F.col("lag_3")))
    scored = score(fit_forecaster(frame, SMALL), holes)
    assert scored.columns == [*frame.columns, "prediction", "status"]
    got = {r.series: r for r in scored.groupBy("series").agg(
        F.count("prediction").alias("n"), F.first("status").alias("status"), F.count("lag_3").alias("kept")
    ).collect()}
    assert got["a"].n == got["a"].kept > 0 and got["a"].status == "ok"
    assert (got["b"].n, got["b"].kept, got["b"].status) == (0, 0, "insufficient_history")


def test_forecast_is_never_negative(spark, seasons):
    negative = seasons.withColumn("ilitotal", -F.col("ilitotal"))
    model = fit_forecaster(training_frame(negative), SMALL)
    for r in next_forecast(model, negative).collect():
        assert (r.predicted_ili, r.ci_lower) == (0.0, 0.0)
    assert score(model, training_frame(negative)).agg(F.max("prediction")).first()[0] < 0


def test_short_series_gets_no_forecast(spark, seasons):
    panel = seasons.unionByName(make_panel(spark, sample_rows("short", 52)))
    model = fit_forecaster(training_frame(panel), SMALL)
    got = {r.series: r for r in next_forecast(model, panel).collect()}
    assert got["short"].status == "insufficient_history" and got["short"].predicted_ili is None
    assert got["a"].status == got["b"].status == "ok"


# --- metrics and interval ---------------------------------------------------------------


def test_metrics_by_hand(spark):
    rows = [("x", 1.0, 2.0), ("x", 3.0, 3.0), ("x", 8.0, 6.0), ("x", 1.0, None), ("flat", 2.0, 2.5), ("flat", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "split string, y double, p double")
    got = {r.split: r for r in regression_metrics(df, "y", "p").collect()}
    assert got["x"].n == 3 and got["x"].rmse == pytest.approx(math.sqrt(5 / 3))
    assert got["x"].r2 == pytest.approx(1 - 5 / 26)
    assert got["flat"].r2 is None and got["flat"].rmse == pytest.approx(math.sqrt(0.125))


def test_interval_uses_the_newest_thirty_residuals(spark):
    rows = []
    for i in range(40):
        day = date(2020, 1, 5) + timedelta(weeks=i)
        rows.append(("a", day, 1, float(1000 if i < 10 else i - 10), 1.0, 1.0, 0.0))
    scored = spark.createDataFrame(
        rows, "series string, week_start date, week int, ilitotal double, total_patients double, percent_ili double, prediction double"
    )
    points = spark.createDataFrame([("a", 50.0), ("none", 1.0)], "series string, predicted_ili double")
    got = {r.series: r for r in residual_interval(scored, points).collect()}
    assert (got["a"].ci_lower, got["a"].ci_upper) == pytest.approx((50 + 0.725, 50 + 28.275))
    assert got["a"].interval_ok is False  # the point lies below its own interval
    assert got["none"].ci_lower is None and got["none"].interval_ok is None
    low = residual_interval(scored.withColumn("prediction", F.lit(500.0)), points).where("series = 'a'").first()
    assert low.ci_lower == 0.0 and low.ci_upper < 0 and low.interval_ok is False


def test_split_then_fit_sees_only_the_early_part(sample):
    parts = chronological_split(training_frame(sample))
    model = fit_forecaster(parts.where("split = 'train'"), SMALL)
    assert score(model, parts).first().prediction == pytest.approx(1618.142857, abs=1e-6)
