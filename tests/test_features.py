from __future__ import annotations

import math
import random
import statistics
from datetime import date, timedelta

import pytest
from panel_helpers import collected, make_panel, sample_rows
from pyspark.sql import functions as F

from weekcast.operators import (
    chronological_split,
    forecast_point_features,
    lag_features,
    rolling_features,
    seasonal_features,
    training_frame,
)
from weekcast.operators import blocks
from weekcast.operators.blocks import numbered_runs, over_series, spread
from weekcast.operators.features import _lags, _rolling, _trend
from weekcast.schema import FEATURES, OBSERVATION_COLUMNS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- golden values of the 70-row sample --------------------------------------------


def test_first_complete_row(sample):
    frame = training_frame(sample)
    assert frame.columns == [*OBSERVATION_COLUMNS, *FEATURES]
    assert frame.count() == 18
    row = frame.orderBy("week_start").first()
    assert (row.week_start, row.week, row.ilitotal) == (date(2024, 1, 1), 1, 1001.0)
    assert (row.lag_1, row.lag_8, row.lag_52, row.trend_4w) == (961.0, 2755.0, 1660.0, -968.0)
    means = [row[f"roll_mean_{k}"] for k in (2, 4, 8, 12)]
    assert means == pytest.approx([1670, 1785.5, 2004, 1909.083333], abs=1e-6)
    stds = [row[f"roll_std_{k}"] for k in (2, 4, 8, 12)]
    assert stds == pytest.approx([1002.677416, 677.526137, 575.247773, 593.209523], abs=1e-6)


def test_serving_features_parity_and_consistent(sample):
    row = forecast_point_features(sample).first()
    assert row.week_start == date(2024, 5, 6)
    assert [row[f"lag_{k}"] for k in (1, 2, 52)] == [2167.0, 864.0, 1259.0]
    assert row.trend_4w == 875.0
    assert [row[f"roll_mean_{k}"] for k in (2, 4, 8, 12)] == pytest.approx([1863, 1749.5, 1650.875, 1659.416667], abs=1e-6)
    assert [row[f"roll_std_{k}"] for k in (2, 4, 8, 12)] == pytest.approx([999, 755.678999, 570.938359, 506.527469], abs=1e-6)
    assert row.week_sin == pytest.approx(math.sin(2 * math.pi * 19 / 52))
    row = forecast_point_features(sample, "consistent").first()
    assert [row[f"roll_mean_{k}"] for k in (2, 4, 8, 12)] == pytest.approx([1515.5, 1968.25, 1687.25, 1667.083333], abs=1e-6)
    assert [row[f"roll_std_{k}"] for k in (2, 4, 8, 12)] == pytest.approx([921.360136, 828.210269, 633.908905, 536.238322], abs=1e-6)


def test_consistent_serving_equals_the_next_training_row(spark):
    rows = sample_rows()
    ahead = forecast_point_features(make_panel(spark, rows[:-1]), "consistent").first()
    seen = training_frame(make_panel(spark, rows)).orderBy(F.desc("week_start")).first()
    assert ahead.week_start == seen.week_start
    for name in FEATURES:
        assert ahead[name] == pytest.approx(seen[name]), name


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 13, 51, 52, 53])
def test_short_series_serving(spark, n):
    rows = sample_rows(n=n)
    y = [r[3] for r in rows]
    row = forecast_point_features(make_panel(spark, rows)).first()
    for k in (*range(1, 9), 52):
        assert row[f"lag_{k}"] == (y[-k] if n >= k else None)
    for k in (2, 4, 8, 12):
        piece = y[-(k + 1) : -1]
        mean, std = row[f"roll_mean_{k}"], row[f"roll_std_{k}"]
        assert mean == (pytest.approx(statistics.fmean(piece)) if len(piece) >= k else None)
        assert std == (pytest.approx(statistics.pstdev(piece)) if len(piece) >= 2 else 0.0)
    assert row.trend_4w == (y[-1] - y[-5] if n >= 5 else None)


def test_missing_values_empty_the_windows_that_hold_them(spark):
    rows = sample_rows()
    rows[60] = (*rows[60][:3], None, *rows[60][4:])
    frame = rolling_features(make_panel(spark, rows)).orderBy("week_start").collect()
    for i, r in enumerate(frame):
        for k in (2, 4, 8, 12):
            whole = i >= k and not i - k <= 60 < i
            assert (r[f"roll_mean_{k}"] is not None) == whole
            assert (r[f"roll_std_{k}"] is not None) == whole
    serving = forecast_point_features(make_panel(spark, rows[:65])).first()
    assert (serving.roll_mean_4, serving.roll_std_4) == (None, None)
    assert serving.roll_mean_2 is not None and (serving.lag_5, serving.lag_4) == (None, rows[61][3])


def test_any_missing_cell_drops_a_row(spark):
    rows = sample_rows()
    rows[60] = (*rows[60][:5], None)
    assert training_frame(make_panel(spark, rows)).count() == 17


def test_season_takes_week_as_given_or_reduced(spark):
    panel = make_panel(spark, [("ca", None, 202401, 1.0, 1.0, 1.0)])
    assert seasonal_features(panel).first().week_sin == pytest.approx(math.sin(2 * math.pi * 202401 / 52))
    assert seasonal_features(panel, strict=True).first().week_sin == pytest.approx(math.sin(2 * math.pi / 52))


# --- properties ----------------------------------------------------------------------


def test_features_never_see_their_target(spark):
    rows = sample_rows()
    before = {r.week_start: r for r in training_frame(make_panel(spark, rows)).collect()}
    rows[60] = (*rows[60][:3], 9999.0, *rows[60][4:])
    after = {r.week_start: r for r in training_frame(make_panel(spark, rows)).collect()}
    for day, r in after.items():
        same = all(r[c] == before[day][c] for c in FEATURES)
        assert same == (day <= rows[60][1] or day > rows[60][1] + timedelta(weeks=52))


def test_series_do_not_touch_each_other(spark, sample):
    other = [("tx", *r[1:3], r[3] * 3, *r[4:]) for r in sample_rows()]
    both = make_panel(spark, sample_rows() + other)
    assert collected(training_frame(both).where("series = 'ca'")) == collected(training_frame(sample))
    assert collected(forecast_point_features(both).where("series = 'ca'")) == collected(forecast_point_features(sample))


def test_row_order_and_partitions_do_not_matter(spark, sample):
    rows = sample_rows()
    random.Random(3).shuffle(rows)
    mixed = make_panel(spark, rows).repartition(7)
    assert collected(training_frame(mixed)) == collected(training_frame(sample))


# --- long series -----------------------------------------------------------------------


def uneven_rows() -> list[tuple]:
    """Long, short, gappy and repeating series, with a run of equal rows longer
    than any block and a week that repeats with different values."""
    draw = random.Random(11)
    rows = []
    for i in range(400):
        day = date(2010, 1, 3) + timedelta(weeks=i)
        if i % 17 != 5:
            rows.append(("long", day, 201001 + i % 52, float(draw.randint(0, 9)), 100.0, 5.0))
    day = date(2012, 1, 1)
    rows += [("long", day, 201201, 7.0, 100.0, 5.0)] * 333
    rows += [("long", day, 201202, float(draw.randint(0, 3)), float(draw.randint(0, 3)), 5.0) for _ in range(150)]
    rows += [("long", day, 201203, None, 1.0, 5.0)] * 3
    rows += sample_rows("short", 20) + sample_rows("year", 60)
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_rows", [1, 60, 1000])
def test_blocks_equal_whole_series(spark, block_rows):
    panel = make_panel(spark, uneven_rows()).repartition(5)

    def features(w):
        return {**_lags(w, (1, 2, 8, 52)), **_rolling(w, (2, 12)), **_trend(w)}

    whole = over_series(panel, features, 52, "series")
    cut = over_series(panel, features, 52, "blocks", block_rows)
    assert collected(cut) == collected(whole)


def test_positions_are_a_numbering(spark):
    panel = make_panel(spark, uneven_rows())
    rows = spread(numbered_runs(panel), block_rows=50)
    got = rows.groupBy("series", "_total").agg(
        F.count("*").alias("n"), F.count_distinct("_pos").alias("d"), F.min("_pos").alias("lo"), F.max("_pos").alias("hi")
    )
    for r in got.collect():
        assert r.n == r.d == r._total and (r.lo, r.hi) == (0, r.n - 1)
    assert rows.groupBy("series", "_block").count().agg(F.max("count")).first()[0] <= 50


def test_split_in_blocks_equals_split_by_series(spark):
    panel = make_panel(spark, uneven_rows())
    assert collected(chronological_split(panel, layout="blocks")) == collected(chronological_split(panel, layout="series"))


@pytest.mark.parametrize("limit, listed", [(100, 10), (100, 0), (10_000, 10)])
def test_auto_layout_cuts_only_the_long_series(spark, monkeypatch, limit, listed):
    panel = make_panel(spark, uneven_rows())
    calls = []
    monkeypatch.setattr(blocks, "SERIES_ROWS_PER_TASK", limit)
    monkeypatch.setattr(blocks, "LISTED_SERIES", listed)
    monkeypatch.setattr(blocks, "numbered_runs", lambda df: calls.append(df) or numbered_runs(df))
    auto = lag_features(panel)
    assert collected(auto) == collected(lag_features(panel, layout="series"))
    cut = sorted(r[0] for df in calls for r in df.select("series").distinct().collect())
    assert cut == {(100, 10): ["long"], (100, 0): ["long", "short", "year"], (10_000, 10): []}[limit, listed]


def test_split_of_equal_observations_does_not_depend_on_partitions(spark):
    rows = [("a", date(2020, 1, 5) + timedelta(weeks=i // 4), 1, float(i % 2), 1.0, 5.0) for i in range(400)]
    frame = training_frame(make_panel(spark, rows), layout="series").persist()
    want = collected(chronological_split(frame, layout="series"))
    for shaken in (frame.repartition(7), frame.repartition(3, "lag_2"), frame.orderBy(F.rand(3))):
        for layout in ("series", "blocks", "auto"):
            assert collected(chronological_split(shaken, layout=layout)) == want


def test_unknown_layout(sample):
    with pytest.raises(ValueError):
        lag_features(sample, layout="other")


# --- split -----------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 18, 70])
def test_split_is_the_first_four_fifths(spark, n):
    rows = chronological_split(make_panel(spark, sample_rows(n=n))).orderBy("week_start").collect()
    assert [r.split for r in rows] == ["train"] * int(n * 0.8) + ["validation"] * (n - int(n * 0.8))


def test_global_split_cuts_all_series_at_one_week(spark):
    panel = make_panel(spark, sample_rows("a") + sample_rows("b", 30))
    got = chronological_split(panel, scope="global").groupBy("split").agg(F.min("week_start"), F.max("week_start"), F.count("*"))
    want = {"train": (date(2023, 1, 2), date(2024, 1, 22), 86), "validation": (date(2024, 1, 29), date(2024, 4, 29), 14)}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


# --- plans -----------------------------------------------------------------------------


def test_training_frame_is_one_window_and_one_shuffle(sample):
    text = plan(training_frame(sample, layout="series"))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 1 and "Python" not in text


def test_newest_rows_are_limited_before_the_shuffle(sample):
    text = plan(forecast_point_features(sample))
    assert text.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning") :]
