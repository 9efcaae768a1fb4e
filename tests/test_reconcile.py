from __future__ import annotations

from datetime import date, datetime, timedelta

from panel_helpers import make_panel, sample_rows

from weekcast.operators import (
    deviation_alerts,
    forecast_accuracy,
    forecast_actual_lookup,
    refresh_gate,
)
from weekcast.schema import LEDGER

LAST = date(2024, 4, 29)


def ledger(spark, *rows):
    made = datetime(2024, 3, 11, 16)
    return spark.createDataFrame([(s, w, p, lo, hi, made) for s, w, p, lo, hi in rows], LEDGER)


def by_series(df):
    return {r.series: r for r in df.collect()}


def test_lookup_statuses(spark):
    rows = sample_rows("seen") + sample_rows("ahead") + sample_rows("gone")
    rows += [("null", LAST, 18, None, 1.0, 1.0)]
    rows = [r for r in rows if not (r[0] == "gone" and r[1] == LAST - timedelta(weeks=3))]
    panel = make_panel(spark, rows)
    made = ledger(
        spark,
        ("seen", LAST, 9999.0, 0.0, 1.0),
        ("ahead", LAST + timedelta(weeks=10), 9999.0, 0.0, 1.0),
        ("null", LAST, 1500.0, 1200.0, 1800.0),
        ("gone", LAST - timedelta(weeks=3), 1.0, 0.0, 2.0),
    )
    got = by_series(forecast_actual_lookup(made, panel))
    assert {s: r.status for s, r in got.items()} == {
        "seen": "matched", "ahead": "pending", "null": "null_actual", "gone": "pending",
    }
    assert got["seen"].actual_ili == sample_rows()[-1][3]
    strict = by_series(forecast_actual_lookup(made, panel, strict=True))
    assert (strict["gone"].status, strict["ahead"].status) == ("stale", "pending")


def test_repeated_week_counts_once_with_its_first_row(spark):
    panel = make_panel(
        spark,
        [
            ("a", LAST, 202501, 30.0, 1.0, 1.0),
            ("a", LAST, 202452, 20.0, 2.0, 1.0),
            ("a", LAST, 202452, 20.0, 1.0, 1.0),
            ("a", LAST, None, 10.0, 1.0, 1.0),
            ("b", LAST, 1, None, 1.0, 1.0),
            ("b", LAST, 2, 5.0, 1.0, 1.0),
            ("c", LAST, 1, None, 1.0, 1.0),
            ("c", LAST, 1, 5.0, 1.0, 1.0),
        ],
    )
    made = ledger(spark, *[(s, LAST, 1.0, 0.0, 2.0) for s in "abc"])
    got = by_series(forecast_actual_lookup(made, panel))
    assert (got["a"].actual_ili, got["c"].actual_ili) == (20.0, 5.0)
    assert got["b"].status == "null_actual"


def test_accuracy_and_alerts(spark):
    panel = make_panel(
        spark,
        [(s, LAST, 18, y, 1.0, 1.0) for s, y in [("over", 1000.0), ("under", 2000.0), ("even", 50.0), ("zero", 0.0), ("edge", 100.0)]],
    )
    made = ledger(
        spark,
        ("over", LAST, 1500.0, 1000.0, 1800.0),
        ("under", LAST, 1000.0, 800.0, 1200.0),
        ("even", LAST, 50.0, 50.0, 50.0),
        ("zero", LAST, 5.0, 0.0, 9.0),
        ("edge", LAST, 120.0, 0.0, 99.0),
        ("later", LAST + timedelta(weeks=1), 1.0, 0.0, 2.0),
    )
    accuracy = forecast_accuracy(forecast_actual_lookup(made, panel))
    got = by_series(accuracy)
    assert set(got) == {"over", "under", "even", "zero", "edge"}
    assert {s: (r.deviation_pct, r.in_interval, r.direction, r.accuracy) for s, r in got.items()} == {
        "over": (50.0, True, "over-predicted", "ok"),
        "under": (50.0, False, "under-predicted", "ok"),
        "even": (0.0, True, "under-predicted", "ok"),
        "zero": (None, True, "over-predicted", "undefined"),
        "edge": (20.0, False, "over-predicted", "ok"),
    }
    upcoming = spark.createDataFrame(
        [("over", date(2024, 5, 6), 1600.0, 1300.0, 1900.0)],
        "series string, week_start date, predicted_ili double, ci_lower double, ci_upper double",
    )
    alerts = by_series(deviation_alerts(accuracy, upcoming))
    assert set(alerts) == {"over", "under"}  # exactly 20 % does not alert
    assert alerts["over"].subject == "Prediction Accuracy — over: over-predicted by 50%"
    assert alerts["under"].direction_label == "Under Predicted"
    assert alerts["under"].interval_status.startswith("No")
    assert (alerts["over"].next_week_start, alerts["over"].next_predicted_ili) == (date(2024, 5, 6), 1600.0)
    assert alerts["under"].next_predicted_ili is None
    assert deviation_alerts(accuracy, upcoming, 0.5).isEmpty()


def test_gate(spark):
    panel = make_panel(spark, [r for s in ("cold", "due", "wait", "old") for r in sample_rows(s) if (s, r[1]) != ("old", date(2024, 3, 4))])
    made = ledger(
        spark,
        ("due", LAST, 1.0, 0.0, 2.0),
        ("wait", LAST + timedelta(weeks=1), 1.0, 0.0, 2.0),
        ("old", date(2024, 3, 4), 1.0, 0.0, 2.0),
    )
    got = {r.series: (r.action, r.reason) for r in refresh_gate(panel, made).collect()}
    assert got == {
        "cold": ("retrain", "cold_start"),
        "due": ("retrain", "matched"),
        "wait": ("skip", "pending"),
        "old": ("skip", "pending"),
    }
    strict = {r.series: (r.action, r.reason) for r in refresh_gate(panel, made, strict=True).collect()}
    assert strict["old"] == ("retrain", "stale") and strict["wait"] == ("skip", "pending")


def test_small_ledger_reaches_the_panel_before_it_is_grouped(spark, tmp_path):
    ledger(spark, ("ca", LAST, 1.0, 0.0, 2.0)).write.parquet(str(tmp_path / "ledger"))
    made = spark.read.parquet(str(tmp_path / "ledger"))
    found = forecast_actual_lookup(made, make_panel(spark, sample_rows()))
    logical = found._jdf.queryExecution().optimizedPlan().toString()
    assert logical.index("Aggregate") < logical.index("LeftSemi")
