from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from panel_helpers import collected, make_panel, sample_rows
from pyspark.sql import functions as F

from weekcast import weekly_run
from weekcast.operators import ModelParams
from weekcast.plans import weekly
from weekcast.schema import LEDGER
from weekcast.session import shared_dir
from weekcast.sources import ledger_append, newest_fetch, observations, payload_errors, payload_rows, read_ledger
from weekcast.streaming import land_payloads

SMALL = ModelParams(trees=2)
AS_OF = "2024-05-01T16:00:00Z"
LAST = date(2024, 4, 29)


def seed(spark, path, *rows):
    forecasts = spark.createDataFrame([(*r, None) for r in rows], LEDGER)
    ledger_append(forecasts, path, "2024-01-01T00:00:00Z")


def run(panel, tmp_path, **options):
    options = {"per_series_files": True, **options}
    return weekly_run(
        panel, str(tmp_path / "ledger"), AS_OF, out_path=str(tmp_path / "out"), params=SMALL, **options
    )


def by_series(df):
    return {r.series: r for r in df.collect()}


def test_cold_start_writes_everything_and_compares_nothing(spark, sample, tmp_path):
    got = run(sample, tmp_path)
    assert by_series(got["gate"])["ca"].reason == "cold_start"
    row = by_series(got["forecasts"])["ca"]
    assert row.predicted_ili == pytest.approx(1695.944444, abs=1e-6)
    assert got["alerts"].isEmpty() and got["outputs"].isEmpty() and got["accuracy"].isEmpty()
    for name in ("prediction", "summary", "chart"):
        assert (tmp_path / "out" / name / "_SUCCESS").exists()
    (stored,) = read_ledger(spark, str(tmp_path / "ledger")).collect()
    assert (stored.week_start, stored.generated_at) == (date(2024, 5, 6), datetime(2024, 5, 1, 16))
    assert got["summary"].where("line like 'Prior%'").isEmpty()


def test_second_run_waits_and_writes_nothing(spark, sample, tmp_path):
    run(sample, tmp_path)
    again = weekly_run(sample, str(tmp_path / "ledger"), AS_OF, out_path=str(tmp_path / "more"), params=SMALL)
    assert by_series(again["gate"])["ca"].action == "skip"
    assert again["forecasts"].isEmpty() and again["chart"].isEmpty()
    assert by_series(again["standing"])["ca"].predicted_ili == pytest.approx(1695.944444, abs=1e-6)
    assert not (tmp_path / "more").exists()
    assert read_ledger(spark, str(tmp_path / "ledger")).count() == 1


def test_three_paths_in_one_panel(spark, tmp_path):
    panel = make_panel(spark, [r for s in ("cold", "due", "wait", "off") for r in sample_rows(s)] + sample_rows("short", 30))
    week, actual = sample_rows()[-5][1], sample_rows()[-5][3]
    seed(
        spark,
        str(tmp_path / "ledger"),
        ("due", week, actual * 1.01, actual * 0.8, actual * 1.2),
        ("off", week, actual * 3, actual * 2, actual * 4),
        ("wait", LAST + timedelta(weeks=10), 1500.0, 1200.0, 1800.0),
    )
    got = run(panel, tmp_path)
    assert {s: r.reason for s, r in by_series(got["gate"]).items()} == {
        "cold": "cold_start", "due": "matched", "off": "matched", "wait": "pending", "short": "cold_start",
    }
    forecasts = by_series(got["forecasts"])
    assert set(forecasts) == {"cold", "due", "off", "short"}
    assert forecasts["short"].status == "insufficient_history"
    assert forecasts["due"].predicted_ili == forecasts["cold"].predicted_ili > 0
    assert set(by_series(got["alerts"])) == {"off"}
    assert by_series(got["alerts"])["off"].next_predicted_ili == forecasts["off"].predicted_ili
    blocks = got["summary"].where("line = 'Prior Prediction Comparison:'")
    assert set(by_series(blocks)) == {"due", "off"}
    keys = {(r.series, r.key): r.value for r in got["outputs"].collect()}
    assert keys[("due", "comparison_alert")] == "false" and keys[("off", "comparison_alert")] == "true"
    assert set(by_series(got["standing"])) == {"wait"}
    (file,) = (tmp_path / "out" / "outputs" / "series=due").glob("*.txt")
    assert file.read_text() == "comparison_alert=false\ncomparison_deviation_pct=1.0\n"
    appended = read_ledger(spark, str(tmp_path / "ledger")).where("generated_at > '2024-02-01'")
    assert set(by_series(appended)) == {"cold", "due", "off"}


def test_high_threshold_does_not_alert(spark, sample, tmp_path):
    week, actual = sample_rows()[-5][1], sample_rows()[-5][3]
    seed(spark, str(tmp_path / "ledger"), ("ca", week, actual * 1.5, 0.0, 1.0))
    got = run(sample, tmp_path, threshold=0.99, per_series_files=False)
    assert got["alerts"].isEmpty() and not got["accuracy"].isEmpty()
    text = [r.value for r in spark.read.text(str(tmp_path / "out" / "summary")).collect()]
    assert text == [r.line for r in got["summary"].orderBy("line_no").collect()]
    assert spark.read.parquet(str(tmp_path / "out" / "outputs")).count() == 2


def test_interval_from_unseen_weeks(spark, sample, tmp_path):
    row = by_series(run(sample, tmp_path, interval_from="validation")["forecasts"])["ca"]
    errors = sorted(y - 1618.142857 for y in [r[3] for r in sample_rows()][-4:])
    low = errors[0] + 0.075 * (errors[1] - errors[0])
    assert row.ci_lower == pytest.approx(1695.944444 + low, abs=1e-3)
    with pytest.raises(ValueError):
        run(sample, tmp_path, interval_from="elsewhere")


def test_nothing_but_short_series(spark, tmp_path):
    got = run(make_panel(spark, sample_rows("short", 40)), tmp_path)
    assert by_series(got["forecasts"])["short"].status == "insufficient_history"
    assert not (tmp_path / "out").exists() and not (tmp_path / "ledger").exists()


def test_a_failed_run_leaves_the_ledger_and_can_be_repeated(spark, sample, tmp_path, monkeypatch):
    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr(weekly, "_write", broken)
    with pytest.raises(OSError):
        run(sample, tmp_path)
    assert read_ledger(spark, str(tmp_path / "ledger")).isEmpty()
    monkeypatch.undo()
    assert by_series(run(sample, tmp_path)["gate"])["ca"].reason == "cold_start"


def test_results_do_not_change_when_the_ledger_grows(spark, sample, tmp_path):
    week, actual = sample_rows()[-1][1], sample_rows()[-1][3]
    seed(spark, str(tmp_path / "ledger"), ("ca", week, actual * 2, 0.0, 1.0))
    got = run(sample, tmp_path)
    before = collected(got["alerts"])
    seed(spark, str(tmp_path / "ledger"), ("ca", week, actual, 0.0, 1.0))
    spark.catalog.clearCache()
    assert collected(got["alerts"]) == before and len(before) == 1


def test_runs_with_blocks_and_with_json(spark, sample, tmp_path):
    whole = run(sample, tmp_path / "a", layout="series")
    blocks = run(sample, tmp_path / "b", layout="blocks", ledger_format="json")
    assert collected(whole["forecasts"]) == collected(blocks["forecasts"])
    assert read_ledger(spark, str(tmp_path / "b" / "ledger"), "json").count() == 1


def test_landing_takes_each_file_once_and_the_newest_fetch_wins(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, at, *weeks):
        records = [{"epiweek": w, "num_ili": y, "num_patients": 1, "ili": 1.0} for w, y in weeks]
        body = {"series": "ca", "fetched_at": at, "payload": json.dumps({"result": 1, "epidata": records})}
        bad = {"series": "tx", "fetched_at": at, "payload": json.dumps({"result": -1, "message": "no"})}
        (landing / name).write_text(json.dumps(body) + "\n" + json.dumps(bad) + "\n")

    def pick_up():
        query = land_payloads(spark, str(landing), str(tmp_path / "table"), str(tmp_path / "state"))
        assert query.awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "table"))

    land("a.json", "2024-01-10T00:00:00Z", (202401, 5))
    assert pick_up().count() == 2
    assert pick_up().count() == 2
    land("b.json", "2024-01-17T00:00:00Z", (202401, 6), (202402, 7))
    table = pick_up()
    assert table.count() == 4
    newest = newest_fetch(table)
    records = observations(payload_rows(newest)).orderBy("week").collect()
    assert [(r.series, r.ilitotal) for r in records] == [("ca", 6.0), ("ca", 7.0)]
    assert [tuple(r) for r in payload_errors(newest, key="series").collect()] == [("tx", "no")]


@pytest.mark.parametrize("n", [53, 54])
def test_hardly_any_history_is_still_forecast(spark, tmp_path, n):
    rows = sample_rows("young", n)
    got = run(make_panel(spark, rows), tmp_path, per_series_files=False)
    row = by_series(got["forecasts"])["young"]
    assert row.status == "ok" and row.predicted_ili == pytest.approx(sum(r[3] for r in rows[52:]) / (n - 52))
    metrics = {r.split: r for r in got["metrics"].collect()}
    if n == 53:
        assert set(metrics) == {"validation"}
        assert (metrics["validation"].n, metrics["validation"].rmse) == (0, None)
    else:
        assert (metrics["train"].n, metrics["validation"].n) == (1, 1)
    assert spark.read.parquet(str(tmp_path / "out" / "metrics")).count() == len(metrics)


def without_value(rows, back):
    hole = len(rows) - back
    return [(*r[:3], None, *r[4:]) if i == hole else r for i, r in enumerate(rows)]


@pytest.mark.parametrize("missing", ["parity", "strict"])
def test_alerts_go_out_even_if_nothing_can_be_forecast(spark, tmp_path, missing):
    rows = without_value(sample_rows(), 2)
    week, actual = rows[-5][1], rows[-5][3]
    seed(spark, str(tmp_path / "ledger"), ("ca", week, actual * 3, 0.0, 1.0))
    got = run(make_panel(spark, rows), tmp_path, missing=missing, per_series_files=False)
    row = by_series(got["forecasts"])["ca"]
    assert spark.read.parquet(str(tmp_path / "out" / "alerts")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out" / "accuracy")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out" / "gate")).count() == 1
    made = (tmp_path / "out" / "prediction").exists()
    if missing == "strict":
        assert row.status == "insufficient_history" and row.predicted_ili is None and not made
    else:
        assert row.status == "missing_feature" and row.predicted_ili > 0 and made
    assert read_ledger(spark, str(tmp_path / "ledger")).count() == 1 + made


def test_a_series_of_the_ledger_alone_is_reported(spark, sample, tmp_path):
    seed(spark, str(tmp_path / "ledger"), ("gone", LAST, 1.0, 0.0, 2.0))
    got = run(sample, tmp_path)
    assert {s: (r.action, r.reason) for s, r in by_series(got["gate"]).items()} == {
        "ca": ("retrain", "cold_start"), "gone": ("skip", "no_data"),
    }
    assert set(by_series(spark.read.parquet(str(tmp_path / "out" / "standing")))) == {"gone"}


def test_a_run_can_remove_its_intermediate_files(spark, sample, tmp_path):
    from pathlib import Path

    shared = Path(shared_dir(spark))
    before = {p.name for p in shared.glob("weekly-*")}
    with run(sample, tmp_path) as got:
        assert {p.name for p in shared.glob("weekly-*")} > before
        got["forecasts"].collect()
    assert {p.name for p in shared.glob("weekly-*")} == before
