"""Publication by one commit, the ledger's snapshot, and what a run sets aside."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from panel_helpers import collected, make_panel, sample_rows
from pyspark.sql import functions as F

from weekcast import weekly_run
from weekcast.__main__ import main
from weekcast.operators import ModelParams
from weekcast.schema import LEDGER
from weekcast.sources import (
    RunLog,
    TakenError,
    ledger_errors,
    ledger_latest_valid,
    ledger_newest,
    observation_errors,
    observations,
    read_ledger,
    sound_observations,
    tagged_observations,
)

SMALL = ModelParams(trees=1)
AS_OF = "2024-05-01T16:00:00Z"
WEEK, ACTUAL = sample_rows()[-5][1], sample_rows()[-5][3]


def rows(spark, *forecasts):
    return spark.createDataFrame(list(forecasts), LEDGER)


def row(series, day, value, made, low=0.0):
    return (series, date(2024, 1, day), value, low, value and value * 2, datetime(2024, 1, made))


def test_a_log_without_runs(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    assert log.commit().number == 0 and log.commits() == []
    assert log.latest_valid().isEmpty() and log.history().isEmpty() and log.output("alerts") is None


def test_the_snapshot_and_newer_runs_give_what_all_history_gives(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), snapshot_every=3)
    made = [
        [row("a", 7, 1.0, 1), row("b", 7, 2.0, 1), row("gone", 7, 9.0, 1)],
        [row("a", 14, 3.0, 8), row("b", 14, None, 8)],
        [row("a", 14, 4.0, 8), row("c", 7, 5.0, 2)],
        [row("b", 21, 6.0, 9), row("c", 7, 1.0, 1)],
        [row("a", 7, 8.0, 3)],
    ]
    for i, some in enumerate(made):
        commit = log.publish_rows({}, f"2024-02-{i + 1:02d}", rows(spark, *some))
        assert commit.number == i + 1
        assert collected(log.latest_valid()) == collected(ledger_latest_valid(log.history()))
        assert collected(log.newest()) == collected(ledger_newest(log.history()))
    assert log.commit().state and len(log.commit().since) == 2
    assert log.history().count() == 10
    read = log.latest_valid().inputFiles()
    folders = {f.split(str(tmp_path))[1].split("/")[1] for f in read}
    assert folders == {"state", "runs"}
    runs = {f.split("/runs/")[1].split("/")[0] for f in read if "/runs/" in f}
    assert runs == set(log.commit().since)
    # The newest row of b was incomplete after the second run and is complete now.
    assert {r.series: r.predicted_ili for r in log.latest_valid().collect()} == {"a": 4.0, "b": 6.0, "c": 5.0, "gone": 9.0}
    second = log.commit(2)
    assert {r.series for r in log.latest_valid(second).collect()} == {"a", "gone"}
    assert [(r.series, r.error) for r in log.errors(second).collect()] == [("b", "missing: predicted_ili, ci_upper")]


def test_only_one_of_two_runs_from_the_same_commit_counts(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    before = log.commit()
    log.publish_rows({}, AS_OF, rows(spark, row("a", 7, 1.0, 1)), before)
    with pytest.raises(TakenError):
        log.publish_rows({}, AS_OF, rows(spark, row("a", 7, 2.0, 1)), before)
    assert [r.predicted_ili for r in log.history().collect()] == [1.0]
    assert not [p for p in (tmp_path / "commits").iterdir() if "draft" in p.name and p.suffix != ".crc"]


@pytest.mark.parametrize("where", ["_publish", "publish_rows"])
def test_a_run_that_stops_before_its_commit_is_repeated_without_a_trace(spark, sample, tmp_path, monkeypatch, where):
    log = RunLog(spark, str(tmp_path))
    log.publish_rows({}, "2024-03-01", spark.createDataFrame(
        [("ca", WEEK, ACTUAL * 3, 0.0, 1.0, datetime(2024, 3, 1))], LEDGER
    ))

    def broken(*_, **__):
        raise OSError("the driver is gone")

    monkeypatch.setattr(RunLog, where, broken)
    with pytest.raises(OSError):
        weekly_run(sample, log, AS_OF, params=SMALL)
    assert log.output("alerts") is None and log.history().count() == 1 and log.commit().number == 1
    monkeypatch.undo()
    done = weekly_run(sample, log, AS_OF, params=SMALL)
    assert log.commit().number == 2
    assert collected(log.output("alerts")) == collected(done["alerts"]) and done["alerts"].count() == 1
    assert collected(log.output("forecasts")) == collected(done["forecasts"])
    assert log.history().count() == 2
    assert set(log.commit().outputs) >= {"alerts", "accuracy", "outputs", "forecasts", "summary", "chart", "gate", "ledger"}
    again = weekly_run(sample, log, AS_OF, params=SMALL)
    assert {r.action for r in again["gate"].collect()} == {"skip"}
    assert log.commit().number == 2  # a run that did nothing publishes nothing


def test_files_are_written_after_the_commit(spark, sample, tmp_path, monkeypatch):
    from weekcast.plans import weekly

    log = RunLog(spark, str(tmp_path / "log"))

    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr(weekly, "_write", broken)
    with pytest.raises(OSError):
        weekly_run(sample, log, AS_OF, params=SMALL, out_path=str(tmp_path / "out"))
    assert log.commit().number == 1 and log.output("forecasts").count() == 1


# --- what is set aside ------------------------------------------------------------------


def records(spark):
    return spark.createDataFrame(
        [
            ("a", "2024-01-07", "202401", "5", "10", "1.5", 1),
            ("a", "2024-02-30", "202402", "6", "10", "x", 2),
            ("b", None, "202403.0", "7", "10", "1", 3),
            ("b", "2024-01-21", None, "8", "10", "1", 4),
            ("b", "2024-01-21", "202404.5", "8", "10", "1", 5),
            ("c", None, "202405", "nan", None, "1", 6),
            (None, "2024-01-07", "week", "1", "1", "1", 7),
            (None, "2024-01-07", "202401", "1", "1", "1", 8),
        ],
        "series string, week_start string, epiweek string, num_ili string, num_patients string, ili string, payload_id int",
    )


def test_faulty_records_are_set_aside_with_their_reason(spark):
    tagged = tagged_observations(records(spark))
    errors = {r.payload_id: (r.series, r.error) for r in observation_errors(tagged).collect()}
    assert errors == {
        2: ("a", "not a date: 2024-02-30"), 4: ("b", "not an epiweek: null"),
        5: ("b", "not an epiweek: 202404.5"), 7: (None, "not an epiweek: week"),
    }
    record = json.loads(observation_errors(tagged).where("payload_id = 4").first().record)
    assert record == {"week_start": "2024-01-21", "epiweek": None, "num_ili": "8", "num_patients": "10", "ili": "1"}
    by_record = sound_observations(tagged, "record")
    assert sorted(r.payload_id for r in by_record.collect()) == [1, 3, 6, 8]
    assert sorted(r.payload_id for r in sound_observations(tagged).collect()) == [6]
    fine = observations(records(spark).where("payload_id IN (1, 3, 6, 8)"))
    assert collected(by_record.select(*fine.columns)) == collected(fine)
    with pytest.raises(ValueError):
        sound_observations(tagged, "job")


@pytest.mark.parametrize("number, column", [(2, "week_start"), (4, "week"), (5, "week_start")])
def test_strict_observations_still_fail(spark, number, column):
    with pytest.raises(Exception, match="not a"):
        observations(records(spark).where(F.col("payload_id") == number)).select(column).collect()


def test_ledger_errors_name_what_is_missing(spark, tmp_path):
    (tmp_path / "week_start=2024-01-07").mkdir()
    lines = ['{"series": "a", "predicted_ili": 1.0, "ci_lower": null, "ci_upper": 2.0}', "{not json",
             '{"series": "b", "predicted_ili": 1.0, "ci_lower": 0.5, "ci_upper": 2.0}']
    (tmp_path / "week_start=2024-01-07" / "x.json").write_text("\n".join(lines))
    found = ledger_errors(read_ledger(spark, str(tmp_path), "json")).collect()
    assert sorted((str(r.series), r.error) for r in found) == [("None", "not a ledger line"), ("a", "missing: ci_lower")]
    assert {r.record for r in found if r.series is None} == {"{not json"}


def landed(tmp_path, *fetches):
    (tmp_path / "landing").mkdir(exist_ok=True)
    lines = [
        json.dumps({"series": s, "fetched_at": at, "payload": json.dumps({"result": 1, "epidata": epidata})})
        for s, at, epidata in fetches
    ]
    (tmp_path / "landing" / f"{len(list((tmp_path / 'landing').iterdir()))}.json").write_text("\n".join(lines))


def epidata(bad=False):
    made = [
        {"week_start": str(r[1]), "epiweek": 202301 + i, "num_ili": r[3], "num_patients": r[4], "ili": r[5]}
        for i, r in enumerate(sample_rows())
    ]
    return [*made[:-1], {**made[-1], "week_start": "soon"}] if bad else made


@pytest.mark.parametrize("bad_records", ["series", "record"])
def test_a_bad_record_of_one_region_leaves_the_others_forecast(spark, tmp_path, bad_records):
    at = "2024-05-01T00:00:00Z"
    landed(tmp_path, ("ca", at, epidata()), ("tx", at, epidata(bad=True)))
    options = ["--landing", str(tmp_path / "landing"), "--run-log", str(tmp_path / "log"), "--as-of", AS_OF, "--trees", "1"]
    options += ["--bad-records", bad_records, "--region", "California", "--region", "Texas", "--region", "Atlantis"]
    assert main(options) == 0
    log = RunLog(spark, str(tmp_path / "log"))
    forecast = {r.series for r in log.output("forecasts").collect()}
    assert forecast == ({"ca"} if bad_records == "series" else {"ca", "tx"})
    (error,) = log.output("record_errors").collect()
    assert (error.series, error.error) == ("tx", "not a date: soon")
    assert [tuple(r) for r in log.output("region_errors").collect()] == [("Atlantis", "unknown region")]
    assert main(options) == 0  # waiting; what was found unusable is published again


def test_incomplete_ledger_rows_are_reported_by_the_run(spark, tmp_path):
    panel = make_panel(spark, sample_rows())
    path = str(tmp_path / "ledger")
    rows(spark, row("ca", 7, 1.0, 1, low=None)).write.partitionBy("week_start").parquet(path)
    done = weekly_run(panel, path, AS_OF, params=SMALL, out_path=str(tmp_path / "out"))
    assert done["gate"].first().reason == "cold_start"
    (error,) = spark.read.parquet(str(tmp_path / "out" / "ledger_errors")).collect()
    assert (error.series, error.error) == ("ca", "missing: ci_lower")
