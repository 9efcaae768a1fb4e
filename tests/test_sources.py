from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from panel_helpers import collected, make_panel, sample_rows
from pyspark.sql import functions as F

from weekcast.sources import (
    alert_outputs,
    chart_frame,
    coverage_stats,
    forecast_csv,
    ledger_append,
    ledger_latest_valid,
    ledger_quarantine,
    newest_fetch,
    normalize_region,
    observations,
    payload_errors,
    payload_rows,
    read_ledger,
    region_mapping,
    scope_filter,
    summary_lines,
    write_lines,
)
from weekcast.sources.regions import REGION_CODES

TWO_WEEKS = [
    {"week_start": "2024-03-03", "epiweek": 202410, "num_ili": 71, "num_patients": 930, "ili": 7.63},
    {"week_start": "2024-03-10", "epiweek": 202411, "num_ili": 64, "num_patients": 880, "ili": 7.27},
]


def envelopes(spark, *bodies):
    rows = [(i, "ca", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "payload_id int, series string, payload string")


# --- payloads and observations -------------------------------------------------


def test_payload_to_observations(spark):
    df = observations(payload_rows(envelopes(spark, {"result": 1, "epidata": TWO_WEEKS})))
    assert [tuple(r) for r in df.orderBy("week").collect()] == [
        ("ca", date(2024, 3, 3), 202410, 71.0, 930.0, 7.63),
        ("ca", date(2024, 3, 10), 202411, 64.0, 880.0, 7.27),
    ]


def test_missing_dates_come_from_the_epiweek_row_by_row(spark):
    bare = [{k: v for k, v in r.items() if k != "week_start"} for r in TWO_WEEKS]
    mixed = [bare[0], TWO_WEEKS[1]]
    # 2023 begins and ends on a Sunday, so the source's rule moves 2024 by a week.
    for records, second in ((bare, date(2024, 3, 17)), (mixed, date(2024, 3, 10))):
        df = observations(payload_rows(envelopes(spark, {"result": 1, "epidata": records})))
        assert [r.week_start for r in df.orderBy("week").collect()] == [date(2024, 3, 10), second]


def test_payload_errors(spark):
    df = envelopes(
        spark,
        {"result": 1, "epidata": TWO_WEEKS},
        {"result": -1, "message": "bad request", "epidata": []},
        {"result": -1, "epidata": TWO_WEEKS},
        {"result": 1, "epidata": []},
        {"result": 1},
        "{not json",
    )
    assert {r.payload_id: r.error for r in payload_errors(df).collect()} == {
        1: "bad request",
        2: "unknown error",
        3: "No data returned",
        4: "No data returned",
        5: "unknown error",
    }
    assert {r.payload_id for r in payload_rows(df).collect()} == {0}


def test_the_newest_fetch_is_chosen_before_anything_is_parsed(spark):
    good, bad = {"result": 1, "epidata": TWO_WEEKS}, {"result": -1, "message": "down"}
    odd = {"result": 1, "epidata": [{"epiweek": "x"}]}
    rows = [
        ("late", "2024-03-12 00:00:00", good), ("late", "2024-03-19 00:00:00", bad),
        ("fine", "2024-03-12 00:00:00", odd), ("fine", "2024-03-19 00:00:00", good),
    ]
    landed = spark.createDataFrame(
        [(s, at, json.dumps(b)) for s, at, b in rows], "series string, fetched_at string, payload string"
    )
    newest = newest_fetch(landed)
    assert {r.series for r in observations(payload_rows(newest)).collect()} == {"fine"}
    assert [tuple(r) for r in payload_errors(newest, key="series").collect()] == [("late", "down")]
    plan = payload_rows(newest)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("LogicalRDD") == 1


@pytest.mark.parametrize(
    "body, text",
    [({"result": -1, "message": "bad request"}, "bad request"), ({"result": 1}, "No data returned")],
)
def test_strict_payload_fails_the_job(spark, body, text):
    with pytest.raises(Exception, match=text):
        payload_rows(envelopes(spark, body), strict=True).collect()


def test_measures_are_lenient_and_weeks_are_not(spark):
    odd = [{"epiweek": "202403", "num_ili": "n/a", "num_patients": None, "ili": "NaN"}]
    df = observations(payload_rows(envelopes(spark, {"result": 1, "epidata": odd})))
    assert tuple(df.first()) == ("ca", date(2024, 1, 21), 202403, None, None, None)
    whole = payload_rows(envelopes(spark, {"result": 1, "epidata": [{"epiweek": "202403.0"}]}))
    assert observations(whole).first().week == 202403
    for cell in ({"epiweek": "x"}, {}, {"epiweek": "202401.7"}, {"epiweek": 202401, "week_start": "soon"}):
        bad = payload_rows(envelopes(spark, {"result": 1, "epidata": [cell]}))
        with pytest.raises(Exception, match="not a"):
            observations(bad).collect()
        assert observations(bad, strict=False).count() == 1


# --- regions, scope, coverage ----------------------------------------------------


def test_regions_by_name_and_code(spark):
    assert len(REGION_CODES) == 56
    texts = ["California", "  new YORK\t", "TX", " vi\n", "Atlantis", None]
    df = spark.createDataFrame([(t,) for t in texts], "region string")
    got = {r.region: r.region_code for r in normalize_region(df, "region").collect()}
    assert [got[t] for t in texts] == ["ca", "ny", "tx", "vi", None, None]
    every = normalize_region(region_mapping(spark), "name", out="found")
    assert every.where(F.col("found") == F.col("code")).count() == 56


def test_trusted_regions_are_only_lowered(spark):
    df = spark.createDataFrame([("TX",), ("Atlantis",)], "region string")
    got = [r.region_code for r in normalize_region(df, "region", strict=False).collect()]
    assert got == ["tx", "atlantis"]


def test_own_mapping_with_repeats_does_not_multiply_rows(spark):
    mapping = spark.createDataFrame([("north", "n"), ("north", "n"), ("n", "x")], "name string, code string")
    df = spark.createDataFrame([("North",), ("n",)], "region string")
    assert [r.region_code for r in normalize_region(df, "region", mapping).orderBy("region").collect()] == ["n", "n"]


def test_scope_is_inclusive_and_reaches_the_scan(spark, tmp_path):
    rows = [("ca", None, w, 1.0, 1.0, 1.0) for w in (201552, 201601, 202552, 202553)]
    rows += [("tx", None, 202001, 1.0, 1.0, 1.0)]
    make_panel(spark, rows).write.partitionBy("series").parquet(str(tmp_path / "obs"))
    table = spark.read.parquet(str(tmp_path / "obs"))
    for as_of in ("2024-06-01", date(2024, 6, 1), datetime(2024, 6, 1)):
        scoped = scope_filter(table, "ca", as_of)
        assert sorted(r.week for r in scoped.collect()) == [201601, 202552]
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(week,201601)" in plan and "PartitionFilters: [isnotnull(series" in plan


def test_coverage_counts_gaps_and_repeats(spark):
    rows = sample_rows()
    panel = make_panel(spark, rows[:10] + rows[12:] + rows[:3] + [("tx", *rows[0][1:])])
    got = {r.series: r for r in coverage_stats(panel).collect()}
    assert tuple(got["ca"])[1:] == (71, date(2023, 1, 2), date(2024, 4, 29), 2, 3, True)
    assert tuple(got["tx"])[1:] == (1, date(2023, 1, 2), date(2023, 1, 2), 0, 0, False)


# --- ledger ------------------------------------------------------------------------


def forecast_rows(spark, *rows):
    return spark.createDataFrame(
        list(rows), "series string, week_start date, predicted_ili double, ci_lower double, ci_upper double"
    )


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_ledger_round_trip_and_ranking(spark, tmp_path, fmt):
    path = str(tmp_path / "ledger")
    assert ledger_latest_valid(path, fmt).count() == 0
    first = forecast_rows(spark, ("ca", date(2024, 3, 18), 1500.0, 1200.0, 1800.0), ("tx", date(2024, 3, 18), None, None, None))
    ledger_append(first, path, "2024-03-11T16:00:00Z", fmt)
    ledger_append(forecast_rows(spark, ("ca", date(2024, 3, 25), 1.0, 0.0, 2.0)), path, datetime(2024, 3, 18, 16), fmt)
    assert read_ledger(spark, path, fmt).count() == 2
    row = ledger_latest_valid(read_ledger(spark, path, fmt)).collect()
    assert [tuple(r) for r in row] == [
        ("ca", date(2024, 3, 25), 1.0, 0.0, 2.0, datetime(2024, 3, 18, 16))
    ]


def test_ledger_json_text(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger_append(forecast_rows(spark, ("ca", date(2024, 3, 18), 1500.0, 1200.0, 1800.0)), path, "2024-03-11T17:00:00+01:00", "json")
    line = spark.read.text(path).first()["value"]
    assert json.loads(line) == {
        "series": "ca", "predicted_ili": 1500.0, "ci_lower": 1200.0, "ci_upper": 1800.0,
        "generated_at": "2024-03-11T16:00:00Z",
    }


def test_bad_ledger_lines_mean_cold_start(spark, tmp_path):
    full = {"week_start": "2023-11-06", "predicted_ili": 42.5, "ci_lower": 30.0, "ci_upper": 61.25}
    lines = [
        '{"series": "cut',
        json.dumps({"series": "missing", "week_start": "2023-11-06"}),
        json.dumps({"series": "fine", **full, "generated_at": "2024-03-11T16:00:00Z"}),
        json.dumps({"series": "undated", **full}),
        json.dumps({"series": "later", **full, "generated_at": "2024-03-11T16:00:00Z"}),
        json.dumps({"series": "later", **full, "ci_upper": None, "generated_at": "2024-03-18T16:00:00Z"}),
        json.dumps({"series": "typo", **full, "generated_at": "2024-03-11T16:00:00Z"}),
        json.dumps({"series": "typo", **full, "ci_lower": "low", "generated_at": "2024-03-18T16:00:00Z"}),
    ]
    (tmp_path / "ledger.json").write_text("\n".join(lines))
    ledger = read_ledger(spark, str(tmp_path / "ledger.json"), "json")
    assert sorted(r.series for r in ledger_latest_valid(ledger).collect()) == ["fine", "undated"]
    assert sorted(str(r.series) for r in ledger_quarantine(ledger).collect()) == ["None", "later", "missing", "typo"]


# --- outputs -----------------------------------------------------------------------

ACCURACY = (
    "series string, week_start date, predicted_ili double, ci_lower double, ci_upper double, "
    "actual_ili double, status string, deviation_pct double"
)


def test_csv_has_one_header_and_reads_back(spark, tmp_path):
    df = forecast_rows(spark, ("ca", date(2024, 3, 18), 1500.0, 1200.0, 1800.0))
    forecast_csv(df.withColumn("status", F.lit("ok")), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["series", "week_start", "predicted_ili", "ci_lower", "ci_upper"]
    assert tuple(back.first()) == ("ca", "2024-03-18", "1500.0", "1200.0", "1800.0")


def test_summary_with_and_without_comparison(spark, tmp_path):
    ahead = forecast_rows(
        spark,
        ("ca", date(2024, 4, 1), 1600.5, 1300.0, 1900.0),
        ("tx", date(2024, 4, 1), 2.5, 0.0, 3.5),
        ("short", date(2024, 4, 1), None, None, None),
    )
    accuracy = spark.createDataFrame(
        [("ca", date(2024, 3, 18), 1500.0, 1200.0, 1800.0, 1450.0, "matched", 50 / 1450 * 100)], ACCURACY
    )
    lines = summary_lines(ahead, accuracy, "2024-03-25T16:00:00Z", title="Summary")
    write_lines(lines, str(tmp_path / "summary"), F.col("line"), ["line_no"], per_series=True)
    text = (tmp_path / "summary" / "series=ca")
    (file,) = text.glob("part-*.txt")
    assert file.read_text() == (
        "Summary\nGenerated: 2024-03-25 16:00:00 UTC\nState: ca\n\n"
        "Prior Prediction Comparison:\n  Week: 2024-03-18\n  Predicted: 1500\n  Actual:    1450\n"
        "  Deviation: 3.4%\n\n"
        "Next Week Prediction:\n  Week Starting: 2024-04-01\n  Predicted ILI: 1600\n  95% PI: [1300, 1900]\n"
    )
    older = accuracy.withColumn("week_start", F.date_sub("week_start", 7))
    twice = summary_lines(ahead, accuracy.unionByName(older), "2024-03-25T16:00:00Z", title="Summary")
    assert collected(twice) == collected(lines)
    plain = [r.line for r in lines.where("series = 'tx'").orderBy("line_no").collect()]
    assert plain[4:] == ["Next Week Prediction:", "  Week Starting: 2024-04-01", "  Predicted ILI: 2", "  95% PI: [0, 4]"]
    assert lines.where("series = 'short'").isEmpty()
    assert summary_lines(ahead).where("line like '%Comparison%'").isEmpty()


def test_chart_layers(spark, sample):
    ahead = forecast_rows(spark, ("ca", date(2024, 5, 6), 1500.0, 1200.0, 1800.0))
    plain = chart_frame(sample, ahead)
    assert {r.layer: r["count"] for r in plain.groupBy("layer").count().collect()} == {"history": 52, "forecast": 1}
    assert plain.agg(F.min("week_start")).first()[0] == date(2023, 5, 8)
    accuracy = spark.createDataFrame(
        [("ca", date(2024, 4, 29), 1300.0, 1.0, 2.0, 1400.0, "matched", 7.1)], ACCURACY
    )
    marks = {r.layer: r for r in chart_frame(sample, ahead, accuracy).where("layer <> 'history'").collect()}
    assert (marks["prior_forecast"].value, marks["actual"].value) == (1300.0, 1400.0)
    assert (marks["difference"].lo, marks["difference"].hi) == (1300.0, 1400.0)
    assert (marks["forecast"].lo, marks["forecast"].hi) == (1200.0, 1800.0)


def test_scheduler_keys(spark):
    accuracy = spark.createDataFrame(
        [
            ("a", date(2024, 3, 18), 1300.0, 1.0, 2.0, 1000.0, "matched", 30.0),
            ("b", date(2024, 3, 18), 1200.0, 1.0, 2.0, 1000.0, "matched", 20.0),
            ("c", date(2024, 3, 18), 10.0, 1.0, 2.0, 0.0, "matched", None),
            ("d", date(2024, 3, 18), 10.0, 1.0, 2.0, None, "pending", None),
        ],
        ACCURACY,
    )
    got = {}
    for r in alert_outputs(accuracy, 0.2).collect():
        got.setdefault(r.series, {})[r.key] = r.value
    assert got == {
        "a": {
            "comparison_alert": "true",
            "comparison_week": "2024-03-18",
            "comparison_predicted": "1300",
            "comparison_actual": "1000",
            "comparison_deviation_pct": "30.0",
        },
        "b": {"comparison_alert": "false", "comparison_deviation_pct": "20.0"},
        "c": {
            "comparison_alert": "undefined",
            "comparison_week": "2024-03-18",
            "comparison_predicted": "10",
            "comparison_actual": "0",
        },
    }
    assert len(collected(alert_outputs(accuracy, 0.5))) == 8
