"""``python -m weekcast``: one scheduled run from landed payload files.

Meant for spark-submit; the session's settings (master, checkpoint folder) come
from there.  Exits with 1 when the run fails.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.model import ModelParams
from .plans import weekly_run
from .schema import ALERT_THRESHOLD, OBSERVATION_COLUMNS, SERIES
from .session import scratch
from .sources.observations import (
    observation_errors,
    scope_filter,
    sound_observations,
    tagged_observations,
)
from .sources.payloads import newest_fetch, payload_errors, payload_rows
from .sources.regions import normalize_region
from .sources.run_log import RunLog
from .streaming.landing import landed

log = logging.getLogger("weekcast")
SHOWN_ERRORS = 100  # in the log; the error table has all


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="weekcast", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder of {series, fetched_at, payload}")
    parser.add_argument("--landing-format", default="json", choices=["json", "parquet"],
                        help="landed JSON lines, or the table the landing stream fills")
    kept = parser.add_mutually_exclusive_group(required=True)
    kept.add_argument("--ledger", help="folder of the forecast ledger; needs --out")
    kept.add_argument("--run-log", help="folder of runs whose outputs and forecasts are published together")
    parser.add_argument("--out", default=None, help="folder for this run's files")
    parser.add_argument("--region", action="append", required=True, help="name or code; repeatable")
    parser.add_argument("--as-of", default=None, help="UTC time of the run, ISO 8601; default now")
    parser.add_argument("--threshold", type=float, default=ALERT_THRESHOLD)
    parser.add_argument("--trees", type=int, default=ModelParams.trees)
    parser.add_argument("--missing", default="parity", choices=["parity", "strict"],
                        help="whether to forecast series whose newest rows lack a value")
    parser.add_argument("--bad-records", default="series", choices=["series", "record"],
                        help="what a record that can't be read leaves out: its series or itself")
    parser.add_argument("--models", default="pooled", choices=["pooled", "series"],
                        help="one model, or one for each series (needs --leaves)")
    parser.add_argument("--leaves", type=int, default=None, help="grow trees leaf by leaf to so many")
    parser.add_argument("--per-series-files", action="store_true",
                        help="one folder of text per series, for some hundreds of them")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Whatever can't be used is logged, written beside the results and left
    out; the rest is forecast.  Only a run without any data fails."""
    if args.ledger and not args.out:
        raise ValueError("--ledger needs --out")
    as_of = args.as_of or datetime.now(timezone.utc).isoformat()
    asked = spark.createDataFrame([(r,) for r in args.region], "region string")
    named = normalize_region(asked, "region")
    codes = {r.region: r.region_code for r in named.collect()}
    unknown = named.where("region_code IS NULL").select("region", F.lit("unknown region").alias("error"))
    fetched = landed(spark, args.landing, args.landing_format)
    fetched = newest_fetch(fetched.where(F.col(SERIES).isin([c for c in codes.values() if c])))
    with scratch(spark, "fetch") as work:
        newest = work.keep(fetched)
        tagged = work.keep(tagged_observations(payload_rows(newest)))
        errors = {
            "region_errors": work.keep(unknown),
            "errors": work.keep(payload_errors(newest, key=SERIES)),
            "record_errors": work.keep(observation_errors(tagged)),
        }
        for name, table in errors.items():
            for row in table.limit(SHOWN_ERRORS).collect():
                log.error("%s: %s", name, ", ".join(str(v) for v in row))
        records = sound_observations(tagged, args.bad_records).select(*OBSERVATION_COLUMNS)
        panel = work.keep(scope_filter(records, [c for c in codes.values() if c], as_of))
        runs = RunLog(spark, args.run_log) if args.run_log else None
        if panel.isEmpty():
            found = {name: table for name, table in errors.items() if not table.isEmpty()}
            if runs and found:
                runs.publish(found, as_of)
            for name, table in found.items():
                if args.out:
                    table.write.mode("overwrite").parquet(f"{args.out}/{name}")
            raise ValueError("no data for the asked regions")
        params = ModelParams(trees=args.trees, leaves=args.leaves)
        with weekly_run(
            panel, runs or args.ledger, as_of, args.threshold, args.out, params,
            per_series_files=args.per_series_files, missing=args.missing, errors=errors, models=args.models,
        ) as done:
            for row in done["gate"].groupBy("action", "reason").count().collect():
                log.info("%s (%s): %d series", row.action, row.reason, row["count"])


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName("weekcast").getOrCreate()
    try:
        run(spark, args)
    except Exception:
        log.exception("run failed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
