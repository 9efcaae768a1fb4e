"""Reading payloads, regions, observations and the ledger; writing outputs."""

from .ledger import (
    ledger_append,
    ledger_errors,
    ledger_latest_valid,
    ledger_newest,
    ledger_quarantine,
    read_ledger,
)
from .observations import (
    coverage_stats,
    observation_errors,
    observations,
    scope_filter,
    sound_observations,
    tagged_observations,
)
from .payloads import newest_fetch, payload_errors, payload_rows
from .regions import normalize_region, region_mapping
from .run_log import Commit, RunLog, TakenError
from .sinks import alert_outputs, chart_frame, forecast_csv, summary_lines, write_lines

__all__ = [
    "Commit",
    "RunLog",
    "TakenError",
    "alert_outputs",
    "chart_frame",
    "coverage_stats",
    "forecast_csv",
    "ledger_append",
    "ledger_errors",
    "ledger_latest_valid",
    "ledger_newest",
    "ledger_quarantine",
    "newest_fetch",
    "normalize_region",
    "observation_errors",
    "observations",
    "payload_errors",
    "payload_rows",
    "read_ledger",
    "region_mapping",
    "scope_filter",
    "sound_observations",
    "summary_lines",
    "tagged_observations",
    "write_lines",
]
