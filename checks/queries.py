"""One registered query per operator.

Doubles are rounded to six places on both sides of the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast import operators as op
from weekcast import sources as src
from weekcast.functions import epiweek_to_date, mmwr_week_start
from weekcast.plans import WeeklyRun, weekly_run
from weekcast.schema import (
    FEATURES,
    LAGS,
    LEDGER,
    OBSERVATION_COLUMNS,
    SERIES,
    TARGET,
    WEEK_START,
    YEAR_LAG,
)
from weekcast.session import cut_lineage, run_dir

from . import inputs

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-06T16:00:00Z"
LATER = "2001-08-13T16:00:00Z"
TREES = op.ModelParams()
# A tree without levels is the mean of its rows: everything around the trees
# (split, refit, scoring, interval) can then be checked by SQL.
MEAN_MODEL = op.ModelParams(trees=1, depth=0)
# Two trees of one cut each, over features of few distinct values: the best cut
# and both leaf means are plain SQL.
STUMPS = op.ModelParams(trees=2, depth=1, feature_share=1.0)
STUMP_FEATURES = [f"lag_{k}" for k in (*LAGS, YEAR_LAG)]
# Two trees of three leaves, the second cut where best-first growth puts it, and
# a stump model for every series: bins, residuals and cuts are plain SQL.
THREE_LEAVES = op.ModelParams(trees=2, depth=2, leaves=3, bins=16, feature_share=1.0)
OWN_STUMPS = op.ModelParams(trees=2, depth=1, leaves=2, bins=16, feature_share=1.0, min_leaf_rows=10)


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places without negative zeros, days and instants as text."""

    def tidy(name: str, kind: str) -> Column:
        if kind == "double":
            near = F.round(F.col(name), 6)
            return F.when(near == 0, F.lit(0.0)).otherwise(near).alias(name)
        if kind == "timestamp":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.col(name).cast("string").alias(name) if kind == "date" else F.col(name)

    return df.select(*[tidy(name, kind) for name, kind in df.dtypes])


def on_panel(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(fn(inputs.weekly_panel(spark, sf_dir)))


def on_stored_panel(fn: Callable[[DataFrame], DataFrame]) -> Query:
    """For operators that read the panel more than once: aggregate it once."""
    return lambda spark, sf_dir: comparable(fn(cut_lineage(inputs.weekly_panel(spark, sf_dir))))


# --- sources -----------------------------------------------------------------


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.payload_rows(inputs.payloads(spark, sf_dir))


def payload_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.payload_errors(inputs.payloads(spark, sf_dir))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(src.observations(payload_rows(spark, sf_dir)))


def observation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.observation_errors(src.tagged_observations(inputs.faulty_records(spark, sf_dir)))


def sound_observations(faulty: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tagged = src.tagged_observations(inputs.faulty_records(spark, sf_dir))
        return comparable(src.sound_observations(tagged, faulty))

    return query


def _named_regions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nation = inputs.table(spark, sf_dir, "nation")
    code = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    mapping = nation.select(F.lower("n_name").alias("name"), code.alias("code"))
    raw = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("  "), "n_name", F.lit("\t")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.upper(code), F.lit(" ")))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("No "), "n_name"))
        .otherwise(F.col("n_name"))
    )
    named = (
        inputs.table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", raw.alias("region"))
    )
    return named, mapping


def normalize_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, mapping = _named_regions(spark, sf_dir)
    return src.normalize_region(named, "region", mapping).select("c_custkey", "region_code")


def normalize_region_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, _ = _named_regions(spark, sf_dir)
    return src.normalize_region(named, "region", strict=False).select("c_custkey", "region_code")


def epiweek_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = epiweek_to_date(F.col("epiweek"))
    return comparable(inputs.epiweeks(spark, sf_dir).withColumn("week_start", dated))


def mmwr_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = mmwr_week_start(F.col("epiweek"))
    return comparable(inputs.epiweeks(spark, sf_dir).withColumn("week_start", dated))


def scope(panel: DataFrame) -> DataFrame:
    return src.scope_filter(panel, ["NATION_1-BUILDING", "NATION_2-MACHINERY"], "1999-06-01")


# --- features ----------------------------------------------------------------


def training_frame_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(op.training_frame(inputs.repeating_panel(spark, sf_dir), layout="blocks"))


def split_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = inputs.repeating_panel(spark, sf_dir)
    return comparable(op.chronological_split(panel, layout="blocks"))


def split_frame(layout: str) -> Query:
    """The split of a training frame whose observations repeat."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = op.training_frame(inputs.repeating_panel(spark, sf_dir), layout="series")
        return comparable(op.chronological_split(cut_lineage(frame), layout=layout))

    return query


# --- model -------------------------------------------------------------------


def _split_frame(panel: DataFrame, scope: str = "series") -> DataFrame:
    frame = op.training_frame(panel, layout="series")
    return op.chronological_split(frame, scope=scope, layout="series")


def split(panel: DataFrame, scope: str = "series") -> DataFrame:
    return _split_frame(panel, scope).select(*OBSERVATION_COLUMNS, "split")


def metrics(panel: DataFrame) -> DataFrame:
    scored = _split_frame(panel).withColumn("prediction", F.col("roll_mean_12"))
    return op.regression_metrics(scored, TARGET, "prediction", (SERIES, "split"))


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(op.training_frame(inputs.weekly_panel(spark, sf_dir), layout="series"))


def fit_forecaster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each feature contributes to the fitted model."""
    model = op.fit_forecaster(_frame(spark, sf_dir), TREES)
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(FEATURES, weights)), "feature string, importance double")


def fit_forecaster_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut of each tree and what its two leaves add to a prediction."""
    trees = op.fit_forecaster(_frame(spark, sf_dir), STUMPS, STUMP_FEATURES).stages[-1]
    rows = []
    for n, (tree, weight) in enumerate(zip(trees.trees, trees.treeWeights)):
        root = tree._java_obj.rootNode()
        low, high = (side.prediction() * weight for side in (root.leftChild(), root.rightChild()))
        cut = root.split()
        rows.append((n + 1, STUMP_FEATURES[cut.featureIndex()], cut.threshold(), low, high))
    schema = "tree int, feature string, threshold double, low double, high double"
    return comparable(spark.createDataFrame(rows, schema))


def _nodes(model: op.LeafwiseModel) -> DataFrame:
    """A row for each node of each tree."""
    names = F.array(*[F.lit(name) for name in model.features])
    nodes = model.trees.select(F.col("_model").alias("model"), "tree", F.inline("nodes"))
    return comparable(nodes.withColumn("feature", F.get(names, F.col("feature"))))


def fit_leafwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(op.fit_forecaster(_frame(spark, sf_dir), THREE_LEAVES, STUMP_FEATURES))


def fit_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = op.fit_forecaster(_frame(spark, sf_dir), OWN_STUMPS, STUMP_FEATURES, scope="series")
    return _nodes(model)


def score_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _frame(spark, sf_dir)
    scored = op.score(op.fit_forecaster(frame, OWN_STUMPS, STUMP_FEATURES, scope="series"), frame)
    return comparable(scored.select(SERIES, WEEK_START, TARGET, "prediction", "status"))


def score_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stumps as one expression over the feature columns."""
    frame = _frame(spark, sf_dir)
    value = op.compiled(op.fit_forecaster(frame, STUMPS, STUMP_FEATURES))
    return comparable(frame.select(SERIES, WEEK_START, TARGET, value.alias("prediction")))


def score(
    spark: SparkSession, sf_dir: str, params: op.ModelParams = TREES, features: list[str] = FEATURES
) -> DataFrame:
    frame = _frame(spark, sf_dir)
    scored = op.score(op.fit_forecaster(frame, params, features), frame)
    return comparable(scored.select(SERIES, WEEK_START, TARGET, "prediction", "status"))


def backtest(
    spark: SparkSession, sf_dir: str, params: op.ModelParams = TREES, features: list[str] = FEATURES
) -> DataFrame:
    frame = op.training_frame(inputs.weekly_panel(spark, sf_dir), layout="series")
    return comparable(op.backtest(frame, params, layout="series", features=features).metrics)


def interval(panel: DataFrame) -> DataFrame:
    points = panel.groupBy(SERIES).agg(
        F.date_add(F.max(WEEK_START), 7).alias(WEEK_START),
        F.avg(TARGET).alias("predicted_ili"),
    )
    return op.residual_interval(inputs.scored_frame(panel), points)


def next_forecast(
    spark: SparkSession, sf_dir: str, params: op.ModelParams = TREES, features: list[str] = FEATURES
) -> DataFrame:
    panel = cut_lineage(inputs.weekly_panel(spark, sf_dir))
    frame = cut_lineage(op.training_frame(panel, layout="series"))
    return comparable(op.next_forecast(op.fit_forecaster(frame, params, features), panel, frame))


def next_forecast_gappy(missing: str) -> Query:
    """Forecasts of a panel with weeks that lack a value."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        panel = cut_lineage(inputs.gappy_panel(inputs.weekly_panel(spark, sf_dir)))
        frame = cut_lineage(op.training_frame(panel, layout="series"))
        model = op.fit_forecaster(frame, MEAN_MODEL)
        return comparable(op.next_forecast(model, panel, frame, missing=missing))

    return query


# --- ledger and reconciliation -----------------------------------------------


def _latest(panel: DataFrame) -> DataFrame:
    return src.ledger_latest_valid(inputs.ledger(panel))


def _accuracy(panel: DataFrame) -> DataFrame:
    return op.forecast_accuracy(op.forecast_actual_lookup(inputs.ledger(panel), panel))


def _newest_accuracy(panel: DataFrame) -> DataFrame:
    return op.forecast_accuracy(op.forecast_actual_lookup(_latest(panel), panel))


def ledger_append(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> DataFrame:
    """Two runs append to one ledger, which is then read back."""
    path = run_dir(spark, f"ledger-{fmt}")
    panel = cut_lineage(inputs.weekly_panel(spark, sf_dir))
    forecasts = cut_lineage(inputs.baseline_forecasts(panel))
    for as_of in (AS_OF, LATER):
        src.ledger_append(forecasts, path, as_of, fmt)
    return comparable(src.read_ledger(spark, path, fmt).drop("_corrupt"))


def _run_log(panel: DataFrame) -> src.RunLog:
    """The ledger's history as twelve runs of a log that takes a snapshot every five."""
    log = src.RunLog(panel.sparkSession, run_dir(panel.sparkSession, "run-log"), snapshot_every=5)
    history = cut_lineage(inputs.ledger(panel).select(*LEDGER.names))
    part = F.month("generated_at")
    for month in range(1, 13):
        log.publish_rows({}, f"2001-{month:02d}-01", history.where(part == month))
    return log


def ledger_snapshot(panel: DataFrame) -> DataFrame:
    return _run_log(panel).latest_valid()


def ledger_errors(panel: DataFrame) -> DataFrame:
    return src.ledger_errors(inputs.ledger(panel).withColumn("_corrupt", F.lit(None).cast("string")))


def alerts(panel: DataFrame) -> DataFrame:
    return op.deviation_alerts(_accuracy(panel), inputs.baseline_forecasts(panel))


def gate(panel: DataFrame) -> DataFrame:
    return op.refresh_gate(panel, _latest(panel))


# --- outputs and the whole run -------------------------------------------------


def forecast_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "csv")
    panel = cut_lineage(inputs.weekly_panel(spark, sf_dir))
    src.forecast_csv(inputs.baseline_forecasts(panel), path)
    types = "series string, week_start date, predicted_ili double, ci_lower double, ci_upper double"
    return comparable(spark.read.schema(types).option("header", True).csv(path))


def summary(panel: DataFrame) -> DataFrame:
    return src.summary_lines(inputs.baseline_forecasts(panel), _newest_accuracy(panel), AS_OF)


def chart(panel: DataFrame) -> DataFrame:
    return src.chart_frame(panel, inputs.baseline_forecasts(panel), _newest_accuracy(panel))


def outputs(panel: DataFrame) -> DataFrame:
    return src.alert_outputs(_accuracy(panel))


def _run(
    spark: SparkSession,
    sf_dir: str,
    params: op.ModelParams,
    key: tuple[str, ...] = inputs.BY_SEGMENT,
    features: list[str] = FEATURES,
) -> WeeklyRun:
    panel = cut_lineage(inputs.weekly_panel(spark, sf_dir, key))
    path = run_dir(spark, "run")
    inputs.ledger(panel).write.partitionBy(WEEK_START).parquet(f"{path}/ledger")
    return weekly_run(
        panel, f"{path}/ledger", AS_OF, out_path=f"{path}/out", params=params, layout="series",
        features=features,
    )


def weekly_report(
    spark: SparkSession, sf_dir: str, key: tuple[str, ...] = inputs.BY_SEGMENT
) -> DataFrame:
    """What the run did with every series, and the new forecast where it made one."""
    run = _run(spark, sf_dir, TREES, key)
    return comparable(run["gate"].join(run["forecasts"], SERIES, "left"))


def _status(tables: dict[str, DataFrame]) -> DataFrame:
    """Gate, comparison and forecast of a run."""
    ahead = tables["forecasts"].select(
        SERIES, F.col(WEEK_START).alias("next_week"), "predicted_ili", "ci_lower", "ci_upper", "status"
    )
    prior = tables["accuracy"].select(
        SERIES, F.col(WEEK_START).alias("prior_week"), "actual_ili", "deviation_pct"
    )
    waiting = tables["standing"].select(SERIES, F.col(WEEK_START).alias("standing_week"))
    report = tables["gate"].join(ahead, SERIES, "left").join(prior, SERIES, "left")
    return comparable(report.join(waiting, SERIES, "left"))


def weekly_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run with the mean model."""
    return _status(_run(spark, sf_dir, MEAN_MODEL))


def weekly_run_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run with trees of one cut each."""
    return _status(_run(spark, sf_dir, STUMPS, features=STUMP_FEATURES))


def weekly_run_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run with the mean model, as its log gives it out."""
    panel = cut_lineage(inputs.weekly_panel(spark, sf_dir))
    log = _run_log(panel)
    weekly_run(panel, log, AS_OF, params=MEAN_MODEL, layout="series").remove()
    names = ("forecasts", "accuracy", "standing", "gate")
    return _status({name: log.output(name) for name in names})


QUERIES: dict[str, Query] = {
    "payload_rows": payload_rows,
    "payload_errors": payload_errors,
    "normalize_region": normalize_region,
    "normalize_region_trusted": normalize_region_trusted,
    "observations": observations,
    "observation_errors": observation_errors,
    "sound_observations": sound_observations("record"),
    "sound_observations_series": sound_observations("series"),
    "epiweek_to_date": epiweek_dates,
    "mmwr_week_start": mmwr_dates,
    "scope_filter": on_panel(scope),
    "coverage_stats": on_panel(src.coverage_stats),
    "lag_features": on_panel(lambda p: op.lag_features(p, layout="series")),
    "rolling_features": on_panel(lambda p: op.rolling_features(p, layout="series")),
    "seasonal_features": on_panel(op.seasonal_features),
    "seasonal_features_strict": on_panel(lambda p: op.seasonal_features(p, strict=True)),
    "trend_feature": on_panel(lambda p: op.trend_feature(p, layout="series")),
    "training_frame": on_panel(lambda p: op.training_frame(p, layout="series")),
    "training_frame_blocks": training_frame_blocks,
    "forecast_point_features": on_panel(op.forecast_point_features),
    "forecast_point_features_consistent": on_panel(
        lambda p: op.forecast_point_features(p, "consistent")
    ),
    "forecast_point_features_strict": on_panel(
        lambda p: op.forecast_point_features(p, "consistent", strict=True)
    ),
    "chronological_split": on_panel(split),
    "chronological_split_global": on_panel(lambda p: split(p, "global")),
    "chronological_split_blocks": split_blocks,
    "chronological_split_frame": split_frame("series"),
    "chronological_split_frame_blocks": split_frame("blocks"),
    "chronological_split_frame_auto": split_frame("auto"),
    "regression_metrics": on_panel(metrics),
    "fit_forecaster": fit_forecaster,
    "fit_forecaster_stumps": fit_forecaster_stumps,
    "fit_forecaster_leafwise": fit_leafwise,
    "fit_forecaster_per_series": fit_per_series,
    "score": score,
    "score_stumps": lambda spark, sf_dir: score(spark, sf_dir, STUMPS, STUMP_FEATURES),
    "score_compiled": score_compiled,
    "score_leafwise": lambda spark, sf_dir: score(spark, sf_dir, THREE_LEAVES, STUMP_FEATURES),
    "score_per_series": score_per_series,
    "backtest": backtest,
    "backtest_stumps": lambda spark, sf_dir: backtest(spark, sf_dir, STUMPS, STUMP_FEATURES),
    "backtest_mean_model": lambda spark, sf_dir: backtest(spark, sf_dir, MEAN_MODEL),
    "residual_interval": on_stored_panel(interval),
    "next_forecast": next_forecast,
    "next_forecast_stumps": lambda spark, sf_dir: next_forecast(
        spark, sf_dir, STUMPS, STUMP_FEATURES
    ),
    "next_forecast_leafwise": lambda spark, sf_dir: next_forecast(
        spark, sf_dir, THREE_LEAVES, STUMP_FEATURES
    ),
    "next_forecast_mean_model": lambda spark, sf_dir: next_forecast(spark, sf_dir, MEAN_MODEL),
    "next_forecast_missing": next_forecast_gappy("parity"),
    "next_forecast_missing_strict": next_forecast_gappy("strict"),
    "ledger_append": ledger_append,
    "ledger_append_json": lambda spark, sf_dir: ledger_append(spark, sf_dir, "json"),
    "ledger_latest_valid": on_panel(_latest),
    "ledger_snapshot": on_stored_panel(ledger_snapshot),
    "ledger_errors": on_stored_panel(ledger_errors),
    "forecast_actual_lookup": on_stored_panel(
        lambda p: op.forecast_actual_lookup(inputs.ledger(p), p)
    ),
    "forecast_accuracy": on_stored_panel(_accuracy),
    "deviation_alerts": on_stored_panel(alerts),
    "refresh_gate": on_stored_panel(gate),
    "forecast_csv": forecast_csv,
    "summary_lines": on_stored_panel(summary),
    "chart_frame": on_stored_panel(chart),
    "alert_outputs": on_stored_panel(outputs),
    "weekly_run": weekly_report,
    "weekly_run_status": weekly_run_status,
    "weekly_run_stumps": weekly_run_stumps,
    "weekly_run_published": weekly_run_published,
}
