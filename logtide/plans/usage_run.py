"""One whole run: choose dates, read, normalise, build features, fit, report, store."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.anomalies import SERVICE_MIN_ROWS, SERVICE_SCORED, service_anomalies_zscore, window_anomalies
from logtide.operators.clusters import (
    CLUSTER_COLUMNS,
    cluster_services,
    cluster_services_dbscan,
    is_fresh,
    score_stored,
    silhouette,
)
from logtide.operators.features import calendar_features, dense_grid, growth_rates, hourly_traffic, service_features
from logtide.operators.forecast import current_states, forecast
from logtide.operators.forest import fit_forest, service_anomalies_iforest, store_forest, stored_forest
from logtide.operators.normalize import dedupe, downsample, normalize_rows
from logtide.operators.report import assemble_report
from logtide.operators.scaling import standardize
from logtide.scratch import materialize, scratch_scope
from logtide.session import use_utc
from logtide.sinks.writers import write_report
from logtide.sources.access_logs import (
    choose_window,
    last_run_date,
    listed_files,
    record_run,
    scan_date_range,
    scan_table,
    skipped_files,
    table_files,
)
from logtide.sources.guarded import cached_result, guard_scan


@dataclass
class Settings:
    """Everything that can be tuned, with its default."""

    lookback_days: int = 30
    incremental: bool = True
    sample_rate: float = 1.0
    max_scan_mb: float = 1000
    algorithm: str = "kmeans"
    n_clusters: int = 8
    auto_k: bool = False
    dbscan_eps: float = 0.5
    dbscan_min_samples: int = 5
    horizon_hours: int = 24
    confidence_interval: float = 0.95
    forecast_top_n: int = 20
    contamination: float = 0.05
    anomaly_method: str = "isolation_forest"
    report_top_n: int = 20
    anomaly_score: float = 0.75
    growth_rate_pct: float = 50
    window_days: int = 7
    time_unit: str = "ns"
    dedupe_order: list[str] | None = None
    dedupe_keys: list[str] | None = None
    save_models_to: str | None = None
    retrain_interval_days: float = 7
    table_time: str = "timestamp"
    table_day: str = "dt"
    cache_dir: str | None = None
    copy_report_to: str | None = None
    tolerant_read: bool = False


@dataclass
class Analysis:
    """The tables of one run."""

    features: DataFrame
    series: DataFrame
    growth: DataFrame
    clustered: DataFrame
    states: DataFrame
    forecasts: DataFrame
    anomalies: DataFrame
    windows: DataFrame
    silhouette: DataFrame
    settings: Settings = field(default_factory=Settings)


def _clusters(features: DataFrame, s: Settings) -> DataFrame:
    if s.algorithm == "dbscan":
        return cluster_services_dbscan(features, s.dbscan_eps, s.dbscan_min_samples)
    stored = f"{s.save_models_to}/clusters" if s.save_models_to else None
    wanted = {"k": s.n_clusters, "auto_k": s.auto_k, "columns": [c for c in CLUSTER_COLUMNS if c in features.columns]}
    if stored and is_fresh(features.sparkSession, stored, s.retrain_interval_days, **wanted):
        return score_stored(features.sparkSession, features, stored)
    return cluster_services(features, s.n_clusters, auto_k=s.auto_k, save_to=stored)


def _forest(features: DataFrame, s: Settings) -> DataFrame | None:
    """The newest stored forest of the same columns and no older than the retraining interval, else a new one."""
    if not s.save_models_to or len(features.take(SERVICE_MIN_ROWS)) < SERVICE_MIN_ROWS:
        return None
    columns = [c for c in SERVICE_SCORED if c in features.columns]
    path = f"{s.save_models_to}/forest"
    return stored_forest(features.sparkSession, path, columns, s.retrain_interval_days) or store_forest(
        fit_forest(features, columns), columns, path
    )


def analyse(logs: DataFrame, settings: Settings | None = None) -> Analysis:
    """Features, series and models of stored, normalised logs."""
    s = settings or Settings()
    features = materialize(service_features(logs), "features")
    hourly = materialize(hourly_traffic(logs), "hourly")
    series = materialize(calendar_features(dense_grid(hourly)), "series")
    clustered = _clusters(features, s)
    kept = f"{s.save_models_to}/forecasts" if s.save_models_to else None
    states = current_states(series, kept, s.forecast_top_n, s.retrain_interval_days)
    if s.anomaly_method == "isolation_forest":
        anomalies = service_anomalies_iforest(features, s.contamination, forest=_forest(features, s))
    else:
        anomalies = service_anomalies_zscore(features)
    columns = [c for c in CLUSTER_COLUMNS if c in features.columns]
    clustered = materialize(clustered, "clustered")
    return Analysis(
        features=features,
        series=series,
        growth=growth_rates(hourly, s.window_days),
        clustered=clustered,
        silhouette=silhouette(standardize(clustered, columns), [f"z_{c}" for c in columns]),
        states=states,
        forecasts=materialize(forecast(states, s.horizon_hours, s.confidence_interval), "forecasts"),
        anomalies=materialize(anomalies, "anomalies"),
        windows=window_anomalies(series),
        settings=s,
    )


def report_of(result: Analysis, start: str, end: str) -> DataFrame:
    s = result.settings
    return assemble_report(
        result.clustered,
        result.forecasts,
        result.anomalies,
        result.windows,
        result.growth,
        result.series,
        start,
        end,
        s.report_top_n,
        s.anomaly_score,
        s.growth_rate_pct,
    )


def run(
    spark: SparkSession,
    state_path: str,
    report_folder: str,
    store: str | None = None,
    schema: T.StructType | None = None,
    table: str | None = None,
    settings: Settings | None = None,
    force_full_run: bool = False,
    today: date | None = None,
) -> dict:
    """Analyse a partitioned store or a catalog table and write the report.

    Which days are new only decides whether there is anything to do: features, growth and forecasts
    always cover the whole lookback window, since one day is too short for them. The run state advances
    only after the report is written.
    """
    s = settings or Settings()
    use_utc(spark)
    last = last_run_date(spark, state_path)
    new_from, end = choose_window(last, s.lookback_days, s.incremental, force_full_run, today)
    start, _ = choose_window(None, s.lookback_days, today=today)
    span = {"start": start, "end": end}

    def files(first: str) -> DataFrame | None:
        """What a read from ``first`` on opens, pruned like the read."""
        if table:
            listed = table_files(spark, table)
            return None if listed is None else listed.where(F.col(s.table_day).between(first, end))
        days = F.make_date("year", "month", "day").between(F.lit(first).cast("date"), F.lit(end).cast("date"))
        try:
            return listed_files(spark, store).where(days)
        except AnalysisException:
            return None  # no store yet

    def read(first: str) -> DataFrame:
        if table:
            return scan_table(spark, table, first, end, s.table_time, s.table_day)
        return scan_date_range(spark, store, first, end, schema, tolerant=s.tolerant_read)

    if read(new_from).isEmpty():
        return {"status": "no_new_data", "date_range": span}
    opened = files(start)
    if opened is not None:
        guard_scan(opened, s.max_scan_mb)
    raw = read(start)
    if table and s.cache_dir:
        raw = cached_result(raw, f"{table} {start} {end} {s.table_time}", opened, s.cache_dir)
    with scratch_scope(spark):
        watch = Observation("normalise")
        rows = materialize(normalize_rows(raw, s.time_unit, watch), "rows")
        seen = watch.get
        unique = materialize(dedupe(rows, s.dedupe_keys, s.dedupe_order), "unique")
        seen["duplicate_rows"] = rows.count() - unique.count()
        if s.tolerant_read and not table:
            seen["skipped_files"] = skipped_files(spark, store, schema).count()
        logs = materialize(downsample(unique, s.sample_rate), "logs") if s.sample_rate < 1 else unique
        if logs.isEmpty():
            return {"status": "empty_after_parsing", "date_range": span, "rows": seen}
        result = analyse(logs, s)
        path = write_report(report_of(result, start, end), report_folder, copy_to=s.copy_report_to)
        score = result.silhouette.first()[0]
    record_run(spark, state_path, end)
    return {"status": "done", "date_range": span, "report": path, "rows": seen, "silhouette": score}
