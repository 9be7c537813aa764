"""Runs of the alerting jobs with output files and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metricwin.operators import windows
from metricwin.operators.pairing import readings_from_tables
from metricwin.plans import alerts
from metricwin.sinks.tables import write_alerts
from metricwin.sources.csv_tables import read_metric_csv
from metricwin.specs import PairSpec
from metricwin.storage import kept


def csv_readings(spark: SparkSession, first_csv: str, second_csv: str, spec: PairSpec) -> DataFrame:
    """Readings of a pair out of its two metric CSV tables."""
    tables = {
        metric: read_metric_csv(spark, path, metric, spec.value_type)
        for metric, path in zip(spec.metrics, (first_csv, second_csv), strict=True)
    }
    return readings_from_tables(tables, spec)


def run_alert_job(
    readings: DataFrame,
    spec: PairSpec,
    path: str,
    skip_empty: bool = True,
    report: bool = False,
) -> bool:
    """Write a pair's sorted alerts to ``path``; with ``report`` also print checks and samples.

    With a report the input is matched once; the matched rows and the windows are kept in the
    shared folder while the checks and the writer read them, and removed at the end.
    """
    timed = alerts.timed_pairs(readings, spec)
    if not report:
        ordered = alerts.labelled(alerts.windowed_pairs(timed, spec), spec)
        return write_alerts(ordered.orderBy("server_id", "window_start"), path, skip_empty)
    with (
        kept(timed, "pairs") as timed,
        kept(alerts.windowed_pairs(timed, spec), "windows") as results,
    ):
        limits = windows.bounds(timed, spec)
        alerts.validation_summary(results, limits).show(truncate=False)
        labelled = alerts.labelled(results, spec)
        alerts.first_rows(labelled).show(truncate=False)
        alerts.last_rows(labelled).show(truncate=False)
        return write_alerts(labelled.orderBy("server_id", "window_start"), path, skip_empty)
