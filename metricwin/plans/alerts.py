"""The alerting jobs, from readings to labelled windows, and reports on their result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwin.functions.clock import clock_text, date_clock_text
from metricwin.functions.labels import alert_label
from metricwin.operators import pairing, windows
from metricwin.specs import PairSpec


def timed_pairs(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """Matched readings with their joined statistics and second."""
    pairs = pairing.pair_readings(readings, spec)
    return pairing.with_seconds(pairing.joined_stats(pairs, spec), spec)


def kept_windows(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """Only which windows there are, without their aggregates."""
    stats = windows.window_stats(timed_pairs(readings, spec), spec)
    return windows.clamp_windows(stats.select("server_id", "window_start_sec", "time_sec"), spec)


def windowed(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """Rounded aggregates per server and kept window."""
    return windowed_pairs(timed_pairs(readings, spec), spec)


def windowed_pairs(timed: DataFrame, spec: PairSpec) -> DataFrame:
    """``windowed`` of readings that are matched already."""
    stats = windows.window_stats(timed, spec)
    return windows.clamp_windows(stats, spec).select(
        "server_id",
        "window_start_sec",
        (F.col("window_start_sec") + spec.size).alias("window_end_sec"),
        *windows.result_columns(spec),
    )


def labelled(results: DataFrame, spec: PairSpec) -> DataFrame:
    """Format the window bounds and add the alert label; the six output columns."""
    text = clock_text if spec.clock == "time_of_day" else date_clock_text
    return results.select(
        "server_id",
        text(F.col("window_start_sec")).alias("window_start"),
        text(F.col("window_end_sec")).alias("window_end"),
        spec.first_out,
        spec.second_out,
        alert_label(spec, F.col(spec.first_out), F.col(spec.second_out)).alias("alert"),
    )


def alerts(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """The whole job, unsorted."""
    return labelled(windowed(readings, spec), spec)


def sorted_alerts(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """The whole job, sorted by server, then window start, both as text."""
    return alerts(readings, spec).orderBy("server_id", "window_start")


def first_rows(result: DataFrame, n: int = 20) -> DataFrame:
    return result.orderBy("server_id", "window_start").limit(n)


def last_rows(result: DataFrame, n: int = 20) -> DataFrame:
    """Latest window first, servers in order within a window."""
    return result.orderBy(F.col("window_start").desc(), "server_id").limit(n)


def validation_summary(kept: DataFrame, limits: DataFrame) -> DataFrame:
    """One row of checks on kept windows or windowed results, in a single aggregate.

    ``limits`` is ``windows.bounds`` of the matched readings: how many windows there are from the
    first to the last is a matter of the data's own bounds, as a window may hold no reading.
    """
    expected = limits.select("expected_windows").scalar()
    return kept.agg(
        F.count("*").alias("total_rows"),
        (F.count("*") + 1).alias("rows_with_header"),
        F.count_distinct("window_start_sec").alias("unique_windows"),
        F.count_distinct("server_id").alias("unique_servers"),
    ).withColumn("expected_windows", F.coalesce(expected, F.lit(0)).cast("long"))
