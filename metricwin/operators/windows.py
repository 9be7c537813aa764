"""Overlapping windows over matched readings: assignment, aggregation, leading clamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwin.specs import PairSpec


def slot(seconds: Column, spec: PairSpec) -> Column:
    """The slide boundary at or before a second (also below zero)."""
    return F.floor(seconds / spec.slide) * spec.slide


def window_starts(seconds: Column, spec: PairSpec) -> Column:
    """Array of the starts of all windows ``[start, start + size)`` a second lies in."""
    base = slot(seconds, spec)
    count = -(-spec.size // spec.slide)
    starts = F.array(*[base - k * spec.slide for k in reversed(range(count))])
    if spec.size % spec.slide == 0:
        return starts
    return F.filter(starts, lambda start: seconds < start + spec.size)


def explode_windows(timed: DataFrame, spec: PairSpec, seconds: str = "time_sec") -> DataFrame:
    """One row per row and window it lies in.

    A plain long as window key shuffles less than the struct of the built-in ``window``;
    the streaming job uses the latter, which carries the watermark.
    """
    return timed.withColumn(
        "window_start_sec", F.explode(window_starts(F.col(seconds), spec))
    ).where(F.col("window_start_sec").isNotNull())


def bounds(timed: DataFrame, spec: PairSpec) -> DataFrame:
    """One row: first and last matched second, first and last window start, windows expected."""
    ends = timed.agg(F.min("time_sec").alias("min_sec"), F.max("time_sec").alias("max_sec"))
    first, last = slot(F.col("min_sec"), spec), slot(F.col("max_sec"), spec)
    if spec.clamp == "raw":
        first = F.ceil(F.col("min_sec") / spec.slide) * spec.slide
    elif spec.clamp == "none":
        first = slot(F.col("min_sec") - spec.size, spec) + spec.slide
    return ends.select(
        "min_sec",
        "max_sec",
        first.alias("first_start"),
        last.alias("last_start"),
        ((last - first) / spec.slide + 1).cast("long").alias("expected_windows"),
    )


def bounded_windows(timed: DataFrame, spec: PairSpec) -> DataFrame:
    """Each matched row with the windows it lies in, from the first to the last of the data."""
    limits = bounds(timed, spec)
    first, last = (limits.select(c).scalar() for c in ("first_start", "last_start"))
    start = F.col("window_start_sec")
    return explode_windows(timed, spec).where(start.between(first, last)).withColumns(
        {"base_window": slot(F.col("time_sec"), spec), "window_end_sec": start + spec.size}
    )


def stat_columns(spec: PairSpec) -> list[Column]:
    """Aggregates that combine joined statistics; they may be applied level upon level."""
    if spec.statistic == "avg":
        names, combine = ("first_n", "first_sum", "second_n", "second_sum"), F.sum
    else:
        names, combine = ("first_max", "second_max"), F.max
    return [combine(n).alias(n) for n in names]


def result_columns(spec: PairSpec) -> list[Column]:
    """The two rounded aggregates out of combined statistics."""
    if spec.statistic == "avg":
        first = F.try_divide("first_sum", "first_n")
        second = F.try_divide("second_sum", "second_n")
    else:
        first, second = F.col("first_max"), F.col("second_max")
    return [
        F.round(first, spec.decimals).alias(spec.first_out),
        F.round(second, spec.decimals).alias(spec.second_out),
    ]


def window_stats(timed: DataFrame, spec: PairSpec) -> DataFrame:
    """Combined statistics per server and window, with the first second seen in each."""
    first_seen = F.min("time_sec").alias("time_sec")
    if spec.panes:
        timed = (
            timed.withColumn("pane", slot(F.col("time_sec"), spec))
            .groupBy("server_id", "pane")
            .agg(first_seen, *stat_columns(spec))
        )
    exploded = explode_windows(timed, spec, "pane" if spec.panes else "time_sec")
    return exploded.groupBy("server_id", "window_start_sec").agg(first_seen, *stat_columns(spec))


def clamp_windows(windows: DataFrame, spec: PairSpec) -> DataFrame:
    """Drop windows that start before the data does, over all servers together.

    The first second of the data is the least of the windows' first seconds, so it is found
    in the aggregated windows, not by another pass over the input. Taking the whole earliest
    row for it, and testing ``time_sec`` beside the start (no window's first second lies
    before the data's), makes both uses of the windows ask for the same columns: Spark then
    runs the shuffles below them once and reuses them.
    """
    if spec.clamp == "none":
        return windows
    rest = [c for c in windows.columns if c not in ("time_sec", "server_id", "window_start_sec")]
    earliest = windows.agg(F.min(F.struct("time_sec", *rest)).alias("earliest"))
    begin = earliest.select("earliest.time_sec").scalar()
    bound = begin if spec.clamp == "raw" else slot(begin, spec)
    before = F.greatest(bound - F.col("window_start_sec"), begin - F.col("time_sec"))
    return windows.where(before <= 0)
