"""Matching the readings of two metrics on server and time.

The match is an inner equi-join in which k copies of a reading on one side and m on the
other give k * m rows. Nothing downstream needs those rows one by one: a mean over them is
a mean weighted by the other side's copies, and a maximum does not see copies at all. So
each (server, time) is reduced to one row holding both sides' counts and sums or maxima.
Copies are combined before the shuffle, and the cost is linear in the input whatever the
multiplicities are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwin.functions.clock import seconds_of_day
from metricwin.specs import PairSpec
from metricwin.storage import written


def readings_of(wide: DataFrame, spec: PairSpec) -> DataFrame:
    """The two metrics of wide readings as one long table, in a single scan."""
    sides = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in spec.metrics]
    return wide.select(*spec.carried, F.inline(F.array(*sides)))


def readings_from_tables(tables: dict[str, DataFrame], spec: PairSpec) -> DataFrame:
    """Two metric tables (``server_id``, time, metric) as one long table."""
    parts = [
        tables[m].select(*spec.carried, F.lit(m).alias("metric"), F.col(m).alias("value"))
        for m in spec.metrics
    ]
    return reduce(DataFrame.unionByName, parts)


def _value(spec: PairSpec) -> Column:
    value = F.col("value").cast(spec.value_type).cast("double")
    return F.when(~F.isnan(value), value) if spec.drop_nan else value


def _side_stats(side: str, metric: str, spec: PairSpec) -> list[Column]:
    """One side's aggregates; all buffers are fixed-width, so hashing needs no sort."""
    mine, value = F.col("metric") == metric, _value(spec)
    if spec.dedup_by:
        rows = F.max(F.when(mine, 1).otherwise(0))
        # Rows of the other side have a null order and are passed over.
        names = spec.dedup_order
        order = F.col(names[0]) if len(names) == 1 else F.struct(*names)
        earliest = F.min_by(F.when(mine, value), F.when(mine, order))
        count, total, largest = earliest.isNotNull().cast("long"), earliest, earliest
    else:
        rows = F.count(F.when(mine, 1))
        mine_value = F.when(mine, value)
        count, total, largest = F.count(mine_value), F.sum(mine_value), F.max(mine_value)
    named = [rows.cast("long").alias(f"{side}_rows")]
    if spec.statistic == "avg":
        return [*named, count.alias(f"{side}_n"), total.alias(f"{side}_sum")]
    return [*named, largest.alias(f"{side}_max")]


def pair_readings(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """One row per (server, time) found on both sides, for batch and streams.

    Columns: the two keys, ``first_rows`` and ``second_rows`` (copies on each side), and per
    side ``_n`` and ``_sum`` (values that are not null) or ``_max``.
    Servers or times that are null or empty match nothing.
    """
    filled = F.col(spec.key).isNotNull()
    if spec.clock == "time_of_day":
        filled = F.col(spec.key) != ""
    return (
        readings.where(F.col("metric").isin(*spec.metrics))
        .where((F.col("server_id") != "") & filled)
        .groupBy("server_id", spec.key)
        .agg(*_side_stats("first", spec.first, spec), *_side_stats("second", spec.second, spec))
        .where((F.col("first_rows") > 0) & (F.col("second_rows") > 0))
    )


def matched_readings(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """Each matched reading once, with the number of joined rows it would be in.

    The row-by-row join of k and m copies has k * m rows; its readings and their weights are k + m.
    The two metrics' columns are written once, so that the input is read and parsed once.
    """
    sides = readings.where(F.col("metric").isin(*spec.metrics))
    sides = written(sides.select(*spec.carried, "metric", "value"), "sides")
    pairs = pair_readings(sides, spec).select("server_id", spec.key, "first_rows", "second_rows")
    others = F.when(F.col("metric") == spec.first, F.col("second_rows")).otherwise(F.col("first_rows"))
    return sides.join(pairs, ["server_id", spec.key]).select(
        "server_id", spec.key, "metric", _value(spec).alias("value"), others.alias("weight")
    )


def joined_readings(readings: DataFrame, spec: PairSpec) -> DataFrame:
    """The inner join itself, a row per pair of readings: k * m rows for k and m copies.

    For those who need the rows; the jobs here take ``pair_readings``, which grows with the input.
    """
    filled = (F.col("server_id") != "") & (F.col(spec.key).cast("string") != "")

    def side(metric: str) -> DataFrame:
        mine = readings.where((F.col("metric") == metric) & filled)
        return mine.select("server_id", spec.key, _value(spec).alias(metric))

    return side(spec.first).join(side(spec.second), ["server_id", spec.key])


def joined_stats(pairs: DataFrame, spec: PairSpec) -> DataFrame:
    """What the joined rows of each (server, time) add up to.

    Counts become doubles here: a product of two large counts outgrows a long.
    """
    ours, theirs = F.col("first_rows").cast("double"), F.col("second_rows").cast("double")
    if spec.statistic == "avg":
        stats = [
            (F.col("first_n") * theirs).alias("first_n"),
            (F.col("first_sum") * theirs).alias("first_sum"),
            (F.col("second_n") * ours).alias("second_n"),
            (F.col("second_sum") * ours).alias("second_sum"),
        ]
    else:
        stats = [F.col("first_max"), F.col("second_max")]
    return pairs.select("server_id", spec.key, (ours * theirs).alias("joined_rows"), *stats)


def with_seconds(joined: DataFrame, spec: PairSpec) -> DataFrame:
    """Add ``time_sec``, whole seconds on the pair's clock, null where there is no time.

    Such rows go when windows are built. A filter here would be moved below the match and
    run the text pattern on every reading instead of once per matched key.
    """
    key = F.col(spec.key)
    seconds = seconds_of_day(key) if spec.clock == "time_of_day" else F.unix_seconds(key)
    return joined.withColumn("time_sec", seconds)
