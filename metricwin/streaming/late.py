"""Readings that come after the watermark: kept beside the others, and counted.

A stateful query drops them without a trace. Here each batch is parted before that: late is what
is not after the latest event time of the batches before, less the delay. Spark's operators judge
by the watermark of one batch earlier, so that none of them drops what was parted as on time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from metricwin.operators.ingest import READING_COLUMNS
from metricwin.schemas import LANDED
from metricwin.storage import make_dir, remove, scratch, written
from metricwin.streaming.batches import (
    last_batch,
    move_batch,
    move_batch_once,
    previous,
    read_batches,
    start_batches,
    write_batch,
)

SEEN = "latest timestamp, on_time long, late long, timeless long"
READING = T.StructType([LANDED[c] for c in READING_COLUMNS])
PARTED = T.StructType([*READING.fields, T.StructField("place", T.IntegerType())])


#: What a reading is for its batch, as the number of the folder that it is written to.
ON_TIME, LATE, TIMELESS = range(3)


def part_batches(folder: str, delay: str) -> Callable[[DataFrame, int], None]:
    """What ``start_parting`` does with a batch of readings; a repeated batch adds no row.

    Readings are written once, each to the part that it belongs to, and the parts are put in their
    places; they are counted from what was written.
    """

    def part(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            before = previous(spark, f"{folder}/seen", SEEN, batch_id)
            # One row, or none before the first batch.
            watermark = before.select(F.expr(f"latest - interval {delay}").alias("w")).first()
            time = F.col("event_time")
            after = F.lit(True) if watermark is None or watermark.w is None else time > F.lit(watermark.w)
            place = F.when(time.isNull(), TIMELESS).when(after, ON_TIME).otherwise(LATE)
            # Beside its places, to be moved there; an earlier try may have left something.
            parted = f"{folder}/parted"
            remove(spark, parted)
            rows = batch.select(*READING_COLUMNS).withColumn("place", place)
            rows.write.partitionBy("place").parquet(parted)
            readings = spark.read.schema(PARTED).parquet(parted)
            seen = readings.agg(
                F.max("event_time").alias("latest"),
                *[
                    F.count_if(F.col("place") == n).alias(name)
                    for name, n in (("on_time", ON_TIME), ("late", LATE), ("timeless", TIMELESS))
                ],
            )
            totals = before.unionByName(seen).agg(
                F.max("latest").alias("latest"),
                *[F.sum(c).alias(c) for c in ("on_time", "late", "timeless")],
            )
            staged = written(totals, "seen")
            move_batch_once(spark, f"{parted}/place={ON_TIME}", f"{folder}/on_time", batch_id)
            move_batch(spark, f"{parted}/place={LATE}", f"{folder}/late", batch_id)
            write_batch(staged, f"{folder}/seen", batch_id)
            remove(spark, parted)

    return part


def start_parting(
    readings: DataFrame, folder: str, delay: str = "1 minute", interval: str | None = None
) -> StreamingQuery:
    """Part a stream of readings into ``on_time`` and ``late`` below ``folder``, with running counts.

    Readings without a time are in neither and counted as ``timeless``.
    """
    for place in ("on_time", "late"):
        make_dir(readings.sparkSession, f"{folder}/{place}")
    return start_batches(readings, part_batches(folder, delay), folder, interval)


def stream_on_time(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The readings that came in time, as a stream for the jobs after.

    A batch is seen once and whole, also if it was run again. ``files_per_trigger`` may take its
    files apart; give it only if the files of a batch are in time order, or a reading can become late
    by another of its own batch.
    """
    make_dir(spark, f"{folder}/on_time")
    reader = spark.readStream.schema(T.StructType([*READING.fields, T.StructField("batch", T.LongType())]))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/on_time").select(*READING_COLUMNS)


def late_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The readings that came late, of finished batches."""
    last = last_batch(spark, f"{folder}/seen")
    late = read_batches(spark, f"{folder}/late", READING)
    return late.where(F.col("batch") <= last).drop("batch")


def arrival_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row: latest event time, readings on time, late, and without a time, since the first batch."""
    last = last_batch(spark, f"{folder}/seen")
    return read_batches(spark, f"{folder}/seen", SEEN).where(F.col("batch") == last).drop("batch")


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that a running query's own state operators have dropped as late, by its progress.

    Operators count what reaches them: one that groups before its state counts groups.
    """
    return sum(
        int(operator.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
