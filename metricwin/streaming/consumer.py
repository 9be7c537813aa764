"""A consumer that keeps several things in step in one pass over the messages.

Each batch is parsed once and gives rows to the four metric CSV tables, to the report of every
n-th message and to the running totals, which outlive restarts. The totals are written last: a
batch counts once they are there, and readers take only batches that count.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from metricwin.functions.fields import number
from metricwin.operators import ingest
from metricwin.schemas import LANDED, METRIC_CSV_COLUMNS
from metricwin.storage import kept, scratch
from metricwin.streaming.batches import (
    last_batch,
    previous,
    read_batches,
    start_batches,
    write_batch,
)

TOTALS = "kind string, messages long, rejected long, unknown_server long"
REPORT = T.StructType(
    [*[LANDED[c] for c in ingest.READING_COLUMNS], T.StructField("ordinal", T.LongType())]
)


def _csv_table(readings: DataFrame, metric: str) -> DataFrame:
    mine = readings.where(F.col("metric") == metric).withColumnRenamed("value", metric)
    return mine.select(*METRIC_CSV_COLUMNS[metric])


def consume_batches(
    folder: str, n: int = 10, strict: bool = False, day: date | None = None
) -> Callable[[DataFrame, int], None]:
    """What ``start_consumer`` does with a batch of messages; a repeated batch adds no row."""

    def consume(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = ingest.parse_envelopes(batch, strict, day=day)
        # Nothing that is made of a batch holds the messages themselves.
        parsed = parsed.select(*ingest.READING_COLUMNS, "reason")
        with scratch(spark), kept(parsed, "consumed") as parsed:
            readings = ingest.accepted(parsed)
            for metric in METRIC_CSV_COLUMNS:
                table = _csv_table(readings, metric)
                write_batch(table, f"{folder}/csv/{metric}", batch_id, "csv", header=True)
            before = previous(spark, f"{folder}/totals", TOTALS, batch_id)
            # A row per kind: what was taken before shifts the ordinals of this batch.
            taken = before.select(F.col("kind").alias("of_kind"), F.col("messages").alias("taken"))
            counted = ingest.numbered(readings).join(taken, F.col("kind") == F.col("of_kind"), "left")
            counted = counted.withColumn("ordinal", F.col("ordinal") + F.coalesce("taken", F.lit(0)))
            report = counted.where(F.col("ordinal") % n == 0).select(*REPORT.names)
            write_batch(report, f"{folder}/every_nth", batch_id)
            totals = before.unionByName(ingest.message_counts(parsed)).groupBy("kind")
            totals = totals.agg(*[F.sum(c).alias(c) for c in ("messages", "rejected", "unknown_server")])
            write_batch(totals.coalesce(1), f"{folder}/totals", batch_id)

    return consume


def start_consumer(
    messages: DataFrame,
    folder: str,
    interval: str | None = None,
    n: int = 10,
    strict: bool = False,
    day: date | None = None,
) -> StreamingQuery:
    """Consume messages into the four CSV tables, the report and the totals below ``folder``.

    Started again on the same folder it goes on where it was: ordinals and totals continue. Within
    a batch messages are taken in the order of ``ingest.numbered``.
    """
    return start_batches(messages, consume_batches(folder, n, strict, day), folder, interval)


def _counting(spark: SparkSession, folder: str, df: DataFrame) -> DataFrame:
    return df.where(F.col("batch") <= last_batch(spark, f"{folder}/totals")).drop("batch")


def consumed_csv(spark: SparkSession, folder: str, metric: str, value_type: str = "double") -> DataFrame:
    """One of the CSV tables: ``server_id``, ``ts`` and the metric."""
    schema = ", ".join(f"{c} string" for c in METRIC_CSV_COLUMNS[metric])
    # Only with a null value that no cell holds is a quoted empty text read as empty, not as null.
    place = f"{folder}/csv/{metric}"
    table = read_batches(spark, place, schema, "csv", header=True, nullValue="\x00")
    table = table.select("server_id", "ts", number(F.col(metric), value_type).alias(metric), "batch")
    return _counting(spark, folder, table)


def consumed_every_nth(spark: SparkSession, folder: str) -> DataFrame:
    """Every n-th reading of each kind since the first batch, with its ordinal."""
    return _counting(spark, folder, read_batches(spark, f"{folder}/every_nth", REPORT))


def consumed_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per kind and over all since the first batch; no rows before it."""
    last = last_batch(spark, f"{folder}/totals")
    return read_batches(spark, f"{folder}/totals", TOTALS).where(F.col("batch") == last).drop("batch")
