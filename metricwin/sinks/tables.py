"""Writing readings, metric tables, messages and alerts."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from metricwin.functions.clock import on_day
from metricwin.schemas import ENVELOPE, METRIC_CSV_COLUMNS
from metricwin.storage import remove, replace_dir


def write_readings(readings: DataFrame, path: str, mode: str = "append") -> None:
    """Land readings as Parquet, one folder per metric, in a single pass."""
    readings.write.mode(mode).partitionBy("metric").parquet(path)


def write_bucketed(
    readings: DataFrame, table: str, buckets: int, time: str = "ts", path: str | None = None
) -> DataFrame:
    """Save readings as a table bucketed by server and time, and return it.

    Its rows are shuffled here once; every later match on server and ``time`` reads a bucket per
    task and shuffles nothing. Choose ``buckets`` for about 128 MB each.
    """
    spread = readings.repartition(buckets, "server_id", time)
    writer = spread.write.mode("overwrite").format("parquet")
    writer = writer.option("path", path) if path else writer
    writer.bucketBy(buckets, "server_id", time).sortBy("server_id", time).saveAsTable(table)
    return readings.sparkSession.table(table)


def write_metric_csv(readings: DataFrame, metric: str, path: str, mode: str = "append") -> None:
    """Write one metric's readings as headed CSV, in that table's column order."""
    table = readings.where(F.col("metric") == metric).withColumnRenamed("value", metric)
    table.select(*METRIC_CSV_COLUMNS[metric]).write.mode(mode).option("header", True).csv(path)


def publish_kafka(envelopes: DataFrame, servers: str) -> None:
    """Send messages to their topics; returns once all are acknowledged (untested, see README)."""
    envelopes.select("topic", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).save()


def stamped(envelopes: DataFrame, day: date | None = None, partition: int | None = None) -> DataFrame:
    """Messages as a broker would keep them: with record time, partition and offset.

    With ``day`` the record time is the message's own time on that day, else (or without a time)
    the time of publishing. Every call is a partition of its own unless one is given, so that
    offsets of several publishes into one folder are told apart.
    """
    if partition is None:
        partition = uuid.uuid4().int % (1 << 31)
    now = F.current_timestamp()
    if day is not None:
        # In a step of its own, a message is parsed once and not for each part of the time.
        envelopes = envelopes.withColumn("own_time", F.get_json_object("value", "$.timestamp"))
        now = F.coalesce(on_day(F.col("own_time"), day), now)
    return envelopes.select(
        "topic",
        "value",
        now.alias("timestamp"),
        F.lit(partition).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    )


def publish_files(envelopes: DataFrame, folder: str, mode: str = "append") -> None:
    """Keep messages as Parquet files with the columns of a topic."""
    envelopes.select(*ENVELOPE.names).write.mode(mode).parquet(folder)


def write_alerts(alerts: DataFrame, path: str, skip_empty: bool = False) -> bool:
    """Write sorted alerts as headed CSV and say whether anything was written.

    The parts are in order: part 0 holds the first rows. ``skip_empty`` leaves ``path`` as it was
    when there are no alerts: rows are counted while they are written beside it, once.
    """
    if not skip_empty:
        alerts.write.mode("overwrite").option("header", True).csv(path)
        return True
    spark, seen = alerts.sparkSession, Observation()
    beside = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}"
    counted = alerts.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("header", True).csv(beside)
    if not seen.get["rows"]:
        remove(spark, beside)
        return False
    replace_dir(spark, beside, path)
    return True


def read_alerts(spark, path: str, schema) -> DataFrame:
    """Read alerts back; an empty label comes out of CSV as null and is restored."""
    return spark.read.schema(schema).option("header", True).csv(path).fillna("", ["alert"])
