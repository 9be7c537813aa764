"""Messages kept in a folder as a broker keeps them: gapless offsets per topic, stable over retries.

A publish has a name. Its messages are staged once with record time and place; per topic the places
are counted by partition, and a prefix sum over the counts, after what earlier publishes hold,
gives the offsets. Staging and ledger are kept, so that a publish that is run again after a failure
finds them and gives the same messages the same offsets. One publisher at a time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricwin.functions.clock import on_day
from metricwin.schemas import ENVELOPE
from metricwin.storage import exists, make_dir

STAGED = "topic string, value string, timestamp timestamp, part int, place long"
LEDGER = "topic string, first long, n long"


def _stage(envelopes: DataFrame, path: str, day: date | None) -> DataFrame:
    spark = envelopes.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        time = F.current_timestamp()
        if day is not None:
            # In a step of its own, a message is parsed once and not for each part of the time.
            envelopes = envelopes.withColumn("own_time", F.get_json_object("value", "$.timestamp"))
            time = F.coalesce(on_day(F.col("own_time"), day), time)
        staged = envelopes.select(
            "topic",
            "value",
            time.alias("timestamp"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
        )
        staged.write.mode("overwrite").parquet(path)
    return spark.read.schema(STAGED).parquet(path)


def _ledger(envelopes: DataFrame, staged: DataFrame, base: str, name: str) -> DataFrame:
    """Where this publish begins in each topic: after all publishes of other names in the ledger."""
    spark, path = envelopes.sparkSession, f"{base}/ledger/publish={name}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make_dir(spark, f"{base}/ledger")
        schema = f"{LEDGER}, publish string"
        held = spark.read.schema(schema).parquet(f"{base}/ledger").where(F.col("publish") != name)
        # A row per publish and topic.
        ends = held.groupBy("topic").agg(F.sum("n").alias("held"))
        own = staged.groupBy("topic").agg(F.count("*").alias("n"))
        begins = own.join(ends, "topic", "left")
        begins.select("topic", F.coalesce("held", F.lit(0)).alias("first"), "n").coalesce(1).write.mode(
            "overwrite"
        ).parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def publish_log(
    envelopes: DataFrame, folder: str, name: str, day: date | None = None, partition: int = 0
) -> None:
    """Append messages (``topic, value``) to the topics kept in ``folder``; once for each ``name``.

    Offsets of a topic run from 0 without gaps over all publishes. With ``day`` the record time is
    the message's own time on that day, else the time of staging. A repeated name changes nothing.
    """
    base = f"{folder}/_log"
    staged = _stage(envelopes, f"{base}/staged/{name}", day)
    begins = _ledger(envelopes, staged, base, name)
    spark, target = envelopes.sparkSession, f"{folder}/publish={name}"
    if exists(spark, f"{target}/_SUCCESS"):
        return
    counts = staged.groupBy("topic", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("topic").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "topic", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    # A task sorts what one task staged of a topic.
    nth = F.row_number().over(Window.partitionBy("topic", "part").orderBy("place")) - 1
    placed = (
        staged.withColumn("nth", nth)
        .join(before, ["topic", "part"])
        .join(begins.select("topic", "first"), "topic")
    )
    placed.select(
        "topic",
        "value",
        "timestamp",
        F.lit(partition).alias("partition"),
        (F.col("first") + F.col("before") + F.col("nth")).alias("offset"),
    ).select(*ENVELOPE.names).write.mode("overwrite").parquet(target)
