"""Wide readings derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def stream_events(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The table as a stream, be it one file or a folder of files.

    Without ``files_per_trigger`` all files present make one batch; in smaller batches,
    files that are not in time order have late readings.
    """
    reader = spark.readStream.schema(EVENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A pattern, since a stream refuses the plain path of a single file.
    return reader.parquet(f"{folder}/events*.parquet")


def wide_readings(events: DataFrame, dealt: bool = False) -> DataFrame:
    """One wide reading per event, with its record time and offset beside it.

    ``dealt``: over all tasks, see ``spread``, and before anything is made of the events.
    """
    k = F.get_json_object("props", "$.k").cast("double")
    events = events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("offset"),
        "user_id",
        "value",
        "props",
    )
    events = spread(events) if dealt else events
    return events.select(
        F.date_format("timestamp", "HH:mm:ss").alias("ts"),
        F.concat(F.lit("srv_"), (F.col("user_id") % 8).cast("string")).alias("server_id"),
        F.least("value", F.lit(100.0)).alias("cpu_pct"),
        k.alias("mem_pct"),
        (F.col("value") * 40).alias("net_in"),
        (F.col("value") * 20).alias("net_out"),
        (k * 30).alias("disk_io"),
        "timestamp",
        "offset",
    )


def spread(wide: DataFrame) -> DataFrame:
    """The same rows dealt over all tasks, for costly steps after a table of few files or row groups.

    A scan has no more tasks with rows than the table has row groups, and files written from it keep
    that number for those who read them. The number of tasks is given: by itself adaptive execution
    would choose it by the size of the rows dealt, not by the work after it, and leave a few tasks
    more than there are cores, the last of them alone.
    """
    tasks = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wide.repartition(tasks, "offset", "timestamp")
