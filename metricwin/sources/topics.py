"""Messages out of topics, as batch or stream: ``topic, value, timestamp, partition, offset``.

The Kafka forms need Spark's Kafka connector on the class path and a broker; neither was
at hand when this was written, so they are untested. The file forms carry the same columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from metricwin.schemas import ENVELOPE


def _columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(*ENVELOPE.names[:1], "cast(value as string) as value", *ENVELOPE.names[2:])


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Subscribe to several topics, from the earliest message unless a checkpoint says else.

    ``min_partitions`` splits a topic partition among several tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return _columns(reader.load())


def kafka_batch(spark: SparkSession, servers: str, topics: Sequence[str]) -> DataFrame:
    """Everything the topics hold now, from the first message."""
    return _columns(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def file_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages kept as Parquet files in a folder."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).select(*ENVELOPE.names)


def file_batch(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(folder).select(*ENVELOPE.names)
