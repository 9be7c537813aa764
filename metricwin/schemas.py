"""Explicit schemas; no reader in this package infers one."""

from pyspark.sql import types as T

# Column names and their order in the files.
WIDE_METRICS = ("cpu_pct", "mem_pct", "net_in", "net_out", "disk_io")
WIDE_COLUMNS = ("ts", "server_id", *WIDE_METRICS)

# Column order of the four metric CSV tables.
METRIC_CSV_COLUMNS = {
    "cpu_pct": ("ts", "server_id", "cpu_pct"),
    "mem_pct": ("ts", "server_id", "mem_pct"),
    "net_in": ("server_id", "ts", "net_in"),
    "disk_io": ("server_id", "ts", "disk_io"),
}

# A message as it lies in a topic.
ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# What tells two messages apart and in which order they are taken.
MESSAGE_ORDER = ("timestamp", "partition", "offset")

# A reading or a reject as an ingest run lands it.
LANDED = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("server_id", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("record_date", T.DateType()),
    ]
)

# A map keeps the difference between a missing field and a JSON null.
MESSAGE = T.MapType(T.StringType(), T.StringType())


def alert_schema(spec) -> T.StructType:
    return T.StructType(
        [
            T.StructField("server_id", T.StringType()),
            T.StructField("window_start", T.StringType()),
            T.StructField("window_end", T.StringType()),
            T.StructField(spec.first_out, T.DoubleType()),
            T.StructField(spec.second_out, T.DoubleType()),
            T.StructField("alert", T.StringType()),
        ]
    )
