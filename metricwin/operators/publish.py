"""Wide readings to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwin.schemas import MESSAGE_ORDER

# The metrics each topic's message carries.
TOPIC_FIELDS = {
    "topic-cpu": ("cpu_pct",),
    "topic-mem": ("mem_pct",),
    "topic-net": ("net_in", "net_out"),
    "topic-disk": ("disk_io",),
}


def _message(topic: str, fields: tuple[str, ...]) -> Column:
    body = F.struct(F.col("ts").alias("timestamp"), "server_id", *fields)
    return F.struct(
        F.lit(topic).alias("topic"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def envelopes(wide: DataFrame) -> DataFrame:
    """Four JSON messages per wide reading, made in one pass without a shuffle.

    Record time, partition and offset are carried along if the input has them.
    """
    carried = [c for c in MESSAGE_ORDER if c in wide.columns]
    messages = F.array(*[_message(t, f) for t, f in TOPIC_FIELDS.items()])
    return wide.select(F.inline(messages), *carried)
