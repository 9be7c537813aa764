"""Messages spoilt by rule, to exercise the ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwin.specs import CPU_MEM, TOPIC_METRIC, TOPICS

# A message whose offset a number divides is spoilt in that number's way, see
# ``_dirty_message``; the first that divides wins.
RULES = (97, 89, 83, 79, 73, 71, 67)


def _rule() -> Column:
    choice = F.lit(0)
    for divisor in reversed(RULES):
        choice = F.when(F.col("offset") % divisor == 0, divisor).otherwise(choice)
    return choice


def _dirty_message(metric: str) -> Column:
    rule = F.col("rule")
    name, text = F.lit(f'"{metric}": '), F.col(metric).cast("string")
    time = F.when(rule != 71, F.concat(F.lit('"timestamp": "'), "ts", F.lit('"')))
    if metric in CPU_MEM.metrics:
        # These take ``ts`` before ``timestamp``.
        both = F.concat(F.lit('"ts": "'), "ts", F.lit('", "timestamp": "00:00:00"'))
        time = F.when(rule == 67, both).otherwise(time)
    server = F.when(rule != 89, F.concat(F.lit('"server_id": "'), "server_id", F.lit('"')))
    value = (
        F.when(rule == 83, F.concat(name, F.lit("null")))
        .when(rule == 73, F.concat(name, F.lit('"'), text, F.lit('"')))
        .when(rule != 79, F.concat(name, text))
    )
    message = F.concat(F.lit("{"), F.concat_ws(", ", time, server, value), F.lit("}"))
    return F.when(rule == 97, F.lit("not json")).otherwise(message)


def dirty_envelopes(wide: DataFrame, topics: Sequence[str] = TOPICS) -> DataFrame:
    """A message per wide reading and topic, some broken, incomplete, null or quoted."""
    messages = [
        F.struct(F.lit(topic).alias("topic"), _dirty_message(TOPIC_METRIC[topic]).alias("value"))
        for topic in topics
    ]
    spoilt = wide.withColumn("rule", _rule())
    return spoilt.select(F.inline(F.array(*messages)), "timestamp", "offset")
