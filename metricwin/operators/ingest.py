"""Messages to readings: parse, default, reject, route, count, thin out, de-duplicate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwin.functions.clock import clock_text, nearest_event_time, on_day
from metricwin.functions.fields import (
    field_or,
    first_filled,
    is_boolean,
    last_of_repeated,
    number,
)
from metricwin.schemas import MESSAGE, MESSAGE_ORDER
from metricwin.specs import (
    CPU_MEM_TOPICS,
    MISSING_VALUE,
    TOPIC_KIND,
    TOPIC_METRIC,
    TOPICS,
    UNKNOWN_SERVER,
)
from metricwin.storage import written

#: Name of the field put after a message; no message is expected to hold it.
AFTER = "after message"
READING_COLUMNS = ("metric", "kind", "server_id", "ts", "event_time", "value", *MESSAGE_ORDER)
REJECT_COLUMNS = ("metric", "kind", "message", "reason", *MESSAGE_ORDER)


def _by_topic(names: dict[str, str]) -> Column:
    choice = F.lit(None).cast("string")
    for topic, name in names.items():
        choice = F.when(F.col("topic") == topic, F.lit(name)).otherwise(choice)
    return choice


def parse_envelopes(
    messages: DataFrame,
    strict: bool = False,
    topics: Sequence[str] = TOPICS,
    day: date | None = None,
) -> DataFrame:
    """Read the topics' messages; ``reason`` says why one is rejected, null for a reading.

    Defaults: a missing server is ``unknown``, a missing metric 0.0. CPU and MEM take
    ``ts`` or else ``timestamp`` and fall back to the record's own time; NET and DISK take
    ``timestamp`` only, empty if missing. A metric that is null or no number stays null
    in CPU and MEM and rejects the message in NET and DISK, where ``true`` and ``false`` are 1 and
    0. Of repeated fields the last counts. Text that is no JSON object, or
    has anything after it, is rejected, or fails the job if ``strict``. Other topics are left out
    before parsing.

    A time of day gets the date of ``day``, or else the date that brings it nearest to the record
    time, which is right only for readings recorded within twelve hours. Messages without a
    partition are of partition 0.
    """
    if "partition" not in messages.columns:
        messages = messages.withColumn("partition", F.lit(0))
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE", "allowSingleQuotes": "false"}
    # The message stands as a field before another: text after its object breaks the whole or
    # hides the field behind it, where the parser by itself would stop reading.
    whole = F.concat(F.lit('{"message":'), "value", F.lit(f',"{AFTER}":0}}'))
    read = F.from_json(whole, f"message {MESSAGE.simpleString()}, `{AFTER}` int", options)
    # Exploding an array of one keeps the parse in a step of its own: a filter on its result
    # would otherwise be moved below it and parse each message again per condition. The steps after
    # it are small for a like reason: Java leaves long generated methods uncompiled.
    parsed = messages.where(F.col("topic").isin(*topics)).select(
        "topic",
        *MESSAGE_ORDER,
        F.col("value").alias("message"),
        F.explode(F.array(read)).alias("read"),
    )
    parsed = parsed.select(
        "topic",
        _by_topic(TOPIC_METRIC).alias("metric"),
        _by_topic(TOPIC_KIND).alias("kind"),
        *MESSAGE_ORDER,
        "message",
        F.when(F.col("read")[AFTER] == 0, last_of_repeated(F.col("read")["message"])).alias("fields"),
    )
    f = F.col("fields")
    lenient = F.col("topic").isin(*CPU_MEM_TOPICS)
    ts = F.when(
        lenient,
        F.coalesce(
            first_filled(f, "ts", "timestamp"), clock_text(F.unix_seconds(F.col("timestamp")))
        ),
    ).otherwise(field_or(f, F.lit("timestamp"), F.lit("")))
    read = parsed.select(
        "topic",
        "metric",
        "kind",
        *MESSAGE_ORDER,
        "message",
        F.nullif(field_or(f, F.lit("server_id"), F.lit(UNKNOWN_SERVER)), F.lit("")).alias("server_id"),
        ts.alias("ts"),
        field_or(f, F.col("metric"), F.lit(str(MISSING_VALUE))).alias("text"),
        f.isNull().alias("malformed"),
    )
    text = F.col("text")
    # Only a metric whose text is such a word is parsed with its type.
    flag = F.lit(False)
    for topic in topics:
        if topic not in CPU_MEM_TOPICS and topic in TOPIC_METRIC:
            own = is_boolean(F.col("message"), TOPIC_METRIC[topic])
            flag = F.when(F.col("topic") == topic, own).otherwise(flag)
    one = F.when(text == "true", F.lit("1")).otherwise(F.lit("0"))
    text = F.when(text.isin("true", "false") & ~lenient, F.when(flag, one)).otherwise(text)
    read = read.withColumn("text", text)
    # As above: a filter on the number stays above the step that reads it.
    read = read.select(
        "topic",
        "metric",
        "kind",
        *MESSAGE_ORDER,
        "message",
        "server_id",
        "ts",
        "malformed",
        F.explode(F.array(number(F.col("text")))).alias("number"),
    )
    if day is None:
        event_time = nearest_event_time(F.col("ts"), F.col("timestamp"))
    else:
        event_time = on_day(F.col("ts"), day)
    reason = F.when(F.col("malformed"), F.lit("malformed")).when(
        ~lenient & F.col("number").isNull(), F.lit("bad_value")
    )
    return read.select(
        "topic",
        "metric",
        "kind",
        "server_id",
        "ts",
        event_time.alias("event_time"),
        F.col("number").alias("value"),
        *MESSAGE_ORDER,
        "message",
        reason.alias("reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select(*READING_COLUMNS)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("topic", *REJECT_COLUMNS)


def metric_table(readings: DataFrame, metric: str, value_type: str = "double") -> DataFrame:
    """The readings of one metric, its value in a column named after it."""
    return readings.where(F.col("metric") == metric).select(
        "server_id", "ts", F.col("value").cast(value_type).alias(metric)
    )


def message_counts(parsed: DataFrame) -> DataFrame:
    """Per kind and in total: messages taken, messages rejected, readings of no known server."""
    ok = F.col("reason").isNull()
    return (
        parsed.rollup("kind")
        .agg(
            F.count_if(ok).alias("messages"),
            F.count_if(~ok).alias("rejected"),
            F.count_if(ok & (F.col("server_id") == UNKNOWN_SERVER)).alias("unknown_server"),
        )
        .withColumn("kind", F.coalesce("kind", F.lit("total")))
    )


def numbered(readings: DataFrame, span: int = 1 << 20) -> DataFrame:
    """``readings`` with ``ordinal``, from 1 for each kind.

    Readings are taken by the minute of their record time, then partition, then offset, whatever
    order the input is in. They are counted within runs of ``span`` offsets, each sorted by a task
    of its own, and shifted by the readings in the runs before; only one count per run and day is
    brought together, so no task sees a whole topic. The numbered readings are written to the
    shared folder: the input is read and parsed once, and runs are counted from what was written.
    """
    run = ["kind", "minute", "partition", "run"]
    runs = readings.withColumns(
        {
            "minute": F.date_trunc("minute", F.col("timestamp")),
            "run": F.floor(F.col("offset") / span),
        }
    )
    place = F.row_number().over(Window.partitionBy(*run).orderBy("offset", "timestamp"))
    placed = written(runs.withColumn("place", place), "numbered")
    counts = placed.groupBy(*run).agg(F.max("place").alias("n"))
    counts = counts.withColumn("day", F.to_date("minute"))
    of_day = Window.partitionBy("kind", "day").orderBy("minute", "partition", "run")
    counts = counts.withColumn("upto", F.sum("n").over(of_day))
    last_of_day = counts.groupBy("kind", "day").agg(F.max("upto").alias("of_day"))
    earlier = Window.partitionBy("kind").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = last_of_day.select(
        "kind", "day", F.coalesce(F.sum("of_day").over(earlier), F.lit(0)).alias("days_before")
    )
    before = counts.join(
        days.select("days_before", F.col("kind").alias("kind_"), F.col("day").alias("day_")),
        F.col("kind").eqNullSafe(F.col("kind_")) & F.col("day").eqNullSafe(F.col("day_")),
    ).select(
        *[F.col(c).alias(f"of_{c}") for c in run],
        (F.col("days_before") + F.col("upto") - F.col("n")).alias("before"),
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in run])
    ordinal = (F.col("before") + F.col("place")).alias("ordinal")
    return placed.join(before, same).select(*readings.columns, ordinal)


def every_nth(readings: DataFrame, n: int = 10, span: int = 1 << 20) -> DataFrame:
    """Every ``n``-th reading of each kind, with its ordinal; see ``numbered``."""
    return numbered(readings, span).where(F.col("ordinal") % n == 0)


#: What a copy has in common with its original, wherever and whenever it is delivered.
COPY_OF = ("metric", "kind", "server_id", "event_time", "value")


def told_apart() -> Column:
    """The message's own place, for readings of no known server or time, which have no copies."""
    server = F.coalesce(F.col("server_id"), F.lit(""))
    nowhere = server.isin("", UNKNOWN_SERVER) | F.col("event_time").isNull()
    return F.when(nowhere, F.struct(*MESSAGE_ORDER))


def dedup(readings: DataFrame) -> DataFrame:
    """Keep the earliest message of each reading: metric, server, dated time and value.

    Readings of an unknown server or without a time are no copies of each other and all stay; of
    them only the same message delivered twice is dropped. Two readings of one server, second and
    value cannot be told from copies. An aggregate, not a window: copies go before the shuffle.
    """
    rest = [c for c in readings.columns if c not in (*COPY_OF, *MESSAGE_ORDER)]
    first = F.min(F.struct(*MESSAGE_ORDER, *rest)).alias("first")
    kept = readings.groupBy(*COPY_OF, told_apart().alias("apart")).agg(first)
    return kept.select(*[c if c in COPY_OF else F.col(f"first.{c}") for c in readings.columns])
