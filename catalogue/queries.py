"""Registered queries. Each takes a session and a data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.spoilt import dirty_envelopes
from metricwin.functions.clock import normalised, on_epoch_day, seconds_of_day
from metricwin.operators import ingest, pairing, windows
from metricwin.operators.publish import envelopes
from metricwin.plans import alerts
from metricwin.plans.jobs import csv_readings, run_alert_job
from metricwin.schemas import WIDE_COLUMNS, alert_schema
from metricwin.sinks.log import publish_log
from metricwin.sinks.tables import (
    publish_files,
    read_alerts,
    stamped,
    write_bucketed,
    write_metric_csv,
    write_readings,
)
from metricwin.sources.csv_tables import read_metric_csv, read_wide_text, wide_rejects, wide_rows
from metricwin.sources.events import read_events, stream_events, wide_readings
from metricwin.sources.topics import file_batch, file_stream
from metricwin.specs import CPU_MEM, NET_DISK, TOPIC_METRIC, TOPICS, PairSpec, net_disk_spec
from metricwin.storage import fresh_dir
from metricwin.streaming.alerts import (
    dedup_stream,
    read_alert_batches,
    start_alerts,
    stream_alerts,
    stream_join,
)
from metricwin.streaming.consumer import (
    consumed_csv,
    consumed_every_nth,
    consumed_totals,
    start_consumer,
)
from metricwin.streaming.ingest import (
    data_folder,
    read_landed,
    run_folder,
    start_ingest,
    start_table,
    stream_landed,
)
from metricwin.streaming.late import arrival_counts, late_readings, start_parting, stream_on_time

Query = Callable[[SparkSession, str], DataFrame]

STREAM_DELAY = "1 minute"
#: How far back a replay goes.
REPLAY_DELAY = "40 days"
DAY, DAY_DELAY = date(2024, 1, 1), "7 hours"


def _wide(spark: SparkSession, folder: str, dealt: bool = False) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return wide_readings(read_events(spark, folder), dealt)


def _stream_wide(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return wide_readings(stream_events(spark, folder), dealt=True)


def _parsed(spark: SparkSession, folder: str, topics: Sequence[str] = TOPICS) -> DataFrame:
    messages = dirty_envelopes(_wide(spark, folder), topics)
    return ingest.parse_envelopes(messages, topics=topics)


def _accepted(spark: SparkSession, folder: str, topics: Sequence[str] = TOPICS) -> DataFrame:
    return ingest.accepted(_parsed(spark, folder, topics))


# -- sources and messages -----------------------------------------------------------------


def scan_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(spark, folder).select(*WIDE_COLUMNS)


def _wide_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Wide readings as headed CSV, one in 61 with a CPU value that is no number."""
    path = fresh_dir(spark, "wide-csv")
    spoilt = F.when(F.col("offset") % 61 == 0, "n/a").otherwise(F.col("cpu_pct").cast("string"))
    wide = _wide(spark, folder).withColumn("cpu_pct", spoilt).select(*WIDE_COLUMNS)
    wide.write.option("header", True).csv(path)
    return read_wide_text(spark, path)


def scan_wide_csv(spark: SparkSession, folder: str) -> DataFrame:
    return wide_rows(_wide_csv(spark, folder))


def scan_wide_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return wide_rejects(_wide_csv(spark, folder)).select("ts", "server_id", "cpu_pct")


def scan_wide_other_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Wide readings whose file has its columns in another order, and one more."""
    path = fresh_dir(spark, "wide-csv")
    wide = _wide(spark, folder).select("disk_io", F.lit("x").alias("note"), *WIDE_COLUMNS[-2::-1])
    wide.write.option("header", True).csv(path)
    return wide_rows(read_wide_text(spark, path))


def metric_csv_other_layout(spark: SparkSession, folder: str) -> DataFrame:
    """The network table with the time first and its second metric kept."""
    path = fresh_dir(spark, "net-csv")
    wide = _wide(spark, folder).select("ts", "net_out", "net_in", "server_id")
    wide.write.option("header", True).csv(path)
    return read_metric_csv(spark, path, "net_in", "double")


def publish_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    body = "timestamp string, server_id string, cpu_pct double, mem_pct double, net_in double, net_out double, disk_io double"
    sent = envelopes(_wide(spark, folder))
    return sent.select("topic", "offset", F.from_json("value", body).alias("m")).select(
        "topic", "offset", "m.*"
    )


def published_files(spark: SparkSession, folder: str) -> DataFrame:
    """Published to a folder of messages and read from there."""
    topic = fresh_dir(spark, "topic")
    publish_files(stamped(envelopes(_wide(spark, folder, dealt=True)), DAY), topic)
    readings = ingest.accepted(ingest.parse_envelopes(file_batch(spark, topic)))
    return readings.select("metric", "server_id", "ts", "value")


def strict_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Every message is a JSON object, so a strict ingest takes them all."""
    parsed = ingest.parse_envelopes(envelopes(_wide(spark, folder)), strict=True)
    return ingest.accepted(parsed).select("metric", "server_id", "ts", "value")


def _published_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The same offsets in two partitions, in no particular order."""
    sent = envelopes(_wide(spark, folder))
    twice = sent.select("*", F.explode(F.array(F.lit(2), F.lit(1))).alias("partition"))
    return ingest.accepted(ingest.parse_envelopes(twice.repartition("value", "offset", "partition")))


def every_10th_of_two_publishes(spark: SparkSession, folder: str) -> DataFrame:
    reported = ingest.every_nth(_published_twice(spark, folder), span=1000)
    return reported.select("kind", "ordinal", "partition", "offset", "server_id", "ts")


def ingest_trailing_text(spark: SparkSession, folder: str) -> DataFrame:
    """One message in 53 with something after its object: a word, a brace, an object, or blanks."""
    sent = envelopes(_wide(spark, folder))
    after = F.element_at(F.array(*map(F.lit, (" rest", "}", " {}", " \n "))), F.expr("cast(offset % 4 + 1 as int)"))
    body = F.when(F.col("offset") % 53 == 0, F.concat("value", after)).otherwise(F.col("value"))
    parsed = ingest.parse_envelopes(sent.withColumn("value", body))
    return ingest.rejected(parsed).select("topic", "offset", "reason")


def ingest_json_types(spark: SparkSession, folder: str) -> DataFrame:
    """One message in 59 whose metric is ``true``, the text of that, or given twice."""
    wide = _wide(spark, folder).where(F.col("offset") % 59 == 0)
    odd = F.element_at(F.array(*map(F.lit, ("true", '"true"', None))), F.expr("cast(offset % 3 + 1 as int)"))

    def message(topic: str) -> Column:
        name = F.lit(f'"{TOPIC_METRIC[topic]}": ')
        twice = F.concat(F.lit("1, "), name, F.lit("7.5"))
        head = F.concat(F.lit('{"timestamp": "'), "ts", F.lit('", "server_id": "'), "server_id", F.lit('", '))
        body = F.concat(head, name, F.coalesce(odd, twice), F.lit("}"))
        return F.struct(F.lit(topic).alias("topic"), body.alias("value"))

    messages = wide.select(F.inline(F.array(*map(message, TOPICS))), "timestamp", "offset")
    parsed = ingest.parse_envelopes(messages)
    return parsed.select("topic", "offset", "server_id", "value", "reason")


def dedup_two_publishes(spark: SparkSession, folder: str) -> DataFrame:
    once = ingest.dedup(_published_twice(spark, folder))
    return once.select("metric", "server_id", "ts", "value", "offset")


def _ingest_metric(topic: str) -> Query:
    return lambda spark, folder: ingest.metric_table(
        _accepted(spark, folder, [topic]), TOPIC_METRIC[topic]
    )


def ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.rejected(_parsed(spark, folder)).select("topic", "offset", "reason")


def ingest_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.message_counts(_parsed(spark, folder))


def ingest_every_10th(spark: SparkSession, folder: str) -> DataFrame:
    reported = ingest.every_nth(_accepted(spark, folder))
    return reported.select("kind", "ordinal", "server_id", "ts", "value", "offset")


def dedup_readings(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.dedup(_accepted(spark, folder)).select(
        "metric", "server_id", "ts", "value", "offset"
    )


# -- steps of the alerting jobs -----------------------------------------------------------


def _joined(spec: PairSpec) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        pairs = pairing.pair_readings(pairing.readings_of(_wide(spark, folder), spec), spec)
        return pairing.joined_stats(pairs, spec)

    return query


def _matched(spec: PairSpec) -> Query:
    return lambda spark, folder: pairing.matched_readings(
        pairing.readings_of(_wide(spark, folder), spec), spec
    )


def time_of_day(spark: SparkSession, folder: str) -> DataFrame:
    """Whole, short and fractional forms of the same time, and one that is none."""
    ts = F.col("ts")
    wide = _wide(spark, folder)
    rule = F.col("offset") % 5
    hour = F.split_part(ts, F.lit(":"), F.lit(1)).cast("int").cast("string")
    short = F.concat_ws(":", hour, F.substring(ts, 4, 5))
    text = (
        F.when(rule == 1, short)
        .when(rule == 2, F.concat(F.lit(" "), ts))
        .when(rule == 3, F.concat(ts, F.lit(".250")))
        .when(rule == 4, F.concat(F.lit("24"), F.substring(ts, 3, 6)))
        .otherwise(ts)
    )
    wide = wide.withColumn("text", text)
    return wide.select(
        "offset",
        normalised(F.col("text")).alias("ts"),
        seconds_of_day(F.col("text")).alias("time_sec"),
        F.unix_seconds(on_epoch_day(F.col("text"))).alias("event_sec"),
    )


def joined_rows_cpu_mem(spark: SparkSession, folder: str) -> DataFrame:
    """The join row by row."""
    return pairing.joined_readings(pairing.readings_of(_wide(spark, folder), CPU_MEM), CPU_MEM)


def join_cpu_mem_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Landed as buckets first; the match then shuffles nothing."""
    readings = pairing.readings_of(_wide(spark, folder), CPU_MEM)
    path = fresh_dir(spark, "buckets")
    table = write_bucketed(readings, f"metricwin_{path[-32:]}", 8, path=path)
    return pairing.joined_stats(pairing.pair_readings(table, CPU_MEM), CPU_MEM)


def _timed(spark: SparkSession, folder: str, spec: PairSpec) -> DataFrame:
    return alerts.timed_pairs(pairing.readings_of(_wide(spark, folder), spec), spec)


def _bounds(spec: PairSpec) -> Query:
    return lambda spark, folder: windows.bounds(_timed(spark, folder, spec), spec)


def windows_exploded(spark: SparkSession, folder: str) -> DataFrame:
    return windows.bounded_windows(_timed(spark, folder, CPU_MEM), CPU_MEM).select(
        "server_id",
        "ts",
        "time_sec",
        "base_window",
        "window_start_sec",
        "window_end_sec",
        "joined_rows",
    )


def _windowed(spec: PairSpec) -> Query:
    return lambda spark, folder: alerts.windowed(
        pairing.readings_of(_wide(spark, folder), spec), spec
    )


# -- whole jobs ---------------------------------------------------------------------------


def _alerts(spec: PairSpec) -> Query:
    return lambda spark, folder: alerts.sorted_alerts(
        pairing.readings_of(_wide(spark, folder), spec), spec
    )


def _dated(spark: SparkSession, folder: str, spec: PairSpec) -> DataFrame:
    wide = _wide(spark, folder)
    wide = wide.withColumn("event_time", F.date_trunc("second", F.col("timestamp")))
    return pairing.readings_of(wide, spec)


def _event_time_alerts(spec: PairSpec) -> Query:
    dated = replace(spec, clock="event_time")
    return lambda spark, folder: alerts.sorted_alerts(_dated(spark, folder, dated), dated)


def _message_alerts(spec: PairSpec, dedup: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        readings = _accepted(spark, folder, spec.topics)
        return alerts.sorted_alerts(ingest.dedup(readings) if dedup else readings, spec)

    return query


def _summary(spec: PairSpec) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        if spec.clock == "event_time":
            readings = _dated(spark, folder, spec)
        else:
            readings = pairing.readings_of(_wide(spark, folder), spec)
        limits = windows.bounds(alerts.timed_pairs(readings, spec), spec)
        return alerts.validation_summary(alerts.kept_windows(readings, spec), limits)

    return query


def _unsorted(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.alerts(pairing.readings_of(_wide(spark, folder), CPU_MEM), CPU_MEM)


def first_20(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.first_rows(_unsorted(spark, folder))


def last_20(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.last_rows(_unsorted(spark, folder))


def _csv_roundtrip(spec: PairSpec, skip_empty: bool) -> Query:
    """Messages to metric CSV tables to alert CSV and back, all through files."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        base = fresh_dir(spark, "csv")
        parsed = ingest.parse_envelopes(envelopes(_wide(spark, folder)), topics=spec.topics)
        write_readings(ingest.accepted(parsed), f"{base}/readings")
        readings = spark.read.parquet(f"{base}/readings")
        for metric in spec.metrics:
            write_metric_csv(readings, metric, f"{base}/{metric}")
        paths = [f"{base}/{metric}" for metric in spec.metrics]
        run_alert_job(csv_readings(spark, *paths, spec), spec, f"{base}/alerts", skip_empty)
        return read_alerts(spark, f"{base}/alerts", alert_schema(spec))

    return query


def alerts_kept_when_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A job without alerts leaves the file of the job before it alone."""
    path = fresh_dir(spark, "alerts")
    readings = pairing.readings_of(_wide(spark, folder), CPU_MEM)
    run_alert_job(readings, CPU_MEM, path)
    run_alert_job(readings.where("server_id is null"), CPU_MEM, path, skip_empty=True)
    return read_alerts(spark, path, alert_schema(CPU_MEM))


# -- streams, run until the input is used up ----------------------------------------------

LANDED = ("metric", "server_id", "ts", "value", "offset")


def _ingested(spark: SparkSession, folder: str) -> str:
    base = fresh_dir(spark, "ingest")
    messages = dirty_envelopes(_stream_wide(spark, folder))
    start_ingest(messages, base).awaitTermination()
    return base


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return read_landed(spark, _ingested(spark, folder)).select(*LANDED)


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = read_landed(spark, _ingested(spark, folder), rejects=True)
    return rejects.select("kind", "offset", "reason")


def _topic_in_two_parts(spark: SparkSession, folder: str) -> tuple[str, list[DataFrame]]:
    """An empty topic folder, and the messages in two halves by offset."""
    messages = dirty_envelopes(_wide(spark, folder, dealt=True)).withColumn("partition", F.lit(0))
    even = F.col("offset") % 2 == 0
    return fresh_dir(spark, "topic"), [messages.where(even), messages.where(~even)]


def stream_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A run that is stopped and started again goes on where it was."""
    topic, halves = _topic_in_two_parts(spark, folder)
    run = run_folder(fresh_dir(spark, "landed"))
    for half in halves:
        publish_files(half, topic)
        start_ingest(file_stream(spark, topic), run).awaitTermination()
    return read_landed(spark, run).select(*LANDED)


def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A replay reads everything again, into a run of its own."""
    topic, halves = _topic_in_two_parts(spark, folder)
    for half in halves:
        publish_files(half, topic)
    base = fresh_dir(spark, "landed")
    runs = [run_folder(base), run_folder(base, replay=True)]
    for run in runs:
        start_ingest(file_stream(spark, topic), run).awaitTermination()
    return read_landed(spark, *runs).groupBy(*LANDED).agg(F.count("*").alias("copies"))


def published_day_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """A day published to files in six-hour parts, ingested, and streamed in several batches."""
    topic = fresh_dir(spark, "topic")
    wide = _wide(spark, folder).withColumn("hour", F.substring("ts", 1, 2).cast("int"))
    for part in range(4):
        sent = envelopes(wide.where(F.floor(F.col("hour") / 6) == part).select(*WIDE_COLUMNS))
        publish_files(stamped(sent, DAY, part), topic)
        run = run_folder(f"{topic}-landed")
        start_ingest(file_stream(spark, topic), run, day=DAY).awaitTermination()
    readings = stream_landed(spark, run, files_per_trigger=6)
    return _stream_result(spark, stream_alerts(readings, CPU_MEM, DAY_DELAY))


def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that come again long after their time, with other values, change nothing."""
    topic, base = fresh_dir(spark, "topic"), fresh_dir(spark, "stream")
    wide = _wide(spark, folder)
    last = wide.agg(F.max("timestamp")).scalar()
    late = wide.where(F.col("timestamp") < last - F.expr("interval 1 hour"))
    late = late.withColumns({m: F.lit(1000.0) for m in CPU_MEM.metrics})
    for partition, sent in enumerate((wide, late)):
        publish_files(envelopes(sent).withColumn("partition", F.lit(partition)), topic)
        messages = file_stream(spark, topic)
        readings = ingest.accepted(ingest.parse_envelopes(messages, topics=CPU_MEM.topics))
        result = stream_alerts(readings, CPU_MEM, STREAM_DELAY)
        start_table(result, base).awaitTermination()
    return spark.read.schema(result.schema).parquet(data_folder(base))


def _stream_result(spark: SparkSession, result: DataFrame) -> DataFrame:
    base = fresh_dir(spark, "stream")
    start_table(result, base).awaitTermination()
    return spark.read.schema(result.schema).parquet(data_folder(base))


def _stream_alerts(spec: PairSpec) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        messages = envelopes(_stream_wide(spark, folder))
        readings = ingest.accepted(ingest.parse_envelopes(messages, topics=spec.topics))
        return _stream_result(spark, stream_alerts(readings, spec, STREAM_DELAY))

    return query


def _sent_in_parts(messages: DataFrame, days: Sequence[int]) -> list[DataFrame]:
    """The messages up to each day of the month but the last part, and the rest."""
    day = F.dayofmonth("timestamp")
    edges = [0, *days, 31]
    parts = zip(edges, edges[1:], strict=False)
    return [
        messages.where(day.between(a + 1, b)).withColumn("partition", F.lit(0)) for a, b in parts
    ]


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Half a month's messages, then the whole month's again, over a restart."""
    topic, base = fresh_dir(spark, "topic"), fresh_dir(spark, "stream")
    messages = dirty_envelopes(_wide(spark, folder, dealt=True))
    first, rest = _sent_in_parts(messages, [15])
    for partition, sent in enumerate((first, first.unionByName(rest))):
        publish_files(sent.withColumn("partition", F.lit(partition)), topic)
        readings = ingest.accepted(ingest.parse_envelopes(file_stream(spark, topic)))
        kept = dedup_stream(readings, REPLAY_DELAY).select(
            "metric", "kind", "server_id", "ts", F.unix_seconds("event_time").alias("event_sec"), "value"
        )
        start_table(kept, base).awaitTermination()
    return spark.read.schema(kept.schema).parquet(data_folder(base))


def stream_join_cpu_mem(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs: one metric is five days ahead of the other, then level, then some of its
    readings come again long after their time."""
    topic, base = fresh_dir(spark, "topic"), fresh_dir(spark, "stream")
    sent = envelopes(_wide(spark, folder)).withColumn("partition", F.lit(0))
    cpu, mem = F.col("topic") == "topic-cpu", F.col("topic") == "topic-mem"
    day = F.dayofmonth("timestamp")
    runs = (
        (cpu & (day <= 15)) | (mem & (day <= 10)),
        (cpu & day.between(16, 20)) | (mem & day.between(11, 20)),
        ((cpu | mem) & (day > 20)) | (cpu & (day <= 18)),
    )
    for run in runs:
        publish_files(sent.where(run), topic)
        messages = file_stream(spark, topic)
        readings = ingest.accepted(ingest.parse_envelopes(messages, topics=CPU_MEM.topics))
        joined = stream_join(readings, CPU_MEM, STREAM_DELAY).select(
            "server_id", F.unix_seconds("event_time").alias("event_sec"), *CPU_MEM.metrics
        )
        start_table(joined, base).awaitTermination()
    return spark.read.schema(joined.schema).parquet(data_folder(base))


def _clamped_stream(spec: PairSpec) -> Query:
    """Alerts of a stream that finds out by itself where the data begins, over a restart."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        topic, base = fresh_dir(spark, "topic"), fresh_dir(spark, "alerts")
        for sent in _sent_in_parts(envelopes(_wide(spark, folder, dealt=True)), [15]):
            publish_files(sent, topic)
            messages = file_stream(spark, topic)
            readings = ingest.accepted(ingest.parse_envelopes(messages, topics=spec.topics))
            start_alerts(readings, spec, base, STREAM_DELAY).awaitTermination()
        return read_alert_batches(spark, base, spec)

    return query


def _consumed(spark: SparkSession, folder: str) -> str:
    """A month's messages consumed in three batches, each after a restart."""
    topic, base = fresh_dir(spark, "topic"), fresh_dir(spark, "consumed")
    for sent in _sent_in_parts(dirty_envelopes(_wide(spark, folder, dealt=True)), [10, 20]):
        publish_files(sent, topic)
        start_consumer(file_stream(spark, topic), base).awaitTermination()
    return base


def consumer_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The four CSV tables of one pass, as one long table."""
    base = _consumed(spark, folder)
    tables = [
        consumed_csv(spark, base, m).select(
            F.lit(m).alias("metric"), "server_id", "ts", F.col(m).alias("value")
        )
        for m in TOPIC_METRIC.values()
    ]
    return reduce(DataFrame.unionByName, tables)


def consumer_totals(spark: SparkSession, folder: str) -> DataFrame:
    return consumed_totals(spark, _consumed(spark, folder))


def consumer_every_10th(spark: SparkSession, folder: str) -> DataFrame:
    reported = consumed_every_nth(spark, _consumed(spark, folder))
    return reported.select("kind", "ordinal", "server_id", "ts", "value", "offset")


def published_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two publishes into one log, the first of them tried again: offsets and messages per topic."""
    topic = fresh_dir(spark, "log")
    wide = _wide(spark, folder)
    for name in ("a", "b", "a"):
        half = wide.where(F.col("offset") % 2 == (0 if name == "a" else 1))
        publish_log(envelopes(half), topic, name, DAY)
    return (
        file_batch(spark, topic)
        .groupBy("topic")
        .agg(
            F.count("*").alias("messages"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count_distinct("offset").alias("offsets"),
            F.sum(F.unix_seconds("timestamp")).alias("seconds"),
        )
    )


def _parted(spark: SparkSession, folder: str) -> str:
    """The readings of ``stream_late``, parted into those on time and late."""
    topic, base = fresh_dir(spark, "topic"), fresh_dir(spark, "parted")
    wide = _wide(spark, folder, dealt=True)
    last = _wide(spark, folder).agg(F.max("timestamp")).scalar()
    late = wide.where(F.col("timestamp") < last - F.expr("interval 1 hour"))
    late = late.withColumns({m: F.lit(1000.0) for m in CPU_MEM.metrics})
    for partition, sent in enumerate((wide, late)):
        publish_files(envelopes(sent).withColumn("partition", F.lit(partition)), topic)
        messages = file_stream(spark, topic)
        readings = ingest.accepted(ingest.parse_envelopes(messages, topics=CPU_MEM.topics))
        start_parting(readings, base, STREAM_DELAY).awaitTermination()
    return base


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = late_readings(spark, _parted(spark, folder))
    return rows.select("metric", "server_id", F.unix_seconds("event_time").alias("event_sec"), "value")


def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = arrival_counts(spark, _parted(spark, folder))
    return counts.withColumn("latest", F.unix_seconds("latest"))


def late_parted_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alert stream over the readings that came in time."""
    on_time = stream_on_time(spark, _parted(spark, folder))
    return _stream_result(spark, stream_alerts(on_time, CPU_MEM, STREAM_DELAY))


QUERIES: dict[str, Query] = {
    "scan_wide": scan_wide,
    "scan_wide_csv": scan_wide_csv,
    "scan_wide_rejects": scan_wide_rejects,
    "publish_envelopes": publish_envelopes,
    "ingest_cpu": _ingest_metric("topic-cpu"),
    "ingest_mem": _ingest_metric("topic-mem"),
    "ingest_net": _ingest_metric("topic-net"),
    "ingest_disk": _ingest_metric("topic-disk"),
    "ingest_rejects": ingest_rejects,
    "ingest_counts": ingest_counts,
    "ingest_every_10th": ingest_every_10th,
    "dedup_readings": dedup_readings,
    "join_cpu_mem": _joined(CPU_MEM),
    "join_net_disk": _joined(NET_DISK),
    "time_of_day": time_of_day,
    "bounds_cpu_mem": _bounds(CPU_MEM),
    "bounds_net_disk": _bounds(NET_DISK),
    "windows_exploded": windows_exploded,
    "windowed_avg": _windowed(CPU_MEM),
    "windowed_max": _windowed(NET_DISK),
    "windowed_avg_25s": _windowed(replace(CPU_MEM, size=25)),
    "alerts_cpu_mem": _alerts(CPU_MEM),
    "alerts_net_disk": _alerts(NET_DISK),
    "alerts_net_disk_flood_label": _alerts(net_disk_spec("flood")),
    "alerts_cpu_mem_unclamped": _alerts(replace(CPU_MEM, clamp="none")),
    "alerts_cpu_mem_panes": _alerts(replace(CPU_MEM, panes=True)),
    "alerts_cpu_mem_event_time": _event_time_alerts(CPU_MEM),
    "alerts_cpu_mem_messages": _message_alerts(CPU_MEM),
    "alerts_net_disk_messages": _message_alerts(NET_DISK),
    "alerts_cpu_mem_dedup": _message_alerts(CPU_MEM, dedup=True),
    "alerts_net_disk_dedup": _message_alerts(NET_DISK, dedup=True),
    "validation_summary": _summary(CPU_MEM),
    "validation_summary_net_disk": _summary(NET_DISK),
    "validation_summary_event_time": _summary(replace(CPU_MEM, clock="event_time")),
    "matched_readings_cpu_mem": _matched(CPU_MEM),
    "matched_readings_net_disk": _matched(NET_DISK),
    "first_20": first_20,
    "last_20": last_20,
    "csv_roundtrip": _csv_roundtrip(CPU_MEM, skip_empty=True),
    "csv_roundtrip_net_disk": _csv_roundtrip(NET_DISK, skip_empty=False),
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_alerts_cpu_mem": _stream_alerts(CPU_MEM),
    "stream_alerts_net_disk": _stream_alerts(NET_DISK),
    "scan_wide_other_layout": scan_wide_other_layout,
    "metric_csv_other_layout": metric_csv_other_layout,
    "published_files": published_files,
    "published_day_alerts": published_day_alerts,
    "strict_ingest": strict_ingest,
    "stream_resume": stream_resume,
    "stream_replay": stream_replay,
    "stream_rejects": stream_rejects,
    "stream_late": stream_late,
    "alerts_kept_when_empty": alerts_kept_when_empty,
    "every_10th_of_two_publishes": every_10th_of_two_publishes,
    "dedup_two_publishes": dedup_two_publishes,
    "ingest_trailing_text": ingest_trailing_text,
    "ingest_json_types": ingest_json_types,
    "joined_rows_cpu_mem": joined_rows_cpu_mem,
    "join_cpu_mem_bucketed": join_cpu_mem_bucketed,
    "stream_join_cpu_mem": stream_join_cpu_mem,
    "stream_alerts_cpu_mem_clamped": _clamped_stream(CPU_MEM),
    "stream_alerts_net_disk_clamped": _clamped_stream(NET_DISK),
    "consumer_csv": consumer_csv,
    "consumer_totals": consumer_totals,
    "consumer_every_10th": consumer_every_10th,
    "published_log": published_log,
    "late_rows": late_rows,
    "late_counts": late_counts,
    "late_parted_alerts": late_parted_alerts,
}
