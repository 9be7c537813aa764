"""Steps that all message queries share cost little per message and use all tasks."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from metricwin.operators import ingest
from metricwin.operators.publish import envelopes
from metricwin.schemas import ENVELOPE
from metricwin.sinks.tables import stamped
from metricwin.storage import kept
from metricwin.streaming import consumer
from metricwin.streaming.alerts import with_event_watermark

ROWS = [
    ("topic-cpu", '{"timestamp": "00:00:05", "server_id": "a", "cpu_pct": 1.5, "cpu_pct": 2.5}'),
    ("topic-net", '{"timestamp": "00:00:05", "server_id": null, "net_in": true}'),
    ("topic-net", '{"timestamp": "00:00:05", "net_in": "true"}'),
    ("topic-disk", "not json"),
]


@pytest.fixture
def messages(spark):
    rows = [(topic, value, None, 0, n) for n, (topic, value) in enumerate(ROWS)]
    return spark.createDataFrame(rows, ENVELOPE)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_generated_methods_of_the_parse_are_short_enough_for_the_compiler(spark, messages):
    # Java's compiler leaves methods of more than 8000 bytes to the interpreter.
    for df in (ingest.parse_envelopes(messages), ingest.accepted(ingest.parse_envelopes(messages))):
        code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert sizes and max(sizes) < 8000


def test_small_steps_read_messages_as_before(messages):
    parsed = ingest.parse_envelopes(messages).orderBy("offset")
    found = [tuple(r) for r in parsed.select("server_id", "value", "reason").collect()]
    assert found == [
        ("a", 2.5, None),
        (None, 1.0, None),
        ("unknown", None, "bad_value"),
        (None, None, "malformed"),
    ]


def test_own_time_is_parsed_once_per_message(messages):
    assert plan_of(stamped(messages, date(2024, 1, 1), 0)).count("get_json_object(") == 1


def test_messages_are_dealt_over_all_tasks(spark, data):
    halves = queries._topic_in_two_parts(spark, data)[1]
    assert all("Exchange hashpartitioning(offset" in plan_of(half) for half in halves)
    sent = envelopes(queries._wide(spark, data))
    assert sent.count() == sum(half.count() for half in halves)


def test_events_are_dealt_before_anything_is_made_of_them(spark, data):
    # One task may read a whole table; it should do no more than that.
    halves = queries._topic_in_two_parts(spark, data)[1]
    for df in (queries._wide(spark, data, dealt=True), *halves):
        made, read = plan_of(df).split("Exchange hashpartitioning(offset", 1)
        assert "get_json_object" in made and "date_format" in made
        assert "get_json_object" not in read and "date_format" not in read


def test_dealt_events_are_the_same_wide_readings(spark, data):
    plain, dealt = queries._wide(spark, data), queries._wide(spark, data, dealt=True)
    assert dealt.columns == plain.columns
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()


def test_dealt_events_keep_their_number_of_tasks(spark, data):
    # Few bytes are dealt, much is made of them: their size must not decide on the tasks.
    dealt = queries._wide(spark, data, dealt=True)
    tasks = dealt.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_consumer_keeps_no_messages_between_its_steps(spark, messages, tmp_path, monkeypatch):
    seen = []

    def noting(df, label):
        seen.append(df.columns)
        return kept(df, label)

    monkeypatch.setattr(consumer, "kept", noting)
    consumer.consume_batches(str(tmp_path), n=1)(messages, 0)
    assert len(seen) == 1 and "message" not in seen[0]
    totals = {r["kind"]: tuple(r)[1:] for r in consumer.consumed_totals(spark, str(tmp_path)).collect()}
    assert totals == {"cpu": (1, 0, 0), "network": (1, 1, 0), "disk": (0, 1, 0), "total": (2, 2, 0)}
    report = consumer.consumed_every_nth(spark, str(tmp_path)).select("kind", "ordinal", "value")
    assert sorted(map(tuple, report.collect())) == [("cpu", 1, 2.5), ("network", 1, 1.0)]


def test_two_publishes_are_not_held_to_a_fixed_number_of_tasks(spark, data):
    assert not re.search(r"hashpartitioning\(.*, 7\)", plan_of(queries._published_twice(spark, data)))


def test_stream_dedup_deals_its_messages(spark, data, monkeypatch):
    plans = []

    def noting(envelopes, topic):
        plans.append(plan_of(envelopes))
        raise InterruptedError

    monkeypatch.setattr(queries, "publish_files", noting)
    with pytest.raises(InterruptedError):
        queries.stream_dedup(spark, data)
    assert "Exchange hashpartitioning(offset" in plans[0]


def test_watermark_does_not_read_messages_again(messages):
    sent = messages.withColumn("timestamp", F.to_timestamp(F.lit("2024-01-01 00:00:06")))
    parsed = with_event_watermark(ingest.accepted(ingest.parse_envelopes(sent)), "1 minute")
    plan = plan_of(parsed)
    # The filter on the time stands over the step that makes it, of a time text that is made once.
    assert plan.count("RLIKE(trim(ts#") == 1 and plan.count("RLIKE(trim(CASE") == 0
    found = [tuple(r) for r in parsed.orderBy("offset").select("metric", "value").collect()]
    assert found == [("cpu_pct", 2.5), ("net_in", 1.0)]
    assert with_event_watermark(ingest.accepted(ingest.parse_envelopes(messages)), "1 minute").isEmpty()
