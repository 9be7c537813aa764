import json
import math
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from metricwin.functions.fields import number
from metricwin.operators import ingest
from metricwin.operators.publish import envelopes
from metricwin.schemas import ENVELOPE, WIDE_METRICS
from metricwin.sinks.tables import stamped
from metricwin.sources.csv_tables import read_metric_csv, read_wide_text, wide_rejects, wide_rows

READING = (
    "metric string, kind string, server_id string, ts string, value double,"
    " timestamp timestamp, partition int, offset long"
)
RECORD = datetime(2024, 1, 1, 10, 0, 7, tzinfo=timezone.utc)


def _messages(spark, pairs):
    rows = [(topic, value, RECORD, 0, i) for i, (topic, value) in enumerate(pairs)]
    return spark.createDataFrame(rows, ENVELOPE)


def _values(spark, topic, metric, texts):
    messages = _messages(spark, [(topic, t) for t in texts])
    rows = ingest.parse_envelopes(messages).orderBy("offset").collect()
    return [(r.value, r.reason) for r in rows]


BODY = '{"timestamp": "10:00:00", "server_id": "s1"%s}'


def test_metric_forms_cpu(spark):
    forms = [
        BODY % ', "cpu_pct": 1.5',
        BODY % ', "cpu_pct": "1.5"',
        BODY % ', "cpu_pct": null',
        BODY % "",
        BODY % ', "cpu_pct": "high"',
        "not json",
        "{'timestamp': '10:00:00'}",
        "[1]",
    ]
    assert _values(spark, "topic-cpu", "cpu_pct", forms) == [
        (1.5, None),
        (1.5, None),
        (None, None),
        (0.0, None),
        (None, None),
        (None, "malformed"),
        (None, "malformed"),
        (None, "malformed"),
    ]


def test_metric_forms_net(spark):
    forms = [
        BODY % ', "net_in": 1.5',
        BODY % ', "net_in": " 1.5 "',
        BODY % ', "net_in": null',
        BODY % "",
        BODY % ', "net_in": "high"',
        "not json",
        "{'timestamp': '10:00:00'}",
        "[1]",
    ]
    assert _values(spark, "topic-net", "net_in", forms) == [
        (1.5, None),
        (1.5, None),
        (None, "bad_value"),
        (0.0, None),
        (None, "bad_value"),
        (None, "malformed"),
        (None, "malformed"),
        (None, "malformed"),
    ]


def test_bare_nan_is_a_number(spark):
    ((value, reason),) = _values(spark, "topic-disk", "disk_io", [BODY % ', "disk_io": NaN'])
    assert math.isnan(value) and reason is None


def test_time_and_server_defaults(spark):
    messages = _messages(
        spark,
        [
            ("topic-cpu", '{"ts": "09:00:00", "timestamp": "08:00:00", "cpu_pct": 1}'),
            ("topic-cpu", '{"ts": "", "timestamp": "08:00:00", "server_id": null, "cpu_pct": 1}'),
            ("topic-mem", '{"server_id": "s1", "mem_pct": 1}'),
            ("topic-net", '{"ts": "09:00:00", "server_id": "s1", "net_in": 1}'),
            ("topic-disk", '{"timestamp": null, "server_id": "", "disk_io": 1}'),
            ("topic-other", '{"timestamp": "08:00:00"}'),
        ],
    )
    rows = ingest.parse_envelopes(messages).orderBy("offset").collect()
    assert [(r.kind, r.server_id, r.ts) for r in rows] == [
        ("cpu", "unknown", "09:00:00"),
        ("cpu", None, "08:00:00"),
        ("mem", "s1", "10:00:07"),
        ("network", "s1", ""),
        ("disk", None, None),
    ]


def test_strict_fails_on_malformed_text(spark):
    messages = _messages(spark, [("topic-cpu", "not json")])
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest.parse_envelopes(messages, strict=True).collect()


def test_counts_and_rejects(spark):
    messages = _messages(
        spark,
        [
            ("topic-net", BODY % ', "net_in": 1'),
            ("topic-net", BODY % ', "net_in": null'),
            ("topic-disk", '{"disk_io": 1}'),
        ],
    )
    parsed = ingest.parse_envelopes(messages)
    counts = {r.kind: (r.messages, r.rejected, r.unknown_server) for r in
              ingest.message_counts(parsed).collect()}
    assert counts == {"network": (1, 1, 0), "disk": (1, 0, 1), "total": (2, 1, 1)}
    (reject,) = ingest.rejected(parsed).collect()
    assert (reject.offset, reject.reason, json.loads(reject.message)["net_in"]) == (1, "bad_value", None)


def test_published_messages_come_back(spark):
    wide = spark.createDataFrame(
        [("10:00:00", "s1", 1.25, 2.5, 3.0, 4.0, 5.0, RECORD, 7)],
        "ts string, server_id string, cpu_pct double, mem_pct double, net_in double,"
        " net_out double, disk_io double, timestamp timestamp, offset long",
    )
    sent = envelopes(wide)
    bodies = {r.topic: json.loads(r.value) for r in sent.collect()}
    head = {"timestamp": "10:00:00", "server_id": "s1"}
    assert bodies == {
        "topic-cpu": {**head, "cpu_pct": 1.25},
        "topic-mem": {**head, "mem_pct": 2.5},
        "topic-net": {**head, "net_in": 3.0, "net_out": 4.0},
        "topic-disk": {**head, "disk_io": 5.0},
    }
    readings = ingest.accepted(ingest.parse_envelopes(sent)).collect()
    assert {(r.metric, r.server_id, r.ts, r.value, r.offset) for r in readings} == {
        ("cpu_pct", "s1", "10:00:00", 1.25, 7),
        ("mem_pct", "s1", "10:00:00", 2.5, 7),
        ("net_in", "s1", "10:00:00", 3.0, 7),
        ("disk_io", "s1", "10:00:00", 5.0, 7),
    }


def test_wide_csv_rejects_or_fails(spark, tmp_path):
    path = str(tmp_path / "wide.csv")
    head = "ts,server_id,cpu_pct,mem_pct,net_in,net_out,disk_io\n"
    (tmp_path / "wide.csv").write_text(head + "10:00:00,s1,1,2,3,4,5\n10:00:01,s1,1,,3,4,5\n")
    raw = read_wide_text(spark, path)
    assert [tuple(r) for r in wide_rows(raw).collect()] == [("10:00:00", "s1", 1.0, 2.0, 3.0, 4.0, 5.0)]
    assert [r.ts for r in wide_rejects(raw).collect()] == ["10:00:01"]
    with pytest.raises(Exception, match="not a number"):
        wide_rows(raw, on_bad="fail").collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "w.csv").write_text("server_id,ts,x,cpu_pct,mem_pct,net_in,disk_io,net_out\ns,t,9,1,2,3,5,4\n")
    got = wide_rows(read_wide_text(spark, str(tmp_path / "w.csv")))
    assert [tuple(r) for r in got.collect()] == [("t", "s", 1.0, 2.0, 3.0, 4.0, 5.0)]
    (tmp_path / "net.csv").write_text("ts,net_out,net_in,server_id\nt,4,3,s\n")
    got = read_metric_csv(spark, str(tmp_path / "net.csv"), "net_in", "double")
    assert [tuple(r) for r in got.collect()] == [("s", "t", 3.0)]


def test_csv_misses_a_column(spark, tmp_path):
    (tmp_path / "w.csv").write_text("server_id,ts,cpu_pct\ns,t,1\n")
    with pytest.raises(ValueError, match="no column mem_pct, net_in, net_out, disk_io"):
        read_wide_text(spark, str(tmp_path / "w.csv"))


def test_csv_files_of_a_folder_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("server_id,ts,net_in\ns,t,1\n")
    (tmp_path / "b.csv").write_text("ts,server_id,net_in\nt,s,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_metric_csv(spark, str(tmp_path), "net_in", "double").collect()


def test_csv_folder_without_files(spark, tmp_path):
    assert read_metric_csv(spark, str(tmp_path), "net_in", "double").collect() == []
    assert read_wide_text(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("text", ["1.5f", "1.5d", "2D", "0x1p3", "1e", "", "1 2", "--1", "infin"])
def test_no_number(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(number(F.col("t"))).first()
    assert row[0] is None


@pytest.mark.parametrize("text", ["1.5", "-.5", "5.", "+1e-3", "Infinity", "-inf", " 7 ", "1E+2"])
def test_number(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(number(F.col("t"))).first()
    assert row[0] == float(text)


def test_day_dates_times_far_from_the_record(spark):
    messages = _messages(spark, [("topic-net", BODY.replace("10:00:00", "23:30:00") % ', "net_in": 1')])
    near = ingest.parse_envelopes(messages).first()
    told = ingest.parse_envelopes(messages, day=date(2024, 1, 1)).first()
    assert near.event_time == datetime(2023, 12, 31, 23, 30)
    assert told.event_time == datetime(2024, 1, 1, 23, 30)


def test_stamped_messages(spark):
    wide = spark.createDataFrame([("23:30:00", "s", 1.0, 1.0, 1.0, 1.0, 1.0), (None, "s", *[1.0] * 5)], ", ".join(
        ["ts string", "server_id string", *(f"{m} double" for m in WIDE_METRICS)]))
    sent = envelopes(wide)
    dated = stamped(sent, date(2024, 1, 1)).where("value like '%23:30%'").collect()
    assert {r.timestamp for r in dated} == {datetime(2024, 1, 1, 23, 30)}
    assert stamped(sent, date(2024, 1, 1)).where("timestamp is null").count() == 0
    one, two = (stamped(sent).select("partition").distinct().collect() for _ in range(2))
    assert len(one) == len(two) == 1 and one != two


def test_every_nth_over_gaps_and_many_runs(spark):
    rng = random.Random(3)
    rows = []
    for kind in ("network", "disk"):
        for partition in (1, 0):
            for o in rng.sample(range(5000), 730):
                # Offsets go with time, over two days.
                time = RECORD + timedelta(seconds=o * 40)
                rows.append((kind, time, partition, o, float(o)))
    rows.append(("cpu", None, None, None, 1.0))
    want = set()
    for kind in ("network", "disk"):
        own = sorted((t.replace(second=0), p, o) for k, t, p, o, _ in rows if k == kind)
        want |= {(kind, i, p, o) for i, (_, p, o) in enumerate(own, 1) if i % 10 == 0}
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(
            rows, "kind string, timestamp timestamp, partition int, offset long, value double"
        ).repartition(seed + 2)
        got = {
            (r.kind, r.ordinal, r.partition, r.offset)
            for r in ingest.every_nth(df, 10, span=64).collect()
        }
        assert got == want


def _read(server, second, value, partition, offset, metric="cpu_pct", ts=None):
    time = None if second is None else datetime(2024, 1, 1, 10, 0, second)
    return (metric, metric[:3], server, ts or "10:00", time, value, RECORD, partition, offset)


DATED = (
    "metric string, kind string, server_id string, ts string, event_time timestamp, value double, "
    "timestamp timestamp, partition int, offset long"
)


def test_dedup_drops_only_copies(spark):
    original = [_read("s", 0, 5.0, 0, 3), _read("s", 1, None, 0, 4), _read("s", 0, 8.0, 0, 9, "mem_pct")]
    # Another value, another second, and the same clock time on another day are no copies.
    others = [_read("s", 0, 6.0, 0, 5), _read("s", 2, 5.0, 0, 6), _read("t", 0, 5.0, 0, 7)]
    others.append((*others[0][:4], datetime(2024, 1, 2, 10, 0, 0), 5.0, *others[0][6:8], 8))
    copies = [(*r[:7], 1, r[8] + 1) for r in original + others] + original
    df = spark.createDataFrame(original + others + copies, DATED)
    kept = ingest.dedup(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, spark.createDataFrame(original + others, DATED).collect())
    )
    assert "partial_min" in kept._jdf.queryExecution().executedPlan().toString()


def test_dedup_leaves_readings_of_no_known_server_or_time(spark):
    places = [("s", None), (None, 0), ("", 0), ("unknown", 0), ("s", 0)]
    rows = [
        _read(server, second, 1.0, 0, 10 * i + k)
        for i, (server, second) in enumerate(places)
        for k in range(3)
    ]
    # The same message twice is one message.
    kept = ingest.dedup(spark.createDataFrame(rows + rows[:1] + rows[9:10], DATED)).collect()
    assert len(kept) == 4 * 3 + 1


@pytest.mark.parametrize("after", ["rest", " }", "}}", "]}", " {}", ', "x": 1}', ',"after": 0}', "\x00"])
def test_text_after_the_object_is_rejected(spark, after):
    body = '{"timestamp": "10:00:00", "server_id": "s1", "net_in": 3}'
    rows = ingest.parse_envelopes(_messages(spark, [("topic-net", body + after)])).collect()
    assert [r.reason for r in rows] == ["malformed"]
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest.parse_envelopes(_messages(spark, [("topic-net", body + " rest")]), strict=True).collect()


@pytest.mark.parametrize(
    "topic, given, value, reason",
    [
        ("topic-net", '"net_in": true', 1.0, None),
        ("topic-net", '"net_in": false', 0.0, None),
        ("topic-net", '"net_in": "true"', None, "bad_value"),
        ("topic-net", '"net_in": "x", "net_in": 4', 4.0, None),
        ("topic-net", '"net_in": 4, "net_in": null', None, "bad_value"),
        ("topic-net", '"net_in": 4, "server_id": "s1", "net_in": 5, "net_in": 6', 6.0, None),
        ("topic-disk", '"disk_io": true', 1.0, None),
        ("topic-cpu", '"cpu_pct": true', None, None),
        ("topic-cpu", '"cpu_pct": 1, "cpu_pct": 2', 2.0, None),
    ],
)
def test_json_types_and_repeated_fields(spark, topic, given, value, reason):
    body = '{"timestamp": "10:00:00", "server_id": "s1", %s}' % given
    (row,) = ingest.parse_envelopes(_messages(spark, [(topic, body)])).collect()
    assert (row.value, row.reason, row.server_id) == (value, reason, "s1")


def test_blanks_around_the_object_do_not_matter(spark):
    body = ' \n{"timestamp": "10:00:00", "server_id": "s1", "net_in": 3} \t\r\n'
    for strict in (False, True):
        (row,) = ingest.parse_envelopes(_messages(spark, [("topic-net", body)]), strict).collect()
        assert (row.reason, row.server_id, row.value) == (None, "s1", 3.0)


def test_unknown_servers_match_each_other(spark):
    bodies = [("topic-cpu", '{"timestamp": "10:00:00", "cpu_pct": 90}'),
              ("topic-mem", '{"timestamp": "10:00:00", "mem_pct": 90}')]
    readings = ingest.accepted(ingest.parse_envelopes(_messages(spark, bodies)))
    table = ingest.metric_table(readings, "cpu_pct", "float")
    assert [tuple(r) for r in table.collect()] == [("unknown", "10:00:00", 90.0)]
    assert dict(table.dtypes)["cpu_pct"] == "float"
    assert readings.where(F.col("server_id") == "unknown").count() == 2
