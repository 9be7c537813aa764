"""The registered queries in SQL, written the plain way: joins row by row, then windows."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Job:
    """What the SQL needs to know of a job; stated here, not taken from what it checks."""

    first: str
    second: str
    first_out: str
    second_out: str
    statistic: str
    value_type: str
    first_threshold: float
    second_threshold: float
    labels: tuple[str, str, str]
    clamp: str


# The two jobs' metrics, thresholds and label texts.
CPU_MEM = Job(
    "cpu_pct", "mem_pct", "avg_cpu", "avg_mem", "avg", "float", 81.69, 76.53,
    ("High CPU + Memory stress", "CPU spike suspected", "Memory saturation suspected"), "floor",
)
NET_DISK = Job(
    "net_in", "disk_io", "max_net_in", "max_disk_io", "max", "double", 3740.67, 2465.45,
    ("Network flood + Disk thrash suspected", "Possible DDoS", "Disk thrash suspected"), "raw",
)
FLOOD = replace(
    NET_DISK,
    labels=(
        "Network flood + Disk thrash suspected", "Network flood suspected", "Disk thrash suspected",
    ),
)

DELAY_SECONDS = 60
#: The published day, as seconds since 1970-01-01, and the delay of its stream.
DAY_START = 1704067200
DAY_DELAY_SECONDS = 25200

WIDE = """
wide AS (
  SELECT event_id, ts AS record_ts, strftime(ts, '%H:%M:%S') AS ts,
         'srv_' || cast(user_id % 8 AS varchar) AS server_id,
         least(value, 100.0) AS cpu_pct,
         cast(json_extract_string(props, '$.k') AS double) AS mem_pct,
         value * 40 AS net_in, value * 20 AS net_out,
         cast(json_extract_string(props, '$.k') AS double) * 30 AS disk_io,
         date_trunc('second', ts) AS event_time
  FROM events)"""

KINDS = {"cpu_pct": "cpu", "mem_pct": "mem", "net_in": "network", "disk_io": "disk"}
TOPICS = {"cpu_pct": "topic-cpu", "mem_pct": "topic-mem", "net_in": "topic-net", "disk_io": "topic-disk"}


def _round2(value: str) -> str:
    return f"cast(round(cast(cast({value} AS varchar) AS decimal(30,10)), 2) AS double)"


def _seconds(ts: str) -> str:
    return (
        f"(cast({ts}[1:2] AS bigint) * 3600 + cast({ts}[4:5] AS bigint) * 60"
        f" + cast({ts}[7:8] AS bigint))"
    )


def _clock(seconds: str) -> str:
    return f"strftime(make_timestamp((({seconds}) * 1000000)::bigint), '%H:%M:%S')"


def _typed(column: str, spec: Job) -> str:
    return f"cast(cast({column} AS float) AS double)" if spec.value_type == "float" else column


def _metric_rows(metric: str) -> str:
    """Messages of one metric after the dirtying rules, with parse results."""
    lenient = metric in ("cpu_pct", "mem_pct")
    no_time = "ts" if lenient else "''"
    bad = "" if lenient else "WHEN rule = 83 THEN 'bad_value'"
    return f"""
  SELECT '{metric}' AS metric, '{KINDS[metric]}' AS kind, '{TOPICS[metric]}' AS topic, event_id,
         CASE WHEN rule = 89 THEN 'unknown' ELSE server_id END AS server_id,
         CASE WHEN rule = 71 THEN {no_time} ELSE ts END AS ts,
         CASE WHEN rule = 83 THEN NULL WHEN rule = 79 THEN 0.0 ELSE {metric} END AS value,
         event_time, record_ts, date_trunc('minute', record_ts) AS record_minute,
         CASE WHEN rule = 97 THEN 'malformed' {bad} END AS reason
  FROM ruled"""


MESSAGES = f"""{WIDE},
ruled AS (
  SELECT *, CASE WHEN event_id % 97 = 0 THEN 97 WHEN event_id % 89 = 0 THEN 89
                 WHEN event_id % 83 = 0 THEN 83 WHEN event_id % 79 = 0 THEN 79
                 WHEN event_id % 73 = 0 THEN 73 WHEN event_id % 71 = 0 THEN 71 END AS rule
  FROM wide),
parsed AS ({" UNION ALL ".join(_metric_rows(m) for m in KINDS)}),
accepted AS (SELECT * FROM parsed WHERE reason IS NULL)"""

DEDUPED = f"""{MESSAGES},
deduped AS (
  SELECT * FROM accepted
  QUALIFY ts = '' OR server_id = 'unknown' OR row_number() OVER (
    PARTITION BY metric, server_id, event_time, value ORDER BY record_ts, event_id) = 1)"""


def _joined(spec: Job, source: str = "wide", key: str = "ts") -> str:
    """CTEs up to the row-by-row join: columns server_id, ts, a, b, t."""
    if source == "wide":
        head = WIDE
        left = f"SELECT server_id, {key} AS ts, {_typed(spec.first, spec)} AS a FROM wide"
        right = f"SELECT server_id, {key} AS ts, {_typed(spec.second, spec)} AS b FROM wide"
    else:
        head = DEDUPED if source == "deduped" else MESSAGES
        left, right = (
            f"SELECT server_id, ts, {_typed('value', spec)} AS {c} FROM {source}"
            f" WHERE metric = '{m}' AND ts <> ''"
            for m, c in ((spec.first, "a"), (spec.second, "b"))
        )
    seconds = _seconds("l.ts") if key == "ts" else "cast(epoch(l.ts) AS bigint)"
    return f"""{head},
l AS ({left}),
r AS ({right}),
joined AS (
  SELECT l.server_id, l.ts, l.a, r.b, {seconds} AS t
  FROM l JOIN r ON l.server_id = r.server_id AND l.ts = r.ts)"""


def _windowed(
    spec: Job, source: str = "wide", key: str = "ts", clamp: str | None = None, size: int = 30
) -> str:
    """CTEs up to the kept windows: columns server_id, w, a, b."""
    agg = spec.statistic
    keep = {
        "floor": "WHERE w >= (SELECT min(t) // 10 * 10 FROM joined)",
        "raw": "WHERE w >= (SELECT min(t) FROM joined)",
        "none": "",
    }[clamp or spec.clamp]
    return f"""{_joined(spec, source, key)},
slots AS (
  SELECT joined.*, t // 10 * 10 - k AS w
  FROM joined CROSS JOIN (VALUES (0), (10), (20)) AS offsets(k)
  WHERE t < t // 10 * 10 - k + {size}),
windowed AS (
  SELECT server_id, w, {_round2(f"{agg}(a)")} AS a, {_round2(f"{agg}(b)")} AS b
  FROM slots {keep} GROUP BY server_id, w)"""


def _label(spec: Job) -> str:
    both, first, second = spec.labels
    t1, t2 = spec.first_threshold, spec.second_threshold
    return f"""CASE WHEN a > {t1} AND b > {t2} THEN '{both}'
       WHEN a > {t1} AND b <= {t2} THEN '{first}'
       WHEN b > {t2} AND a <= {t1} THEN '{second}' ELSE '' END"""


def _alerts(
    spec: Job,
    source: str = "wide",
    key: str = "ts",
    clamp: str | None = None,
    where: str = "",
    tail: str = "",
) -> str:
    if key == "ts":
        start, end = _clock("w"), _clock("w + 30")
    else:
        start, end = (
            f"strftime(make_timestamp((({w}) * 1000000)::bigint), '%Y-%m-%d %H:%M:%S')"
            for w in ("w", "w + 30")
        )
    return f"""WITH {_windowed(spec, source, key, clamp)}
SELECT server_id, {start} AS window_start, {end} AS window_end,
       a AS {spec.first_out}, b AS {spec.second_out}, {_label(spec)} AS alert
FROM windowed {where} {tail}"""


def _joined_rows(spec: Job) -> str:
    if spec.statistic == "avg":
        stats = """cast(count(a) AS double) AS first_n, sum(a) AS first_sum,
       cast(count(b) AS double) AS second_n, sum(b) AS second_sum"""
    else:
        stats = "max(a) AS first_max, max(b) AS second_max"
    return f"""WITH {_joined(spec)}
SELECT server_id, ts, cast(count(*) AS double) AS joined_rows, {stats}
FROM joined GROUP BY server_id, ts"""


def _bounds(spec: Job) -> str:
    first = "min(t) // 10 * 10" if spec.clamp == "floor" else "(min(t) + 9) // 10 * 10"
    return f"""WITH {_joined(spec)}
SELECT min(t) AS min_sec, max(t) AS max_sec, {first} AS first_start,
       max(t) // 10 * 10 AS last_start, (max(t) // 10 * 10 - {first}) // 10 + 1 AS expected_windows
FROM joined"""


def _windowed_rows(spec: Job, size: int = 30) -> str:
    return f"""WITH {_windowed(spec, size=size)}
SELECT server_id, w AS window_start_sec, w + {size} AS window_end_sec,
       a AS {spec.first_out}, b AS {spec.second_out} FROM windowed"""


def _ingest(metric: str) -> str:
    return f"""WITH {MESSAGES}
SELECT server_id, ts, value AS {metric} FROM accepted WHERE metric = '{metric}'"""


def _summary(spec: Job, key: str = "ts") -> str:
    first = "min(t) // 10 * 10" if spec.clamp == "floor" else "(min(t) + 9) // 10 * 10"
    return f"""WITH {_windowed(spec, key=key)}
SELECT count(*) AS total_rows, count(*) + 1 AS rows_with_header,
       count(DISTINCT w) AS unique_windows, count(DISTINCT server_id) AS unique_servers,
       (SELECT (max(t) // 10 * 10 - {first}) // 10 + 1 FROM joined) AS expected_windows
FROM windowed"""


def _matched(spec: Job) -> str:
    return f"""WITH {_joined(spec)}
SELECT l.server_id, l.ts, '{spec.first}' AS metric, l.a AS value, n.k AS weight
FROM l JOIN (SELECT server_id, ts, count(*) AS k FROM r GROUP BY ALL) n
  ON l.server_id = n.server_id AND l.ts = n.ts
UNION ALL
SELECT r.server_id, r.ts, '{spec.second}', r.b, n.k
FROM r JOIN (SELECT server_id, ts, count(*) AS k FROM l GROUP BY ALL) n
  ON r.server_id = n.server_id AND r.ts = n.ts"""


def _published_day(spec: Job) -> str:
    """Every reading on one day, whatever its own; windows the day's stream has closed."""
    start, end = (
        f"strftime(make_timestamp((({DAY_START} + {w}) * 1000000)::bigint), '%Y-%m-%d %H:%M:%S')"
        for w in ("w", "w + 30")
    )
    return f"""WITH {_windowed(spec, clamp="none")}
SELECT server_id, {start} AS window_start, {end} AS window_end,
       a AS {spec.first_out}, b AS {spec.second_out}, {_label(spec)} AS alert
FROM windowed WHERE w + 30 <= (SELECT max({_seconds("ts")}) - {DAY_DELAY_SECONDS} FROM wide)"""


# Windows the watermark has passed when the input is used up.
CLOSED = f"""WHERE w + 30 <= (
  SELECT max(cast(epoch(event_time) AS bigint)) - {DELAY_SECONDS} FROM wide)"""

# A message of no known server that is published again has a place of its own and stays.
REPLAYED_UNKNOWN = """UNION ALL
SELECT metric, kind, server_id, ts, cast(epoch(event_time) AS bigint), value
FROM accepted WHERE ts <> '' AND server_id = 'unknown' AND day(record_ts) <= 15"""

ORACLE: dict[str, str] = {
    "scan_wide": f"""WITH {WIDE}
SELECT ts, server_id, cpu_pct, mem_pct, net_in, net_out, disk_io FROM wide""",
    "scan_wide_csv": f"""WITH {WIDE}
SELECT ts, server_id, cpu_pct, mem_pct, net_in, net_out, disk_io FROM wide
WHERE event_id % 61 <> 0""",
    "scan_wide_rejects": f"""WITH {WIDE}
SELECT ts, server_id, 'n/a' AS cpu_pct FROM wide WHERE event_id % 61 = 0""",
    "publish_envelopes": f"""WITH {WIDE}
SELECT topic, event_id AS "offset", ts AS "timestamp", server_id,
       CASE WHEN topic = 'topic-cpu' THEN cpu_pct END AS cpu_pct,
       CASE WHEN topic = 'topic-mem' THEN mem_pct END AS mem_pct,
       CASE WHEN topic = 'topic-net' THEN net_in END AS net_in,
       CASE WHEN topic = 'topic-net' THEN net_out END AS net_out,
       CASE WHEN topic = 'topic-disk' THEN disk_io END AS disk_io
FROM wide CROSS JOIN (VALUES ('topic-cpu'), ('topic-mem'), ('topic-net'), ('topic-disk')) t(topic)""",
    "ingest_cpu": _ingest("cpu_pct"),
    "ingest_mem": _ingest("mem_pct"),
    "ingest_net": _ingest("net_in"),
    "ingest_disk": _ingest("disk_io"),
    "ingest_rejects": f"""WITH {MESSAGES}
SELECT topic, event_id AS "offset", reason FROM parsed WHERE reason IS NOT NULL""",
    "ingest_counts": f"""WITH {MESSAGES}
SELECT coalesce(kind, 'total') AS kind,
       count(*) FILTER (WHERE reason IS NULL) AS messages,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rejected,
       count(*) FILTER (WHERE reason IS NULL AND server_id = 'unknown') AS unknown_server
FROM parsed GROUP BY ROLLUP (kind)""",
    "ingest_every_10th": f"""WITH {MESSAGES},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY record_minute, event_id) AS ordinal FROM accepted)
SELECT kind, ordinal, server_id, ts, value, event_id AS "offset" FROM numbered
WHERE ordinal % 10 = 0""",
    "dedup_readings": f"""WITH {DEDUPED}
SELECT metric, server_id, ts, value, event_id AS "offset" FROM deduped""",
    "join_cpu_mem": _joined_rows(CPU_MEM),
    "join_net_disk": _joined_rows(NET_DISK),
    "time_of_day": f"""WITH {WIDE}
SELECT event_id AS "offset",
       CASE WHEN event_id % 5 <> 4 THEN ts END AS ts,
       CASE WHEN event_id % 5 <> 4 THEN {_seconds("ts")} END AS time_sec,
       CASE WHEN event_id % 5 <> 4
            THEN cast(epoch(strptime('1970-01-01 ' || ts, '%Y-%m-%d %H:%M:%S')) AS bigint)
       END AS event_sec
FROM wide""",
    "bounds_cpu_mem": _bounds(CPU_MEM),
    "bounds_net_disk": _bounds(NET_DISK),
    "windows_exploded": f"""WITH {_joined(CPU_MEM)},
slots AS (
  SELECT server_id, ts, t, t // 10 * 10 AS base_window, t // 10 * 10 - k AS w
  FROM joined CROSS JOIN (VALUES (0), (10), (20)) AS offsets(k))
SELECT server_id, ts, t AS time_sec, base_window, w AS window_start_sec,
       w + 30 AS window_end_sec, cast(count(*) AS double) AS joined_rows
FROM slots
WHERE w >= (SELECT min(t) // 10 * 10 FROM joined) AND w <= (SELECT max(t) // 10 * 10 FROM joined)
  AND t >= w AND t < w + 30
GROUP BY server_id, ts, t, base_window, w""",
    "windowed_avg": _windowed_rows(CPU_MEM),
    "windowed_max": _windowed_rows(NET_DISK),
    "windowed_avg_25s": _windowed_rows(CPU_MEM, size=25),
    "alerts_cpu_mem": _alerts(CPU_MEM),
    "alerts_net_disk": _alerts(NET_DISK),
    "alerts_net_disk_flood_label": _alerts(FLOOD),
    "alerts_cpu_mem_unclamped": _alerts(CPU_MEM, clamp="none"),
    "alerts_cpu_mem_panes": _alerts(CPU_MEM),
    "alerts_cpu_mem_event_time": _alerts(CPU_MEM, key="event_time"),
    "alerts_cpu_mem_messages": _alerts(CPU_MEM, source="accepted"),
    "alerts_net_disk_messages": _alerts(NET_DISK, source="accepted"),
    "alerts_cpu_mem_dedup": _alerts(CPU_MEM, source="deduped"),
    "alerts_net_disk_dedup": _alerts(NET_DISK, source="deduped"),
    "validation_summary": _summary(CPU_MEM),
    "validation_summary_net_disk": _summary(NET_DISK),
    "validation_summary_event_time": _summary(CPU_MEM, key="event_time"),
    "matched_readings_cpu_mem": _matched(CPU_MEM),
    "matched_readings_net_disk": _matched(NET_DISK),
    "first_20": _alerts(CPU_MEM, tail="ORDER BY server_id, window_start LIMIT 20"),
    "last_20": _alerts(CPU_MEM, tail="ORDER BY window_start DESC, server_id LIMIT 20"),
    "csv_roundtrip": _alerts(CPU_MEM),
    "csv_roundtrip_net_disk": _alerts(NET_DISK),
    "stream_ingest": f"""WITH {MESSAGES}
SELECT metric, server_id, ts, value, event_id AS "offset" FROM accepted""",
    "stream_dedup": f"""WITH {DEDUPED}
SELECT metric, kind, server_id, ts, cast(epoch(event_time) AS bigint) AS event_sec, value
FROM deduped WHERE ts <> ''
""" + REPLAYED_UNKNOWN,
    "stream_alerts_cpu_mem": _alerts(CPU_MEM, key="event_time", clamp="none", where=CLOSED),
    "stream_alerts_net_disk": _alerts(NET_DISK, key="event_time", clamp="none", where=CLOSED),
    "scan_wide_other_layout": f"""WITH {WIDE}
SELECT ts, server_id, cpu_pct, mem_pct, net_in, net_out, disk_io FROM wide""",
    "metric_csv_other_layout": f"""WITH {WIDE} SELECT server_id, ts, net_in FROM wide""",
    "published_files": f"""WITH {WIDE}
SELECT metric, server_id, ts, value FROM (
  SELECT server_id, ts, unnest(['cpu_pct', 'mem_pct', 'net_in', 'disk_io']) AS metric,
         unnest([cpu_pct, mem_pct, net_in, disk_io]) AS value FROM wide)""",
    "published_day_alerts": _published_day(CPU_MEM),
    "strict_ingest": f"""WITH {WIDE}
SELECT metric, server_id, ts, value FROM (
  SELECT server_id, ts, unnest(['cpu_pct', 'mem_pct', 'net_in', 'disk_io']) AS metric,
         unnest([cpu_pct, mem_pct, net_in, disk_io]) AS value FROM wide)""",
    "stream_resume": f"""WITH {MESSAGES}
SELECT metric, server_id, ts, value, event_id AS "offset" FROM accepted""",
    "stream_replay": f"""WITH {MESSAGES}
SELECT metric, server_id, ts, value, event_id AS "offset", cast(2 AS bigint) AS copies
FROM accepted""",
    "stream_rejects": f"""WITH {MESSAGES}
SELECT kind, event_id AS "offset", reason FROM parsed WHERE reason IS NOT NULL""",
    "stream_late": _alerts(CPU_MEM, key="event_time", clamp="none", where=CLOSED),
    "alerts_kept_when_empty": _alerts(CPU_MEM),
    "every_10th_of_two_publishes": f"""WITH {WIDE},
sent AS (
  SELECT kind, p AS "partition", event_id, server_id, ts, date_trunc('minute', record_ts) AS m
  FROM wide CROSS JOIN (VALUES (1), (2)) AS publishes(p)
  CROSS JOIN (VALUES ('cpu'), ('mem'), ('network'), ('disk')) AS kinds(kind)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY m, "partition", event_id) AS ordinal
  FROM sent)
SELECT kind, ordinal, "partition", event_id AS "offset", server_id, ts FROM numbered
WHERE ordinal % 10 = 0""",
    "dedup_two_publishes": f"""WITH {WIDE}
SELECT metric, server_id, ts, value, min(event_id) AS "offset"
FROM (
  SELECT server_id, ts, event_time, event_id,
         unnest(['cpu_pct', 'mem_pct', 'net_in', 'disk_io']) AS metric,
         unnest([cpu_pct, mem_pct, net_in, disk_io]) AS value FROM wide)
GROUP BY metric, server_id, ts, event_time, value""",
    "ingest_trailing_text": f"""WITH {WIDE}
SELECT topic, event_id AS "offset", 'malformed' AS reason
FROM wide CROSS JOIN (VALUES ('topic-cpu'), ('topic-mem'), ('topic-net'), ('topic-disk')) t(topic)
WHERE event_id % 53 = 0 AND event_id % 4 <> 3""",
    "ingest_json_types": f"""WITH {WIDE}
SELECT topic, event_id AS "offset", server_id,
       CASE WHEN event_id % 3 = 2 THEN 7.5
            WHEN event_id % 3 = 0 AND topic IN ('topic-net', 'topic-disk') THEN 1.0 END AS value,
       CASE WHEN event_id % 3 = 1 AND topic IN ('topic-net', 'topic-disk') THEN 'bad_value' END AS reason
FROM wide CROSS JOIN (VALUES ('topic-cpu'), ('topic-mem'), ('topic-net'), ('topic-disk')) t(topic)
WHERE event_id % 59 = 0""",
    "joined_rows_cpu_mem": f"""WITH {_joined(CPU_MEM)}
SELECT server_id, ts, a AS cpu_pct, b AS mem_pct FROM joined""",
    "join_cpu_mem_bucketed": _joined_rows(CPU_MEM),
    "stream_join_cpu_mem": f"""WITH {WIDE}
SELECT l.server_id, cast(epoch(l.event_time) AS bigint) AS event_sec, l.cpu_pct, r.mem_pct
FROM wide l JOIN wide r ON l.server_id = r.server_id AND l.event_time = r.event_time""",
    "stream_alerts_cpu_mem_clamped": _alerts(CPU_MEM, key="event_time", where=CLOSED),
    "stream_alerts_net_disk_clamped": _alerts(NET_DISK, key="event_time", where=CLOSED),
    "consumer_csv": f"""WITH {MESSAGES}
SELECT metric, server_id, ts, value FROM accepted""",
    "consumer_totals": f"""WITH {MESSAGES}
SELECT coalesce(kind, 'total') AS kind,
       count(*) FILTER (WHERE reason IS NULL) AS messages,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rejected,
       count(*) FILTER (WHERE reason IS NULL AND server_id = 'unknown') AS unknown_server
FROM parsed GROUP BY ROLLUP (kind)""",
    "consumer_every_10th": f"""WITH {MESSAGES},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY record_minute, event_id) AS ordinal FROM accepted)
SELECT kind, ordinal, server_id, ts, value, event_id AS "offset" FROM numbered
WHERE ordinal % 10 = 0""",
    "published_log": f"""WITH {WIDE}
SELECT topic, count(*) AS messages, 0 AS first_offset, count(*) - 1 AS last_offset,
       count(*) AS offsets, cast(sum({DAY_START} + {_seconds("ts")}) AS bigint) AS seconds
FROM wide CROSS JOIN (VALUES ('topic-cpu'), ('topic-mem'), ('topic-net'), ('topic-disk')) t(topic)
GROUP BY topic""",
    "late_rows": f"""WITH {WIDE}
SELECT metric, server_id, cast(epoch(event_time) AS bigint) AS event_sec, 1000.0 AS value
FROM wide CROSS JOIN (VALUES ('cpu_pct'), ('mem_pct')) m(metric)
WHERE record_ts < (SELECT max(record_ts) FROM wide) - INTERVAL 1 HOUR""",
    "late_counts": f"""WITH {WIDE}
SELECT cast(epoch(max(event_time)) AS bigint) AS latest, 2 * count(*) AS on_time,
       2 * count(*) FILTER (WHERE record_ts < (SELECT max(record_ts) FROM wide) - INTERVAL 1 HOUR) AS late,
       0 AS timeless
FROM wide""",
    "late_parted_alerts": _alerts(CPU_MEM, key="event_time", clamp="none", where=CLOSED),
}
