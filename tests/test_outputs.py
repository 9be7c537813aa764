import glob
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from metricwin.__main__ import main
from metricwin.operators import pairing, windows
from metricwin.plans import alerts
from metricwin.plans.jobs import run_alert_job
from metricwin.schemas import alert_schema
from metricwin.sinks.tables import read_alerts, write_alerts
from metricwin.sources.events import read_events, wide_readings
from metricwin.specs import CPU_MEM, NET_DISK
from metricwin.storage import clean, fresh_dir, shared_dir
from metricwin.streaming.alerts import read_alert_batches
from metricwin.streaming.consumer import consumed_csv, consumed_totals
from metricwin.streaming.ingest import run_folder


@pytest.fixture(scope="module")
def readings(spark, data):
    return pairing.readings_of(wide_readings(read_events(spark, data)), CPU_MEM)


def parts(path):
    return sorted(glob.glob(f"{path}/part-*.csv"))


def test_parts_are_headed_and_in_order(spark, readings, tmp_path):
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = alerts.sorted_alerts(readings, CPU_MEM)
        assert write_alerts(ordered, path)
        assert write_alerts(ordered, f"{path}-checked", skip_empty=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for folder in (path, f"{path}-checked"):
        lines = [open(p).read().splitlines() for p in parts(folder)]
        assert len(lines) > 1
        assert {own[0] for own in lines} == {"server_id,window_start,window_end,avg_cpu,avg_mem,alert"}
        keys = [tuple(line.split(",")[:2]) for own in lines for line in own[1:]]
        assert keys == sorted(keys) and len(keys) == ordered.count()


def test_nothing_is_left_behind(spark, readings, tmp_path):
    before = set(glob.glob(f"{shared_dir(spark)}/*"))
    run_alert_job(readings, CPU_MEM, str(tmp_path / "out"), report=True)
    run_alert_job(readings.where(F.lit(False)), CPU_MEM, str(tmp_path / "out"), report=True)
    assert set(glob.glob(f"{shared_dir(spark)}/*")) == before
    assert glob.glob(f"{tmp_path}/*") == [str(tmp_path / "out")]
    assert parts(str(tmp_path / "out"))


def test_clean_removes_intermediates(spark):
    path = fresh_dir(spark, "mine")
    spark.range(3).write.parquet(path)
    clean(spark)
    assert not glob.glob(f"{path}*")


def test_labels_survive_the_round_trip(spark, readings, tmp_path):
    path = str(tmp_path / "out")
    ordered = alerts.sorted_alerts(readings, CPU_MEM)
    write_alerts(ordered, path)
    back = read_alerts(spark, path, alert_schema(CPU_MEM))
    assert back.dtypes == ordered.dtypes
    assert back.exceptAll(ordered).isEmpty() and ordered.exceptAll(back).isEmpty()
    assert not back.where("alert = ''").isEmpty()


def test_empty_result(readings, tmp_path):
    nothing = readings.where(F.lit(False))
    skipped, written = str(tmp_path / "skipped"), str(tmp_path / "written")
    assert not run_alert_job(nothing, CPU_MEM, skipped, skip_empty=True)
    assert not glob.glob(f"{skipped}/*")
    assert run_alert_job(nothing, NET_DISK, written, skip_empty=False)
    (part,) = parts(written)
    assert open(part).read().strip() == "server_id,window_start,window_end,max_net_in,max_disk_io,alert"


def test_report_writes_the_same(readings, tmp_path, capsys):
    plain, reported = str(tmp_path / "plain"), str(tmp_path / "reported")
    run_alert_job(readings, CPU_MEM, plain)
    run_alert_job(readings, CPU_MEM, reported, report=True)

    def whole(path):
        return [line for p in parts(path) for line in open(p).read().splitlines()[1:]]

    assert whole(plain) == whole(reported)
    assert "expected_windows" in capsys.readouterr().out


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")


# -- command line -------------------------------------------------------------------------


def test_command_line_end_to_end(spark, data, tmp_path):
    d = {n: str(tmp_path / n) for n in ("wide", "topic", "landed", "cm", "nd", "st")}
    wide = wide_readings(read_events(spark, data))
    columns = ["ts", "server_id", "cpu_pct", "mem_pct", "net_in", "net_out", "disk_io"]
    wide.select(*columns).write.option("header", True).csv(d["wide"])
    main(["publish", "--wide-csv", d["wide"], "--folder", d["topic"]])
    main(["ingest", "--folder", d["topic"], "--out", d["landed"]])
    run = run_folder(d["landed"])
    main(["cpu-mem", "--readings", run, "--out", d["cm"], "--report"])
    main(["net-disk", "--readings", run, "--out", d["nd"], "--label-style", "flood"])
    for spec, out in ((CPU_MEM, d["cm"]), (NET_DISK, d["nd"])):
        want = alerts.alerts(pairing.readings_of(wide, spec), spec)
        got = read_alerts(spark, out, alert_schema(spec))
        if spec is NET_DISK:
            assert got.where("alert = 'Possible DDoS'").isEmpty()
            got, want = got.drop("alert"), want.drop("alert")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    main(["cpu-mem", "--readings", run, "--out", d["st"], "--stream"])
    assert read_alert_batches(spark, d["st"], CPU_MEM).columns == alert_schema(CPU_MEM).names
    log, consumed = str(tmp_path / "log"), str(tmp_path / "consumed")
    for _ in range(2):
        main(["publish", "--wide-csv", d["wide"], "--folder", log, "--name", "one", "--date", "2024-01-01"])
        main(["consume", "--folder", log, "--out", consumed, "--date", "2024-01-01", "--every", "100"])
    assert {r.kind: r.messages for r in consumed_totals(spark, consumed).collect()}["total"] == 4000
    assert consumed_csv(spark, consumed, "disk_io").count() == 1000
    with pytest.raises(SystemExit):
        main(["cpu-mem", "--out", d["cm"]])


# -- plans --------------------------------------------------------------------------------


def whole(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["alerts_cpu_mem", "alerts_net_disk", "alerts_cpu_mem_messages", "windows_exploded", "validation_summary"])
def test_bounds_reuse_the_shuffle(spark, data, name):
    assert "ReusedExchange" in whole(entry_module.queries()[name](spark, data))


def executed(df):
    """The plans that ran, without those they began as."""
    lines, shown = [], True
    for line in whole(df).split("\n"):
        if "== Initial Plan ==" in line:
            shown = False
        elif "== Final Plan ==" in line:
            shown = True
        if shown:
            lines.append(line)
    return "\n".join(lines)


def test_every_nth_reads_and_parses_once(spark, data):
    plan = executed(entry_module.queries()["ingest_every_10th"](spark, data))
    # The input was read when the numbered readings were written.
    assert "from_json" not in plan and "events.parquet" not in plan
    assert "metricwin-numbered" in plan


@pytest.mark.parametrize("spec", [CPU_MEM, NET_DISK], ids=["cpu_mem", "net_disk"])
def test_alerts_compute_the_input_once(spark, readings, spec):
    """Rows are counted as they pass: the windows' bound needs no second pass."""
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    rows = wide_readings(read_events(spark, "/root/testdata/sf0.001"))
    rows = pairing.readings_of(rows, spec)
    passing = rows.withColumn("value", F.udf(counted, "double").asNondeterministic()("value"))
    assert alerts.sorted_alerts(passing, spec).collect()
    assert seen.value == rows.count()


def test_summary_counts_windows_between_the_datas_ends(spark):
    """Raw clamp, readings at 5 and 44 seconds: windows from 10 to 40, one of them empty."""
    rows = [("s", f"00:00:{s:02d}", m, 1.0) for s in (5, 44) for m in NET_DISK.metrics]
    frame = spark.createDataFrame(rows, "server_id string, ts string, metric string, value double")
    limits = windows.bounds(alerts.timed_pairs(frame, NET_DISK), NET_DISK)
    (row,) = alerts.validation_summary(alerts.kept_windows(frame, NET_DISK), limits).collect()
    assert (row.expected_windows, row.unique_windows) == (4, 3)


def test_summary_tells_days_apart(spark):
    spec = replace(CPU_MEM, clock="event_time")
    times = [datetime(2024, 1, d, 10, 0, 5, tzinfo=timezone.utc) for d in (1, 2)]
    rows = [("s", t, m, 1.0) for t in times for m in spec.metrics]
    frame = spark.createDataFrame(
        rows, "server_id string, event_time timestamp, metric string, value double"
    )
    limits = windows.bounds(alerts.timed_pairs(frame, spec), spec)
    (row,) = alerts.validation_summary(alerts.kept_windows(frame, spec), limits).collect()
    assert row.unique_windows == row.total_rows == 4


def test_matched_readings_are_the_joins(spark):
    rows = [("s", "00:00:01", "cpu_pct", v) for v in (1.0, 2.0)]
    rows += [("s", "00:00:01", "mem_pct", v) for v in (5.0, 6.0, 7.0)]
    rows += [("s", "00:00:02", "cpu_pct", 9.0), (None, "00:00:01", "mem_pct", 9.0)]
    frame = spark.createDataFrame(rows, "server_id string, ts string, metric string, value double")
    got = sorted((r.metric, r.value, r.weight) for r in pairing.matched_readings(frame, CPU_MEM).collect())
    assert got == [("cpu_pct", 1.0, 3), ("cpu_pct", 2.0, 3), ("mem_pct", 5.0, 2), ("mem_pct", 6.0, 2), ("mem_pct", 7.0, 2)]


def test_no_row_by_row_join(spark, data):
    for name in ("join_cpu_mem", "alerts_cpu_mem", "alerts_net_disk"):
        plan = whole(entry_module.queries()[name](spark, data))
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_copies_are_combined_before_the_shuffle(spark, data):
    plan = entry_module.queries()["join_cpu_mem"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")


def test_scan_reads_only_what_it_needs(spark, data):
    plan = entry_module.queries()["bounds_cpu_mem"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan and "event_id" not in plan


def test_single_topic_is_filtered_before_parsing(spark, data, tmp_path):
    from metricwin.operators import ingest
    from metricwin.operators.publish import envelopes
    from metricwin.sinks.tables import publish_files, stamped
    from metricwin.sources.topics import file_batch

    folder = str(tmp_path / "topic")
    publish_files(stamped(envelopes(wide_readings(read_events(spark, data)))), folder)
    messages = file_batch(spark, folder)
    readings = ingest.accepted(ingest.parse_envelopes(messages, topics=["topic-cpu"]))
    plan = ingest.metric_table(readings, "cpu_pct")._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Generate explode(array(from_json", 1)[1]
    assert "EqualTo(topic,topic-cpu)" in below
    assert plan.count("from_json") == 1


def test_panes_do_not_change_results(readings):
    plain = alerts.alerts(readings, CPU_MEM)
    panes = alerts.alerts(readings, replace(CPU_MEM, panes=True))
    assert plain.exceptAll(panes).isEmpty() and panes.exceptAll(plain).isEmpty()
