"""Command line: publish wide readings, ingest or consume messages, run the two alerting jobs.

spark-submit or ``python -m metricwin <command> --help``.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from metricwin.operators.ingest import dedup
from metricwin.operators.publish import envelopes
from metricwin.plans.jobs import csv_readings, run_alert_job
from metricwin.session import configure
from metricwin.sinks.log import publish_log
from metricwin.sinks.tables import publish_files, publish_kafka, stamped
from metricwin.sources.csv_tables import read_wide_text, wide_rows
from metricwin.sources.topics import file_stream, kafka_stream
from metricwin.specs import CPU_MEM, TOPICS, net_disk_spec
from metricwin.streaming.alerts import start_alerts, stream_alerts
from metricwin.streaming.consumer import start_consumer
from metricwin.streaming.ingest import (
    read_landed,
    run_folder,
    start_ingest,
    start_table,
    stream_landed,
)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="metricwin")
    commands = parser.add_subparsers(dest="command", required=True)

    publish = commands.add_parser("publish", help="wide CSV to messages")
    publish.add_argument("--wide-csv", required=True)
    publish.add_argument("--on-bad", choices=("reject", "fail"), default="reject")
    publish.add_argument(
        "--date", type=date.fromisoformat, help="with --folder: the day the readings are of"
    )
    target = publish.add_mutually_exclusive_group(required=True)
    target.add_argument("--kafka", help="bootstrap servers")
    target.add_argument("--folder")
    publish.add_argument(
        "--name", help="with --folder: gapless offsets per topic; a name is published once"
    )

    ingest = commands.add_parser("ingest", help="messages to landed readings")
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--folder")
    ingest.add_argument("--out", required=True, help="each run gets a folder below")
    ingest.add_argument("--replay", action="store_true", help="read everything again, as a new run")
    ingest.add_argument("--strict", action="store_true", help="fail on text that is no JSON object")
    ingest.add_argument("--interval", help="keep running, one batch per interval")
    ingest.add_argument(
        "--date", type=date.fromisoformat, help="the day the readings are of, if they are of one"
    )
    ingest.add_argument("--max-offsets", type=int, help="with --kafka: messages per batch")
    ingest.add_argument("--min-partitions", type=int, help="with --kafka: tasks per batch")
    ingest.add_argument("--files-per-batch", type=int, help="with --folder")
    ingest.add_argument("--spread", type=int, default=1, help="files a batch adds to a folder")

    consume = commands.add_parser("consume", help="messages to metric CSV tables, totals and a report")
    consume.add_argument("--folder", required=True)
    consume.add_argument("--out", required=True)
    consume.add_argument("--every", type=int, default=10, help="report every so many messages of a kind")
    consume.add_argument("--strict", action="store_true", help="fail on text that is no JSON object")
    consume.add_argument("--interval", help="keep running, one batch per interval")
    consume.add_argument("--date", type=date.fromisoformat, help="the day the readings are of")
    consume.add_argument("--files-per-batch", type=int)

    for name in ("cpu-mem", "net-disk"):
        job = commands.add_parser(name, help=f"{name} alerts")
        job.add_argument("--readings", nargs="+", help="folders of ingest runs")
        job.add_argument("--first-csv")
        job.add_argument("--second-csv")
        job.add_argument("--out", required=True)
        job.add_argument(
            "--dedup", action="store_true", help="count copies of a reading, as of a replay, once"
        )
        job.add_argument("--report", action="store_true")
        job.add_argument("--label-style", default="possible", help="net-disk only")
        job.add_argument("--stream", action="store_true", help="over one run as a stream")
        job.add_argument("--delay", default="1 minute", help="with --stream")
        job.add_argument("--interval", help="with --stream: keep running")
        job.add_argument("--files-per-batch", type=int, help="with --stream")
        job.add_argument(
            "--data-start", type=datetime.fromisoformat, help="with --stream: drop windows before"
        )
    return parser


def _alert_command(spark: SparkSession, args: argparse.Namespace) -> None:
    cpu_mem = args.command == "cpu-mem"
    spec = CPU_MEM if cpu_mem else net_disk_spec(args.label_style)
    if args.stream:
        landed = stream_landed(spark, args.readings[0], args.files_per_batch)
        if args.data_start is None:
            query = start_alerts(landed, spec, args.out, args.delay, args.interval, args.dedup)
        else:
            result = stream_alerts(landed, spec, args.delay, args.data_start, args.dedup)
            query = start_table(result, args.out, args.interval)
        query.awaitTermination()
        return
    if args.readings:
        readings = read_landed(spark, *args.readings)
        readings = dedup(readings) if args.dedup else readings
    else:
        readings = csv_readings(spark, args.first_csv, args.second_csv, spec)
    # Only the CPU/MEM job leaves its output alone when there is nothing to write.
    run_alert_job(readings, spec, args.out, skip_empty=cpu_mem, report=args.report)


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.command in ("cpu-mem", "net-disk"):
        if not args.readings and not (args.first_csv and args.second_csv):
            parser.error("give --readings, or --first-csv and --second-csv")
        if args.stream and len(args.readings or []) != 1:
            parser.error("--stream needs the --readings of one run")
        if args.dedup and not args.readings:
            parser.error("--dedup needs --readings: CSV tables do not tell messages apart")
    spark = configure(SparkSession.builder.appName(f"metricwin-{args.command}").getOrCreate())
    if args.command == "publish":
        messages = envelopes(wide_rows(read_wide_text(spark, args.wide_csv), args.on_bad))
        if args.kafka:
            publish_kafka(messages, args.kafka)
        elif args.name:
            publish_log(messages, args.folder, args.name, args.date)
        else:
            # A folder has no broker to stamp messages.
            publish_files(stamped(messages, args.date), args.folder)
    elif args.command == "consume":
        messages = file_stream(spark, args.folder, args.files_per_batch)
        start_consumer(
            messages, args.out, args.interval, args.every, args.strict, args.date
        ).awaitTermination()
    elif args.command == "ingest":
        if args.kafka:
            messages = kafka_stream(
                spark, args.kafka, TOPICS, args.max_offsets, args.min_partitions
            )
        else:
            messages = file_stream(spark, args.folder, args.files_per_batch)
        folder = run_folder(args.out, args.replay)
        print(f"run folder: {folder}", flush=True)
        start_ingest(
            messages, folder, args.interval, args.strict, args.date, args.spread
        ).awaitTermination()
    else:
        _alert_command(spark, args)


if __name__ == "__main__":
    main()
