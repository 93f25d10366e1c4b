"""The jobs as commands: ``python -m shelfwise.jobs <job> …``."""

from __future__ import annotations

import argparse
import signal
import sys
import threading
from collections.abc import Sequence

from pyspark.sql import SparkSession

from shelfwise import Lakehouse, predict_stockouts, publish_predictions, publish_views, refresh, tune, update
from shelfwise.operators import run_report
from shelfwise.plans import publish_run, save_predictions
from shelfwise.schema import (
    DEFAULT_TOPIC,
    MAX_BATCH_EVENTS,
    MAX_TASK_EVENTS,
    RAW_FILE_GLOB,
    RAW_PATH_REGEX,
    REMEMBER_FILES,
)
from shelfwise.sources import read_bronze, read_topic
from shelfwise.streaming import LoadReport, land_raw, load_bronze, load_files, reported, run_stream


def _land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Until the process is told to end, and then to the end of the batch."""
    messages = read_topic(
        spark,
        args.servers,
        args.topic,
        max_events_per_batch=args.max_batch_events,
        max_events_per_task=args.max_task_events,
    )
    stop = threading.Event()
    before = {number: signal.signal(number, lambda *_: stop.set()) for number in (signal.SIGTERM, signal.SIGINT)}
    report = reported(spark)
    try:
        run_stream(
            lambda: land_raw(messages, args.raw, args.checkpoint, files_per_day=args.files_per_day), stop, args.retries
        )
    finally:
        spark.streams.removeListener(report)
        for number, handler in before.items():
            signal.signal(number, handler)


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.stream:
        query = load_bronze(
            spark,
            args.raw,
            args.bronze,
            args.checkpoint,
            name_glob=args.files,
            path_regex=args.paths,
            archive=args.archive,
            remember=args.remember,
        )
        query.awaitTermination()
        counts = [progress.observedMetrics["load"] for progress in query.recentProgress if progress.numInputRows]
        report = sum((LoadReport(0, **row.asDict()) for row in counts), LoadReport())
    else:
        report = load_files(spark, args.raw, args.bronze, args.checkpoint, name_glob=args.files, path_regex=args.paths)
    if report.files or report.lines:
        print(f"Lines read: {report.lines}, loaded: {report.loaded}, rejected: {report.rejected}")
    else:
        print(f"No new file below {args.raw} is named {args.files} and matches {args.paths}")


def _refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    mode = "quarantine" if args.quarantine else "raise"
    tables = refresh(
        spark, read_bronze(spark, args.bronze), args.out, on_cast_error=mode, overwrite=args.overwrite
    )
    if args.publish:
        publish_views(tables, args.bronze)
    if args.runs:
        print(f"Run {publish_run(tables, args.runs)} is the current one")


def _update(spark: SparkSession, args: argparse.Namespace) -> None:
    mode = "quarantine" if args.quarantine else "raise"
    tables = update(spark, args.bronze, args.out, args.checkpoint, on_cast_error=mode)
    if args.publish:
        publish_views(tables, args.bronze)


def _predict(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Lakehouse(spark, args.tables)
    predict_stockouts(tables, keep_keys=args.keep_keys)
    if args.table:
        save_predictions(tables, args.table)
    elif not args.no_publish:
        publish_predictions(tables, keyed=args.keep_keys)
    rows, top = run_report(tables.stockout_predictions)
    print(f"{rows} rows scored; those of highest risk:")
    top.show(truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shelfwise", description=__doc__)
    parser.add_argument("--shuffle-partitions", type=int, help="a few times the number of cores")
    jobs = parser.add_subparsers(required=True)

    def job(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    land = job("land", _land, "servers", "raw", "checkpoint")
    land.add_argument("--topic", default=DEFAULT_TOPIC)
    land.add_argument("--max-batch-events", type=int, default=MAX_BATCH_EVENTS)
    land.add_argument("--max-task-events", type=int, default=MAX_TASK_EVENTS)
    land.add_argument("--files-per-day", type=int, help="files a batch adds for a day, if not by its size")
    land.add_argument("--retries", type=int, default=3, help="failures in a row after which the job ends")
    load = job("load", _load, "raw", "bronze", "checkpoint")
    load.add_argument("--stream", action="store_true", help="load with a stream, which remembers files in memory")
    load.add_argument("--files", default=RAW_FILE_GLOB, help="name pattern of the raw files")
    load.add_argument("--paths", default=RAW_PATH_REGEX, help="regular expression that their paths match")
    load.add_argument("--archive", help="with --stream: folder to which loaded files are moved")
    load.add_argument("--remember", default=REMEMBER_FILES, help="with --stream: how long loaded files are remembered")
    full = job("refresh", _refresh, "bronze", "out")
    full.add_argument("--quarantine", action="store_true", help="set uncastable events aside")
    full.add_argument("--overwrite", action="store_true", help="replace a run that nobody reads")
    full.add_argument("--publish", action="store_true", help="point the catalog views at the result")
    full.add_argument("--runs", help="table of runs that gets this one as the current run")
    days = job("update", _update, "bronze", "out", "checkpoint")
    days.add_argument("--quarantine", action="store_true", help="set uncastable events aside")
    days.add_argument("--publish", action="store_true", help="point the catalog views at the tables")
    predict = job("predict", _predict, "tables")
    predict.add_argument("--keep-keys", action="store_true", help="write the table with keys as well")
    predict.add_argument("--no-publish", action="store_true", help="leave the catalog as it is")
    predict.add_argument("--table", help="declared table that gets the predictions, in place of a view")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(tune(SparkSession.builder.getOrCreate(), args.shuffle_partitions), args)


if __name__ == "__main__":
    main(sys.argv[1:])
