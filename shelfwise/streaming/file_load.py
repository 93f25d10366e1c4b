"""Incremental load of raw files into Bronze with the files' names kept in a table, not in memory."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.bronze import LOADED, REJECTED, load_counts, parse_lines
from shelfwise.schema import MAX_LOAD_FILES, RAW_FILE_GLOB, RAW_PATH_REGEX
from shelfwise.sources.raw_files import list_raw, scan_files
from shelfwise.sources.tables import exists, overwrite_partitions

LOAD = "load"


@dataclass(frozen=True)
class LoadReport:
    """What one run of the load has done: blank lines are in none of the counts."""

    files: int = 0
    lines: int = 0
    loaded: int = 0
    rejected: int = 0

    def __add__(self, other: LoadReport) -> LoadReport:
        return LoadReport(
            self.files + other.files, self.lines + other.lines, self.loaded + other.loaded, self.rejected + other.rejected
        )


def load_files(
    spark: SparkSession,
    raw: str,
    bronze: str,
    log: str,
    name_glob: str = RAW_FILE_GLOB,
    path_regex: str | None = RAW_PATH_REGEX,
    max_files: int = MAX_LOAD_FILES,
) -> LoadReport:
    """Load every file below ``raw`` once; run again, it loads only new files, however old these are.

    The names of loaded files are a table below ``log``, with which Spark joins the files
    that are there; a driver holds the names of one load, at most ``max_files``, and no age of a
    file is ever too old. Each load is a partition of the Bronze table, so ``read_bronze`` and
    ``read_rejects`` read it like one that ``load_bronze`` has written.

    A load is planned, written and then marked as done. One that was cut off is taken up again
    first, with the files of its plan, and writes only what is not there yet: nothing is lost or
    loaded twice. One run at a time. Lines are counted in the pass that writes them.
    """
    if exists(spark, f"{bronze}/_spark_metadata"):
        raise ValueError(f"{bronze} is written by a stream; go on with load_bronze, or load into a new folder")
    report, number = LoadReport(), _resume(spark, log)
    while True:
        planned = _planned(spark, log).where(F.col(LOAD) == number)
        if planned.isEmpty():
            new = list_raw(spark, raw, name_glob, path_regex).join(_planned(spark, log), "path", "left_anti")
            chosen = new.select("path", F.lit(number).alias(LOAD)).orderBy("path").limit(max_files)
            overwrite_partitions(chosen.coalesce(1), f"{log}/planned", (LOAD,))
            planned = _planned(spark, log).where(F.col(LOAD) == number)
        paths = [row["path"] for row in planned.select("path").collect()]
        if not paths:
            return report
        report += _load(spark, paths, bronze, number)
        overwrite_partitions(spark.range(1).select(F.lit(number).alias(LOAD), F.lit(len(paths)).alias("files")), f"{log}/done", (LOAD,))
        number += 1


def _planned(spark: SparkSession, log: str) -> DataFrame:
    return _log_table(spark, f"{log}/planned", f"path string, {LOAD} int")


def _log_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _resume(spark: SparkSession, log: str) -> int:
    """The number of the first load that is not done."""
    done = _log_table(spark, f"{log}/done", f"files int, {LOAD} int").agg(F.max(LOAD)).first()[0]
    return 0 if done is None else done + 1


def _load(spark: SparkSession, paths: list[str], bronze: str, number: int) -> LoadReport:
    parts = {status: f"{bronze}/status={status}/{LOAD}={number}" for status in (LOADED, REJECTED)}
    missing = [status for status, path in parts.items() if not exists(spark, path)]
    parsed = parse_lines(scan_files(spark, paths), source_file=F.col("source_file"))
    if not missing:  # written, but not marked
        return LoadReport(len(paths), **parsed.agg(*load_counts()).first().asDict())
    counted = Observation("load")
    rows = parsed.observe(counted, *load_counts()).where(F.col("status").isin(missing)).withColumn(LOAD, F.lit(number))
    overwrite_partitions(rows, bronze, ("status", LOAD))
    return LoadReport(len(paths), **counted.get)
