"""Recursive scans of a raw prefix, one row per line of text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.schema import RAW_FILE_GLOB, RAW_PATH_REGEX, REMEMBER_FILES


def source_file() -> Column:
    return F.col("_metadata.file_path")


def _options(name_glob: str) -> dict[str, str]:
    return {"recursiveFileLookup": "true", "pathGlobFilter": name_glob}


def _lines(df: DataFrame, path_regex: str | None) -> DataFrame:
    lines = df.select("value", source_file().alias("source_file"))
    return lines if path_regex is None else lines.where(F.col("source_file").rlike(path_regex))


def scan_raw(
    spark: SparkSession, path: str, name_glob: str = RAW_FILE_GLOB, path_regex: str | None = RAW_PATH_REGEX
) -> DataFrame:
    """All lines of the matching files below ``path``, with the file each came from."""
    return _lines(spark.read.options(**_options(name_glob)).text(path), path_regex)


def list_raw(
    spark: SparkSession, path: str, name_glob: str = RAW_FILE_GLOB, path_regex: str | None = RAW_PATH_REGEX
) -> DataFrame:
    """``path, length`` of the matching files below ``path``; no file is opened, and without any there is no row."""
    try:
        files = spark.read.format("binaryFile").options(**_options(name_glob)).load(path).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint")
    return files if path_regex is None else files.where(F.col("path").rlike(path_regex))


def scan_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines of the named files, with the file each came from."""
    return _lines(spark.read.text([_escaped(path) for path in paths]), None)


def _escaped(path: str) -> str:
    """The path as a pattern that matches it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def stream_raw(
    spark: SparkSession,
    path: str,
    name_glob: str = RAW_FILE_GLOB,
    path_regex: str | None = RAW_PATH_REGEX,
    max_bytes_per_trigger: int | None = None,
    archive: str | None = None,
    remember: str = REMEMBER_FILES,
) -> DataFrame:
    """Like ``scan_raw`` as a stream that reads every file once.

    The driver remembers each file it has read for as long as ``remember``. To keep that
    memory bounded over years, give an ``archive`` outside ``path``, into which Spark moves
    files once they are read, and a ``remember`` longer than any file may come late.
    """
    options = {**_options(name_glob), "maxFileAge": remember}
    if archive is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if max_bytes_per_trigger is not None:
        options["maxBytesPerTrigger"] = str(max_bytes_per_trigger)
    return _lines(spark.readStream.options(**options).text(path), path_regex)
