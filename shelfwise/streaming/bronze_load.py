"""Incremental load of raw files into Bronze."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.bronze import load_counts, parse_lines
from shelfwise.schema import MAX_LOAD_BYTES, RAW_FILE_GLOB, RAW_PATH_REGEX, REMEMBER_FILES
from shelfwise.sources.raw_files import stream_raw


def load_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    name_glob: str = RAW_FILE_GLOB,
    path_regex: str | None = RAW_PATH_REGEX,
    max_bytes_per_trigger: int | None = MAX_LOAD_BYTES,
    trigger: dict | None = None,
    archive: str | None = None,
    remember: str = REMEMBER_FILES,
) -> StreamingQuery:
    """Load every file below ``raw`` once; run again, it loads only new files.

    A bad line is set aside and the rest of its file loads. Loaded events and
    rejected lines are two partitions of one table, written in the same pass; read
    them with ``read_bronze`` and ``read_rejects``.

    The counts of lines read, loaded and rejected stand in each batch's progress under
    ``load``. A large backlog loads in batches of ``max_bytes_per_trigger``, so a failure
    costs one batch and not the whole load. ``archive`` and ``remember`` are those of
    ``stream_raw``: they bound what is remembered of files already loaded, which a stream
    otherwise keeps in the driver's memory; ``load_files`` keeps it in a table.
    """
    lines = stream_raw(spark, raw, name_glob, path_regex, max_bytes_per_trigger, archive, remember)
    return (
        parse_lines(lines, source_file=F.col("source_file"))
        .observe("load", *load_counts())
        .writeStream.format("parquet")
        .partitionBy("status")
        .option("checkpointLocation", checkpoint)
        .option("path", bronze)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
