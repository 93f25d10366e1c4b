"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import shared_dir

# The six ASCII white-space bytes, as a class for regular expressions.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs planned here drop their shuffle files at their end.

    Else they stay until the driver happens to collect its garbage, and a chain of large
    steps would hold all its shuffles at once.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def settled(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder, with a short lineage.

    Uses the folder of ``spark.checkpoint.dir``; only a local session without it gets
    a folder of its own. The files stay until the folder's owner removes them, or, with
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` on, until the last reference to the rows is collected.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    with _without_old_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written as Parquet below the shared folder and read back: columns can be pruned.

    Results may be read from there after an operator returns, so its files are the folder's owner's to remove.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with _without_old_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bucket(key: str | Column, modulus: int) -> Column:
    """The document folds of the contracts: crc32 of the key as text, modulo."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(schema, held)
            held = []
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema,
    )


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""
