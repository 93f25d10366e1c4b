"""Reading and rewriting lakehouse tables by path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise.operators.bronze import bronze_events, rejected_lines
from shelfwise.schema import BRONZE_LOG_SCHEMA


def full_refresh(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the table at ``path`` by ``df``. ``df`` must not read that table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace the partitions that ``df`` has rows of; all others stay. ``df`` may read the table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at the path."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with its declared schema, columns in its order, also when it holds no file yet."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The loaded events of a Bronze table; rejected lines sit in another partition."""
    return bronze_events(read_table(spark, path, BRONZE_LOG_SCHEMA))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that the Bronze load could not parse, with the file each came from."""
    return rejected_lines(read_table(spark, path, BRONZE_LOG_SCHEMA))


def write_bronze(parsed: DataFrame, path: str) -> None:
    """Write parsed lines as a Bronze table in one batch."""
    full_refresh(parsed, path, partition_by=("status",))


