"""Exact deduplication with a split for heavy hitters.

Each text has a digest. Misra-Gries counters find the digests that are frequent; there
are at most ``counters`` of them whatever the input, so their verified winners can be
broadcast and their copies are settled on the map side. All other digests meet in an
ordinary shuffle, in which no group is large.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import BLANKS, settled, unused

# Of all rows, a digest with more than 2 / (COUNTERS + 1) is always found as frequent.
COUNTERS = 1000

_SUMMARY = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("rows", pa.int64())])


def normalised(text: Column) -> Column:
    """Each run of ASCII blanks becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _pruned(counts: Counter, k: int) -> Counter:
    """Misra-Gries: take the (k+1)-th largest count off all, and keep the positive ones."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return Counter({key: n - cut for key, n in counts.items() if n > cut})


def _summarise(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        rows = 0
        for part in parts:
            rows += part.num_rows
            seen = part.column(0).value_counts()
            counts.update(dict(zip(seen.field(0).to_pylist(), seen.field(1).to_pylist(), strict=True)))
            counts = _pruned(counts, k)
        if rows:
            keys, values = list(counts), list(counts.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *keys], pa.binary()), pa.array([0, *values], pa.int64()), pa.array([rows] + [0] * len(keys), pa.int64())],
                schema=_SUMMARY,
            )

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may be frequent: all with more than 2 / (counters + 1) of the rows, ``counters`` at most.

    Every task sends ``counters`` counts at most. Their sums fall short of the true
    count by less than rows / (counters + 1), and add up to no more than the rows, so
    fewer than ``counters`` + 1 of them can be above that.
    """
    summary = digests.select("digest").mapInArrow(
        _summarise(counters), "digest binary, n bigint, rows bigint"
    )
    sums = settled(summary.groupBy("digest").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")))
    rows = sums.agg(F.sum("rows")).first()[0] or 0
    return sums.where(F.col("digest").isNotNull() & (F.col("n") * (counters + 1) > rows)).select("digest")


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: ``key, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they have the same SHA-256 after each run of ASCII blanks has
    become one space; a null text is empty. Of equal texts the row with the smallest
    key stays. A null key counts as the largest; of rows with the same key and the
    same text one stays, whichever was read first. An empty table gives no row; other
    columns are not looked at.
    """
    row = F.struct(F.col(key).isNull().alias("late"), F.col(key).alias("key"), F.col("row").alias("row"))
    digests = settled(
        docs.select(
            F.col(key),
            F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    heavy = settled(frequent(digests, counters))
    # ``counters`` rows of 32 bytes at most: small enough for every task.
    candidates = F.broadcast(heavy)
    winners = settled(
        digests.join(candidates, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("group_size"))
    )
    common = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rare = (
        digests.join(candidates, "digest", "left_anti")
        .withColumn("first", F.min(row).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    return common.unionByName(rare).select(
        F.col(key),
        F.col("first.key").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The documents without their exact copies, all columns unchanged.

    Copies of frequent texts go on the map side; only the rest is shuffled. Rows that
    are equal in key and text count as copies of each other.
    """
    own, rank = unused(docs, "digest"), unused(docs, "rank")
    marked = docs.withColumn(own, F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)))
    heavy = settled(frequent(marked.select(F.col(own).alias("digest")), counters)).withColumnRenamed("digest", own)
    first = unused(docs, "first")
    firsts = settled(
        marked.join(F.broadcast(heavy), own, "left_semi")
        .groupBy(own)
        .agg(F.min(F.struct(F.col(key).isNull().alias("late"), F.col(key).alias("key"))).alias(first))
    )
    ours = marked.join(F.broadcast(firsts), own).where(F.col(first)["key"].eqNullSafe(F.col(key))).drop(first)
    # What is left of a frequent digest are the rows that share the winner's key.
    rest = marked.join(F.broadcast(heavy), own, "left_anti").unionByName(ours)
    ranked = rest.withColumn(rank, F.row_number().over(Window.partitionBy(own).orderBy(F.col(key).asc_nulls_last())))
    return ranked.where(F.col(rank) == 1).select(*docs.columns)
