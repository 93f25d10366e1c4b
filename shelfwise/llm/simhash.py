"""SimHash near-deduplication by tiled exact comparison.

Distinct fingerprints are put into cells by the population counts of their segments. The
distance of two fingerprints is at least the sum of the differences of these counts, so a
pair of cells further apart than the radius is skipped as a whole. Cells are cut into
tiles of bounded size; a tile is one row with its fingerprints packed as bytes, and a task
compares a pair of tiles with exclusive-or and bit counts in numpy. It returns the edges
of a spanning forest, never all links, and the forests are joined by star contractions
on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import ASCII_LOWER, settled, unused, utf8, written
from shelfwise.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
# Segments whose population counts make the cells; more of them skip more and copy more.
SEGMENTS = 4
# Fingerprints in a tile: 32 kB packed, and 16 million comparisons for a pair.
TILE = 4096

_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64; no words give 0."""
    found = text.translate(ASCII_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(found))
    starts, ends = starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)), dtype=np.uint64, count=len(starts)
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[at : at + _BLOCK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(shingle: int, seed: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = np.array([fingerprint(t, shingle, seed) for t in utf8(part.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(values.view(np.int64))], names=["key", "fingerprint"]
            )

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``key, fingerprint`` for each document, the fingerprint's 64 bits as a signed number."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _fingerprints(shingle, seed), f"key {kind}, fingerprint bigint"
    )


def _with_fingerprint(column: str, name: str, shingle: int, seed: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = np.array([fingerprint(t, shingle, seed) for t in utf8(part.column(column))], dtype=np.uint64)
            yield part.append_column(name, pa.array(values.view(np.int64)))

    return run


def _cell(segments: int) -> Column:
    """The population counts of the segments, seven bits each, as one number."""
    bounds = [64 * k // segments for k in range(segments + 1)]
    cell = F.lit(0).cast("bigint")
    for low, high in zip(bounds, bounds[1:], strict=False):
        mask = ((1 << high) - 1) ^ ((1 << low) - 1)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        count = F.bit_count(F.col("fingerprint").bitwiseAND(F.lit(signed).cast("bigint"))).cast("bigint")
        cell = F.shiftleft(cell, 7) + count
    return cell


def _steps(segments: int, radius: int) -> list[int]:
    """Offsets from a cell to the cells within the radius that come after it, and to itself."""
    out = []
    for step in product(range(-radius, radius + 1), repeat=segments):
        offset = 0
        for difference in step:
            offset = (offset << 7) + difference
        if sum(map(abs, step)) <= radius and offset >= 0:
            out.append(offset)
    return out


def _tiles(distinct: DataFrame, segments: int, tile: int) -> DataFrame:
    """``cell, split, splits, packed``: the fingerprints of each tile as bytes, in cells cut by hash.

    There are at most (64 / segments + 1) ^ segments cells, so their sizes can be sent to
    every task.
    """
    celled = distinct.withColumn("cell", _cell(segments))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("splits"))
    split = F.pmod(F.xxhash64("fingerprint"), F.col("splits")).cast("int")
    return (
        celled.join(F.broadcast(settled(sizes)), "cell")
        .groupBy("cell", split.alias("split"), "splits")
        .agg(F.array_sort(F.collect_list("fingerprint")).alias("packed"))
    )


def _forest(radius: int):
    """Edges that join the fingerprints of a pair of tiles which are within the radius."""

    def edges(left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[int, int]]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        rows = max(1, (1 << 21) // max(1, len(right)))
        for at in range(0, len(left), rows):
            near = np.bitwise_count(left[at : at + rows, None] ^ right[None, :]) <= radius
            i, j = np.nonzero(near)
            for a, b in zip(left[at + i].tolist(), right[j].tolist(), strict=True):
                if (a < b or not same) and (x := root(a)) != (y := root(b)):
                    parent[x] = y
                    out.append((a, b))
        return out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found: list[tuple[int, int]] = []
            ours, theirs = part.column("packed"), part.column("other")
            for k, same in enumerate(part.column("same").to_pylist()):
                left = ours[k].values.to_numpy().view(np.uint64)
                right = theirs[k].values.to_numpy().view(np.uint64)
                found += edges(left, right, same)
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """``a, b``: forests of links between distinct fingerprints within the radius; none of the links' groups is lost."""
    tiles = settled(_tiles(distinct, segments, tile))
    steps = F.array(*[F.lit(x).cast("bigint") for x in _steps(segments, radius)])
    out = tiles.select(
        F.col("cell").alias("from_cell"), F.col("split").alias("from_split"), F.explode(steps).alias("step")
    ).select("from_cell", "from_split", (F.col("from_cell") + F.col("step")).alias("cell"))
    names = tiles.select("cell", "split")
    # Names of tiles only: the packed fingerprints are fetched for pairs of tiles that exist.
    wanted = out.join(names, "cell").where((F.col("cell") > F.col("from_cell")) | (F.col("split") >= F.col("from_split")))
    left = tiles.select(F.col("cell").alias("from_cell"), F.col("split").alias("from_split"), "packed")
    right = tiles.select("cell", "split", F.col("packed").alias("other"))
    pairs = wanted.join(left, ["from_cell", "from_split"]).join(right, ["cell", "split"])
    same = (F.col("cell") == F.col("from_cell")) & (F.col("split") == F.col("from_split"))
    return pairs.select("packed", "other", same.alias("same")).mapInArrow(_forest(radius), "a bigint, b bigint")


def _linked(
    docs: DataFrame, key: str, text: str, shingle: int, radius: int, seed: int, segments: int, tile: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``key, fingerprint`` of all rows, ``fingerprint, first`` of all fingerprints, ``node, component`` of those with a link."""
    marked = settled(fingerprints(docs, key, text, shingle, seed))
    distinct = settled(marked.groupBy("fingerprint").agg(F.min("key").alias("first")))
    return marked, distinct, components(links(distinct.select("fingerprint"), radius, segments, tile))


def near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
    segments: int = SEGMENTS,
    tile: int = TILE,
) -> DataFrame:
    """One row per document: ``key, fingerprint, component_id``.

    The fingerprint is 16 hexadecimal digits; the component is named by the smallest key
    that can be reached over links of at most ``radius`` differing bits. Texts without
    words, null ones too, have fingerprint zero and link like any other. Repeated rows
    give repeated rows. A null key names a component only if no other key is in it.
    An empty table gives no row.
    """
    marked, distinct, member = _linked(docs, key, text, shingle, radius, seed, segments, tile)
    # Only fingerprints with a link to another have a row here.
    joined = distinct.join(member.withColumnRenamed("node", "fingerprint"), "fingerprint")
    named = settled(joined.groupBy("component").agg(F.min("first").alias("name")))
    linked = member.join(named, "component").select(F.col("node").alias("fingerprint"), "name")
    # Settled, so that nothing but a shuffle stands on either side of the last join, and
    # Spark can split the rows of a fingerprint that very many documents share.
    named_all = settled(
        distinct.join(linked, "fingerprint", "left").select(
            "fingerprint", F.coalesce("name", "first").alias("component_id")
        )
    )
    return marked.join(named_all, "fingerprint").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
    segments: int = SEGMENTS,
    tile: int = TILE,
) -> DataFrame:
    """One document of each component, columns unchanged: that of the smallest key, a null one last.

    Of rows that share that key, the one of the smallest fingerprint as a signed number
    stays, then the one of the smallest SHA-256 of the row as JSON. Rows that share a key
    but are in different components each count for their own.
    """
    marked, distinct, member = _linked(docs, key, text, shingle, radius, seed, segments, tile)
    component = F.coalesce("component", "fingerprint")
    least = F.min(F.struct(F.col("first").isNull(), "first", "fingerprint")).alias("least")
    chosen = settled(
        distinct.join(member.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .groupBy(component.alias("component"))
        .agg(least)
        .select(F.col("least.first").alias("key"), F.col("least.fingerprint").alias("fingerprint"))
    )
    # A key of one row needs no fingerprint to find the row again.
    counted = marked.select("key", F.lit(1).alias("n"), F.lit(False).alias("chosen"))
    counted = counted.unionByName(chosen.select("key", F.lit(0).alias("n"), F.lit(True).alias("chosen")))
    by_key = counted.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n"), F.max("chosen").alias("chosen"))
    # Most documents stay. The other keys are written, so that Spark knows their size: if they are few, no text is shuffled.
    others = written(by_key.where("NOT chosen OR n > 1").select(F.col("key").alias(key), F.col("chosen").alias("shared")), "near-copies")
    keyed = docs.where(F.col(key).isNotNull())
    alone = keyed.join(others.select(key), key, "left_anti").select(*docs.columns)
    rest = docs.where(F.col(key).isNull())
    repeated = others.where("shared").select(key)
    if not repeated.isEmpty():
        rest = rest.unionByName(keyed.join(repeated, key, "left_semi").select(*docs.columns))
    marks = unused(docs, "fingerprint")
    row = F.struct(*docs.columns)
    one = (
        rest.mapInArrow(
            _with_fingerprint(text, marks, shingle, seed), T.StructType([*docs.schema.fields, T.StructField(marks, T.LongType())])
        )
        # One row of each key and fingerprint in a task goes through the shuffle.
        .groupBy(F.col(key).alias("key"), F.col(marks).alias("fingerprint"))
        .agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row"))
    )
    wanted = chosen.select(F.col("key").alias("k"), F.col("fingerprint").alias("f"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("fingerprint") == F.col("f"))
    return alone.unionByName(one.join(wanted, same, "left_semi").select("row.*"))
