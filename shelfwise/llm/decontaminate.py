"""Benchmark decontamination: training windows looked up in a broadcast set of test n-grams.

The benchmark's windows are found and numbered by Spark, then sent to every task in blocks
bounded by their number and their bytes. A task gives each word of a document its number in
the block's vocabulary, or 0, hashes the windows that hold known words only, looks the hashes
up, and verifies each hit word by word. What comes back are hit words and the numbers of hit
windows; which items have a window stays a table, which Spark joins to the distinct sets of
numbers. So a passage that very many items share is sent once and costs no larger block.

One block needs one pass over the documents. Further blocks read the documents again, and
only digests of texts with their hits are kept between them, never the texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import LOWER, UPPER, settled, unused

WINDOW = 10
# Windows in one broadcast block, and bytes of their words: about 200 MB at ten words each.
BLOCK_WINDOWS = 500_000
BLOCK_BYTES = 64 << 20

# Letters, digits and every byte above ASCII make words; A-Z become lower case.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.IntegerType())),
        T.StructField("windows", T.ArrayType(T.LongType())),
    ]
)
_HITS_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("windows", pa.list_(pa.int64()))])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: Column) -> Column:
    """The words of a text in Spark SQL, as the tasks see them."""
    return F.regexp_extract_all(
        F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1
    )


def windows(
    benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW, nameless: bool = False
) -> DataFrame:
    """Distinct windows of each item of the benchmark: ``item, window``.

    An item of fewer words is one window; one without words has none. Items without a
    key are left out, or with ``nameless`` stand as one item whose name is null.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (
        benchmark.where(F.col(key).isNotNull() | F.lit(nameless))
        .select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("start"))
        .select("item", F.slice("w", F.col("start"), F.lit(size)).alias("window"))
        .distinct()
    )


class _Block:
    """Numbered windows: vocabulary, and by length sorted hashes with the windows they stand for."""

    def __init__(self, rows: Iterable[tuple[list[str], int]]):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[list[int], int]]] = {}
        for window, number in rows:
            ids = [self.vocabulary.setdefault(w.encode(), len(self.vocabulary) + 1) for w in window]
            by_length.setdefault(len(ids), []).append((ids, number))
        self.lengths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length, found in by_length.items():
            ids = np.array([x[0] for x in found], dtype=np.uint32)
            hashes = _hashes(ids.reshape(-1), np.arange(len(ids)) * length, length)
            order = np.argsort(hashes, kind="stable")
            self.lengths[length] = hashes[order], ids[order], np.array([x[1] for x in found], dtype=np.int64)[order]


def _hashes(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A polynomial in the word numbers, modulo 2^64, for each window."""
    total = np.zeros(len(starts), dtype=np.uint64)
    for k in range(length):
        total = total * _BASE + ids[starts + k].astype(np.uint64)
    return total


def _matches(ids: np.ndarray, block: _Block) -> Iterator[tuple[int, int, int]]:
    """Start, length and number of each window of the block that occurs."""
    unknown = np.concatenate(([0], np.cumsum(ids == 0)))
    for length, (hashes, known, numbers) in block.lengths.items():
        if len(ids) < length:
            continue
        starts = np.flatnonzero(unknown[length:] == unknown[:-length])
        if not len(starts):
            continue
        wanted = _hashes(ids, starts, length)
        at = np.searchsorted(hashes, wanted)
        hit = at < len(hashes)
        hit[hit] = hashes[at[hit]] == wanted[hit]
        for start, first in zip(starts[hit].tolist(), at[hit].tolist(), strict=True):
            for i in range(first, len(hashes)):
                if hashes[i] != hashes[first]:
                    break
                if np.array_equal(known[i], ids[start : start + length]):
                    yield start, length, int(numbers[i])
                    break


def _scan(held: Broadcast, column: str, hits: str, keep: list[str]):
    """The kept columns, and the hits of a block's windows."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        number = block.vocabulary.get
        for part in parts:
            rows = []
            for raw in part.column(column).cast(pa.binary()):
                found = (raw.as_py() or b"").translate(_WORD_BYTES).split()
                ids = np.fromiter((number(w, 0) for w in found), dtype=np.uint32, count=len(found))
                edges = np.zeros(len(found) + 1, dtype=np.int32)
                numbers = set()
                for start, length, window in _matches(ids, block):
                    edges[start] += 1
                    edges[start + length] -= 1
                    numbers.add(window)
                covered = np.concatenate(([0], (np.cumsum(edges) > 0).astype(np.int8)))
                rows.append({"n_words": len(found), "spans": np.flatnonzero(np.diff(covered)).tolist(), "windows": sorted(numbers)})
            yield pa.RecordBatch.from_arrays(
                [*[part.column(name) for name in keep], pa.array(rows, _HITS_ARROW)],
                schema=pa.schema([*[part.schema.field(name) for name in keep], (hits, _HITS_ARROW)]),
            )

    return run


def _merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One text's hits in several blocks as one: ``print, hits`` from ``print, found``."""
    for part in parts:
        rows = []
        for found in part.column("found").to_pylist():
            flat: list[int] = []
            for start, stop in sorted(span for h in found for span in pairs(h["spans"])):
                if flat and start <= flat[-1]:
                    flat[-1] = max(flat[-1], stop)
                else:
                    flat += [start, stop]
            rows.append({"n_words": found[0]["n_words"], "spans": flat, "windows": sorted(w for h in found for w in h["windows"])})
        yield pa.RecordBatch.from_arrays([part.column("print"), pa.array(rows, _HITS_ARROW)], names=["print", "hits"])


def pairs(bounds: list[int]) -> list[tuple[int, int]]:
    """Starts and stops, alternating, as pairs."""
    return list(zip(bounds[::2], bounds[1::2], strict=True))


def _numbered(members: DataFrame) -> DataFrame:
    """Each distinct window under a number: ``number, window``."""
    return settled(members.select("window").distinct().select(F.monotonically_increasing_id().alias("number"), "window"))


def _blocks(grams: DataFrame, block_windows: int, block_bytes: int) -> list[Column]:
    """Conditions that part the windows into blocks of about these sizes at most."""
    length = F.aggregate("window", F.lit(0).cast("bigint"), lambda a, w: a + F.octet_length(w))
    count, size = grams.agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0))).first()
    blocks = max(1, -(-count // block_windows), -(-size // block_bytes))
    part = F.pmod(F.xxhash64("window"), F.lit(blocks))
    return [part == k for k in range(blocks)]


def _hold(grams: DataFrame, block: Column) -> Broadcast:
    rows = grams.where(block).select("window", "number").toLocalIterator()
    return grams.sparkSession.sparkContext.broadcast(_Block((r["window"], r["number"]) for r in rows))


def _marked(docs: DataFrame, grams: DataFrame, blocks: list[Column], text: str, hits: str, keep: list[str]) -> DataFrame:
    """The kept columns and ``hits``: one pass for one block, else hits of distinct texts, joined to them by a digest."""
    added = T.StructField(hits, _HITS)
    if len(blocks) == 1:
        schema = T.StructType([*[docs.schema[name] for name in keep], added])
        return docs.mapInArrow(_scan(_hold(grams, blocks[0]), text, hits, keep), schema)
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    texts = docs.select(digest.alias("print"), F.col(text).alias("text"))
    found = []
    for k, block in enumerate(blocks):
        held = _hold(grams, block)
        rows = texts.mapInArrow(_scan(held, "text", "hits", ["print"]), T.StructType([texts.schema["print"], T.StructField("hits", _HITS)]))
        # The first block tells of every text how many words it has.
        rows = rows.where((F.size("hits.spans") > 0) | F.lit(k == 0))
        found.append(settled(rows.groupBy("print").agg(F.min("hits").alias("hits"))))
        held.destroy()
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    mark = unused(docs, "print")
    merged = (
        every.groupBy("print")
        .agg(F.collect_list("hits").alias("found"))
        .mapInArrow(_merge, T.StructType([texts.schema["print"], T.StructField("hits", _HITS)]))
        .select(F.col("print").alias(mark), F.col("hits").alias(hits))
    )
    return docs.select(*keep, digest.alias(mark)).join(merged, mark).select(*keep, hits)


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    block_bytes: int = BLOCK_BYTES,
    hits: str = "hits",
    nameless: bool = False,
) -> DataFrame:
    """The documents with a struct ``hits`` of ``n_words, spans, windows`` added.

    ``spans`` holds start and stop, in words, of each hit stretch, one after the other;
    ``windows`` the sorted numbers of the benchmark's windows in the document, which hold
    for this result alone; with ``nameless``, windows of items without a key hit too. Null
    and empty texts have no words and no hit; rows with the same text, and repeated rows,
    have the same hits; an empty table gives no row. Every benchmark window is used,
    ``block_windows`` of them, and about ``block_bytes`` of their words, at a time.
    ``hits`` must be a new name.
    """
    if hits in docs.columns:
        raise ValueError(f"{hits} is a column of the documents; name another for the hits")
    grams = _numbered(windows(benchmark, item, item_text, size, nameless))
    return _marked(docs, grams, _blocks(grams, block_windows, block_bytes), text, hits, docs.columns)


def hit_words(spans: Column) -> Column:
    """The number of hit words in alternating starts and stops."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _removed(text: bytes, spans: list[int]) -> bytes:
    flat = np.frombuffer(text.translate(_WORD_BYTES), dtype=np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flat.astype(np.int8), [0]))))
    starts, stops = edges[::2], edges[1::2]
    kept, at = [], 0
    for first, last in pairs(spans):
        kept.append(text[at : starts[first]])
        at = stops[last - 1]
    return b"".join([*kept, text[at:]])


def _cut(column: str, hits: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = part.column(hits).to_pylist()
            cleaned = [
                _removed(t.encode(), h["spans"]).decode() if h["spans"] else t
                for t, h in zip(part.column(column).to_pylist(), found, strict=True)
            ]
            yield part.set_column(part.schema.get_field_index(column), column, pa.array(cleaned, pa.string()))

    return run


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents", **options
) -> DataFrame:
    """The documents without benchmark passages, columns unchanged.

    ``remove="documents"`` drops each document with a hit word; ``remove="spans"`` keeps
    them all and cuts the hit stretches out of their text, from the first hit word's
    first letter to the last one's last. Clean documents and null texts stay as they are,
    each as often as it comes; an empty table stays one. A passage counts whether or not
    its item has a key.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    hits = unused(docs, "hits")
    marked = find_hits(docs, benchmark, text, hits=hits, nameless=True, **options)
    if remove == "documents":
        return marked.where(F.size(F.col(hits)["spans"]) == 0).select(*docs.columns)
    return marked.mapInArrow(_cut(text, hits), marked.schema).select(*docs.columns)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    block_bytes: int = BLOCK_BYTES,
    nameless: bool = False,
) -> DataFrame:
    """One row per document, repeated rows too: ``key, n_words, n_hit, n_items, items_sha256, contaminated``.

    The digest is that of the sorted items, comma-joined; no item gives that of the empty text.
    With ``nameless``, items without a key count as one item, which the digest leaves out.
    Other columns are not looked at, whatever their names; an empty table gives no row.
    """
    members = settled(windows(benchmark, item, item_text, size, nameless))
    grams = _numbered(members)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marked = _marked(narrow, grams, _blocks(grams, block_windows, block_bytes), "text", "hits", ["key"])
    marked = settled(marked.select("key", "hits.n_words", hit_words(F.col("hits.spans")).alias("n_hit"), "hits.windows"))
    # Documents with the same windows have the same items, which are gathered once.
    items = (
        marked.where(F.size("windows") > 0)
        .select("windows")
        .distinct()
        .select("windows", F.explode("windows").alias("number"))
        .join(grams.join(members, "window").select("number", "item"), "number")
        .groupBy("windows")
        .agg(F.collect_set("item").alias("names"), F.max(F.col("item").isNull().cast("bigint")).alias("unnamed"))
        .select(
            "windows",
            (F.size("names") + F.col("unnamed")).alias("n_items"),
            F.sha2(F.array_join(F.array_sort("names"), ",").cast("binary"), 256).alias("items_sha256"),
        )
    )
    dirty = marked.where(F.size("windows") > 0).join(items, "windows")
    clean = marked.where(F.size("windows") == 0).select(
        "*", F.lit(0).cast("bigint").alias("n_items"), F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256")
    )
    return dirty.unionByName(clean).select(
        F.col("key").alias(key), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated")
    )
