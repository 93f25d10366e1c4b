"""Best-fit packing of tokenised documents under several capacities.

Documents are tokenised and cut into pieces on Spark. Pieces of one length are alike, so
the plan needs only the number of pieces of each length: a table that cannot be longer
than a sequence. The driver runs a vector best-fit over it, longest first. Open bins in
the same state are one class with a count; each round picks the class that fits best under
all capacities and puts one piece into each of its bins. The plan maps the rank of a piece
among those of its length to a bin and a place, and Spark joins it to the pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import pairwise
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import utf8, written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 2
SEQUENCE = 1024


@dataclass(frozen=True)
class Capacities:
    """What a sequence may hold, and how bins are chosen.

    ``documents`` limits the pieces in a sequence, ``attention`` the sum of the squares of
    their lengths; without a limit of its own, either is as large as the tokens allow, and
    has no weight in the choice, which is then best-fit by tokens. ``choose`` is "norm" (least weighted norm of what stays free) or "dot" (largest
    weighted product of what the piece needs and what is free).
    """

    tokens: int = SEQUENCE
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    choose: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], dtype=np.int64)

    def scaled_weights(self) -> np.ndarray:
        """Of the squares of what is needed or free, so that each capacity counts as 1."""
        limited = np.array([True, self.documents is not None, self.attention is not None])
        return np.where(limited, self.weights, 0.0) / self.vector().astype(float) ** 2


#: The limits that tokens alone set on documents and attention, so that they have weight but force no sequence more.
VECTOR = Capacities(documents=SEQUENCE, attention=SEQUENCE**2)


@dataclass(eq=False)
class _Class:
    """Bins in one state: ``count`` of them from number ``first``, with what is free and filled."""

    first: int
    count: int
    free: np.ndarray
    filled: int


def needs(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.int64)


def plan_bins(lengths: dict[int, int], capacities: Capacities | None = None) -> list[tuple[int, int, int, int, int]]:
    """``length, from_rank, count, first_bin, offset`` for pieces given as length to count.

    The pieces of a length with ranks from ``from_rank`` go one each into ``count`` bins
    from ``first_bin``, at token ``offset``. Lengths are placed from the longest; a piece
    that exceeds a capacity by itself is an error. The number of classes grows with the
    number of lengths, not of pieces.
    """
    capacities = capacities or Capacities()
    if capacities.choose not in ("norm", "dot"):
        raise ValueError("choose is 'norm' or 'dot'")
    limit = capacities.vector()
    weights = capacities.scaled_weights()
    open_bins: list[_Class] = []
    out: list[tuple[int, int, int, int, int]] = []
    bins = 0
    for length in sorted(lengths, reverse=True):
        need, left, rank = needs(length), lengths[length], 0
        if (need > limit).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities of an empty sequence")
        while left:
            best = _best(open_bins, need, weights, capacities.choose)
            if best is None:
                # As many as these pieces fill, or one for fewer pieces.
                held = int(min(limit // need))
                opened = _Class(bins, max(1, left // held), limit.copy(), 0)
                open_bins.append(opened)
                bins += opened.count
                best = opened
            put = min(left, best.count)
            if put < best.count:  # only some of its bins get a piece
                open_bins.append(_Class(best.first + put, best.count - put, best.free.copy(), best.filled))
                best.count = put
            out.append((length, rank, put, best.first, best.filled))
            best.free = best.free - need
            best.filled += length
            rank += put
            left -= put
            if best.free[0] == 0 or best.free[1] == 0:
                open_bins.remove(best)
    return out


def _best(bins: list[_Class], need: np.ndarray, weights: np.ndarray, choose: str) -> _Class | None:
    if not bins:
        return None
    free = np.array([b.free for b in bins])
    fits = np.flatnonzero((free >= need).all(axis=1))
    if not len(fits):
        return None
    if choose == "norm":
        score = -(weights * (free[fits] - need).astype(float) ** 2).sum(axis=1)
    else:
        score = (weights * need * free[fits].astype(float)).sum(axis=1)
    return bins[fits[int(score.argmax())]]


@lru_cache(maxsize=1)
def encoder(path: str = TOKENIZER) -> tiktoken.Encoding:
    """The byte-level vocabulary of the tokenizer file, and its added tokens as special ones.

    The file's tokens are written in the printable stand-ins for bytes that such files
    use. Merges of this kind of file are in the order of their numbers, which is what a
    rank table needs; a test compares the numbers with those of the tokenizers library.
    An added token stands for its literal text wherever that occurs; ones that also take
    blanks beside it, or only whole words, are refused.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    added = content.get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or (t["normalized"] and content["normalizer"]) for t in added):
        raise ValueError("only added tokens that are plain text are handled")
    special = {t["content"]: t["id"] for t in added}
    vocabulary = content["model"]["vocab"]
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    ranks = {bytes(byte[c] for c in token): n for token, n in vocabulary.items() if token not in special}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


_FIELDS = {
    "piece": pa.int32(),
    "start": pa.int64(),
    "length": pa.int32(),
    "ids": pa.binary(),
    "ids_crc32": pa.int64(),
    "task": pa.int32(),
    "nth": pa.int64(),
}
_COLUMNS = "piece int, start bigint, length int, ids binary, ids_crc32 bigint, task int, nth bigint"
_ROWS = 5000


def _cut(path: str, sequence: int, end: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(encoder(path).encode, allowed_special="all")
        task = TaskContext.get().partitionId()
        seen = np.zeros(sequence + 1, dtype=np.int64)
        for part in parts:
            source: list[int] = []
            rows: list[tuple] = []
            for k, text in enumerate(utf8(part.column(1))):
                ids = np.array([*encode(text.decode()), end], dtype="<u4")
                bounds = [0, *range((len(ids) - 1) % sequence + 1, len(ids) + 1, sequence)]
                for piece, (a, b) in enumerate(pairwise(bounds)):
                    raw = ids[a:b].tobytes()
                    rows.append((piece, a, b - a, raw, crc32(raw), task, int(seen[b - a])))
                    source.append(k)
                    seen[b - a] += 1
                if len(rows) >= _ROWS:
                    yield _pieces(part.column(0), source, rows)
                    source, rows = [], []
            if rows:
                yield _pieces(part.column(0), source, rows)

    return run


def _pieces(keys: pa.Array, source: list[int], rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), _FIELDS.values(), strict=True)]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(source)), *columns], names=["key", *_FIELDS])


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacities: Capacities | None = None,
    path: str = TOKENIZER,
    end: int = END,
) -> DataFrame:
    """``key, piece, start, length, ids, ids_crc32, sequence_id, offset`` for each piece of each document.

    ``ids`` holds the piece's token numbers as little-endian unsigned 32-bit numbers, and
    ``ids_crc32`` their checksum; a document's are those of its whole text, as the tokenizers library
    gives them without a template's tokens, then ``end``: the literal of an added token is that token. Only a document longer than a
    sequence is cut: into full pieces, but for the first, which has what is left over. A
    null text is an empty one, so every row gives a piece; a null key is carried as null;
    an empty table gives no row. Sequences are numbered from 0, their pieces follow each
    other without a gap. Other columns are not looked at.
    """
    capacities = capacities or Capacities()
    kind = docs.schema[key].dataType.simpleString()
    cut = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _cut(path, capacities.tokens, end), f"key {kind}, {_COLUMNS}"
    )
    pieces = written(cut, "pieces")
    # Rank of a piece among all of its length: those of earlier tasks, and those before it in its own.
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # A row for each length at most, and few classes of bins for each.
    lengths = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan_bins(lengths, capacities)
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(length, _steps_of(steps, length)) for length in sorted(lengths)],
        "length int, steps array<struct<from_rank:bigint, count:bigint, first_bin:bigint, offset:bigint>>",
    )
    rank = F.col("before") + F.col("nth")
    step = F.element_at(F.filter("steps", lambda s: (s["from_rank"] <= F.col("rank")) & (F.col("rank") < s["from_rank"] + s["count"])), 1)
    return (
        pieces.join(before, ["length", "task"])
        .join(F.broadcast(plan), "length")
        .withColumn("rank", rank)
        .withColumn("step", step)
        .select(
            F.col("key").alias(key),
            "piece",
            "start",
            F.col("length").cast("bigint").alias("length"),
            "ids",
            "ids_crc32",
            (F.col("step.first_bin") + F.col("rank") - F.col("step.from_rank")).alias("sequence_id"),
            F.col("step.offset").alias("offset"),
        )
    )


def _steps_of(steps: list[tuple[int, int, int, int, int]], length: int) -> list[tuple[int, int, int, int]]:
    return [(rank, count, first, offset) for of, rank, count, first, offset in steps if of == length]
