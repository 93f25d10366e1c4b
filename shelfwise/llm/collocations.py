"""Phrases whose words belong together, ranked for each language.

Every word begins one window: itself and the words after it in its piece, padded with nulls. Only
these longest windows are counted; a ROLLUP over their columns then sums them by their first
words, which gives the count of every shorter phrase without cutting the texts into shorter
windows again, since each occurrence of a phrase is the beginning of one window.

Nearly all windows of a large text are distinct, and a phrase is asked for only from so many
occurrences on. So pairs of neighbours, and then what longer phrases these leave possible, are
counted first in cells of a hash. A phrase in a cell with too few is within no such phrase, and a
window ends before its last word, padded as at the end of a piece. This leaves every count that is
asked for as it is; phrases that share a cell keep more windows, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.bulk_words import LOWERED, Slice, Texts, Words
from shelfwise.llm.common import written

LONGEST, LEAST, KEEP, COVER = 4, 30, 2000, 80
# Bytes of text for each cell, and bounds on the cells of a size: a bit of each is sent to all tasks.
CELL_BYTES = 48
MIN_CELL_BITS, MAX_CELL_BITS = 16, 28

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK


def _groups(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """The group of each row as a number, and the groups."""
    coded = batch.column(1).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _cut(part: Slice) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a slice, their rows, and whether each is followed by another one in its piece."""
    shown = LOWERED[part.data]
    kind = _KIND[shown]
    words = part.words(kind == _WORD, shown)
    rows = part.rows(words.starts)
    breaks = np.cumsum(kind == _BREAK, dtype=np.int32)[words.starts]
    followed = np.zeros(len(rows), bool)
    followed[:-1] = (rows[1:] == rows[:-1]) & (breaks[1:] == breaks[:-1])
    return words, rows, followed


class _Cells:
    """The words of a slice, and the cells of the phrases that begin at them."""

    def __init__(self, part: Slice, of_row: np.ndarray, groups: pa.Array, bits: int):
        self.words, rows, self.followed = _cut(part)
        self.group, self._bits = of_row[rows], np.uint64(64 - bits)
        hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.distinct.to_pylist()], np.uint64)
        of_group = np.array([xxhash.xxh3_64_intdigest(g.encode()) for g in groups.to_pylist()], np.uint64)
        self._hashed, self._of_group = hashed[self.words.codes], of_group[self.group]

    def of(self, starts: np.ndarray, size: int) -> np.ndarray:
        """The cell of the ``size`` words from each of ``starts`` on, all in one piece."""
        mixed = self._hashed[starts]
        for ahead in range(1, size):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + self._hashed[starts + ahead]
        mixed = (mixed ^ self._of_group[starts]) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> self._bits).astype(np.int64)

    def sizes(self, frequent: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Whether a phrase of 2, 3 and more words begins at each word whose cells, one by one, have enough.

        A phrase is asked for its own cell only if the two a word shorter have enough; the last size is
        one more than there are cells for.
        """
        enough = self.followed
        for size, held in enumerate(frequent, 2):
            starts = np.flatnonzero(enough)
            cells = self.of(starts, size)
            enough = np.zeros(len(enough), bool)
            enough[starts] = (held[cells >> 6] >> (cells & 63)) & 1 == 1
            yield enough
            enough = enough & np.append(enough[1:], False)
        yield enough


def _slices(batch: pa.RecordBatch, bits: int) -> Iterator[tuple[_Cells, pa.Array]]:
    of_row, groups = _groups(batch)
    for part in Texts.of(batch.column(0)).slices(_KIND == _BREAK):
        yield _Cells(part, of_row, groups, bits), groups


def _cell_counts(bits: int, frequent: list[Broadcast]):
    """Counts of the phrases that are a word longer than those of the last cells."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in frequent]
        for batch in batches:
            for part, _ in _slices(batch, bits):
                *_, possible = part.sizes(known)
                cells, counts = np.unique(part.of(np.flatnonzero(possible), len(known) + 2), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(counts.astype(np.int32))], ["cell", "n"])

    return count


def _frequent_cells(texts: DataFrame, bits: int, least: int, longest: int) -> list[Broadcast]:
    """For phrases of 2 to ``longest - 1`` words, a bit for each cell with so many of them.

    At most 32 MB a size come to the driver and go to the tasks.
    """
    frequent: list[Broadcast] = []
    for _ in range(2, longest):
        counts = texts.mapInArrow(_cell_counts(bits, list(frequent)), "cell int, n int")
        enough = counts.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("cell").bitwiseAND(63))
        bits_by_place = enough.groupBy(F.shiftright("cell", 6).alias("place")).agg(F.bit_or(one).alias("bits"))
        packed = written(bits_by_place, "cells").toArrow()
        held = np.zeros(1 << (bits - 6), np.int64)
        held[packed["place"].to_numpy()] = packed["bits"].to_numpy()
        frequent.append(texts.sparkSession.sparkContext.broadcast(held))
    return frequent


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct row of the columns of small whole numbers, and how often it comes."""
    key = columns[0].astype(np.int64)
    for column in columns[1:]:
        key = np.unique((key << 32) | (column.astype(np.int64) + 1), return_inverse=True)[1]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return first, counts


def _windows(longest: int, bits: int, frequent: list[Broadcast]):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in frequent]
        for batch in batches:
            for part, groups in _slices(batch, bits):
                codes = part.words.codes
                columns = [codes]
                for ahead, enough in enumerate(part.sizes(known), 1):
                    columns.append(np.where(enough, np.append(codes[ahead:], codes[:ahead]), -1))
                first, counts = _distinct([part.group, *columns])
                chosen = [pa.array(c[first], mask=c[first] < 0) for c in columns]
                shown = part.words.distinct.cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [groups.take(pa.array(part.group[first])), *[shown.take(c) for c in chosen], pa.array(counts)],
                    ["grp", *[f"w{i}" for i in range(1, longest + 1)], "n"],
                )

    return windows


def phrase_counts(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = LONGEST, least: int = LEAST, nameless: str = "und") -> DataFrame:
    """``grp, words, f``: the phrases of up to ``longest`` words that occur ``least`` times in a group, and the words of each group.

    The row without words has the number of all words of its group. Texts are in lower case
    (A-Z only), cut into pieces at ``.,;:!?`` and line breaks, and those into words at blanks
    and tabs; phrases do not go over the end of a piece, and occurrences may overlap.
    """
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(group).cast("string"), F.lit(nameless)).alias("grp"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // CELL_BYTES).bit_length(), MIN_CELL_BITS), MAX_CELL_BITS)
    frequent = _frequent_cells(texts, bits, least, longest)
    names = [f"w{i}" for i in range(1, longest + 1)]
    schema = ", ".join(["grp string", *[f"{name} string" for name in names], "n bigint"])
    found = texts.mapInArrow(_windows(longest, bits, frequent), schema)
    counted = written(found.groupBy("grp", *names).agg(F.sum("n").alias("n")), "windows")

    rolled = counted.rollup("grp", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    # Nulls of columns that are summed over stand for no word, all others are padding. What is asked
    # here of the grouping columns alone, in a condition of its own, Spark asks before it sums and shuffles.
    level = F.lit(longest) - F.bit_count("left_out")
    last_word = F.coalesce(*[F.when(level == i, F.col(name)) for i, name in enumerate(names, 1)])
    whole = rolled.where((level == 0) | last_word.isNotNull()).where(F.col("f") >= F.when(level > 0, least).otherwise(0))
    words = F.slice(F.array(*names), F.lit(1), level)
    return whole.select("grp", F.when(level > 0, words).otherwise(F.array().cast("array<string>")).alias("words"), "f")


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def _exact(column: str, factor: int) -> Column:
    """A product that may pass 64 bits."""
    return F.col(column).cast("decimal(38,0)") * F.lit(factor).cast("decimal(9,0)")


def _scored(phrases: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut."""
    candidates = phrases.where(F.size("words") > 1).select("grp", "words", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "grp",
        _phrase(F.col("words")).alias("phrase"),
        "a",
        "k",
        _phrase(F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        _phrase(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("rest"),
    )
    parts = phrases.where(F.size("words") > 0).select("grp", _phrase(F.col("words")).alias("part"), "f")
    firsts = parts.withColumnsRenamed({"part": "first", "f": "l"})
    rests = parts.withColumnsRenamed({"part": "rest", "f": "r"})
    scored = cuts.join(firsts, ["grp", "first"]).join(rests, ["grp", "rest"]).withColumns({"up": _exact("a", 2_000_000), "down": _exact("l", 1) + _exact("r", 1)})
    cut = F.struct(F.expr("up div down").cast("bigint").alias("score"), "k", "l", "r")
    return scored.groupBy("grp", "phrase", "a").agg(F.min(cut).alias("cut"))


def _covers(phrases: DataFrame, longest: int) -> DataFrame:
    """For each phrase within longer ones, the highest count of these."""
    words = F.col("words")

    def inner(size: int) -> Column:
        return F.array(*[_phrase(F.slice(words, start, n)) for n in range(2, size) for start in range(1, size - n + 2)])

    within = F.lit(None).cast("array<string>")
    for size in range(3, longest + 1):
        within = F.when(F.size("words") == size, inner(size)).otherwise(within)
    longer = phrases.where(F.size("words") > 2).select("grp", "f", F.explode(within).alias("phrase"))
    return longer.groupBy("grp", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    keep: int = KEEP,
    cover: int = COVER,
    nameless: str = "und",
) -> DataFrame:
    """``grp, rank, phrase, a, l, r, n, score``: the first ``keep`` phrases of each group.

    A phrase has 2 to ``longest`` words and occurs ``a`` times, ``least`` at least. It is cut in two
    where ``floor(2000000 a / (l + r))`` is lowest, for the counts of its parts (of equal cuts, the
    first); that is its score. One that lies within a longer phrase with at least
    ``cover`` percent of its occurrences goes. The rest are ranked by score and count, highest first, then by
    their bytes. ``n`` is the number of all words of the group. See ``phrase_counts`` for words and pieces.

    A null text has no words and a null group is ``nameless``. Texts of any length are taken; they are
    cut where pieces end, and a single piece has to fit in a task's memory some twenty times.
    Repeated rows count each time, an empty table gives no row, and other columns play no part.
    """
    phrases = written(phrase_counts(docs, text, group, longest, least, nameless), "phrases")
    total = phrases.where(F.size("words") == 0).select("grp", F.col("f").alias("n"))
    covered = _exact("longer", 100) >= _exact("a", cover)
    kept = _scored(phrases).join(_covers(phrases, longest), ["grp", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("grp").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return first.join(total, "grp").select(
        "grp", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
