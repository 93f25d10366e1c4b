"""Spelling variants: words a single edit apart, and the more frequent form that each leads to.

Words are sorted once as they are and once backwards. If two words differ by one edit, they share the
first half of either or, read backwards, the rest of it: in one of the two lists all words near
a given one stand together, behind a shared half. So a word asks only the blocks of the lists that
this stretch runs through. Blocks are ranges of bounded size, so that a half shared by very many
words is many blocks; of these a word asks only those whose own shared prefix it is within one edit of.

Within a block the sorted words are read by dynamic programming, for all askers at once. Words
that share a prefix, which adjacent common prefixes tell, share the row of the edit matrix
behind it, of which three places next to the diagonal matter; a range is skipped as soon as its shared
prefix is more than one edit away.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bulk_words import LOWERED, Texts
from shelfwise.llm.common import settled, written

SHORTEST, LEAST, RATIO = 6, 5, 5
# Words of a block, and the most blocks: their first and last words come to the driver.
BLOCK_WORDS, MAX_BLOCKS = 4096, 8192
# Askers read a block in groups of so many.
_TOGETHER = 2048

_FORWARD, _BACKWARD = "f", "b"
_HIGHEST = "\U0010ffff"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
# The byte before each of U+00C0 to U+00FF, and the bytes that follow it.
_LEAD = 0xC3
_FOLLOWS = np.zeros(256, bool)
_FOLLOWS[0x80:0xC0] = True
# Where a long text may be cut: at bytes of ASCII that are no letter.
_BETWEEN = ~_LETTER & (np.arange(256) < 0x80)


def _letters(data: np.ndarray) -> np.ndarray:
    inside = _LETTER[data] | (data == _LEAD)
    inside[1:] |= _FOLLOWS[data[1:]] & (data[:-1] == _LEAD)
    return inside


def _slips(distinct: list[bytes], rows: np.ndarray, codes: np.ndarray, keys: list[bytes], every: int) -> Iterator[tuple[int, int, int]]:
    """The code of each word in which a slip falls, the place of its row, and the checksum."""
    begun = [crc32(key + b":") for key in keys]
    for i, (row, code) in enumerate(zip(rows.tolist(), codes.tolist(), strict=True)):
        h = crc32(distinct[code], begun[row])
        if not h % every:
            yield i, code, h


def _counts(shortest: int, slip_every: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k.encode() for k in batch.column(0).to_pylist()]
            for part in Texts.of(batch.column(1)).slices(_BETWEEN):
                words = part.words(_letters(part.data), LOWERED[part.data])
                n = np.bincount(words.codes, minlength=len(words.distinct))
                slipped: dict[bytes, int] = {}
                if slip_every:
                    of_row = part.rows(words.starts).astype(np.int64)
                    pairs, times = np.unique((of_row << 32) | words.codes, return_counts=True)
                    distinct = words.distinct.to_pylist()
                    for i, code, h in _slips(distinct, pairs >> 32, pairs & 0xFFFFFFFF, keys, slip_every):
                        text = distinct[code].decode()
                        place = h % len(text)
                        left = (text[:place] + text[place + 1 :]).encode()
                        slipped[left] = slipped.get(left, 0) + int(times[i])
                        n[code] -= times[i]
                found = pa.concat_arrays([words.distinct.cast(pa.string()), pa.array(list(slipped), pa.binary()).cast(pa.string())])
                counts = np.concatenate([n, np.array(list(slipped.values()), np.int64)])
                some = pc.and_(pc.greater_equal(pc.utf8_length(found), shortest), pa.array(counts > 0))
                yield pa.RecordBatch.from_arrays([found.filter(some), pa.array(counts).filter(some)], ["word", "n"])

    return count


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, slip_every: int | None = None
) -> DataFrame:
    """``word, n``: runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, and how often each occurs.

    Only those of at least ``shortest`` code points and ``least`` occurrences in all texts. With
    ``slip_every``, a word of a document loses a letter where that number divides the CRC-32 ``h`` of
    the key as text, a colon and the word: the one at ``h`` modulo its length. A null text has no
    word, a null key is an empty text; repeated rows count each time, an empty table gives no row.
    """
    texts = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = texts.mapInArrow(_counts(shortest, slip_every), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _half(length: int) -> int:
    return length // 2


def _within_one(prefix: str, text: str) -> bool:
    """Whether some beginning of the text is within one edit of the prefix."""
    shared = len(commonprefix((prefix, text)))
    rest = prefix[shared + 1 :]
    # Left out, exchanged or put in where the two first differ.
    return not rest or text.startswith(rest, shared) or text.startswith(rest, shared + 1) or text.startswith(prefix[shared:], shared + 1)


def _ask(numbers: list[int], lowest: list[str], highest: list[str]):
    """Each word with the blocks that may hold words near it; blocks are given in their order."""
    shared = [commonprefix(pair) for pair in zip(lowest, highest, strict=True)]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blocks = [], []
            for i, text in enumerate(batch.column(0).to_pylist()):
                length = len(text) - 1
                half = _half(length) if text[0] == _FORWARD else length - _half(length)
                stretch = text[: half + 1]
                for block in range(bisect_left(highest, stretch), bisect_right(lowest, stretch + _HIGHEST)):
                    if _within_one(shared[block], text):
                        rows.append(i)
                        blocks.append(numbers[block])
            chosen = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), chosen.column(0), chosen.column(1)], ["block", "text", "n"])

    return ask


class SortedWords:
    """Sorted distinct words, with the adjacent common prefixes by which they share rows of the edit matrix."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self._chars = _code_points(words)
        self.lcp = self._common_prefixes()

    def _common_prefixes(self) -> np.ndarray:
        lcp = np.zeros(len(self.words), np.int64)
        going = np.arange(1, len(self.words))
        depth = 0
        while len(going):
            there = np.minimum(self.lengths[going], self.lengths[going - 1]) > depth
            going = going[there]
            same = self._chars[self._starts[going] + depth] == self._chars[self._starts[going - 1] + depth]
            going = going[same]
            depth += 1
            lcp[going] = depth
        return lcp

    def near(self, texts: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a text and a word exactly one edit apart that share the text's first ``exact`` code points."""
        length = np.array([len(t) for t in texts], np.int64)
        # A place without a code point before each text, and three after it.
        padded = _code_points(["\0" + t + "\0\0\0" for t in texts])
        begins = np.concatenate([[0], np.cumsum(length + 4)])[:-1] + 1
        text = np.arange(len(texts))
        low, high = np.zeros(len(texts), np.int64), np.full(len(texts), len(self.words))
        # The row's places before, on and after the diagonal; 2 stands for more than one edit.
        before, on, after = (np.full(len(texts), v, np.int64) for v in (2, 0, 1))
        found_texts, found_words = [], []
        depth = 0
        while len(text) and len(self.words):
            # Words that end here are the first of their range.
            m = length[text]
            edits = np.select([m == depth - 1, m == depth, m == depth + 1], [before, on, after], 2)
            ended = (self.lengths[low] == depth) & (edits == 1) & (depth >= exact[text])
            found_texts.append(text[ended])
            found_words.append(low[ended])
            # The ranges one code point further: each begins where the common prefix is no longer than this one.
            borders = np.flatnonzero(self.lcp <= depth)
            begin = borders[self.lengths[borders] > depth]
            end = np.append(borders, len(self.words))[np.searchsorted(borders, begin, "right")]
            first, last = np.searchsorted(begin, low), np.searchsorted(begin, high)
            pair = np.repeat(np.arange(len(text)), last - first)
            child = np.arange(len(pair)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)
            text, low, high = text[pair], begin[child], end[child]
            char = self._chars[self._starts[low] + depth]
            at, m = begins[text] + np.minimum(depth, length[text] + 1), length[text]
            a, b, c = before[pair], on[pair], after[pair]
            before = np.minimum(a + (char != padded[at - 1]), b + 1)
            before[m < depth] = 2
            on = np.minimum(np.minimum(b + (char != padded[at]), c + 1), before + 1)
            on[m < depth + 1] = 2
            after = np.minimum(c + (char != padded[at + 1]), on + 1)
            after[m < depth + 2] = 2
            depth += 1
            kept = np.where(depth <= exact[text], on == 0, np.minimum(np.minimum(before, on), after) <= 1)
            text, low, high, before, on, after = (x[kept] for x in (text, low, high, before, on, after))
        if not found_texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_texts), np.concatenate(found_words)


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


def _answer(askers: pa.Table, block: pa.Table) -> pa.Table:
    """What each asker's near words in one block come to: their number, and the most frequent one."""
    order = np.argsort(np.array(block["text"].to_pylist(), object), kind="stable")
    keys = block["text"].take(pa.array(order)).to_pylist()
    counts = block["n"].take(pa.array(order)).to_numpy()
    out: dict[str, list] = {"word": [], "n": [], "n_near": [], "form": [], "form_n": []}
    for side in (_FORWARD, _BACKWARD):
        mine = [i for i, key in enumerate(keys) if key[0] == side]
        listed = SortedWords([keys[i][1:] for i in mine])
        of_word = counts[mine].tolist()
        asking = [(text[1:], n) for text, n in zip(askers["text"].to_pylist(), askers["n"].to_pylist(), strict=True) if text[0] == side]
        for start in range(0, len(asking), _TOGETHER):
            some = asking[start : start + _TOGETHER]
            exact = np.array([_half(len(t)) if side == _FORWARD else len(t) - _half(len(t)) for t, _ in some], np.int64)
            near = [0] * len(some)
            best: list[tuple[int, str] | None] = [None] * len(some)
            for i, j in zip(*(x.tolist() for x in listed.near([t for t, _ in some], exact)), strict=True):
                text, word = some[i][0], listed.words[j]
                if side == _BACKWARD:
                    half = _half(len(text))
                    # Those that share the first half as well are found in the other list.
                    if text[::-1][:half] == word[::-1][:half]:
                        continue
                    word = word[::-1]
                near[i] += 1
                this = (-of_word[j], word)
                if best[i] is None or this < best[i]:
                    best[i] = this
            for (text, n), times, chosen in zip(some, near, best, strict=True):
                out["word"].append(text if side == _FORWARD else text[::-1])
                out["n"].append(n)
                out["n_near"].append(times)
                out["form"].append(chosen and chosen[1])
                out["form_n"].append(chosen and -chosen[0])
    return pa.table(out, schema=_ANSWER)


_ANSWER = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, n_near, near, near_n``: for each word, how many others are one edit away, and the most frequent of them.

    ``words`` has distinct ``word`` and their ``n``. An edit is one code point put in, left out or
    exchanged. Of equally frequent words the first in the order of code points counts. Without any, the
    last two are null. Nulls are left out, and the counts of repeated words are summed.
    """
    once = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = written(once, "vocabulary")
    both = vocabulary.select(F.concat(F.lit(_FORWARD), "word").alias("text"), "n").unionAll(
        vocabulary.select(F.concat(F.lit(_BACKWARD), F.reverse("word")).alias("text"), "n")
    )
    blocks = min(max(-(-2 * vocabulary.count() // BLOCK_WORDS), 1), MAX_BLOCKS)
    listed = written(both.repartitionByRange(blocks, "text").withColumn("block", F.spark_partition_id()), "sorted-words")
    # One row a block comes to the driver.
    ranges = listed.groupBy("block").agg(F.min("text").alias("low"), F.max("text").alias("high")).orderBy("low").collect()
    asked = listed.select("text", "n").mapInArrow(
        _ask([r["block"] for r in ranges], [r["low"] for r in ranges], [r["high"] for r in ranges]), "block int, text string, n bigint"
    )
    schema = "word string, n bigint, n_near bigint, form string, form_n bigint"
    answers = asked.groupBy("block").cogroup(listed.groupBy("block")).applyInArrow(_answer, schema)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("word"))))
    return (
        answers.groupBy("word", "n")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", F.col("best.word").alias("near"), (-F.col("best.n")).alias("near_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms that each word leads to.

    Each round every word takes the root of its root, so a chain halves; forms grow by a
    factor with each step, so chains are short.
    """
    current = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settled(current.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            return current
        current = moved.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: each word with the more frequent one it may stand for.

    ``form`` is the word's most frequent near word (see ``near_words``), if that occurs ``ratio``
    times as often, else null; ``root`` is where the forms lead in the end, the word itself if it has
    none. An empty table gives no row; words of any length are taken. The ratio is over 1, or forms
    could lead in a circle.
    """
    if ratio <= 1:
        raise ValueError("the ratio must be over 1")
    enough = F.col("near_n") >= ratio * F.col("n")
    near = written(
        near_words(words).select("word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")), "near-words"
    )
    roots = _roots(near.where(F.col("form").isNotNull()))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
