"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its words. Words are numbered so that rarer ones have smaller
numbers; two lines similar enough must then share a word among their first few, their
prefixes. Equal lines become one, prefixes are joined on their words, and the position of
the shared word, the lengths and a bitmap of the words bound the overlap.

Spark derives filters from plain explodes and from join conditions (the array has elements, a
column is not null) and pushes them down as far as it can, which here would part every line into
words once more for each. So explodes are outer ones, and computed columns are never null.

The join asks only whether a line has a match, so a family of similar lines never gives all
its pairs: a first semi-join finds the lines that have any candidate, with a few numbers
for each prefix word, and a second one verifies the Jaccard similarity of those that are
left on their whole word lists. What one step leaves for the next is a list of line hashes;
lines themselves are read again, and those that matter told by a bitmap of these hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import BLANKS, settled, unused, written

# Jaccard similarity in percent from which two lines match.
SIMILARITY = 80
# Word counts are pooled in so many buckets: a bound on what every task gets, and what Spark's fast map of counts holds.
BUCKETS = 1 << 16
# Lines of more words have a second bitmap.
LONG = 80
# Cells of the bitmap of line hashes; seven bits each.
FILTER_CELLS = 1 << 19


def _words(line: Column) -> Column:
    """The words, and empty ones where blanks stand at either end or beside each other.

    Parting at a single blank needs no regular expression, which takes twice as long.
    """
    lowered = F.lower(line)
    others = F.lit(False)
    for blank in "\t\n\v\f\r":
        others = others | F.contains(line, F.lit(blank))
    return F.when(others, F.split(lowered, BLANKS)).otherwise(F.split(lowered, " "))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, print, line_no, line, id``: a document is told by its key and a print of its text, a line by a hash."""
    # A first byte above the blank tells a word without the regular expression.
    # The print is taken before the lines are parted, or it would be taken for each of them.
    parted = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("print"), F.split(text, "\n").alias("parts")
    )
    return (
        parted.select("key", "print", F.posexplode_outer("parts").alias("line_no", "line"))
        .where((F.col("line") >= "!") | F.col("line").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("id", F.xxhash64("line"))
    )


def _number(word: Column) -> Column:
    """56 bits of the word's hash."""
    return F.shiftrightunsigned(F.xxhash64(word), 8)


def _bucket(number: Column) -> Column:
    return number.bitwiseAND(BUCKETS - 1)


def _rarity(docs: DataFrame, text: str) -> DataFrame:
    """One row: an array by bucket of the rarity class, the logarithm of the count of the bucket's words in quarters of a bit."""
    counts = (
        docs.select(F.explode_outer(F.split(text, "\n")).alias("line"))
        .select(F.explode_outer(_words(F.col("line"))).alias("w"))
        .groupBy(_bucket(_number(F.col("w"))).alias("bucket"))
        .agg(F.least(F.floor(4 * F.log2(F.count(F.lit(1)))), F.lit(126)).cast("int").alias("class"))
    )
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
    listed = every.agg(F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("class", F.lit(0)).alias("class")))).alias("c"))
    return settled(listed.select(F.transform("c", lambda x: x["class"].cast("tinyint")).alias("classes")))


def _with_ids(lines: DataFrame, rarity: DataFrame) -> DataFrame:
    """With ``ids``: the line's distinct words as sorted numbers, seven bits of rarity class, then 56 of the word's hash.

    The classes are asked for by a subquery: the plan names it and doesn't hold its numbers. Spark
    takes no subquery within a function of array elements, so it is a column first, and Spark puts it in its place.
    """
    return lines.withColumn("classes", rarity.scalar()).withColumn("ids", _ids(F.col("line"), F.col("classes"))).drop("classes")


def _ids(line: Column, rarity: Column) -> Column:

    def ranked(number: Column) -> Column:
        # Never null, so that Spark sorts the numbers as they are and not as objects.
        rare = F.coalesce(rarity[_bucket(number)], F.lit(0).cast("tinyint")).cast("bigint")
        return F.shiftleft(rare, 56).bitwiseOR(number)

    # Repeated words go before they are ranked.
    numbers = F.array_distinct(F.transform(F.array_remove(_words(line), ""), _number))
    return F.coalesce(F.sort_array(F.transform(numbers, ranked)), F.array().cast("array<bigint>"))


def _count(ids: Column) -> Column:
    return F.coalesce(F.size(ids), F.lit(0))


def _bits(ids: Column, second: bool = False) -> Column:
    """64 places, each set if an odd number of words fall there; the second ones are of the words with one bit of their hash set.

    A word that only one of two lines has changes one place, so they differ in no more places than words,
    and unlike marks of the words that are there, these stay apart in long lines too.
    """

    def mark(bits: Column, t: Column) -> Column:
        one = F.lit(1).cast("bigint")
        if second:
            one = F.shiftright(t, 6).bitwiseAND(one)
        return bits.bitwiseXOR(F.call_function("shiftleft", one, t.bitwiseAND(63).cast("int")))

    return F.coalesce(F.aggregate(ids, F.lit(0).cast("bigint"), mark), F.lit(0).cast("bigint"))


def _order() -> Column:
    return F.struct(F.col("key").isNull().alias("late"), "key", "print", "line_no")


def _prefix(similarity: int) -> Column:
    """How many of a set's first words a match must share one of: n - ceil(t n) + 1."""
    n = F.size("ids")
    return (n - F.floor((n * similarity + 99) / 100) + 1).cast("int")


def _overlap(similarity: int) -> str:
    """The overlap two sets of x.n and y.n words need: ceil(t / (1 + t) (x.n + y.n))."""
    return f"(({similarity} * (x.n + y.n) + {99 + similarity}) div {100 + similarity})"


def _may_match(similarity: int) -> str:
    """Length filter, and positional filter at a shared prefix word."""
    return (
        f"100 * least(x.n, y.n) >= {similarity} * greatest(x.n, y.n)"
        f" AND 1 + least(x.n - x.place - 1, y.n - y.place - 1) >= {_overlap(similarity)}"
    )


def _close(similarity: int) -> tuple[str, str]:
    """No more differing words than two matches can have, by their bitmaps: a bound that is quick to tell, and the least one."""
    most = f"x.n + y.n - 2 * {_overlap(similarity)}"
    quick = f"{100 + similarity} * bit_count(x.b0 ^ y.b0) <= {100 - similarity} * (x.n + y.n)"
    # The first bitmaps without the words of the second ones, and these: 128 places in all.
    both = "bit_count(x.b0 ^ x.b1 ^ y.b0 ^ y.b1) + bit_count(x.b1 ^ y.b1)"
    return quick, f"bit_count(x.b0 ^ y.b0) <= {most} AND (least(x.n, y.n) <= {LONG} OR {both} <= {most})"


def _with_candidates(lines: DataFrame, rarity: DataFrame, similarity: int) -> DataFrame:
    """``id, words``: lines that share a prefix word with another and pass all filters with it, and these words.

    Of two lines that match, both keep the first prefix word they share.
    """
    rows = (
        _with_ids(lines.select("line", "id").distinct(), rarity)
        .withColumn("n", _count(F.col("ids")))
        .withColumn("b0", _bits(F.col("ids")))
        .withColumn("b1", F.when(F.col("n") > LONG, _bits(F.col("ids"), second=True)).otherwise(F.lit(0).cast("bigint")))
        .select("id", "n", "b0", "b1", F.slice("ids", F.lit(1), _prefix(similarity)).alias("prefix"))
        .select("id", "n", "b0", "b1", F.posexplode_outer("prefix").alias("place", "word"))
    )
    quick, least = _close(similarity)
    # The quick test comes first: nearly all pairs of lines with a common word fail it.
    condition = f"x.word = y.word AND {quick} AND x.id <> y.id AND {_may_match(similarity)} AND {least}"
    left = rows.alias("y").join(rows.alias("x"), F.expr(condition), "left_semi")
    # No more words than the line's prefix has.
    return left.groupBy("id").agg(F.collect_list(F.struct("place", "word")).alias("words"))


def _cell(hashed: Column) -> tuple[Column, Column]:
    place = F.pmod(hashed, F.lit(FILTER_CELLS * 7))
    return F.floor(place / 7).cast("int"), (place % 7).cast("int")


def _passes(some: DataFrame) -> Column:
    """Whether a line's ``id`` may be among some: those do pass, and of the others those that share a bit of the bitmap."""
    cell, bit = _cell(F.col("id"))
    cells = some.groupBy(cell.alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), bit)).alias("bits"))
    every = some.sparkSession.range(FILTER_CELLS).select(F.col("id").cast("int").alias("cell")).join(cells, "cell", "left")
    listed = every.agg(F.array_sort(F.collect_list(F.struct("cell", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("c"))
    held = settled(listed.select(F.transform("c", lambda x: x["bits"].cast("tinyint")).alias("bits"))).scalar()
    return F.call_function("shiftright", F.get(held, cell).cast("int"), bit).bitwiseAND(1) == 1


def _firsts(lines: DataFrame) -> DataFrame:
    """``line, id, first, times`` for each distinct line: where it comes first, and how often it comes."""
    return lines.groupBy("line", "id").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("times"))


def _covered(lines: DataFrame, some: DataFrame, rarity: DataFrame, similarity: int) -> DataFrame:
    """``id`` of the lines with another line that matches and comes earlier."""
    rows = (
        _firsts(lines.where(_passes(some)))
        .join(some, "id")
    )
    rows = (
        _with_ids(rows.select("id", "first", "words", "line"), rarity)
        .select("id", "first", "ids", _count(F.col("ids")).alias("n"), F.inline_outer("words"))
    )
    # Both sides use all columns, so that Spark shuffles the rows once for both.
    condition = (
        f"x.word = y.word AND x.id <> y.id AND x.first < y.first AND {_may_match(similarity)}"
        f" AND size(array_intersect(x.ids, y.ids)) >= {_overlap(similarity)}"
    )
    return rows.alias("y").join(rows.alias("x"), F.expr(condition), "left_semi").select("id").distinct()


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """``key, print, numbers``: by document, the sorted numbers of its lines that go.

    A line goes if an earlier line is equal, or has a Jaccard similarity of
    ``similarity`` percent or more, whether that line itself stays or not. Lines are in
    the order of key, print of the text, and place; a null key comes last. Lines and words
    are told apart by their 64-bit and 56-bit hashes.
    """
    rarity = _rarity(docs, text)
    lines = _lines(docs, key, text)
    some = settled(_with_candidates(lines, rarity, similarity))
    covered = settled(_covered(lines, some, rarity, similarity))
    places = written(lines.select("key", "print", "line_no", "id"), "lines")
    # Lines that come once and have no match are most: only the others are joined.
    repeated = places.groupBy("id").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("times"))
    going = (
        repeated.join(covered.withColumn("all", F.lit(True)), "id", "left")
        .where("times > 1 OR all")
        .select("id", F.when(F.col("all").isNull(), F.col("first")).alias("first"))
    )
    gone = places.join(going, "id").where(F.col("first").isNull() | (F.col("first") < _order()))
    return gone.groupBy("key", "print").agg(F.sort_array(F.collect_set("line_no")).alias("numbers"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """The documents with ``text`` freed of repeated lines, and ``lines`` and ``removed_lines`` added.

    Lines are parted by newlines, words by ASCII blanks, without regard to case; a line's
    words form a set. See ``removed_lines`` for what goes. Lines without a word stay. A
    null text stays null, with 0 lines; an empty one has one line. Rows with the same key
    and text are one document and lose the same lines; an empty table gives no row. The
    added names get underscores in front where a column has them.
    """
    own = {name: unused(docs, f"gone_{name}") for name in ("key", "print", "numbers")}
    gone = removed_lines(docs, key, text, similarity).withColumnsRenamed(own)
    mark = unused(docs, "print")
    marked = docs.withColumn(mark, F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col(own["key"])) & (F.col(mark) == F.col(own["print"]))
    numbers, split = F.col(own["numbers"]), F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(split, lambda line, i: ~F.array_contains(numbers, i)), "\n")
    freed = F.when(numbers.isNull(), F.col(text)).otherwise(kept)
    return marked.join(gone, same, "left").select(
        *[freed.alias(c) if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.size(split), F.lit(0)).alias(unused(docs, "lines")),
        F.coalesce(F.size(numbers), F.lit(0)).alias(unused(docs, "removed_lines")),
    )
