import hashlib
import re

import duckdb
import pytest

from shelfwise.llm.decontaminate import _Block, contamination, decontaminate, windows
from shelfwise.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import bag, documents, odd_documents, with_clashes

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def grams_of(text, size=10):
    w = words(text)
    return [w[i : i + size] for i in range(max(1, len(w) - size + 1) if w else 0)]


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for gram, of in windows.items():
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i : i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    found |= of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item"),
    (10, "two three four five six seven eight nine ten ELEVEN"),
    (3, None),
    (4, "... !!!"),
    (5, "short ITEM"),
    (6, "solo"),
]
DOCS = [
    (0, "Intro: one, two-three four five six seven eight nine ten eleven... outro"),
    (1, "a short (item) and a short item; solo"),
    (2, "one two three four five six seven eight nine"),
    (3, None),
    (4, ""),
    (5, "clean text with nothing in it"),
    (6, "one two three four five six seven eight nine ten " * 30),
    (7, "solo"),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id bigint, text string")


# One block of windows, several, and one for each window.
@pytest.mark.parametrize("block", [500_000, 3, 1])
def test_equals_brute_force(spark, block):
    got = contamination(documents(spark, DOCS).repartition(3), items(spark), block_windows=block)
    assert bag(got) == brute(DOCS, ITEMS)


def test_blocks_are_bounded_by_bytes(spark):
    docs = documents(spark, DOCS + DOCS[:2])
    got = contamination(docs, items(spark), block_bytes=100)
    assert bag(got) == brute(DOCS + DOCS[:2], ITEMS)
    clean = [row[0] for row in brute(DOCS + DOCS[2:6], ITEMS) if not row[-1]]
    left = decontaminate(with_clashes(documents(spark, DOCS + DOCS[2:6]), "print", "hits"), items(spark), block_bytes=100)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(clean)
    cut = decontaminate(docs, items(spark), remove="spans")
    assert bag(decontaminate(docs, items(spark), remove="spans", block_windows=2)) == bag(cut)


def test_passage_that_a_third_of_the_items_share(spark):
    passage = "one two three four five six seven eight nine ten"
    rows = [(i, f"{passage} and item {i}" if i % 3 == 0 else f"a text of item {i} alone, with no more than these words") for i in range(300)]
    docs = [(k, f"before {passage} after {k % 2}") for k in range(30)] + [(99, "a text of item 1 alone, with no more than these words")]
    assert bag(contamination(documents(spark, docs).repartition(4), items(spark, rows))) == brute(docs, rows)
    block = _Block([(r["window"], k) for k, r in enumerate(windows(items(spark, rows)).select("window").distinct().collect())])
    # The shared passage is held once, whatever the number of its items.
    assert sum(len(numbers) for *_, numbers in block.lengths.values()) == len({tuple(w) for _, text in rows for w in grams_of(text)})


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    more = [*ITEMS, (None, "no key at all"), (8, "漢字 \U0001f389")]
    expected = brute(rows, [i for i in more if i[0] is not None])
    assert bag(contamination(with_clashes(docs, "hits", "window", "item"), items(spark, more))) == expected


def test_documents_and_spans_are_removed(spark):
    docs = with_clashes(documents(spark, DOCS), "hits")
    clean = {key for key, *_, bad in brute(DOCS, ITEMS) if not bad}
    assert {r["doc_id"] for r in decontaminate(docs, items(spark)).collect()} == clean
    cut = {r["doc_id"]: r["text"] for r in decontaminate(docs, items(spark), remove="spans").collect()}
    assert cut[0] == "Intro: ... outro"
    assert cut[1] == "a ) and a "
    assert cut[3] is None and cut[4] == "" and cut[5] == DOCS[5][1]
    with pytest.raises(ValueError):
        decontaminate(docs, items(spark), remove="words")


NAMELESS = [*ITEMS, (None, "clean text with nothing in it"), (None, "solo"), (None, None)]


def test_items_without_a_key_hit_as_in_the_sql(spark, tmp_path):
    documents(spark, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    items(spark, NAMELESS).write.parquet(str(tmp_path / "benchmark.parquet"))
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = QUERIES["op2_decontaminate"](spark, str(tmp_path))
    expected = connection.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op2_decontaminate']})").fetchall()
    assert bag(got) == sorted(map(tuple, expected), key=repr)
    assert bag(contamination(documents(spark, DOCS), items(spark, NAMELESS), nameless=True, block_windows=2)) == bag(got)


def test_passages_of_items_without_a_key_are_removed(spark):
    docs = documents(spark, DOCS)
    dirty = {key for key, *_, bad in brute(DOCS, [(9, text) for _, text in NAMELESS]) if bad}
    assert 5 in dirty
    assert {r["doc_id"] for r in decontaminate(docs, items(spark, NAMELESS)).collect()} == {key for key, _ in DOCS} - dirty
    cut = {r["doc_id"]: r["text"] for r in decontaminate(docs, items(spark, NAMELESS), remove="spans").collect()}
    assert cut[5] == "" and cut[7] == ""


def test_empty_tables(spark):
    assert contamination(documents(spark, []), items(spark)).count() == 0
    got = contamination(documents(spark, DOCS), items(spark, []))
    assert bag(got) == brute(DOCS, [])
