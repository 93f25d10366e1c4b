import hashlib
import re
from collections import Counter

from shelfwise.llm.exact_dedup import _pruned, drop_exact_copies, exact_copies, frequent
from tests.llm.helpers import bag, documents, odd_documents, with_clashes


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    out = []
    for i, (key, _) in enumerate(rows):
        same = [j for j, n in enumerate(norm) if n == norm[i]]
        first = min(same, key=lambda j: (rows[j][0] is None, rows[j][0] or 0, j))
        digest = hashlib.sha256(norm[i].encode()).hexdigest()
        out.append((key, rows[first][0], len(same), i == first, digest))
    return sorted(out, key=repr)


def test_equals_brute_force_with_frequent_and_rare_texts(spark):
    texts = ["hot  text"] * 40 + ["hot\ttext"] * 5 + [f"rare {i % 17}" for i in range(60)] + [None, "", " ", "  "]
    rows = list(enumerate(texts))
    # With two counters only the hot text is frequent, with a thousand all of them are.
    for counters in (2, 1000):
        assert bag(exact_copies(documents(spark, rows).repartition(5), counters=counters)) == brute(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = bag(exact_copies(with_clashes(docs, "digest", "row", "first", "group_size")))
    assert got == brute(rows)
    kept = drop_exact_copies(with_clashes(docs, "digest", "rank", "first"))
    assert kept.count() == sum(1 for r in brute(rows) if r[3])
    assert kept.columns[-3:] == ["digest", "rank", "first"]


def test_removal_keeps_one_of_each(spark):
    texts = ["same text"] * 30 + ["same  text"] * 3 + ["other", "other", "third"]
    for counters in (1, 1000):
        kept = drop_exact_copies(documents(spark, texts).repartition(4), counters=counters)
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 33, 35]


def test_empty_table(spark):
    empty = documents(spark, [])
    assert exact_copies(empty).count() == 0
    assert drop_exact_copies(empty).count() == 0


def test_counters_find_every_frequent_digest(spark):
    values = [f"d{i}" for i in range(500)] + ["often"] * 120
    df = spark.createDataFrame([(bytearray(v.encode()),) for v in values], "digest binary").repartition(6)
    found = {bytes(r["digest"]) for r in frequent(df, counters=20).collect()}
    assert b"often" in found
    assert len(found) <= 20


def test_pruning_bounds_the_error():
    counts = Counter({"a": 10, "b": 4, "c": 3, "d": 1})
    assert _pruned(counts, 2) == {"a": 7, "b": 1}
    assert _pruned(counts, 4) == counts
