import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm.language_model import discount, from_code, score_language_model, to_code
from tests.llm.helpers import documents, odd_documents, with_clashes

END = object()


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w] + [END]


def brute(rows, train):
    """Base score and score of each row, straight from the formulas."""
    counts, after = Counter(), defaultdict(Counter)
    for (_, text), learn in zip(rows, train, strict=True):
        if learn:
            previous = None
            for t in tokens(text):
                counts[t] += 1
                after[previous][t] += 1
                previous = t
    n, v = sum(counts.values()), len(counts)
    out = []
    for (key, text), learn in zip(rows, train, strict=True):
        base = score = known = 0
        previous = None
        for t in tokens(text):
            own = (counts[t] + 1) / (n + v + 1)
            p, seen = own, after[previous]
            if seen:
                total = sum(seen.values())
                d = float(discount(sum(c == 1 for c in seen.values()), sum(c == 2 for c in seen.values())))
                p = max(seen[t] - d, 0) / total + d * len(seen) / total * own
            base, score, known = base + math.log10(own), score + math.log10(p), known + (counts[t] > 0)
            previous = t
        out.append((key, learn, len(tokens(text)), known, n, base, score))
    return sorted(out, key=repr)


def corpus(count, seed):
    rng = random.Random(seed)
    return [(i, " ".join(f"W{min(int(rng.expovariate(0.15)), 60)}" for _ in range(rng.randrange(40)))) for i in range(count)]


def compare(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5] == pytest.approx(e[5], abs=1e-9 * e[2])
        assert g[6] == pytest.approx(e[6], abs=2e-4 * e[2])


# Many shards and small blocks; hardly any, some or many hot words.
@pytest.mark.parametrize(("block", "pairs", "hot"), [(10**6, 10**6, 1000), (300, 500, 4), (100, 50, 60), (1, 10**6, 2)])
def test_equals_brute_force(spark, block, pairs, hot):
    rows = corpus(60, 1)
    train = [i % 3 != 1 for i in range(60)]
    df = score_language_model(
        documents(spark, rows).repartition(4), F.col("doc_id") % 3 != 1, block_tokens=block, shard_pairs=pairs, hot_parts=hot
    )
    compare(df, brute(rows, train))


def test_probabilities_sum_to_one(spark):
    rows = [(0, "a b a c a b"), (1, "b a")]
    words = ["a", "b", "c", "unknown"]
    asked = [(10 + i, f"a {w}") for i, w in enumerate(words)]
    df = score_language_model(documents(spark, rows + asked), F.col("doc_id") < 10)
    scores = {r["doc_id"]: r for r in df.collect()}
    # P(a | start) P(w | a) P(end | w), by formula; the second factor sums to one with the end.
    for i, expected in enumerate(r for r in brute(rows + asked, [True, True] + [False] * 4) if r[0] >= 10):
        assert scores[10 + i]["score"] == pytest.approx(expected[6], abs=1e-3)


def test_odd_rows(spark):
    docs = odd_documents(spark).where("length(text) < 1000 OR text IS NULL")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    train = [k is not None and k % 2 == 1 for k, _ in rows]
    df = score_language_model(with_clashes(docs, "key", "train", "block"), F.col("doc_id") % 2 == 1)
    compare(df, brute(rows, train))
    assert score_language_model(odd_documents(spark), F.lit(True)).count() == 12


def test_no_training_and_empty_table(spark):
    rows = corpus(5, 2)
    compare(score_language_model(documents(spark, rows), F.lit(False)), brute(rows, [False] * 5))
    assert score_language_model(documents(spark, []), F.lit(True)).count() == 0


def test_codes():
    import numpy as np

    logs = np.array([0.0, -0.1, -3.25, -15.9, -40.0])
    codes = to_code(logs)
    assert codes.min() >= 1
    assert np.allclose(from_code(codes)[:4], -logs[:4], atol=2e-4)
    assert from_code(codes)[4] == pytest.approx(16, abs=0.01)
