import random
import re
from collections import Counter, defaultdict

import pytest

from shelfwise.llm.collocations import collocations, phrase_counts
from tests.llm.helpers import documents, odd_documents, with_clashes


def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute_counts(rows):
    counts = defaultdict(Counter)
    for group, text in rows:
        for words in pieces(text):
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts["und" if group is None else group][tuple(words[i : i + size])] += 1
    return counts


def brute(rows, least, keep=2000, cover=80):
    out = []
    for group, f in brute_counts(rows).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        found = []
        for g, a in often.items():
            score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            inside = lambda h, g=g: any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
            if not any(len(h) > len(g) and 100 * c >= cover * a and inside(h) for h, c in often.items()):
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:keep], 1):
            out.append((group, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df):
    assert df.columns == ["grp", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def corpus(seed, count=120):
    """Few words, in two languages and none; sentences that recur, cut by every break and blank."""
    rng = random.Random(seed)
    stock = ["of the sea", "OF THE", "new york city hall", "New York", "é ü", "ÄÖ x", "a a a a a", "  z"]
    rows = []
    for _ in range(count):
        parts = [rng.choice([rng.choice(stock), " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 8)))]) for _ in range(rng.randrange(1, 9))]
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(p + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", "!?", ";", ":"]) for p in parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("least", [3, 9])
def test_equals_brute_force(spark, seed, least):
    rows = corpus(seed)
    got = found(collocations(table(spark, rows).repartition(4), least=least))
    assert got == brute(rows, least) and len(got) > 20


def test_other_limits(spark):
    rows = corpus(4)
    assert found(collocations(table(spark, rows), least=2, keep=7, cover=100)) == brute(rows, 2, 7, 100)


def test_counts_of_all_frequent_phrases(spark):
    rows = corpus(5)
    got = {(r.grp, tuple(r.words)): r.f for r in phrase_counts(table(spark, rows), least=4).collect()}
    counts = brute_counts(rows)
    assert {k: f for k, f in got.items() if k[1]} == {(g, w): c for g, f in counts.items() for w, c in f.items() if c >= 4}
    assert {k[0]: f for k, f in got.items() if not k[1]} == {g: sum(c for w, c in f.items() if len(w) == 1) for g, f in counts.items()}


def test_a_phrase_with_a_third_of_all_words(spark):
    rows = [("en", "very hot phrase here " * 40)] * 30 + [("en", " ".join(f"w{i}x{j}" for j in range(80))) for i in range(90)]
    assert found(collocations(table(spark, rows).repartition(8))) == brute(rows, 30)


def test_odd_and_very_long_texts(spark):
    long_piece = " ".join(f"p{i % 50}" for i in range(3000))
    rows = [(r.lang, r.text) for r in odd_documents(spark).collect()] + [(None, long_piece), ("en", "y" * 300_000), ("en", ("word pair, " * 50) * 60)]
    assert found(collocations(table(spark, rows))) == brute(rows, 30)


def test_arithmetic_beyond_64_bits(spark):
    from shelfwise.llm.collocations import _scored

    a = 5_000_000_000_000_000_001
    phrases = spark.createDataFrame([("en", ["x", "y"], a), ("en", ["x"], a + 6), ("en", ["y"], a + 1)], "grp string, words array<string>, f bigint")
    (row,) = _scored(phrases).collect()
    assert row.cut.score == 2000000 * a // (2 * a + 7)


def test_no_rows_and_clashing_names(spark):
    assert found(collocations(documents(spark, []))) == []
    assert found(collocations(documents(spark, [None, "", " \t. "]))) == []
    rows = corpus(6)
    clashing = with_clashes(table(spark, rows), "grp", "n", "w1", "words", "f")
    assert found(collocations(clashing, least=5)) == brute(rows, 5)
