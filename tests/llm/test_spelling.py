import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from shelfwise.llm import spelling
from shelfwise.llm.spelling import SortedWords, near_words, spelling_variants, word_counts
from tests.llm.helpers import documents, odd_documents, with_clashes


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows, shortest=6, least=5, slip_every=199):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{word}".encode())
            if slip_every and h % slip_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def brute(counts, ratio=5):
    """Every pair of words compared."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


def vocabulary(seed, count, letters="ab", sizes=(1, 9), most=4000):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(*sizes))): rng.choice([1, 5, 6, 30, 200, most]) for _ in range(count)}
    return dict(sorted(words.items()))


@pytest.mark.parametrize("seed", range(6))
def test_sorted_words_find_every_near_word(seed):
    words = sorted(vocabulary(seed, 150, "abé\U0001f389"[: 2 + seed % 3]))
    listed = SortedWords(words)
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    assert listed.lcp.tolist() == [0, *[common(a, b) for a, b in zip(words, words[1:], strict=False)]]
    for exact in (0, 1, 3):
        texts, near = listed.near(words, np.minimum([len(w) for w in words], exact))
        got = sorted(zip(texts.tolist(), near.tolist(), strict=True))
        assert got == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b) and b.startswith(a[:exact])]


def test_no_sorted_words():
    texts, near = SortedWords([]).near(["abc"], np.array([1]))
    assert len(texts) == len(near) == 0


@pytest.mark.parametrize("seed", range(300))
def test_shared_prefixes_within_one_edit(seed):
    rng = random.Random(seed)
    a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(7))) for _ in range(2))
    expected = any(a == b[:j] or one_edit(a, b[:j]) for j in range(len(b) + 1))
    assert spelling._within_one(a, b) == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("blocks", [4096, 9])
def test_equals_brute_force(spark, monkeypatch, seed, blocks):
    """Also with very small blocks, so that words ask several and stretches run through many."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", blocks)
    counts = vocabulary(seed, 260, "abc", (1, 8)) | vocabulary(seed, 120, "xyö", (6, 14))
    assert found(spelling_variants(table(spark, counts).repartition(5))) == brute(counts)


def test_a_prefix_shared_by_most_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 16)
    counts = {"commonbeginning" + w: n for w, n in vocabulary(8, 220, "abcd", (1, 6)).items()} | vocabulary(9, 60, "mno", (6, 9))
    assert found(spelling_variants(table(spark, counts))) == brute(counts)


def test_chains_lead_to_their_last_form(spark):
    """Each word is one letter from the next, five times as frequent one."""
    chain = {"a" * i + "zzzzzz": 5 ** (14 - i) for i in range(14)}
    got = {r.word: r.root for r in spelling_variants(table(spark, chain)).collect()}
    assert set(got.values()) == {"zzzzzz"}
    assert found(spelling_variants(table(spark, chain))) == brute(chain)


def test_ties_nulls_repeats_and_other_ratios(spark):
    rows = [("colour", 50), ("colours", 10), ("kolour", 50), ("golour", 50), (None, 9), ("nullish", None), ("colours", 2), ("", 7), ("x", 1)]
    words = spark.createDataFrame(rows, "word string, n bigint")
    counts = {"colour": 50, "colours": 12, "kolour": 50, "golour": 50, "": 7, "x": 1}
    for ratio in (2, 4, 5):
        assert found(spelling_variants(words, ratio)) == brute(counts, ratio)
    with pytest.raises(ValueError):
        spelling_variants(words, 1)
    near = {r.word: (r.n_near, r.near, r.near_n) for r in near_words(words).collect()}
    assert near["colours"] == (1, "colour", 50)
    assert near["colour"] == (3, "golour", 50)
    assert near["golour"] == (2, "colour", 50)


def test_counts_of_words(spark):
    rng = random.Random(3)
    stock = ["Straße", "STRASSE", "naïveté", "übergrößen", "aaaaaaa", "ÀÉÎÕÜß", "x×y÷zzz", "don't", "longword", "Ābcdefgh", "Ã bcdefgh"]
    texts = [" ".join(rng.choice(stock) + rng.choice(["", "s", "\n", "1", "漢"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(900, None), (901, "")]
    docs = documents(spark, rows)
    for every in (199, 7, None):
        assert dict(map(tuple, word_counts(docs.repartition(3), slip_every=every).collect())) == brute_counts(rows, slip_every=every)


def test_odd_rows_repeated_rows_and_clashing_names(spark):
    docs = odd_documents(spark)
    docs = with_clashes(docs.unionAll(docs).unionAll(docs), "word", "n", "key", "form")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = brute_counts(rows, least=3)
    assert any(len(w) > 200_000 for w in counts)
    words = word_counts(docs, least=3, slip_every=199)
    assert dict(map(tuple, words.collect())) == counts
    assert found(spelling_variants(words)) == brute(counts)


def test_no_rows(spark):
    assert found(spelling_variants(word_counts(documents(spark, [])))) == []
    assert found(spelling_variants(word_counts(documents(spark, [None, "", "1 2"])))) == []
