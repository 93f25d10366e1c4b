import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpus_pipeline import best_fit_packing
from shelfwise.llm.common import read
from shelfwise.llm.packing import VECTOR, Capacities, encoder, needs, pack, plan_bins
from shelfwise.llm.queries import QUERIES
from tests.llm.helpers import documents, odd_documents, with_clashes


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_tokens_are_those_of_the_tokenizers_library(spark, tokenizer):
    texts = [r["text"] or "" for r in read(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    rng = random.Random(3)
    letters = "ab C\t\n\r \x00\x1f'’éß漢\U0001f389​　٣²_-<|endoftext|>"
    texts += ["".join(rng.choice(letters) for _ in range(200)) for _ in range(300)]
    texts += ["a" * 5000, "<|endoftext|>", "it's I'LL  we've", " " * 100, "\r\n" * 50]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [encoder().encode_ordinary(t) for t in texts] == expected


def test_added_tokens_in_texts_are_those_of_the_library_as_it_comes(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|endoftext|", "|>", " ", "  ", "\n", "end", "next", "é", "'s", "7"]
    texts = ["end <|endoftext|> next", "<|endoftext|>", "<|endoftext|><|endoftext|> "]
    texts += ["".join(rng.choice(parts) for _ in range(40)) for _ in range(300)]
    docs = list(enumerate(texts))
    assert library.encode(texts[0], add_special_tokens=False).ids == [437, 220, 50256, 1306]
    check(pack(documents(spark, docs).repartition(3)).collect(), docs, library, Capacities())


def check(rows, docs, tokenizer, limits):
    """Whole documents, gapless sequences, all limits kept."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        assert len(r["ids"]) == 4 * r["length"]
    for key, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        mine = sorted(pieces[key], key=lambda r: r["piece"])
        assert np.frombuffer(b"".join(bytes(r["ids"]) for r in mine), "<u4").tolist() == ids
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["start"] for r in mine] == np.cumsum([0, *[r["length"] for r in mine[:-1]]]).tolist()
        assert len(mine) == -(-len(ids) // limits.tokens)
        assert all(r["length"] == limits.tokens for r in mine[1:])
    for held in sequences.values():
        held.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == np.cumsum([0, *[r["length"] for r in held[:-1]]]).tolist()
        assert (sum(needs(r["length"]) for r in held) <= limits.vector()).all()
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


LIMITS = [
    Capacities(),
    Capacities(tokens=64),
    Capacities(tokens=64, choose="dot"),
    Capacities(tokens=64, documents=3),
    Capacities(tokens=64, attention=4096 - 900, documents=5, choose="dot"),
]


@pytest.mark.parametrize("limits", LIMITS[:4])
def test_round_trip(spark, tokenizer, limits):
    rng = random.Random(8)
    docs = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(500, "word " * 3000), (501, None), (502, ""), (503, "a")]
    rows = pack(documents(spark, docs).repartition(5), capacities=limits).collect()
    used = check(rows, docs, tokenizer, limits)
    tokens = sum(r["length"] for r in rows)
    if limits.documents is None:
        assert used <= -(-tokens // limits.tokens) + 2


def test_odd_rows(spark, tokenizer):
    docs = odd_documents(spark).where("doc_id IS NULL OR doc_id <> 3")
    keyed = docs.where("doc_id IS NOT NULL")
    found = pack(with_clashes(keyed, "key", "piece", "task", "length")).collect()
    check(found, [(r["doc_id"], r["text"]) for r in keyed.collect()], tokenizer, Capacities())
    assert pack(docs).where("doc_id IS NULL").count() == 2
    # Repeated rows are documents of their own.
    assert pack(odd_documents(spark)).where("doc_id = 3").count() == 2
    assert pack(documents(spark, [])).count() == 0


def brute_bins(steps):
    bins = {}
    for length, _, count, first, offset in steps:
        for b in range(first, first + count):
            bins.setdefault(b, []).append((offset, length))
    return bins


@pytest.mark.parametrize("limits", LIMITS)
def test_plan_keeps_every_limit_and_places_every_piece(limits):
    rng = random.Random(1)
    top = min(limits.tokens, int((limits.attention or limits.tokens**2) ** 0.5))
    lengths = {n: rng.randrange(1, 40) for n in rng.sample(range(1, top + 1), min(40, top))}
    steps = plan_bins(lengths, limits)
    placed = {}
    for length, rank, count, _, _ in steps:
        assert rank == placed.get(length, 0)
        placed[length] = rank + count
    assert placed == lengths
    for held in brute_bins(steps).values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held[:-1]]]).tolist()
        assert (sum(needs(n) for _, n in held) <= limits.vector()).all()


def test_registered_queries_choose_by_all_capacities(spark):
    sf_dir = "/root/testdata/sf0.001"
    for rows in (QUERIES["op3_best_fit_packing"](spark, sf_dir), best_fit_packing(spark, read(spark, sf_dir, "documents"), sf_dir)):
        held = {}
        for r in rows.select("sequence_id", "offset", "length").collect():
            held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        lengths = Counter(n for pieces in held.values() for _, n in pieces)
        by_vector, by_tokens = brute_bins(plan_bins(lengths, VECTOR)), brute_bins(plan_bins(lengths))
        plain = lambda bins: {b: sorted(pieces) for b, pieces in bins.items()}
        assert plain(held) == plain(by_vector) != plain(by_tokens)
        assert len(by_vector) == len(by_tokens)


def least_bins(lengths, size=1024):
    """A lower bound: pieces over half a bin need one each, and only some others fit beside them."""
    best = 0
    for k in range(size // 2 + 1):
        alone = sum(c for n, c in lengths.items() if n > size - k)
        large = [(n, c) for n, c in lengths.items() if size // 2 < n <= size - k]
        rest = sum(n * c for n, c in lengths.items() if k <= n <= size // 2) - sum((size - n) * c for n, c in large)
        best = max(best, alone + sum(c for _, c in large) + max(0, -(-rest // size)))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_near_the_least(seed):
    rng = random.Random(seed)
    lengths = {n: rng.randrange(200) + 1 for n in range(1, 1025 if seed else 400)}
    assert len(brute_bins(plan_bins(lengths))) <= least_bins(lengths) * 1.005


def one_by_one(lengths, capacities):
    """Bins of a vector best-fit that takes one piece after the other, the longest first."""
    limit, weights = capacities.vector().astype(float), capacities.scaled_weights()
    free = np.zeros((0, 3))
    for length in sorted(lengths, reverse=True):
        need = np.array([length, 1, length * length], dtype=float)
        fits = np.flatnonzero((free >= need).all(axis=1))
        if not len(fits):
            free, best = np.vstack([free, limit]), len(free)
        elif capacities.choose == "norm":
            best = fits[(weights * (free[fits] - need) ** 2).sum(axis=1).argmin()]
        else:
            best = fits[(weights * need * free[fits]).sum(axis=1).argmax()]
        free[best] -= need
    return len(free)


@pytest.mark.parametrize("choose", ["norm", "dot"])
@pytest.mark.parametrize("limits", [{}, {"documents": 4}, {"documents": 6, "attention": 300_000}])
def test_as_few_bins_as_piece_by_piece(limits, choose):
    rng = np.random.default_rng(11)
    capacities = Capacities(choose=choose, **limits)
    for top in (300, 540):
        lengths = rng.integers(1, top, 1500).tolist()
        steps = plan_bins(dict(Counter(lengths)), capacities)
        # Bins of one state get their pieces in one round: a hundredth more at most.
        assert len({b for _, _, n, first, _ in steps for b in range(first, first + n)}) <= 1.01 * one_by_one(lengths, capacities) + 1


def test_impossible_pieces_are_refused():
    with pytest.raises(ValueError):
        plan_bins({10: 1}, Capacities(tokens=64, attention=99))
    with pytest.raises(ValueError):
        plan_bins({10: 1}, Capacities(choose="first"))
