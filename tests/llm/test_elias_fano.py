import random

import numpy as np
import pytest

from shelfwise.llm.elias_fano import BigramTrie, EliasFano


@pytest.mark.parametrize(("n", "universe"), [(1, 1), (1, 1 << 48), (50, 60), (500, 1 << 20), (3000, 1 << 63), (2000, 300)])
def test_access_and_successor(n, universe):
    rng = random.Random(n)
    values = np.array(sorted(rng.randrange(universe) for _ in range(n)), dtype=np.uint64)
    held = EliasFano.of(values, universe)
    assert (held.at(np.arange(n)) == values).all()
    asked = np.array([rng.randrange(universe) for _ in range(500)] + values.tolist() + [0, universe - 1], dtype=np.uint64)
    index, equal = held.successor(asked)
    assert (index == np.searchsorted(values, asked)).all()
    assert (equal == np.isin(asked, values)).all()


def test_no_values():
    held = EliasFano.of(np.zeros(0, np.uint64), 1 << 40)
    index, equal = held.successor(np.array([0, 5, (1 << 40) - 1], dtype=np.uint64))
    assert index.tolist() == [0, 0, 0] and not equal.any()


def test_it_is_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 100_000)).astype(np.uint64)
    held = EliasFano.of(values, 1 << 40)
    # Two bits and the logarithm of the mean gap, and a directory for the high parts.
    assert sum(a.nbytes for a in held.arrays()) * 8 / len(values) < 2 + np.log2((1 << 40) / len(values)) + 3


def test_trie_finds_each_child_and_no_other():
    rng = random.Random(6)
    contexts = np.array(sorted(rng.sample(range(1, 1 << 62), 300)), dtype=np.uint64)
    words = np.array(sorted(rng.sample(range(1 << 48), 400)), dtype=np.uint64)
    children = [sorted(rng.sample(range(400), rng.randrange(1, 30))) for _ in contexts]
    flat = np.array(sum(children, []))
    values = np.arange(1, len(flat) + 1).astype(np.uint16)
    trie = BigramTrie(contexts, np.array([len(c) for c in children]), words, flat, np.arange(300, dtype=np.uint16), values, 64, 48)
    index, known = trie.find_contexts(np.append(contexts, np.uint64(12345)))
    assert known.tolist() == [True] * 300 + [False]
    assert (trie.context_values[index[:300]] == np.arange(300)).all()
    truth = {(c, w): v for v, (c, w) in enumerate(((c, w) for c, of in enumerate(children) for w in of), 1)}
    asked = [(c, w) for c in range(300) for w in range(0, 400, 3)]
    at, there = trie.find(np.array([c for c, _ in asked]), words[[w for _, w in asked]])
    got = np.where(there, trie.child_values[at], 0)
    assert got.tolist() == [truth.get(p, 0) for p in asked]
    _, there = trie.find(np.zeros(1, int), np.array([words[0] + np.uint64(1)]))
    assert not there.any() or words[1] == words[0] + 1
    trie.close()
