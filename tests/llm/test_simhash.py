import random

import pytest
import xxhash

from shelfwise.llm.simhash import drop_near_copies, fingerprint, near_copies
from tests.llm.helpers import bag, documents, odd_documents, with_clashes


def brute_fingerprint(text, shingle=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in "".join(" " if c in "\t\n\v\f\r " else c for c in lower).split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    component = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= radius and component[j] < component[i]:
                    component[i], changed = component[j], True
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if component[j] == component[i] and rows[j][0] is not None]
        out.append((key, f"{prints[i]:016x}", min(keys, default=None)))
    return sorted(out, key=repr)


def family(count, seed):
    """Long texts with a word or two exchanged, so that fingerprints differ in few bits."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(1500)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        out.append(" ".join(words))
    return out


def test_fingerprint_is_the_majority_of_shingles():
    for text in ("", " \n", "a", "A b", "a B c", "a b c d e f g\th", "x " * 5000, "café 漢 \U0001f389 A B C"):
        assert fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize(("segments", "tile"), [(4, 4096), (1, 3), (3, 2), (8, 7)])
def test_equals_brute_force(spark, segments, tile):
    rng = random.Random(segments)
    texts = family(25, 1) + family(25, 2) + [" ".join(f"v{rng.randrange(9)}" for _ in range(rng.randrange(6))) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert bag(near_copies(documents(spark, rows).repartition(4), segments=segments, tile=tile)) == brute(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert bag(near_copies(with_clashes(docs, "key", "fingerprint", "component"))) == brute(rows)


def test_one_document_of_each_group_stays(spark):
    texts = family(20, 3) + ["alpha beta gamma", "alpha  beta gamma", None, ""]
    rows = list(enumerate(texts))
    kept = drop_near_copies(with_clashes(documents(spark, [*rows, rows[0]]), "component_id"))
    expected = {component for *_, component in brute(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


@pytest.mark.parametrize("turn", [1, -1])
def test_each_component_keeps_a_row_whatever_the_keys(spark, turn):
    rows = [
        (3, "alpha beta gamma"),
        (5, "Alpha  beta gamma"),  # of the component that 3 names
        (5, "some quite different words"),  # two components that 5 names
        (5, "another text that is like none of them"),
        (5, "another  text that is like none of them"),
        (6, "some quite different  words"),
        (None, "no key and no copy"),
        (None, "no key and  no copy"),
        (None, "alpha beta  gamma"),
        (None, None),
        (7, "a key of its own"),
        (7, "a key of its own"),
    ]
    docs = with_clashes(documents(spark, rows[::turn]).repartition(3), "fingerprint", "key", "shared")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], " ".join((r["text"] or "").split())) for r in kept.collect()]
    assert sorted(found, key=repr) == sorted(
        [
            (3, "alpha beta gamma"),
            (5, "some quite different words"),
            (5, "another text that is like none of them"),
            (None, "no key and no copy"),
            (None, ""),
            (7, "a key of its own"),
        ],
        key=repr,
    )
    assert bag(kept) == bag(drop_near_copies(docs.orderBy("n_chars", "text")))


def test_empty_table(spark):
    assert near_copies(documents(spark, [])).count() == 0
    assert drop_near_copies(documents(spark, [])).count() == 0
