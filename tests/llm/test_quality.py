import math
import struct

import numpy as np
import pytest
import xxhash
import zstandard

from shelfwise.llm.common import bucket, read
from shelfwise.llm.quality import CHUNK, DICTIONARY_BYTES, SAMPLE_CHUNKS, SAMPLE_DOCUMENTS, _compressor, score_quality
from tests.llm.helpers import by_key, documents, odd_documents, with_clashes

GOOD = [(i, f"a calm sentence about number {i} and the things that follow from it") for i in range(200)]
BAD = [(1000 + i, f"$$$ BUY {i} NOW!!! " * 20) for i in range(200)]


def labels(spark, rows=None):
    rows = [(k, 1) for k, _ in GOOD] + [(k, 0) for k, _ in BAD] + [(5000, 1), (5001, None), (5002, 0), (5003, 7), (None, 1)] if rows is None else rows
    return spark.createDataFrame(rows, "doc_id bigint, label int")


def test_told_apart(spark):
    asked = [(9000, "a calm sentence about number 77 and what follows"), (9001, "$$$ BUY 9 NOW!!! $$$ BUY 9 NOW!!!")]
    docs = documents(spark, GOOD + BAD + [(5000, None), (5001, "x"), (5002, ""), (5003, "y")] + asked)
    scores = by_key(score_quality(docs, labels(spark)))
    assert len(scores) == docs.count()
    assert scores[9000]["score"] > 0.9 > 0.1 > scores[9001]["score"]


def test_odd_rows(spark):
    docs = odd_documents(spark).unionByName(documents(spark, [(k + 100, t) for k, t in GOOD + BAD]))
    known = with_clashes(labels(spark, [(k + 100, 1) for k, _ in GOOD] + [(k + 100, 0) for k, _ in BAD]), "key", "bytes")
    rows = score_quality(with_clashes(docs, "key", "score", "difference", "label"), known).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (0, 1)}
    assert len(empty) == 1


def test_few_labels(spark):
    docs = documents(spark, [f"text {i} is fine" for i in range(60)])
    assert {r["score"] for r in score_quality(docs, labels(spark, [])).collect()} == {0.5}
    one = score_quality(docs, labels(spark, [(i, 1) for i in range(60)])).collect()
    assert all(r["score"] > 0.9 for r in one)
    assert score_quality(documents(spark, []), labels(spark)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = read(spark, sf, "documents")
    known = read(spark, sf, "labels").select("doc_id", "quality")
    learn = known.where(bucket("doc_id", 5) != 0).withColumnRenamed("quality", "label")
    scores = score_quality(docs, learn).join(known.where(bucket("doc_id", 5) == 0), "doc_id").collect()
    good = sorted(r["score"] for r in scores if r["quality"] == 1)
    bad = sorted(r["score"] for r in scores if r["quality"] == 0)
    above = sum(sum(g > b for g in good) + 0.5 * sum(g == b for g in good) for b in bad)
    assert above / (len(good) * len(bad)) > 0.9
    assert sum(s >= 0.3 for s in good) > 0.95 * len(good)


@pytest.mark.parametrize("size", [1, 4095, 4096, 4097, 20_000])
def test_whole_texts_are_measured(size):
    from shelfwise.llm.quality import _compressor, difference

    plain = _compressor(b"")
    assert difference(b"x" * size, plain, plain) == 0.0
    other = _compressor(b"tail of the text " * 50)
    assert difference(b"q" * size + b"tail of the text " * 20, other, plain) < 0


def signed(data, seed):
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(data, seed=seed)))[0]


def key_hash(key):
    return signed(struct.pack("<q", key), 42)


def brute(docs, labels):
    """Scores by key, one text after the other: sample, dictionaries, sizes, and a logistic curve by Newton's method."""
    half = {key: xxhash.xxh64_intdigest(b"half", seed=key_hash(key) % 2**64) % 2 for key, _ in labels}
    compressors = []
    for label in (1, 0):
        keys = sorted({k for k, x in labels if x == label and half[k] == 0}, key=lambda k: (key_hash(k), k))[:SAMPLE_DOCUMENTS]
        chunks = sorted(
            (signed(struct.pack("<i", i), key_hash(k) % 2**64), text[i * CHUNK : (i + 1) * CHUNK].encode())
            for k, text in docs
            if k in set(keys)
            for i in range(-(-len(text or "") // CHUNK))
        )[:SAMPLE_CHUNKS]
        compressors.append(_compressor(zstandard.train_dictionary(DICTIONARY_BYTES, [c for _, c in chunks]).as_bytes()))
    value = {}
    for key, text in docs:
        data = (text or "").encode()
        good, bad = (sum(len(c.compress(data[i : i + CHUNK])) for i in range(0, len(data), CHUNK)) for c in compressors)
        value[key] = (good - bad) / (good + bad) if data else 0.0
    points = [(value[k], x) for k, x in labels if half[k] == 1 and dict(docs)[k]]
    x, y = (np.array(c, dtype=float) for c in zip(*points))
    design, spread, w = np.stack([x, np.ones(len(x))], axis=1), x.std(ddof=1), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ w))
        penalty = np.diag([1e-6 * spread**2, 0.0])
        gradient = design.T @ (p - y) / len(x) + penalty @ w
        w = w - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design / len(x) + penalty, gradient)
    return {key: 1 / (1 + math.exp(-(w[0] * v + w[1]))) for key, v in value.items()}


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    calm = "river stone quiet morning letter garden window evening paper road winter lamp".split()
    loud = "BUY now!!! $$$ cheap CLICK free winner deal http://x.example/ bonus".split()
    docs, labels = [], []
    for key in range(700):
        label = int(rng.random() < 0.5)
        share = 0.75 if label else 0.3
        words = [str(rng.choice(calm if rng.random() < share else loud)) + str(rng.integers(30)) for _ in range(int(rng.integers(3, 60)))]
        docs.append((key, " ".join(words)))
        if key % 5:
            labels.append((key, label))
    docs += [(9000, " ".join(docs[0][1] for _ in range(200))), (9001, ""), (9002, "ä" * 5000)]
    expected = brute(docs, labels)
    found = by_key(score_quality(documents(spark, docs).repartition(5), labels_of(spark, labels)))
    assert found.keys() == expected.keys()
    # Both fits stop close to the optimum, not at the same number.
    assert all(math.isclose(found[k]["score"], expected[k], abs_tol=2e-3) for k in expected)
    assert len({round(v, 2) for v in expected.values()}) > 10


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, label int")
