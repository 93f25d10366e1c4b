"""Quality classifier by compression: which of two dictionaries packs a text better.

One zstandard dictionary is built from good labelled text and one from bad. A text is cut
into chunks, each compressed with both; the difference of the two total sizes, over their
sum, is the only feature, and a logistic regression turns it into a probability. The
dictionaries come from a bounded sample of one half of the labelled documents, the
calibration from all documents of the other half. Texts stay where they are: labels meet
the measured differences, and only the sample's keys are sent to the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import settled, utf8

# The bounded sample: so many documents of each label, and so many chunks of their whole
# texts, of so many characters at most.
SAMPLE_DOCUMENTS = 2000
SAMPLE_CHUNKS = 1000
CHUNK = 4096
DICTIONARY_BYTES = 96 * 1024
LEVEL = 3
THRESHOLD = 0.3


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=parameters)
    data = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)


def difference(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """Size with the good dictionary less that with the bad one, over their sum: below 0 for good text, 0 for none."""
    sizes = [0, 0]
    for at in range(0, len(text), CHUNK):
        piece = text[at : at + CHUNK]
        sizes[0] += len(good.compress(piece))
        sizes[1] += len(bad.compress(piece))
    return (sizes[0] - sizes[1]) / sum(sizes) if text else 0.0


def _differences(good: bytes, bad: bytes):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _compressor(good), _compressor(bad)
        for part in parts:
            texts = list(utf8(part.column("text")))
            values = np.array([difference(t, first, second) for t in texts], dtype=np.float64)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(values), pa.array(sizes)], names=["key", "difference", "bytes"]
            )

    return run


def measured(docs: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``key, difference, bytes`` for rows ``key, text``."""
    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(_differences(good, bad), f"key {kind}, difference double, bytes bigint")


def _dictionary(docs: DataFrame, labels: DataFrame, label: int) -> bytes:
    """Built from the chunks with the smallest hashes, of the documents of that label with the smallest hashes."""
    chosen = labels.where(F.col("label") == label).select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(SAMPLE_DOCUMENTS)
    # SAMPLE_DOCUMENTS keys at most.
    texts = docs.where(F.length("text") > 0).join(F.broadcast(settled(chosen)), "key", "left_semi")
    places = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / CHUNK).cast("int"))
    chunks = (
        texts.select("key", "text", F.explode(places).alias("k"))
        .select(F.substring("text", F.col("k") * CHUNK + 1, F.lit(CHUNK)).alias("chunk"), F.xxhash64("key", "k").alias("order"))
        .orderBy("order", "chunk")
        .limit(SAMPLE_CHUNKS)
    )
    samples = [r["chunk"].encode() for r in chunks.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples for a trained dictionary: use them as they are
        return b"".join(samples)[-DICTIONARY_BYTES:]


def train_dictionaries(docs: DataFrame, labels: DataFrame) -> tuple[bytes, bytes]:
    """For good and for bad text, from rows ``key, text`` and ``key, label`` of the half for dictionaries."""
    half = labels.where(_half(0))
    return _dictionary(docs, half, 1), _dictionary(docs, half, 0)


def _half(which: int) -> Column:
    return F.col("label").isin(0, 1) & (F.pmod(F.xxhash64("key", F.lit("half")), F.lit(2)) == which)


def calibrate(differences: DataFrame, labels: DataFrame) -> tuple[float, float]:
    """Slope and intercept of the logistic curve, from the other half's documents that have a text.

    With one label only, every score is near it; with no row at all every score is 0.5.
    """
    points = settled(
        differences.where("bytes > 0").join(labels.where(_half(1)), "key").select("difference", F.col("label").cast("double").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    zeros, ones = counts.get(0.0, 0), counts.get(1.0, 0)
    if not zeros or not ones:
        return 0.0, log((ones + 0.5) / (zeros + 0.5))
    fitted = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-6, maxIter=100).fit(
        points.select(array_to_vector(F.array("difference")).alias("x"), "label")
    )
    return float(fitted.coefficients[0]), float(fitted.intercept)


def probability(slope: float, intercept: float, feature: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(slope) * feature + F.lit(intercept))))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for each document: the probability of label 1, from the whole text.

    ``labels`` holds rows ``key, label`` to learn from; labels other than 0 and 1, and those
    of documents without a text, teach nothing. A null or empty text has difference 0
    and gets the score that belongs to it. Repeated rows give repeated rows, an empty
    table none; other columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = labels.select(F.col(key).alias("key"), "label")
    good, bad = train_dictionaries(rows, known)
    differences = settled(measured(rows, good, bad))
    slope, intercept = calibrate(differences, known)
    return differences.select(F.col("key").alias(key), probability(slope, intercept, F.col("difference")).alias("score"))
