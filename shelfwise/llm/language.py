"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public byte-level vocabulary. For each language they get
probabilities from the training words, each cut once by the vocabulary's own merges. A
word's probability under a language is the sum over all ways to cut it into pieces, found
by a forward algorithm that runs over many distinct words at once in numpy; a text's is
the product over its words.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import batches

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UNDETERMINED = "und"
# Added to each piece's count; keeps every byte, and so every word, possible.
SMOOTHING = 0.05
# A document with a lower score than this is rejected by the filter.
MIN_SCORE = 0.5

# Words up to this many bytes go through the forward pass together, longer ones one by one: the results are the same.
_TOGETHER = 48
# Below this a product of probabilities may have lost digits, and the word is worked out in logarithms.
_SMALLEST = 1e-280
_GROUP = 5_000
_KEPT_WORDS = 50_000
# Documents looked at together, whatever the size of the batch they come in.
_ROWS = 500
_LETTER = regex.compile(r"\p{L}")
# ASCII letters and all other bytes above ASCII stay; the rest separates words.
_LETTER_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def letter_words(text: bytes) -> list[bytes]:
    """Lower-case runs of letters; anything above ASCII counts as one."""
    return text.translate(_LETTER_BYTES).split()


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=_ranks(path), special_tokens={})


def _usable(piece: bytes) -> bool:
    """Pieces that can stand in a word: a leading space or none, then bytes that stay in words."""
    body = piece.removeprefix(b" ")
    return (bool(body) and body.translate(_LETTER_BYTES) == body and b" " not in body) or piece == b" "


def _piece_counts(path: str):
    """Per task: how often each language's words are cut into each piece."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        pieces: dict[str, Counter] = {}
        encode = _encoding(path)._encode_single_piece

        def settle() -> None:
            for lang, counts in words.items():
                into = pieces.setdefault(lang, Counter())
                for word, n in counts.items():
                    for piece in encode(b" " + word):
                        into[piece] += n
                counts.clear()

        for part in _slices(parts):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()), strict=True):
                words.setdefault(lang, Counter()).update(letter_words(text.as_py() or b""))
            if sum(map(len, words.values())) > _KEPT_WORDS:
                settle()
        settle()
        rows = ((lang, piece, n) for lang, counts in pieces.items() for piece, n in counts.items())
        yield from batches(_COUNTS, rows)

    return run


_COUNTS = pa.schema([("lang", pa.string()), ("piece", pa.int32()), ("n", pa.int64())])


@dataclass(frozen=True)
class LanguageModel:
    """Languages, and for each usable piece its probability under each of them."""

    languages: tuple[str, ...]
    path: str
    table: np.ndarray  # usable pieces x languages

    def pieces(self) -> list[bytes]:
        return usable_pieces(self.path)


@lru_cache(maxsize=2)
def usable_pieces(path: str) -> list[bytes]:
    return sorted(p for p in _ranks(path) if _usable(p))


def train_language(labelled: DataFrame, path: str = VOCABULARY) -> LanguageModel:
    """A model from rows ``text, lang``; rows without a language or a text add nothing.

    Every training text counts whole. What comes to the driver is one count for each
    language and piece: the vocabulary's size times the number of languages.
    """
    counts = (
        labelled.where("lang IS NOT NULL AND text IS NOT NULL")
        .select("lang", "text")
        .mapInArrow(_piece_counts(path), "lang string, piece int, n bigint")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = tuple(sorted(set(counts.column("lang").to_pylist())))
    pieces = usable_pieces(path)
    row = {_ranks(path)[p]: k for k, p in enumerate(pieces)}
    table = np.full((len(pieces), len(languages)), SMOOTHING)
    for lang, piece, n in zip(*(counts.column(c).to_pylist() for c in ("lang", "piece", "n")), strict=True):
        if piece in row:
            table[row[piece], languages.index(lang)] += n
    return LanguageModel(languages, path, table / table.sum(axis=0, keepdims=True))


def _trie(pieces: list[bytes], code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """By node and byte the next node, and by node the piece that ends there or -1; node 0: no piece goes on, node 1: the root.

    All pieces go down one byte at a time, so that no task holds a dictionary for each node.
    """
    size = np.array([len(p) for p in pieces])
    first = np.concatenate(([0], np.cumsum(size)))
    codes = code[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    at, alive = np.ones(len(pieces), dtype=np.int64), np.arange(len(pieces))
    edges, nodes, depth = [], 2, 0
    while len(alive):
        found, below = np.unique(at[alive] * width + codes[first[alive] + depth], return_inverse=True)
        edges.append(found)
        at[alive] = nodes + below
        nodes += len(found)
        depth += 1
        alive = alive[size[alive] > depth]
    step = np.concatenate(edges)
    table = np.zeros((nodes, width), dtype=np.int32)
    table[step // width, step % width] = np.arange(2, nodes)
    end = np.full(nodes, -1, dtype=np.int32)
    end[at] = np.arange(len(pieces))
    return table, end


class Scorer:
    """The forward algorithm over a trie of the pieces."""

    def __init__(self, model: LanguageModel):
        self.languages = model.languages
        self.known: dict[bytes, np.ndarray] = {}
        pieces = model.pieces()
        # Bytes that occur in pieces get small numbers, so that the trie is a dense table.
        self.code = np.zeros(256, dtype=np.int64)
        used = sorted({b for p in pieces for b in p})
        self.code[used] = np.arange(len(used))
        self.next, self.end = _trie(pieces, self.code, len(used))
        # The last row: no piece ends here.
        self.probability = np.vstack([model.table, np.zeros((1, len(model.languages)))])
        self.logarithm = np.log(model.table)

    def _together(self, words: list[bytes]) -> np.ndarray:
        """Log-probabilities of words of equal length, a space put before each."""
        n, size = len(words), len(words[0]) + 1
        codes = self.code[np.frombuffer(b"".join(b" " + w for w in words), dtype=np.uint8)].reshape(n, size)
        forward = np.zeros((size + 1, n, len(self.languages)))
        forward[0] = 1.0
        for start in range(size):
            node = np.ones(n, dtype=np.int32)
            alive = np.arange(n)
            for stop in range(start, size):
                node = self.next[node, codes[alive, stop]]
                if not node.all():
                    alive, node = alive[node > 0], node[node > 0]
                    if not len(node):
                        break
                forward[stop + 1, alive] += forward[start, alive] * self.probability[self.end[node]]
        out = np.log(np.maximum(forward[size], _SMALLEST))
        for i in np.flatnonzero(forward.min(axis=(0, 2)) < _SMALLEST).tolist():
            out[i] = self._alone(words[i])
        return out

    def _pieces_within(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in the bytes, by where they stop: start, piece, and the first of each stop."""
        starts, stops, pieces = [], [], []
        at, node = np.arange(len(codes)), np.ones(len(codes), dtype=np.int32)
        length = 0
        while len(at):
            node = self.next[node, codes[at + length]]
            at, node = at[node > 0], node[node > 0]
            length += 1
            piece = self.end[node]
            starts.append(at[piece >= 0])
            stops.append(at[piece >= 0] + length)
            pieces.append(piece[piece >= 0])
            inside = at + length < len(codes)
            at, node = at[inside], node[inside]
        start, stop, piece = map(np.concatenate, (starts, stops, pieces))
        order = np.argsort(stop, kind="stable")
        return start[order], piece[order], np.searchsorted(stop[order], np.arange(len(codes) + 2))

    def _alone(self, word: bytes) -> np.ndarray:
        """The same for a word of any length, in logarithms: some steps of numpy for each byte."""
        codes = self.code[np.frombuffer(b" " + word, dtype=np.uint8)]
        start, piece, first = self._pieces_within(codes)
        forward = np.zeros((len(codes) + 1, len(self.languages)))
        bounds = first.tolist()
        for stop in range(1, len(codes) + 1):
            low, high = bounds[stop], bounds[stop + 1]
            steps = forward[start[low:high]] + self.logarithm[piece[low:high]]
            most = steps.max(axis=0)
            forward[stop] = most + np.log(np.exp(steps - most).sum(axis=0))
        return forward[-1]

    def words(self, wanted: list[bytes]) -> np.ndarray:
        """Log-probabilities of distinct words, one row each."""
        out = np.empty((len(wanted), len(self.languages)))
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(wanted):
            if len(word) > _TOGETHER:
                out[i] = self._alone(word)
            else:
                by_length.setdefault(len(word), []).append(i)
        for at in by_length.values():
            for k in range(0, len(at), _GROUP):
                group = at[k : k + _GROUP]
                out[group] = self._together([wanted[i] for i in group])
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Log-probabilities of whole texts, one row each."""
        number: dict[bytes, int] = {}
        docs = [[number.setdefault(w, len(number)) for w in letter_words(t)] for t in texts]
        scores = self.words(list(number))
        return np.array([scores[d].sum(axis=0) for d in docs]).reshape(len(texts), len(self.languages))


def _slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for at in range(0, part.num_rows, _ROWS):
            yield part.slice(at, _ROWS)


def _shares(scorer: Scorer | None, texts: list[str | None]) -> tuple[list[int], np.ndarray]:
    """The places of the texts with a letter, and each language's share in the sum of all languages' probabilities of them."""
    at = [i for i, text in enumerate(texts) if has_letter(text)] if scorer is not None else []
    if not at:
        return at, np.empty((0, 0))
    logs = scorer.texts([texts[i].encode() for i in at])
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    return at, shares / shares.sum(axis=1, keepdims=True)


def _identify(held: Broadcast):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        scorer = Scorer(model) if model.languages else None
        for part in _slices(parts):
            texts = part.column("text").to_pylist()
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            at, shares = _shares(scorer, texts)
            if at:
                best = shares.argmax(axis=1)
                for i, b, s in zip(at, best.tolist(), shares.max(axis=1).tolist(), strict=True):
                    names[i], scores[i] = model.languages[b], s
            kept = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for each document, from its whole text.

    The score is the share of the best language in the sum of all languages' text
    probabilities; of equal languages the first in the alphabet wins. A text that is
    null or has no letter gets ``und`` and 0, as does every text under a model that has
    seen no language. Repeated rows give repeated rows, an empty table none.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(_identify(held), f"key {kind}, lang_pred string, score double")
        .withColumnRenamed("key", key)
    )


def _with_unlearned(model: LanguageModel) -> LanguageModel:
    """With a language of which nothing was seen: there all pieces are equally likely."""
    if not model.languages:
        return model
    unseen = np.full((len(model.table), 1), 1.0 / len(model.table))
    return LanguageModel((*model.languages, UNDETERMINED), model.path, np.hstack([model.table, unseen]))


def _accept(held: Broadcast, column: str, least: float, together: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        scorer = Scorer(model) if model.languages else None
        learned = np.array([name != UNDETERMINED for name in model.languages], dtype=bool)
        for part in _slices(parts):
            at, shares = _shares(scorer, part.column(column).to_pylist())
            kept = np.zeros(part.num_rows, dtype=bool)
            if at:
                score = shares[:, learned].sum(axis=1) if together else shares.max(axis=1)
                kept[at] = (score >= least) & (together | learned[shares.argmax(axis=1)])
            yield part.filter(pa.array(kept))

    return run


def keep_identified(
    docs: DataFrame, model: LanguageModel, text: str = "text", min_score: float = MIN_SCORE, together: bool = False
) -> DataFrame:
    """The documents whose language is found with at least ``min_score``, columns unchanged.

    The score is that of ``identify``. With ``together`` it is the share of all languages
    together, beside one of which nothing was seen: a text in any of them stays, however
    close the next one, and a text goes if its pieces are mostly ones that none of them
    uses. Null texts and texts without a letter go.
    """
    held = docs.sparkSession.sparkContext.broadcast(_with_unlearned(model) if together else model)
    return docs.mapInArrow(_accept(held, text, min_score, together), docs.schema)
