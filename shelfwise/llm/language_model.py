"""Language-model scoring with an interpolated bigram model in sharded Elias-Fano tries.

1. Tasks turn documents into blocks of bounded size: a vocabulary and word numbers.
2. Each block sends its distinct words to shards by hash, and gets their corpus counts.
3. Each block sends its distinct word pairs, with their training counts, to the shard of
   the first word. The shard adds up all blocks' counts, builds its trie of smoothed,
   quantised probabilities, looks up the pairs of every block, and sends back the codes.
   So one shuffle both gathers the model and asks it.
4. A first word with a large share of all tokens would make one shard large. Its pairs go
   to shards by the second word instead, which send back counts; what smoothing needs to
   know of such a word is a few numbers, added up over the shards.
5. The codes meet their block again, which sums the logarithms of each document.

The discount of a word h is D = (n1 + 9) / (n1 + 2 n2 + 10), where n1 and n2 count the
words that followed it once and twice: close to 1 unless pairs recur. With T words seen
after h, P(w | h) = max(c(h w) - D, 0) / c(h) + D T / c(h) P(w), which sums to one over
the words and one unknown word; P(w) is the add-one estimate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ASCII_LOWER, utf8, written
from shelfwise.llm.elias_fano import BigramTrie

# Tokens after which a block ends with its document, and distinct pairs for which there is a shard.
BLOCK_TOKENS = 1_800_000
SHARD_PAIRS = 1_000_000
# A word with over 1.5 of so many parts of all tokens is split; twice as many words can be.
HOT_PARTS = 1000

# Stand-ins for the start and the end of a text among the 64-bit word hashes.
START, END = 0, 1
# Words are told apart by 48 bits of their hash among those that follow one word.
_WORD_BITS = 48
_WORD_MASK = np.uint64((1 << _WORD_BITS) - 1)
# Logarithms from 0 to -16 in 65,534 steps; code 0 stands for none.
_STEP = 16.0 / 65_534


def to_code(logs: np.ndarray) -> np.ndarray:
    """Base-10 logarithms, of either sign but below 16 in size, as 16-bit codes."""
    return (np.minimum(np.round(np.abs(logs) / _STEP), 65_534) + 1).astype(np.uint16)


def from_code(codes: np.ndarray) -> np.ndarray:
    """The size of the logarithm of each code but 0."""
    return (codes.astype(np.float64) - 1) * _STEP


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: for each, its kind, its length, and its values by place in the value, compressed."""
    out = []
    for array in arrays:
        array = np.ascontiguousarray(array)
        planes = array.view(np.uint8).reshape(len(array), array.itemsize).T
        out += [np.array([ord(array.dtype.char), len(array)], dtype=np.int64).tobytes(), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, n = np.frombuffer(raw, dtype=np.int64, count=2, offset=at).tolist()
        dtype = np.dtype(chr(kind))
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * dtype.itemsize, offset=at + 16)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).reshape(-1).view(dtype))
        at += 16 + n * dtype.itemsize
    return out


def _six(words: np.ndarray) -> np.ndarray:
    """The low 48 bits of each as three 16-bit numbers, the lowest first, planes one after the other."""
    return np.ascontiguousarray(words.view(np.uint16).reshape(-1, 4)[:, :3].T).reshape(-1)


def _unsix(parts: np.ndarray) -> np.ndarray:
    low, middle, high = parts.reshape(3, -1).astype(np.uint64)
    return low | (middle << np.uint64(16)) | (high << np.uint64(32))


def word_hash(word: bytes) -> int:
    hashed = xxhash.xxh64_intdigest(word)
    return hashed if hashed > END else hashed + 2


@dataclass
class _Block:
    """Documents as word numbers: ``tokens`` of all, the end of each included, and where each one ends."""

    vocabulary: np.ndarray
    tokens: np.ndarray
    ends: np.ndarray
    train: np.ndarray

    @classmethod
    def of(cls, data: bytes) -> _Block:
        return cls(*_unpack(data))

    def in_training(self) -> np.ndarray:
        return np.repeat(self.train, np.diff(self.ends, prepend=0)).astype(bool)

    def before(self) -> np.ndarray:
        """The number of each token's predecessor; the start's is the vocabulary's size."""
        out = np.concatenate(([0], self.tokens[:-1])).astype(np.int64)
        out[np.concatenate(([0], self.ends[:-1])) if len(self.ends) else []] = len(self.vocabulary)
        return out


def _blocks(block_tokens: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        keys: list = []
        train: list[bool] = []
        docs: list[np.ndarray] = []
        numbers: dict[bytes, int] = {}
        held = 0

        def emit() -> pa.RecordBatch:
            hashes = np.array([END, *map(word_hash, numbers)], dtype=np.uint64)
            tokens = np.concatenate(docs).astype(np.int64)
            # Two words of one hash are one word; then the most frequent word is number 0.
            hashes, same = np.unique(hashes, return_inverse=True)
            tokens = same[tokens]
            order = np.argsort(-np.bincount(tokens, minlength=len(hashes)), kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            data = _pack(hashes[order], place[tokens].astype(np.uint32), np.cumsum([len(d) for d in docs]).astype(np.int64), np.array(train, dtype=np.uint8))
            pairs = min(len(tokens), len(hashes) ** 2)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{task}-{nth}"]), pa.array([keys], pa.list_(kind)), pa.array([data], pa.binary()), pa.array([pairs], pa.int64())],
                names=["block", "keys", "data", "pairs"],
            )

        for part in parts:
            kind = part.schema.field(0).type
            for key, text, learn in zip(part.column(0).to_pylist(), utf8(part.column(1)), part.column(2).to_pylist(), strict=True):
                words = text.translate(ASCII_LOWER).split()
                ids = [numbers.setdefault(w, len(numbers) + 1) for w in words]
                ids.append(0)
                docs.append(np.array(ids, dtype=np.uint32))
                keys.append(key)
                train.append(bool(learn))
                held += len(ids)
                if held >= block_tokens:
                    yield emit()
                    keys, train, docs, numbers, held, nth = [], [], [], {}, 0, nth + 1
        if docs:
            yield emit()

    return run


def _route(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by shard, stable, and where each shard begins in it."""
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


_SENT = pa.schema([("shard", pa.int32()), ("block", pa.string()), ("data", pa.binary())])
_SENT_SQL = "shard int, block string, data binary"


def _send(make: Callable[[_Block], Iterator[tuple[int, bytes]]]):
    """Messages of each block to shards."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, data in zip(part.column("block").to_pylist(), part.column("data"), strict=True):
                for shard, message in make(_Block.of(data.as_py())):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int32()), pa.array([name]), pa.array([message], pa.binary())], schema=_SENT
                    )

    return run


def _word_messages(shards: int):
    def make(block: _Block) -> Iterator[tuple[int, bytes]]:
        counts = np.bincount(block.tokens[block.in_training()], minlength=len(block.vocabulary))
        order, bounds = _by_shard(_route(block.vocabulary, shards), shards)
        for s in range(shards):
            at = order[bounds[s] : bounds[s + 1]]
            if len(at):
                yield s, _pack(block.vocabulary[at], counts[at].astype(np.int64))

    return make


def _messages(table: pa.Table) -> tuple[list[str], list[list[np.ndarray]]]:
    """In the order of the blocks' names, whatever order they came in."""
    names = table.column("block").to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    data = table.column("data")
    return [names[i] for i in order], [_unpack(data[i].as_py()) for i in order]


_BACK = pa.schema([("block", pa.string()), ("kind", pa.string()), ("shard", pa.int32()), ("data", pa.binary()), ("stats", pa.binary())])
_BACK_SQL = "block string, kind string, shard int, data binary, stats binary"


def _back(names: list[str], kind: str, shard: int, data: list[bytes], stats: bytes | None) -> pa.Table:
    """The answers to each block, and a row of the shard's own numbers under no block."""
    rows = [*zip(names, data, [None] * len(names), strict=True), ("", None, stats)]
    return pa.table(
        [
            pa.array([r[0] for r in rows]),
            pa.array([kind] * len(rows)),
            pa.array([shard] * len(rows), pa.int32()),
            pa.array([r[1] for r in rows], pa.binary()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        schema=_BACK,
    )


def _split(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1])


def _count_words(table: pa.Table) -> pa.Table:
    """The corpus count of each word of each block; in all, tokens and distinct words of this shard."""
    names, messages = _messages(table)
    words, inverse = np.unique(np.concatenate([m[0] for m in messages]), return_inverse=True)
    counts = np.bincount(inverse, weights=np.concatenate([m[1] for m in messages]), minlength=len(words)).astype(np.int64)
    answers = _split(counts[inverse], [len(m[0]) for m in messages])
    stats = np.array([counts.sum(), (counts > 0).sum()], dtype=np.int64)
    return _back(names, "words", table.column("shard")[0].as_py(), [_pack(a) for a in answers], _pack(stats))


@dataclass
class _Pairs:
    """The distinct pairs of a block, in the order in which they are sent."""

    first: np.ndarray  # word numbers; the vocabulary's size is the start
    second: np.ndarray
    trained: np.ndarray  # how often in training
    shard: np.ndarray
    place: np.ndarray | None  # of each token's pair in this order, -1 if its pair is not here


def _pairs(block: _Block, hot: np.ndarray, shards: int, is_hot: bool, places: bool) -> _Pairs:
    """Those whose first word is hot, by the hash of the second; or those of the others, by that of the first."""
    hashes = np.append(block.vocabulary, np.uint64(START))
    before = block.before()
    chosen = np.isin(hashes, hot)[before] == is_hot
    key = before[chosen] * len(block.vocabulary) + block.tokens[chosen]
    unique, inverse = np.unique(key, return_inverse=True)
    trained = np.bincount(inverse, weights=block.in_training()[chosen], minlength=len(unique)).astype(np.uint32)
    first, second = np.divmod(unique, max(1, len(block.vocabulary)))
    shard = _route(hashes[second if is_hot else first], shards)
    order, _ = _by_shard(shard, shards)
    place = None
    if places:
        to = np.empty(len(order), dtype=np.int64)
        to[order] = np.arange(len(order))
        place = np.full(len(block.tokens), -1)
        place[chosen] = to[inverse]
    return _Pairs(first[order], second[order], trained[order], shard[order], place)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    return starts, np.diff(np.append(starts, len(values)))


def _pair_messages(hot: np.ndarray, shards: int, is_hot: bool):
    def make(block: _Block) -> Iterator[tuple[int, bytes]]:
        hashes = np.append(block.vocabulary, np.uint64(START))
        pairs = _pairs(block, hot, shards, is_hot, places=False)
        for start, size in zip(*map(np.ndarray.tolist, _runs(pairs.shard)), strict=True):
            at = slice(start, start + size)
            starts, lengths = _runs(pairs.first[at])
            yield int(pairs.shard[start]), _pack(
                hashes[pairs.first[at][starts]], lengths.astype(np.uint32), _six(hashes[pairs.second[at]]), pairs.trained[at]
            )

    return make


def discount(once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    return (once + 9.0) / (once + 2.0 * twice + 10.0)


@dataclass
class _Gathered:
    """All blocks' pairs of a shard, the same ones added up."""

    contexts: np.ndarray
    words: np.ndarray
    context: np.ndarray  # of each distinct pair, as index
    word: np.ndarray
    counts: np.ndarray
    inverse: np.ndarray  # of each pair as sent
    run_contexts: np.ndarray  # of each run as sent


def _gather(messages: list[list[np.ndarray]]) -> _Gathered:
    lengths = np.concatenate([m[1] for m in messages])
    contexts, of_run = np.unique(np.concatenate([m[0] for m in messages]), return_inverse=True)
    words, of_pair = np.unique(np.concatenate([_unsix(m[2]) for m in messages]), return_inverse=True)
    key = np.repeat(of_run, lengths) * len(words) + of_pair
    unique, inverse = np.unique(key, return_inverse=True)
    counts = np.bincount(inverse, weights=np.concatenate([m[3] for m in messages]), minlength=len(unique)).astype(np.int64)
    context, word = np.divmod(unique, max(1, len(words)))
    return _Gathered(contexts, words, context, word, counts, inverse, of_run)


def _stats(g: _Gathered) -> np.ndarray:
    """By context: tokens, distinct words, words seen once and twice in training."""
    size = len(g.contexts)
    weights = (g.counts, g.counts > 0, g.counts == 1, g.counts == 2)
    return np.stack([np.bincount(g.context, weights=w, minlength=size) for w in weights]).astype(np.int64)


def _trie(g: _Gathered, context_codes: np.ndarray, child_codes: np.ndarray) -> BigramTrie:
    """Of the pairs seen in training."""
    seen = g.counts > 0
    here, counts = np.unique(g.context[seen], return_counts=True)
    return BigramTrie(
        g.contexts[here], counts, g.words, g.word[seen], context_codes[here], child_codes[seen], context_bits=64, word_bits=_WORD_BITS
    )


def _ask(trie: BigramTrie, g: _Gathered) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all distinct pairs and of all contexts; 0 for those not in the trie."""
    index, known = trie.find_contexts(g.contexts)
    context_codes = np.zeros(len(g.contexts), dtype=np.uint16)
    context_codes[known] = trie.context_values[index[known]]
    codes = np.zeros(len(g.context), dtype=np.uint16)
    at = np.flatnonzero(known[g.context])
    found, there = trie.find(index[g.context[at]], g.words[g.word[at]])
    codes[at[there]] = trie.child_values[found[there]]
    return codes, context_codes


def _answer_pairs(is_hot: bool):
    def run(table: pa.Table) -> pa.Table:
        names, messages = _messages(table)
        shard = table.column("shard")[0].as_py()
        g = _gather(messages)
        tokens, kinds, once, twice = stats = _stats(g)
        with np.errstate(divide="ignore", invalid="ignore"):
            if is_hot:
                # Counts come back; the block knows the rest.
                child_codes, context_codes = to_code(np.log10(np.maximum(g.counts, 1))), np.ones(len(g.contexts), np.uint16)
            else:
                d = discount(once, twice)
                child_codes = to_code(np.log10((g.counts - d[g.context]) / tokens[g.context]))
                context_codes = to_code(np.log10(np.where(tokens > 0, d * kinds / tokens, 1.0)))
        trie = _trie(g, context_codes, child_codes)
        codes, context_codes = _ask(trie, g)
        trie.close()
        answers = _split(codes[g.inverse], [len(m[2]) // 3 for m in messages])
        runs = _split(context_codes[g.run_contexts], [len(m[0]) for m in messages])
        data = [_pack(a, r) for a, r in zip(answers, runs, strict=True)]
        return _back(names, "hot" if is_hot else "pairs", shard, data, _pack(g.contexts, stats.reshape(-1)) if is_hot else None)

    return run


def _hot_words(parts_of: int):
    """A block's words with more than one of so many parts of its tokens, the start among them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for data in part.column("data"):
                block = _Block.of(data.as_py())
                counts = np.append(np.bincount(block.tokens, minlength=len(block.vocabulary)), len(block.ends))
                hashes = np.append(block.vocabulary, np.uint64(START)).view(np.int64)
                at = np.flatnonzero(counts * parts_of > len(block.tokens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*hashes[at].tolist(), None], pa.int64()), pa.array([*counts[at].tolist(), len(block.tokens)], pa.int64())],
                    names=["word", "n"],
                )

    return run


def _score(hot: np.ndarray, hot_stats: np.ndarray, shards: int, total: int, distinct: int):
    """Sums the logarithms of a block's documents from the answers it got."""
    known = {int(h): k for k, h in enumerate(hot.tolist())}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _SCORES.empty_table()
        block = _Block.of(left.column("data")[0].as_py())
        answers: dict[str, list[tuple[int, list[np.ndarray]]]] = {"words": [], "hot": [], "pairs": []}
        for kind, shard, data in zip(*(right.column(c).to_pylist() for c in ("kind", "shard", "data")), strict=True):
            answers[kind].append((shard, _unpack(data)))
        for found in answers.values():
            found.sort(key=lambda x: x[0])
        joined = lambda kind, k: np.concatenate([a[k] for _, a in answers[kind]]) if answers[kind] else np.zeros(0, np.uint16)
        counts = np.empty(len(block.vocabulary), dtype=np.int64)
        counts[_by_shard(_route(block.vocabulary, shards), shards)[0]] = joined("words", 0)
        base = (counts + 1.0) / (total + distinct + 1.0)
        p = np.empty(len(block.tokens))
        own = base[block.tokens]

        cold = _pairs(block, hot, shards, False, places=True)
        at = cold.place >= 0
        starts, lengths = _runs(cold.first) if not len(cold.shard) else _runs(cold.shard * (len(block.vocabulary) + 1) + cold.first)
        codes, context = joined("pairs", 0), np.repeat(joined("pairs", 1), lengths)
        direct = np.where(codes > 0, 10.0 ** -from_code(codes), 0.0)
        weight = np.where(context > 0, 10.0 ** -from_code(context), 1.0)
        p[at] = direct[cold.place[at]] + weight[cold.place[at]] * own[at]

        warm = _pairs(block, hot, shards, True, places=True)
        at = warm.place >= 0
        hashes = np.append(block.vocabulary, np.uint64(START))
        rows = np.array([known[h] for h in hashes[warm.first].tolist()], dtype=np.int64)
        tokens, kinds, once, twice = hot_stats[:, rows]
        d = discount(once, twice)
        codes = joined("hot", 0)
        c = np.where(codes > 0, 10.0 ** from_code(codes), 0.0)
        safe = np.maximum(tokens, 1)
        direct = np.where(codes > 0, (c - d) / safe, 0.0)
        weight = np.where(tokens > 0, d * kinds / safe, 1.0)
        p[at] = direct[warm.place[at]] + weight[warm.place[at]] * own[at]

        begins = np.concatenate(([0], block.ends[:-1])).astype(np.int64)
        keys = left.column("keys").combine_chunks().flatten()
        sums = lambda x: np.add.reduceat(x, begins)
        return pa.table(
            {
                "key": keys,
                "trained": pa.array(block.train.astype(bool)),
                "n_tokens": pa.array(np.diff(block.ends, prepend=0)),
                "n_known": pa.array(sums((counts > 0)[block.tokens].astype(np.int64))),
                "train_tokens": pa.array(np.full(len(begins), total)),
                "base_score": pa.array(sums(np.log10(own))),
                "score": pa.array(sums(np.log10(p))),
            }
        )

    return run


_SCORES = pa.schema(
    [("key", pa.int64()), ("trained", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def score_language_model(
    docs: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
    shard_pairs: int = SHARD_PAIRS,
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """``key, trained, n_tokens, n_known, train_tokens, base_score, score`` for each document.

    The model learns from the documents for which ``train`` holds; a null there is no.
    Tokens are the words between ASCII blanks, A-Z in lower case, and one end. Scores are
    base-10 logarithms of the text's probability: ``base_score`` under the add-one
    unigram model, ``score`` under the bigram model. A null text is an empty one, which
    has its end only. Repeated rows are scored and counted each; with no training row
    every probability of a word is that of the unknown one. An empty table gives no row.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = written(
        rows.mapInArrow(_blocks(block_tokens), f"block string, keys array<{kind}>, data binary, pairs bigint"), "blocks"
    )
    shards = max(1, -(-(blocks.agg(F.sum("pairs")).first()[0] or 0) // shard_pairs))
    # At most 2 * hot_parts words: their counts from blocks in which they are frequent add up to over half a part.
    frequent = blocks.mapInArrow(_hot_words(hot_parts), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    every = {r["word"]: r["n"] for r in written(frequent, "frequent").where(F.col("word").isNull()).collect()}.get(None, 0)
    hot = np.sort(
        np.array(
            [r["word"] for r in frequent.where(F.col("word").isNotNull() & (F.col("n") * (2 * hot_parts) > every)).collect()],
            dtype=np.int64,
        ).view(np.uint64)
    )

    def through(messages, answer) -> DataFrame:
        sent = blocks.select("block", "data").mapInArrow(_send(messages), _SENT_SQL)
        return sent.groupBy("shard").applyInArrow(answer, _BACK_SQL)

    words = written(through(_word_messages(shards), _count_words), "words")
    total, distinct = 0, 0
    for row in words.where("block = ''").select("stats").toLocalIterator():
        n, v = _unpack(row["stats"])[0].tolist()
        total, distinct = total + n, distinct + v
    warm = written(through(_pair_messages(hot, shards, True), _answer_pairs(True)), "hot")
    hot_stats = np.zeros((4, len(hot)), dtype=np.int64)
    for row in warm.where("block = ''").select("stats").toLocalIterator():
        contexts, stats = _unpack(row["stats"])
        hot_stats[:, np.searchsorted(hot, contexts)] += stats.reshape(4, -1)
    cold = through(_pair_messages(hot, shards, False), _answer_pairs(False))
    answers = words.unionByName(warm).unionByName(cold).where("block <> ''").select("block", "kind", "shard", "data")
    return (
        blocks.select("block", "keys", "data")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _score(hot, hot_stats, shards, total, distinct),
            f"key {kind}, trained boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
        .withColumnRenamed("key", key)
    )
