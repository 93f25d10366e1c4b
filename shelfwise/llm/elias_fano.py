"""A two-level n-gram trie of Elias-Fano sequences in one memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

_ONE = np.uint64(1)
_WORD = np.uint64(63)
_SIX = np.uint64(6)


def _low_mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


class EliasFano:
    """A sorted sequence of numbers: low bits packed, high bits in unary.

    ``low`` holds ``width`` bits for each number. In ``high`` number i sets the bit
    (number >> width) + i, and ``ones`` counts the set bits before each word of it.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """From sorted numbers below ``universe``."""
        n = len(values)
        width = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = _pack(values & _low_mask(width), width)
        places = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        # A zero for each high part up to the universe's, and one to end the last.
        size = n + (universe >> width) + 2
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[places.astype(np.int64)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))
        return cls(n, width, low, high, ones)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones]

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> _SIX).astype(np.int64), at & _WORD
        first = self.low[word] >> shift
        # The rest lies in the next word; a shift by 64 is none, so shift by 63 and 1.
        second = (self.low[word + 1] << (_WORD - shift)) << _ONE
        return (first | second) & _low_mask(self.width)

    def _select(self, k: np.ndarray, of_ones: bool) -> np.ndarray:
        """Place of the k-th set, or not set, bit of the high part, from 0."""
        before = self.ones if of_ones else np.arange(len(self.ones)) * 64 - self.ones
        word = np.searchsorted(before, k, side="right") - 1
        left = k - before[word]
        bits = self.high[word] if of_ones else ~self.high[word]
        place = np.zeros(len(k), dtype=np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            half = np.bitwise_count((bits >> place.astype(np.uint64)) & _low_mask(step)).astype(np.int64)
            up = left >= half
            left = np.where(up, left - half, left)
            place += np.where(up, step, 0)
        return word * 64 + place

    def at(self, i: np.ndarray) -> np.ndarray:
        """The numbers at indices ``i``."""
        high = (self._select(i.astype(np.int64), True) - i).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._lows(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first number that is not below each ``x``, and whether it equals it."""
        x = x.astype(np.uint64)
        part = (x >> np.uint64(self.width)).astype(np.int64)
        end = self._select(part, False) - part
        start = np.where(part > 0, self._select(np.maximum(part - 1, 0), False) - (part - 1), 0)
        wanted = x & _low_mask(self.width)
        # Binary search among the numbers with the same high part.
        low, high = start.copy(), end.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            below = self._lows(middle) < wanted[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
        equal = low < end
        at = np.flatnonzero(equal)
        equal[at] = self._lows(low[at]) == wanted[at]
        return low, equal


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each, one after the other, and a spare word."""
    n = len(values)
    out = np.zeros(-(-n * width // 64) * 8 + 16, dtype=np.uint8)
    block = 1 << 16  # a multiple of 8, so that each block begins at a whole byte
    for a in range(0, n if width else 0, block):
        bytes_ = values[a : a + block].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(bytes_, axis=1, count=width, bitorder="little")
        packed = np.packbits(bits.reshape(-1), bitorder="little")
        out[a * width // 8 : a * width // 8 + len(packed)] = packed
    return out[: len(out) // 8 * 8].view(np.uint64)


class BigramTrie:
    """Contexts and the words seen after them, with a value for each, in a memory-mapped file.

    The word level ranks the words. The context level has sorted contexts, and monotone
    pointers to their children. The child level has the children's ranks, made one
    sorted sequence by adding to each context's the end of the context before.
    """

    def __init__(self, contexts: np.ndarray, counts: np.ndarray, words: np.ndarray, children: np.ndarray, context_values: np.ndarray, child_values: np.ndarray, context_bits: int, word_bits: int):
        """``contexts`` and ``words`` sorted; ``children`` as ranks of words, sorted within each context."""
        pointers = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        last = children[pointers[1:] - 1].astype(np.int64) + 1
        bases = np.concatenate(([0], np.cumsum(last)))
        relative = children.astype(np.int64) + np.repeat(bases[:-1], counts)
        levels = [
            EliasFano.of(words, 1 << word_bits),
            EliasFano.of(contexts, 1 << context_bits),
            EliasFano.of(pointers, int(pointers[-1]) + 1),
            EliasFano.of(bases, int(bases[-1]) + 1),
            EliasFano.of(relative, int(bases[-1]) + 1),
        ]
        arrays = [a for level in levels for a in level.arrays()] + [context_values, child_values]
        # The file has no name from the start, so it goes with the task, however that ends.
        self._file = tempfile.TemporaryFile()
        offsets = []
        for array in arrays:
            offsets.append(self._file.tell())
            self._file.write(np.ascontiguousarray(array).tobytes())
            self._file.write(b"\0" * (-self._file.tell() % 8))
        self._file.flush()
        mapped = [
            np.memmap(self._file, dtype=a.dtype, mode="r", offset=o, shape=a.shape) if a.size else a
            for a, o in zip(arrays, offsets, strict=True)
        ]
        self.words, self.contexts, self.pointers, self.bases, self.children = (
            EliasFano(level.n, level.width, *mapped[3 * k : 3 * k + 3]) for k, level in enumerate(levels)
        )
        self.context_values, self.child_values = mapped[-2:]

    def find_contexts(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each context, and whether it is there."""
        return self.contexts.successor(contexts)

    def find(self, index: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the child of the context at ``index`` for each word, and whether it is there."""
        rank, known = self.words.successor(words)
        at = np.zeros(len(words), dtype=np.int64)
        there = known.copy()
        k = np.flatnonzero(known)
        base, stop = self.bases.at(index[k]).astype(np.int64), self.bases.at(index[k] + 1).astype(np.int64)
        inside = base + rank[k] < stop  # beyond, the successor is another context's
        k, base = k[inside], base[inside]
        there[:] = False
        found, equal = self.children.successor(base + rank[k])
        there[k] = equal
        at[k] = found
        return at, there

    def bits(self) -> int:
        """Size of the levels."""
        levels = (self.words, self.contexts, self.pointers, self.bases, self.children)
        return 8 * (sum(a.nbytes for x in levels for a in x.arrays()) + self.context_values.nbytes + self.child_values.nbytes)

    def close(self) -> None:
        self._file.close()
