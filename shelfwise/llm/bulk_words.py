"""Words of Arrow texts, cut in bulk with numpy: byte classes, places, and exact dictionary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are cut at once; some twenty times as much memory is used meanwhile.
SLICE_BYTES = 2 << 20

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


@dataclass(frozen=True)
class Texts:
    """The UTF-8 bytes of an Arrow column, null as empty, and where each row begins and the last ends."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        filled = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, offsets, data = filled.buffers()
        places = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
        return cls(np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), places)

    def slices(self, cuttable: np.ndarray, size: int = SLICE_BYTES) -> Iterator[Slice]:
        """Whole rows of at most ``size`` bytes together; a longer row is cut behind bytes marked in ``cuttable``.

        A stretch of more than ``size`` bytes without such a byte stays whole.
        """
        low, end = int(self.offsets[0]), int(self.offsets[-1])
        while low < end:
            high = min(low + size, end)
            if high < end:
                row = int(np.searchsorted(self.offsets, high, "right")) - 1
                if self.offsets[row] > low:
                    high = int(self.offsets[row])
                else:
                    high = self._cut(cuttable, low, high, int(self.offsets[row + 1]))
            yield Slice(self.data[low:high], low, self.offsets)
            low = high

    def _cut(self, cuttable: np.ndarray, low: int, high: int, row_end: int) -> int:
        before = np.flatnonzero(cuttable[self.data[low:high]])
        if len(before):
            return low + int(before[-1]) + 1
        step = high - low
        while high < row_end:
            after = np.flatnonzero(cuttable[self.data[high : min(high + step, row_end)]])
            if len(after):
                return high + int(after[0]) + 1
            high += step
        return min(high, row_end)


@dataclass(frozen=True)
class Slice:
    """Some of the bytes, from ``low`` on."""

    data: np.ndarray
    low: int
    offsets: np.ndarray

    def _row_starts(self) -> np.ndarray:
        """Places in the slice where a row begins."""
        first, last = np.searchsorted(self.offsets, (self.low, self.low + len(self.data)), "left")
        return self.offsets[first:last] - self.low

    def rows(self, places: np.ndarray) -> np.ndarray:
        """The row of each place."""
        return np.searchsorted(self.offsets, places + self.low, "right") - 1

    def words(self, inside: np.ndarray, shown: np.ndarray) -> Words:
        """The maximal runs of bytes ``inside`` within rows, as they stand in ``shown``."""
        edge = np.zeros(len(inside) + 1, bool)  # before which bytes a run cannot go on
        edge[self._row_starts()] = True
        edge[0] = edge[-1] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        starts, lengths = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        lengths -= starts
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(lengths, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(shown[inside]))]
        coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        return Words(starts, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary)


@dataclass(frozen=True)
class Words:
    """Words in their order: where they begin, and which of the distinct words each is."""

    starts: np.ndarray
    codes: np.ndarray
    distinct: pa.Array
