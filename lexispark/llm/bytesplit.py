"""Vectorised splitting and hashing of UTF-8 texts in Arrow batches.

A word is a run of bytes outside the six ASCII white-space bytes. That equals `[^\\x20\\x09-\\x0D]+`
over code points, because no byte of a multi-byte UTF-8 character falls into that class.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: 0: white space, 1: letters, digits and all bytes of non-ASCII characters, 2: other ASCII.
KIND = np.full(256, 2, dtype=np.uint8)
KIND[128:] = 1
KIND[48:58] = KIND[65:91] = KIND[97:123] = 1
KIND[WHITE] = 0

#: Texts are handled together up to so many bytes; a longer text is handled alone.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose hash sums are held together.
WINDOW = 1 << 18
_powers: list[np.ndarray] = []


def _power() -> list[np.ndarray]:
    """The powers of the base and of its inverse modulo 2**64 over a window and a range that begins in it."""
    if not _powers:
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(2 * WINDOW, base, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Slice:
    """Consecutive texts of a batch: their bytes, lower-cased on demand, and where each text begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, fold: bool):
        self.first = first
        self.rows = len(offsets) - 1
        self.offsets = offsets
        self.data = LOWER[data] if fold else data

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges (in the order of their starts), equal for equal bytes wherever they stand.

        Ranges are hashed through windows of about WINDOW bytes, so memory follows neither the slice nor the longest range.
        """
        raw, at = np.zeros(len(starts), dtype=np.uint64), 0
        while at < len(starts):
            low = int(starts[at])
            long_ = int(ends[at]) - low > WINDOW
            to = at + 1 if long_ else max(at + 1, int(np.searchsorted(starts, low + WINDOW)))
            if long_:
                raw[at] = self._long(low, int(ends[at]))
            else:
                s, e = starts[at:to] - low, ends[at:to] - low
                whole = e - s <= WINDOW
                data = self.data[low : low + int(e[whole].max())]
                up, down = _power()
                sums = np.zeros(len(data) + 1, dtype=np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
                raw[at:to][whole] = (sums[e[whole]] - sums[s[whole]]) * down[s[whole]]
                for k in np.flatnonzero(~whole):
                    raw[at + k] = self._long(low + int(s[k]), low + int(e[k]))
            at = to
        return mix(raw + (ends - starts).astype(np.uint64))

    def _long(self, start: int, end: int) -> np.uint64:
        """The sum of a range longer than a window, piece by piece."""
        up, total = _power()[0], 0
        for at in range(start, end, WINDOW):
            data = self.data[at : min(at + WINDOW, end)]
            part = int(((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)]).sum(dtype=np.uint64))
            total += part * pow(int(_BASE), at - start, 1 << 64)
        return np.uint64(total & ((1 << 64) - 1))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text numbers of the words."""
        return self._runs((~WHITE[self.data]).view(np.uint8))

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As words(), but a word is cut where letters or digits meet other signs."""
        return self._runs(KIND[self.data])

    def _runs(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(kind)
        if not n:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        cut = np.ones(n + 1, dtype=bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
        cut[self.offsets] = True
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        keep = kind[starts] != 0
        starts, ends = starts[keep], ends[keep]
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1


def release() -> None:
    """Give freed memory back to the system. Spark uses Python workers again for later tasks and stages, and each would keep its largest size."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library alone
    if trim:
        trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; memory is given back when the last has been taken."""
    try:
        yield from batches
    finally:
        release()


def utf8(array: pa.Array) -> pa.Array:
    array = array.cast(pa.large_string())  # first: chunks of over 2 GB together have no 32-bit offsets
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def slices(array: pa.Array, fold: bool = False, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow string array in slices of about limit bytes; null counts as empty."""
    array = utf8(array)
    if array.null_count:
        array = array.fill_null("")
    rows = len(array)
    if not rows:
        return
    _, offs, data = array.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[array.offset : array.offset + rows + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        end = min(end, rows)
        yield Slice(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], fold)
        at = end

