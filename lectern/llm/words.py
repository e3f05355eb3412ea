"""Words of whole Arrow text batches and their 64-bit fingerprints, vectorised with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D, the UTF-8 form of ``[^\\x20\\x09-\\x0D]+``.
Null texts have no words.  Fingerprints depend on the bytes of a word only, so they agree between tasks,
batches and runs.  The work is done in blocks of about a megabyte, so a very long text needs memory for
its words, never a multiple of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` reproducible 64-bit values of one seed."""
    offset = seed * 0xD1342543DE82EF95 % (1 << 64)
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(offset))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _join(a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The fingerprints of runs whose halves have fingerprints a and b; not linear, so no two structured runs cancel out."""
    x = a * key[0] + b
    x ^= x >> _U(32)
    x *= key[1]
    x ^= x >> _U(29)
    return x


class RunHash:
    """Fingerprints of any run of a sequence of 64-bit values: level k holds those of all runs of 2**k values."""

    def __init__(self, values: np.ndarray, seed: int) -> None:
        self.key = stream(4, seed) | _U(1)
        self.levels = [mix(values ^ self.key[2])]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            x, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_join(x[:-step], x[step:], self.key) if len(x) > step else x[:0])
        return self.levels[k]

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the values start..end-1, one or more of them; runs of different length differ too."""
        n = end - start
        out = np.zeros(len(n), dtype=_U)
        size = np.frexp(n.astype(np.float64))[1] - 1
        for k in np.unique(size):
            if k < 0:
                continue
            at = np.flatnonzero(size == k)
            x, width = self.level(int(k)), 1 << int(k)
            out[at] = _join(x[start[at]], x[end[at] - width], self.key[[1, 3]])
        return mix(out + n.astype(_U) * self.key[3])


class ByteHash(RunHash):
    """Fingerprints of runs of bytes; runs of up to eight bytes are their own value, mixed."""

    def __init__(self, data: np.ndarray, seed: int) -> None:
        self.key = stream(4, seed) | _U(1)
        n = len(data)
        padded = np.zeros((n + 15) // 8 * 8 + 8, dtype=np.uint8)
        padded[:n] = data
        self.eight = np.empty(n, dtype=_U)
        for r in range(min(8, n)):
            view = padded[r : r + (len(padded) - r) // 8 * 8].view("<u8")
            self.eight[r::8] = view[: len(self.eight[r::8])]
        none = self.eight[:0]
        self.levels = [none, none, none, mix(self.eight[: max(n - 7, 0)] ^ self.key[2])]

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = end - start
        short = n <= 8
        out = np.empty(len(n), dtype=_U)
        own = self.eight[start[short]] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * n[short].astype(_U)))
        out[short] = mix(mix(own ^ self.key[0]) + n[short].astype(_U) * self.key[3])
        out[~short] = super().runs(start[~short], end[~short])
        return out


@dataclass
class Words:
    """Words of a batch in order; ``first[d]..first[d+1]`` are the words of document d.

    ``hash`` and ``check`` are fingerprints with independent keys; ``check`` is there where it was asked for.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    check: np.ndarray | None = None

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool, check: bool = False) -> Words:
    """Words of the concatenated documents data[offsets[d]:offsets[d+1]]."""
    starts, ends, hashes, checks = [], [], [], []
    lo, stop = int(offsets[0]), int(offsets[-1])
    while lo < stop:
        hi = min(lo + BLOCK, stop)
        if hi < stop:  # a block ends at white space or at the end of a document
            d = int(np.searchsorted(offsets, hi, side="right")) - 1
            spaces = np.flatnonzero(_SPACE[data[lo:hi]])
            cut = max(int(offsets[d]), lo + int(spaces[-1]) + 1 if len(spaces) else lo)
            while cut <= lo:  # one word longer than a block
                end = int(offsets[d + 1])
                spaces = np.flatnonzero(_SPACE[data[hi : min(hi + BLOCK, end)]])
                cut = hi + int(spaces[0]) + 1 if len(spaces) else (end if hi + BLOCK >= end else lo)
                hi = min(hi + BLOCK, end)
            hi = cut
        b = data[lo:hi]
        solid = ~_SPACE[b]
        edge = np.zeros(len(b) + 1, dtype=bool)
        a, z = np.searchsorted(offsets, [lo, hi])
        edge[offsets[a:z] - lo] = True
        edge[0] = edge[-1] = True
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | edge[1:-1]
        s, e = np.flatnonzero(begins), np.flatnonzero(last) + 1
        cased = _LOWER[b] if lower else b
        hashes.append(ByteHash(cased, 1).runs(s, e))
        if check:
            checks.append(ByteHash(cased, 2).runs(s, e))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, dtype=t)
    start = cat(starts, np.int64)
    first = np.searchsorted(start, offsets)
    return Words(data, start, cat(ends, np.int64), cat(hashes, _U), first, cat(checks, _U) if check else None)


def text_blocks(column: pa.Array | pa.ChunkedArray, lower: bool = False, size: int = BLOCK, check: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over runs of rows of about ``size`` bytes, one long text alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.null_count:  # a null's slot may hold bytes
        column = column.fill_null("")
        _, offs, data = column.buffers()
        offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        end = min(end, len(column))
        yield row, end, words_of(raw, offsets[row : end + 1], lower, check)
        row = end


def shingles(w: Words, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all runs of k words inside one document, and each document's first one.

    A document of fewer than k words, but of some, has its whole sequence as its only one.
    """
    n = np.diff(w.first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    start = np.arange(first[-1]) - first[doc] + w.first[doc]
    return RunHash(w.hash, seed).runs(start, np.minimum(start + k, w.first[doc + 1])), first
