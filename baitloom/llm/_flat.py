"""Flat, vectorised views of Arrow text columns.

A batch of texts is one byte array with offsets; words and k-grams are found
and hashed for all texts of a slice at once. Slices are cut between texts, so
memory follows the slice size and the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xD1342543DE82EF95)
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_bytes_powers, _word_powers = Powers(_ODD), Powers(_WORD)


def byte_values(is_word: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """One 64-bit value for each byte of a word, zero for separators; A-Z count as a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return np.where(is_word, values, np.uint64(0))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(offs):
        offs = np.zeros(1, np.int64)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together; a longer text stands alone."""
    at, n = 0, len(offs) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


class Words:
    """Words of some texts: byte starts and ends, hashes, and the first word of each text."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, values: np.ndarray):
        inside = (values != 0)[data]
        first = np.zeros(len(data), bool)
        first[offs[:-1][offs[:-1] < len(data)]] = True
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        self.starts = np.flatnonzero(inside & (first | ~before))
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:] & ~first[1:]
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offs)
        if len(self.starts):
            up, self._down = _bytes_powers.upto(len(data))
            self._sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * up, out=self._sums[1:])
            self.hashes = self.prefix(len(data))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def prefix(self, k: int) -> np.ndarray:
        """Hash of the first k bytes of each word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        ends = np.minimum(self.ends, self.starts + k)
        return mix((self._sums[ends] - self._sums[self.starts]) * self._down[self.starts])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that leave their text mean nothing."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.uint64)
        up, down = _word_powers.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * up[:n], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])

    def span(self, a: int, b: int) -> np.uint64:
        """Hash of words a to b of the slice, equal to grams(b - a)[a]."""
        up, _ = _word_powers.upto(b - a)
        return mix(np.sum(self.hashes[a:b] * up, keepdims=True))[0]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by doubling."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
