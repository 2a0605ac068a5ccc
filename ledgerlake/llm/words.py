"""Words and lines of a batch of texts as numpy arrays over the UTF-8 bytes.

Separators are ASCII, so bytes of longer characters never look like one. Texts are handled whole; NULL counts as empty.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Masks of the first 0 to 8 bytes of a little-endian number.
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@cache
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, base, np.uint64)
    down = np.full(size, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hash of each values[start:end], equal for equal runs wherever they stand; for values that are hashes themselves.

    A sum of powers modulo 2^64. Over runs of some ten values its worst patterns lose some 20 of the 64 bits, over thousands all.
    """
    size = 1 << max(12, int(len(values)).bit_length())
    up, down = _powers(size, base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Text:
    """``data``: bytes of all texts; ``offsets``: where each begins, and the end of the last."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, lower: bool = False) -> Text:
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        return cls(_LOWER[raw] if lower else raw, at - at[0])

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def code_points(self) -> np.ndarray:
        """Running count of code points before each byte."""
        return np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))

    def byte_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each run of bytes, equal for equal runs wherever they stand.

        A run is taken by eights; each eight goes through ``mix`` with its place in the run, so no sum of powers is involved that
        patterns of two letters could cancel.
        """
        sizes = ends - starts
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        at_byte = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        found = mix((at_byte[starts] & _LOW_BYTES[np.minimum(sizes, 8)]) + sizes.astype(np.uint64) * np.uint64(_BASE))
        long = np.flatnonzero(sizes > 8)
        if len(long):
            eights = (sizes[long] - 1) >> 3  # after the first
            end = np.cumsum(eights)
            place = np.arange(end[-1]) - np.repeat(end - eights, eights)
            value = at_byte[np.repeat(starts[long] + 8, eights) + 8 * place]
            value[end - 1] &= _LOW_BYTES[((sizes[long] - 1) & 7) + 1]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ mix((place.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))))))
            found[long] = mix(found[long] + sums[end] - sums[end - eights])
        return found


@dataclass
class Words:
    """``starts``/``ends``: bytes of each word; ``row``: its text; ``first``: first word of each text, and their number."""

    text: Text
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, text: Text, separator: np.ndarray = _SPACE) -> Words:
        """``separator``: for each byte, whether it stands between words."""
        solid = ~separator[text.data]
        edge = np.zeros(len(solid) + 1, bool)
        edge[text.offsets] = True
        before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
        after = np.concatenate((solid[1:], [False])) & ~edge[1:]
        starts = np.flatnonzero(solid & ~before)
        ends = np.flatnonzero(solid & ~after) + 1
        return cls(text, starts, ends, text.row_of(starts), np.searchsorted(starts, text.offsets))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return self.text.byte_hashes(self.starts, self.ends)

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words within one text."""
        at = np.arange(len(self.starts))
        return at[at + size <= self.first[self.row + 1]]

    def joined(self, keep: np.ndarray) -> pa.Array:
        """The kept words of each text, joined by one space."""
        starts, row = self.starts[keep], self.row[keep]
        sizes = self.ends[keep] - starts
        last = np.diff(row, append=-1) != 0
        room = sizes + ~last
        offsets = np.concatenate(([0], np.cumsum(room)))
        data = np.full(offsets[-1], 32, np.uint8)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data[np.repeat(offsets[:-1], sizes) + within] = self.text.data[np.repeat(starts, sizes) + within]
        ends = offsets[np.searchsorted(row, np.arange(len(self.first)))]
        return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


@dataclass
class Lines:
    """Lines cut at \\n, without the \\n: at least one in each text."""

    text: Text
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, text: Text) -> Lines:
        cuts = np.flatnonzero(text.data == 10)
        starts = np.concatenate((text.offsets[:-1], cuts + 1))
        row = np.concatenate((np.arange(len(text.offsets) - 1), text.row_of(cuts)))
        order = np.lexsort((starts, row))
        starts, row = starts[order], row[order]
        ends = np.concatenate((starts[1:] - 1, text.offsets[-1:]))
        last = np.flatnonzero(np.diff(row, append=-1))
        ends[last] = text.offsets[row[last] + 1]
        return cls(text, starts, ends, row, np.searchsorted(row, np.arange(len(text.offsets))))

    def stripped(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends without spaces at both ends; a blank line becomes an empty one."""
        solid = np.flatnonzero(~_SPACE[self.text.data])
        if not len(solid):
            return self.starts, self.starts
        left, right = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        blank = left == right
        starts = np.where(blank, self.starts, solid[np.minimum(left, len(solid) - 1)])
        ends = np.where(blank, self.starts, solid[np.maximum(right, 1) - 1] + 1)
        return starts, ends


def distinct_in_rows(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places of one of each (row, value), ordered by row, then value."""
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    r, v = row[order], value[order]
    return order[np.concatenate(([True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])))] if len(order) else order
