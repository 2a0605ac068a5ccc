"""Bloom filters built by all tasks together: what was seen once, and what was seen twice.

A filter is a row of bits cut into blocks. Each task sets bits for its own keys and sends its blocks compressed, so a
sparse block costs about as much as its set bits and a dense one no more than its size. Blocks are merged as a stream:
``twice |= twice' | (once & once')``, then ``once |= once'``. That can only claim too much, never too little: a key
seen by two tasks has all its bits in both. The size is bounded by MAX_BITS, so the finished filter may be broadcast; past
that bound it says yes more often, and callers, who confirm every yes, do more work with the same results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BITS = 1 << 20
MAX_BITS = 1 << 30
BITS_PER_KEY = 16
#: Keys a task gathers before it sends blocks.
FLUSH_KEYS = 1 << 22

BLOCKS = "block int, once binary, twice binary"


def bits_for(n_keys: int, most: int = MAX_BITS) -> int:
    return min(most, max(BLOCK_BITS, 1 << (n_keys * BITS_PER_KEY - 1).bit_length() if n_keys else 0))


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(bits - 1)
    return (keys & low).astype(np.int64), ((keys >> np.uint64(32)) & low).astype(np.int64)


def _blocks_of(keys: np.ndarray, bits: int) -> dict[int, bytes]:
    """Compressed blocks with the bits of these keys."""
    places = np.unique(np.concatenate(_places(keys, bits)))
    blocks = places // BLOCK_BITS
    cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
    found = {}
    for begin, part in zip(cuts, np.split(places, cuts[1:]), strict=True):
        field = np.zeros(BLOCK_BITS, bool)
        field[part % BLOCK_BITS] = True
        found[int(blocks[begin])] = zlib.compress(np.packbits(field).tobytes(), 1)
    return found


def partial_blocks(key_arrays: Iterator[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one task. Within an array a key must stand once per document; documents do not span arrays."""
    held, size = [], 0
    for keys in key_arrays:
        held.append(keys)
        size += len(keys)
        if size >= FLUSH_KEYS:
            yield from _flush(held, bits)
            held, size = [], 0
    if size:
        yield from _flush(held, bits)


def _flush(held: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    once, twice = _blocks_of(keys, bits), _blocks_of(keys[counts > 1], bits) if (counts > 1).any() else {}
    for block, field in once.items():
        yield _row(block, field, twice.get(block))


def _row(block: int, once: bytes | None, twice: bytes | None) -> pa.RecordBatch:
    columns = [pa.array([block], pa.int32()), pa.array([once], pa.binary()), pa.array([twice], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["block", "once", "twice"])


def _open(field: bytes | None) -> np.ndarray:
    return np.frombuffer(zlib.decompress(field), np.uint8) if field else np.zeros(BLOCK_BITS // 8, np.uint8)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted; only the current one is held."""
    now, once, twice = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != now:
                if now is not None:
                    yield _row(now, zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1))
                now, once, twice = row["block"], _open(None), _open(None)
            new = _open(row["once"])
            twice = twice | _open(row["twice"]) | (once & new)
            once = once | new
    if now is not None:
        yield _row(now, zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1))


def merged(blocks: DataFrame, which: str, bits: int) -> np.ndarray:
    """One finished filter, at most MAX_BITS / 8 bytes, on the driver: ``once`` or ``twice``."""
    whole = np.zeros(bits // 8, np.uint8)
    size = BLOCK_BITS // 8
    done = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, BLOCKS)
    for row in done.select("block", which).toLocalIterator():
        whole[row["block"] * size : (row["block"] + 1) * size] = _open(row[which])
    return whole


def contains(field: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """packbits puts the first place into the highest bit."""
    yes = np.ones(len(keys), bool)
    for place in _places(keys, len(field) * 8):
        yes &= (field[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return yes
