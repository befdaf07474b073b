"""A distributed count-min sketch that answers one question: can this hash have occurred twice?

Two rows of cells count 64-bit hashes, saturating at two. Tasks count their own hashes and emit the cells they touched, block by
block; the blocks are added up by sorted partitions, one block of counters in memory at a time. A hash is *possibly repeated* if
all its cells hold two or more, so counts are overestimated and no repeated hash is ever missed.

The number of cells grows with the expected number of hashes up to 2^MAX_BITS a row, the proven bound of what is broadcast; a
larger input gets more false candidates, which the exact second pass removes, and the same result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from shelfwise.llm.common import mixed, stored

BLOCK_BITS = 20
MAX_BITS = 29
HELD = 1 << 20
ROWS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def bits_for(expected: int) -> int:
    return min(MAX_BITS, max(BLOCK_BITS, math.ceil(math.log2(max(2, 2 * expected)))))


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mixed(h * ROWS[row]) >> np.uint64(64 - bits)).astype(np.uint32)


def _packed(cells: np.ndarray) -> bytes:
    """Sorted distinct cells of a block as distances, in as few bytes as they need."""
    steps = np.diff(cells, prepend=np.uint32(0))
    kind = np.uint8 if steps.max(initial=0) < 256 else np.uint16 if steps.max(initial=0) < 65536 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + steps.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[data[0]], offset=1), dtype=np.int64)


def _partial(h: np.ndarray, bits: int) -> pd.DataFrame:
    rows = []
    for row in range(len(ROWS)):
        cells = np.sort(_cells(h, row, bits))
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        twice = np.diff(np.append(first, len(cells))) > 1
        cells = cells[first]
        block = cells >> np.uint32(BLOCK_BITS)
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        low = cells & np.uint32((1 << BLOCK_BITS) - 1)
        for s, e in zip(starts, np.append(starts[1:], len(cells))):
            part, again = low[s:e], twice[s:e]
            rows.append((row, int(block[s]), _packed(part[~again]), _packed(part[again])))
    return pd.DataFrame(rows, columns=["row", "block", "once", "twice"])


def build(source: DataFrame, hashes: Callable[[pd.DataFrame], Iterator[np.ndarray]], bits: int) -> list[np.ndarray]:
    """The sketch of all hashes of ``source``: a bit map of the cells with two or more, for each row.

    ``hashes`` gives the uint64 hashes of a batch of rows, in arrays.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            for h in hashes(pdf):
                held.append(h)
                size += len(h)
                if size >= HELD:
                    yield _partial(np.concatenate(held), bits)
                    held, size = [], 0
        if size:
            yield _partial(np.concatenate(held), bits)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, None
        done = lambda: pd.DataFrame([(*key, np.packbits(total > 1).tobytes())], columns=["row", "block", "bits"])
        for pdf in batches:
            for row, block, once, twice in pdf.itertuples(index=False):
                if (row, block) != key:
                    if key is not None:
                        yield done()
                    key, total = (row, block), np.zeros(1 << BLOCK_BITS, np.uint8)
                cells = _unpacked(once)
                total[cells] = np.minimum(total[cells] + 1, 2)
                total[_unpacked(twice)] = 2
        if key is not None:
            yield done()

    blocks = len(ROWS) << (bits - BLOCK_BITS)
    parts = source.mapInPandas(count, "row int, block int, once binary, twice binary")
    parts = parts.repartition(min(blocks, 200), "row", "block").sortWithinPartitions("row", "block")
    maps = [np.zeros(1 << (bits - 3), np.uint8) for _ in ROWS]
    width = 1 << (BLOCK_BITS - 3)
    summed, _ = stored(parts.mapInPandas(add, "row int, block int, bits binary"), "sketch")
    for r in summed.toLocalIterator():  # 2^bits / 8 bytes a row at most
        maps[r.row][r.block * width:(r.block + 1) * width] = np.frombuffer(r.bits, np.uint8)
    return maps


def maybe_repeated(h: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """True where a hash may have occurred more than once."""
    out = np.ones(len(h), bool)
    bits = int(maps[0].size * 8).bit_length() - 1
    for row, bitmap in enumerate(maps):
        cells = _cells(h, row, bits)
        out &= (bitmap[cells >> np.uint32(3)] >> (np.uint8(7) - (cells & np.uint32(7)).astype(np.uint8))) & 1 > 0
    return out
