"""Count-min sketch of 64-bit keys: partition sketches, merged, kept as "met twice" bits.

Every task counts its keys into rows (two, or as asked) of cells and sends, per block of cells, the
cells met once and more often. Blocks are merged by adding, capped at two: all that is
asked of an estimate is whether it reaches two. A key's estimate is the least of its
cells and never below its count, so a key met twice is never missed.

The width follows the number of keys up to a documented bound, which bounds the merged
bits that are sent to every task (2 * 2^30 bits, 256 MB). Beyond it the cells fill: more
keys pass that are met once, and no key is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from carelake.llm.wordhash import mixed

DEPTH = 2
BLOCK = 1 << 16
MOST_CELLS = 1 << 30  # per row of the sketch
PER_KEY = 4  # cells per expected key


def width_for(keys: int, per_key: int = PER_KEY, most: int = MOST_CELLS) -> int:
    """Cells of a row: a power of two, per_key times the keys, within the bound."""
    wanted = max(BLOCK, per_key * max(1, keys))
    return min(most, 1 << (wanted - 1).bit_length())


def cells(keys: np.ndarray, width: int, depth: int) -> list[np.ndarray]:
    return [(mixed(keys, row + 1) & np.uint64(width - 1)).astype(np.int64) for row in range(depth)]


def _partition_sketch(keys: np.ndarray, width: int, depth: int) -> pa.RecordBatch:
    places = np.concatenate([c + row * width for row, c in enumerate(cells(keys, width, depth))])
    places, counts = np.unique(places, return_counts=True)
    blocks, starts = np.unique(places // BLOCK, return_index=True)
    inside = (places % BLOCK).astype("<u2")
    once, more = [], []
    for first, last in zip(starts, [*starts[1:], len(places)]):
        part, often = inside[first:last], counts[first:last] > 1
        once.append(part[~often].tobytes())
        more.append(part[often].tobytes())
    arrays = [pa.array(blocks, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["block", "once", "more"])


def repeated(frame: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], width: int, depth: int = DEPTH) -> np.ndarray:
    """Bits of the cells met at least twice over all rows. keys_of: the keys (uint64) in a
    task's batches; a key given twice counts twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for keys in keys_of(batches):
            held.append(keys)
            size += len(keys)
            if size > 1_000_000:
                yield _partition_sketch(np.concatenate(held), width, depth)
                held, size = [], 0
        if size:
            yield _partition_sketch(np.concatenate(held), width, depth)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                counts = met.setdefault(block, np.zeros(BLOCK, np.uint8))
                seen = np.frombuffer(once, "<u2")
                counts[seen] = np.minimum(counts[seen] + 1, 2)
                counts[np.frombuffer(more, "<u2")] = 2
        for block, counts in met.items():
            bits = np.packbits(counts > 1).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])

    partial = frame.mapInArrow(count, "block int, once binary, more binary")
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = partial.repartition(parts, "block").mapInArrow(merge, "block int, bits binary")
    bits = np.zeros(depth * width // 8, np.uint8)
    for row in merged.toLocalIterator():  # depth * width bits in all
        bits[row.block * BLOCK // 8 : (row.block + 1) * BLOCK // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def estimated_twice(bits: np.ndarray, width: int, keys: np.ndarray) -> np.ndarray:
    """True where every cell of the key was met at least twice."""
    out = np.ones(len(keys), bool)
    for row, c in enumerate(cells(keys, width, 8 * len(bits) // width)):
        at = c + row * width
        out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return out
