"""Bloom filters over 64-bit keys, built by Spark in segments and sent to workers as one bit array.

The size follows the number of keys up to a fixed bound, so a filter can be broadcast whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key's bits all lie in one segment, which one task can build.
SEGMENT_BITS = 1 << 16
MAX_BITS = 1 << 29
PROBES = 4


def n_segments(n_keys: int, bits_per_key: int, max_bits: int = MAX_BITS) -> int:
    """A power of two: enough for the keys, within the bound."""
    wanted = min(max(n_keys * bits_per_key, SEGMENT_BITS), max_bits)
    return 1 << max(0, (wanted - 1).bit_length() - SEGMENT_BITS.bit_length() + 1)


def offset(prints: np.ndarray, probe: int) -> np.ndarray:
    """The bit inside its segment that a probe of a key looks at (keys are fingerprints: their bits are even)."""
    step = ((prints >> np.uint64(16)) & np.uint64(0xFFFF)) | np.uint64(1)
    return (prints + np.uint64(probe) * step) & np.uint64(SEGMENT_BITS - 1)


def places(keys: np.ndarray, segments: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The segment of each key and its bits inside."""
    segment = (keys >> np.uint64(40)) & np.uint64(segments - 1)
    return segment, [offset(keys, probe) for probe in range(PROBES)]


def contains(bits: np.ndarray, keys: np.ndarray, segments: int) -> np.ndarray:
    """Which keys may be in the filter; never misses one that is."""
    segment, offsets = places(keys, segments)
    base = segment * np.uint64(SEGMENT_BITS)
    found = np.ones(len(keys), bool)
    for offset in offsets:
        at = base + offset
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def filled(
    batches: Iterator[pa.RecordBatch], segments: int, bits_of: Callable[[pa.RecordBatch], Iterable[tuple]]
) -> Iterator[pa.RecordBatch]:
    """The segments that a task's keys touch. ``bits_of(batch)`` gives pairs as ``places`` does."""
    bits = np.zeros(segments * SEGMENT_BITS // 8, np.uint8)
    touched = np.zeros(segments, bool)
    for batch in batches:
        for segment, offsets in bits_of(batch):
            touched[segment] = True
            base = segment * np.uint64(SEGMENT_BITS)
            for offset in offsets:
                at = base + offset
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    own = np.flatnonzero(touched)
    parts = bits.reshape(segments, -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(own), pa.array([parts[k].tobytes() for k in own], pa.binary())], ["segment", "bits"])


def put_together(keys: DataFrame, segment: Column, segments: int, fill: Callable) -> np.ndarray:
    """Fill the filter in tasks that share no segment, and collect it: ``segments`` * 8 KB."""
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = keys.repartition(tasks, segment).mapInArrow(fill, "segment long, bits binary")
    bits = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for row in table.collect():
        bits[row["segment"]] |= np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def build(keys: DataFrame, segments: int) -> np.ndarray:
    """The filter of a one-column table of longs."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return filled(batches, segments, lambda batch: [
            places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), segments)])

    segment = F.shiftright(F.col(keys.columns[0]), 40).bitwiseAND(F.lit(segments - 1))
    return put_together(keys, segment, segments, fill)
