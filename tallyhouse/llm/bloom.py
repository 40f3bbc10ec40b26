"""Bloom filters that Spark builds piece by piece.

A key is a 64-bit hash. Its filter is cut into segments, and all bits of a key
lie in one of them, so segments are built in separate tasks and a task holds one
at a time. A filter that gets more keys than it was sized for lets more through;
it never misses a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PROBES = 4
MIX = np.uint64(0x9E3779B97F4A7C15)


def bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES places below bits, a power of two, for each hash."""
    mixed = hashes.view(np.uint64) * MIX
    mixed ^= mixed >> np.uint64(29)
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    return ((mixed[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def by_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Runs of one segment in batches that are sorted by it: (segment, is it new, its rows)."""
    last = None
    for batch in batches:
        segments = batch.column("segment").to_numpy()
        if not len(segments):
            continue
        cuts = np.flatnonzero(np.diff(segments)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(segments)]):
            segment = int(segments[start])
            yield segment, segment != last, batch.slice(start, end - start)
            last = segment


def dealt(hashes: DataFrame, segments: int) -> DataFrame:
    """Hashes with their segment, each segment in one task and in one run."""
    rows = hashes.withColumn("segment", F.pmod(F.col("h"), F.lit(segments)).cast("int"))
    return rows.repartition("segment").sortWithinPartitions("segment")


class Filter:
    """A finished filter of a fixed number of bits, small enough to broadcast."""

    def __init__(self, segments: int, segment_bits: int, parts: dict[int, bytes]):
        self.segments, self.segment_bits = segments, segment_bits
        packed = np.zeros((segments, segment_bits // 8), np.uint8)
        for segment, part in parts.items():
            packed[segment] = np.frombuffer(part, np.uint8)
        self.packed = packed.reshape(-1)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """For each 64-bit hash, signed, whether it may have been put in."""
        if not len(hashes):
            return np.zeros(0, bool)
        base = np.mod(hashes.view(np.int64), self.segments) * self.segment_bits
        places = base[:, None] + bit_places(hashes, self.segment_bits)
        return ((self.packed[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1)


def build_filter(hashes: DataFrame, bits: int, segment_bits: int = 1 << 18) -> Filter:
    """A filter of so many bits (a power of two) over column h. Only its bits,
    a fixed number of bytes whatever the input, come to the driver."""
    segment_bits = min(segment_bits, bits)
    segments = bits // segment_bits

    def fill(batches):
        current, held = None, None

        def done():
            packed = np.packbits(held, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict(
                {"segment": pa.array([current], pa.int32()), "part": pa.array([packed], pa.binary())}
            )

        for segment, new, rows in by_segment(batches):
            if new:
                if current is not None:
                    yield done()
                current, held = segment, np.zeros(segment_bits, bool)
            held[bit_places(rows.column("h").to_numpy(), segment_bits).ravel()] = True
        if current is not None:
            yield done()

    parts = dealt(hashes.select("h"), segments).mapInArrow(fill, "segment int, part binary")
    return Filter(segments, segment_bits, {row["segment"]: bytes(row["part"]) for row in parts.collect()})


def seen_again(hashes: DataFrame, expected: int, bits_per_key: int = 10, shard_bits: int = 1 << 20) -> DataFrame:
    """Hashes that occur in more than one row of (h, again), or in one with again
    set; a few others too. Column h; a hash may come several times.

    The once-seen filter has bits for every expected hash and is cut into shards of
    a fixed size, so a task holds one shard's bits, however many hashes there are.
    """
    shards = max(1, -(-expected * bits_per_key // shard_bits))

    def repeats(batches):
        once = np.zeros(shard_bits, bool)
        for _, new, rows in by_segment(batches):
            if new:
                once[:] = False
            h = rows.column("h").to_numpy()
            found, first, count = np.unique(h, return_index=True, return_counts=True)
            again = np.zeros(len(found), bool)
            marked = h[rows.column("again").to_numpy(zero_copy_only=False)]
            again[np.searchsorted(found, marked)] = True
            places = bit_places(found, shard_bits)
            hit = once[places].all(axis=1) | (count > 1) | again
            once[places.ravel()] = True
            yield pa.RecordBatch.from_pydict({"h": pa.array(found[hit], pa.int64())})

    return dealt(hashes.select("h", "again"), shards).mapInArrow(repeats, "h long")
