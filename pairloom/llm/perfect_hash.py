"""Minimal perfect hashing of a table of distinct 64-bit keys, built in segments by hash and displace.

A hash deals the keys to segments of bounded size, and each segment is built by one task. Its keys fall into
buckets; the largest first, each bucket gets the first displacement that sends its keys to free slots, and the last ones,
single keys, name their slot outright. A segment has as many slots as keys. The slot's key is kept, so a key that was not in the table is recognised.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.llm.words import mix

SEGMENT = 50_000  # expected keys of a segment
BUCKET = 3        # expected keys of a bucket
_TRIES = 32
_STEP = np.uint64(0xD6E8FEB86659FD93)
_DEAL, _CHOOSE, _PLACE = 101, 102, 103


def _slots(keys: np.ndarray, displacement, size) -> np.ndarray:
    return mix(keys + np.asarray(displacement).astype(np.uint64) * _STEP, _PLACE) % np.asarray(size).astype(np.uint64)


def build_segment(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements of the buckets and the keys in slot order."""
    size = len(keys)
    buckets = -(-size // BUCKET)
    bucket = (mix(keys, _CHOOSE) % np.uint64(max(1, buckets))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=buckets)
    begins = np.concatenate([[0], np.cumsum(counts)])
    displacements, slot_of, taken = np.zeros(buckets, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
    for b in np.argsort(-counts, kind="stable").tolist():
        if counts[b] < 2:
            break
        rows = order[begins[b]:begins[b + 1]]
        first = 0
        while True:
            tries = np.arange(first, first + _TRIES)
            slots = _slots(keys[rows][:, None], tries[None, :], size).astype(np.int64)
            clash = np.sort(slots, axis=0)
            free = ~taken[slots].any(axis=0) & (clash[1:] != clash[:-1]).all(axis=0)
            if free.any():
                at = int(free.argmax())
                break
            first += _TRIES
        displacements[b] = first + at
        slot_of[rows] = slots[:, at]
        taken[slots[:, at]] = True
    single = np.flatnonzero(counts == 1)
    left = np.flatnonzero(~taken)
    displacements[single] = -1 - left
    slot_of[order[begins[single]]] = left
    in_order = np.empty_like(keys)
    in_order[slot_of] = keys
    return displacements, in_order


@dataclass
class PerfectHash:
    """Numbers 0 .. n - 1 of the keys of a table; about ten bytes a key."""

    keys: np.ndarray            # by number
    begins: np.ndarray          # first number of each segment, and the end
    displacements: np.ndarray
    bucket_begins: np.ndarray

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not in the table."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        keys = keys.astype(np.uint64)
        segment = (mix(keys, _DEAL) % np.uint64(len(self.begins) - 1)).astype(np.int64)
        size = np.maximum(self.begins[segment + 1] - self.begins[segment], 1)
        buckets = np.maximum(self.bucket_begins[segment + 1] - self.bucket_begins[segment], 1)
        bucket = self.bucket_begins[segment] + (mix(keys, _CHOOSE) % buckets.astype(np.uint64)).astype(np.int64)
        shift = self.displacements[np.minimum(bucket, len(self.displacements) - 1)]
        slot = np.where(shift < 0, -1 - shift, _slots(keys, np.maximum(shift, 0), size).astype(np.int64))
        number = np.minimum(self.begins[segment] + slot, len(self.keys) - 1)
        return np.where(self.keys[number] == keys, number, -1)


def assembled(parts: list[tuple[int, np.ndarray, np.ndarray]], segments: int) -> PerfectHash:
    """One function of the ``segment, displacements, keys`` of all segments; absent ones are empty."""
    sizes, buckets = np.zeros(segments, np.int64), np.zeros(segments, np.int64)
    for segment, displacements, keys in parts:
        sizes[segment], buckets[segment] = len(keys), len(displacements)
    parts = sorted(parts, key=lambda p: p[0])
    join = lambda i, dtype: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype)
    return PerfectHash(join(2, np.uint64), np.concatenate([[0], np.cumsum(sizes)]), join(1, np.int64), np.concatenate([[0], np.cumsum(buckets)]))


def build(keys: DataFrame, count: int, segment_keys: int = SEGMENT) -> PerfectHash:
    """The function of the distinct longs in column ``key``, of which there are ``count``.

    Segments are built by the executors; the driver gets the finished parts, about ten bytes a key, so the caller bounds ``count``.
    """
    segments = max(1, -(-count // segment_keys))

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((mix(values, _DEAL) % np.uint64(segments)).astype(np.int32)), batch.column(0)], ["segment", "key"])

    def one(table: pa.Table) -> pa.Table:
        displacements, in_order = build_segment(np.sort(table.column("key").to_numpy().astype(np.uint64)))
        return pa.table({"segment": table.column("segment")[:1], "displacements": pa.array([displacements.astype("<i8").tobytes()]), "keys": pa.array([in_order.astype("<u8").tobytes()])})

    built = keys.select("key").mapInArrow(deal, "segment int, key long").groupBy("segment").applyInArrow(one, "segment int, displacements binary, keys binary")
    return assembled([(r.segment, np.frombuffer(r.displacements, "<i8"), np.frombuffer(r["keys"], "<u8")) for r in built.toLocalIterator()], segments)
