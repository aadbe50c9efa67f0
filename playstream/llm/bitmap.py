"""Which 64-bit values are there, or do two owners have?  Found one bucket of
values at a time and told to tasks as a bitmap of bounded size.

The bitmap may say yes wrongly (more often, the larger the input); whoever
uses it must find the true matches among what it lets through."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLOT_BITS = 27       # the bitmap has 2 ** 27 bits (16 MB), whatever the input's size, unless told otherwise
MOST_BITS = 30       # the largest one, 128 MB
_REST_BITS = 40      # bits of a value that are compared within a bucket
_FLUSH = 1 << 21     # values that a task gathers before it writes their buckets

#: Of a record batch: well-mixed values, and the owner's number of each (None: every value has an owner of its own).
Values = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray | None]]


def _bucketed(values_of: Values, bits: int):
    """A task's values by bucket, sorted, each once, or twice if two owners have it."""
    def flush(values: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        v, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(v, kind="stable")
        v, owner = v[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        two = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
        v = np.repeat(v[start], 1 + two)
        rest = (v >> np.uint64(64 - bits - _REST_BITS)) & np.uint64((1 << _REST_BITS) - 1)
        cut = np.searchsorted(v >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        used = np.flatnonzero(cut[1:] > cut[:-1])
        low, high = rest.astype(np.uint32), (rest >> np.uint64(32)).astype(np.uint8)
        blobs = [low[cut[i]:cut[i + 1]].tobytes() + high[cut[i]:cut[i + 1]].tobytes() for i in used]
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, owners, have = [], [], 0
        for b in batches:
            v, owner = values_of(b)
            if len(v):
                values.append(v)
                owners.append(np.arange(have, have + len(v)) if owner is None else owner)  # not from 0 in every batch
                have += len(v)
            if have >= _FLUSH:
                yield flush(values, owners)
                values, owners, have = [], [], 0
        if have:
            yield flush(values, owners)
    return run


def slots_for(size: int) -> int:
    """``slot_bits`` for the samples of ``size`` bytes of text: at least one slot
    for every eight bytes, up to 8 GB; beyond that the bitmap fills up."""
    return min(MOST_BITS, max(SLOT_BITS, (size // 8).bit_length()))


def shared(df: DataFrame, values_of: Values, owners: int = 2, slot_bits: int = SLOT_BITS) -> np.ndarray:
    """Packed bits by the first ``slot_bits`` bits of the values that two owners
    (``owners=1``: any) have.

    Owners' numbers only need to differ within a task; equal values of
    different tasks count as two owners'."""
    parts = df.rdd.getNumPartitions()
    bits = min(20, max(8, (4 * parts - 1).bit_length()))  # more buckets for larger inputs

    def meet(group: pa.Table) -> pa.Table:
        values = []
        for blob in group.column("values").to_pylist():
            n = len(blob) // 5
            values.append(np.frombuffer(blob, np.uint32, n).astype(np.uint64) | np.frombuffer(blob, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32))
        v = np.sort(np.concatenate(values))
        flags = np.zeros(1 << (slot_bits - bits), bool)
        if owners > 1:
            v = v[1:][v[1:] == v[:-1]]
        flags[(v >> np.uint64(_REST_BITS - slot_bits + bits)).astype(np.int64)] = True
        return pa.table({"bucket": group.column("bucket").slice(0, 1), "flags": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    out = np.zeros(1 << (slot_bits - 3), np.uint8)
    size = 1 << (slot_bits - 3 - bits)
    rows = df.mapInArrow(_bucketed(values_of, bits), "bucket int, values binary").groupBy("bucket").applyInArrow(meet, "bucket int, flags binary")
    for row in rows.toLocalIterator():  # a bucket at a time, 128 MB in all at most
        out[row.bucket * size:(row.bucket + 1) * size] = np.frombuffer(row.flags, np.uint8)
    return out


class Flags:
    """A bitmap for tasks, sent compressed and unpacked once by a task."""

    def __init__(self, spark: SparkSession, bits: np.ndarray) -> None:
        self._sent = spark.sparkContext.broadcast(zlib.compress(bits, 1))   # 16 MB, or 128 MB at most
        self._shift = np.uint64(64 - 3 - (len(bits) - 1).bit_length())
        self._bits = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_bits": None}

    def holds(self, values: np.ndarray) -> np.ndarray:
        if self._bits is None:
            self._bits = np.frombuffer(zlib.decompress(self._sent.value), np.uint8)
        slot = (values >> self._shift).astype(np.int64)
        return (self._bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1

    def forget(self) -> None:
        """Remove it everywhere; what was computed with it must have been saved."""
        self._sent.destroy()
