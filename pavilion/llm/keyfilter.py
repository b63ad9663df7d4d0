"""Which keys occur twice or more in a corpus, as a bit filter of fixed size.

A Bloom filter with three places a key. Tasks deal their keys to buckets, packed into one binary
row per bucket, four bytes a key, each key at most twice. A bucket's rows are counted together and
answer with their own slice of the filter. The filter has ``2**bits`` bits whatever the input, or, where a
caller lets it grow, a few times that for keys that would fill it, so it can
be sent to all tasks; a filter that fills up, or keys that agree in their upper bits only, let
more keys through, which costs later stages work but never loses a key that repeats.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

_U = np.uint64
_FLUSH = 1 << 20
# Odd numbers; each gives a key one more place in the filter.
_FACTORS = (1, 0x9E3779B1, 0x85EBCA77)
# A filter that may grow does so below so many bits a key; of other keys 8 percent pass then.
_BITS_A_KEY = 5


def bucket_bits(df: DataFrame, bits: int) -> int:
    """Buckets follow the session's number of shuffle partitions, so that they grow with the data."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(8, math.ceil(math.log2(4 * partitions))), bits - 3)


def _dealer(keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], n_bits: int):
    def packed(keys: np.ndarray) -> pa.RecordBatch:
        keys = np.sort(keys)
        if len(keys) > 2:
            keys = keys[np.concatenate([[True, True], (keys[2:] != keys[:-2])])]
        bucket = (keys >> _U(64 - n_bits)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        # The four bytes below the bucket's bits.
        rest = ((keys << _U(n_bits)) >> _U(32)).astype(np.uint32)
        offsets = np.concatenate([heads, [len(keys)]]).astype(np.int32) * 4
        blobs = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(rest)])
        return pa.RecordBatch.from_arrays([pa.array(bucket[heads]), blobs], ["bucket", "keys"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for keys in keys_of(batches):
            held.append(keys)
            size += len(keys)
            if size >= _FLUSH:
                yield packed(np.concatenate(held))
                held, size = [], 0
        if size:
            yield packed(np.concatenate(held))

    return deal


class KeyFilter(NamedTuple):
    """A Bloom filter in slices: the upper ``n_bits`` bits of a key choose the slice."""

    bits: np.ndarray
    n_bits: int


def _slots(rest: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """A key's places in its slice of ``2**width`` bits, from the 32 bits below its bucket's."""
    for factor in _FACTORS:
        yield (rest * np.uint32(factor)) >> np.uint32(32 - width)


def _counter(n_bits: int, bits: int, more: int):
    def count(rows: pa.Table) -> pa.Table:
        keys = np.sort(np.frombuffer(b"".join(x.as_buffer() for x in rows.column("keys")), np.uint32))
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        width = bits - n_bits
        while width < bits - n_bits + more and 1 << width < _BITS_A_KEY * len(twice):
            width += 1
        out = np.zeros(1 << width, bool)
        for slot in _slots(twice, width):
            out[slot] = True
        return pa.table({"bucket": rows.column("bucket")[:1], "bits": [np.packbits(out, bitorder="little").tobytes()]})

    return count


def _widened(part: np.ndarray, size: int) -> np.ndarray:
    """A slice as one of ``size`` bytes: a place's upper bits are its place in a narrower slice."""
    if len(part) == size:
        return part
    return np.packbits(np.repeat(np.unpackbits(part, bitorder="little"), size // len(part)), bitorder="little")


def repeated_keys(df: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int, more: int = 0) -> Broadcast:
    """Filter of the keys that ``keys_of`` yields twice or more over all tasks; see ``may_repeat``.

    It has ``2**bits`` bits, or up to ``2**(bits + more)`` when that is less than five a key.
    """
    n_bits = bucket_bits(df, bits)
    if bits - n_bits > 32:
        raise ValueError("the filter is too large for its buckets")
    dealt = df.mapInArrow(_dealer(keys_of, n_bits), "bucket bigint, keys binary")
    counter = _counter(n_bits, bits, min(more, 32 - (bits - n_bits)))
    slices = dealt.groupBy("bucket").applyInArrow(counter, "bucket bigint, bits binary")
    found = {row["bucket"]: np.frombuffer(row["bits"], np.uint8) for row in slices.collect()}  # the whole filter, whatever the input
    width = max((len(part) for part in found.values()), default=1 << (bits - n_bits - 3))
    out = np.zeros(width << n_bits, np.uint8)
    while found:
        bucket, part = found.popitem()
        out[bucket * width : (bucket + 1) * width] = _widened(part, width)
    # A plain tuple: broadcasts are pickled by the names of their classes, which workers without the package do not know.
    return df.sparkSession.sparkContext.broadcast((out, n_bits))


def may_repeat(found: KeyFilter | tuple[np.ndarray, int], keys: np.ndarray) -> np.ndarray:
    """False for keys that surely occur once."""
    bits, n_bits = found
    width = int(len(bits)).bit_length() - 1 + 3 - n_bits
    start = (keys >> _U(64 - n_bits)) << _U(width)
    rest = ((keys << _U(n_bits)) >> _U(32)).astype(np.uint32)
    held = np.ones(keys.shape, bool)
    for slot in _slots(rest, width):
        place = start + slot
        held &= (bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1
    return held
