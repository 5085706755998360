"""Counters and bit sets of a fixed size, filled by Spark and read as one small array.

Their size is a constant of the caller, not of the data, so they may be sent to every task.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 14


def count_rows(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """(chunk numbers, packed int64 counters) of one task's counters."""
    parts = counts.reshape(-1, CHUNK)
    return list(range(len(parts))), [zlib.compress(p.astype("<i8").tobytes(), 1) for p in parts]


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), dtype="<i8")


def summed_counts(packed: DataFrame, size: int) -> np.ndarray:
    """Sum of all tasks' counters in packed (chunk, blob): one task adds one chunk at a time."""

    def add(frames):
        held: dict[int, np.ndarray] = {}
        for frame in frames:
            for chunk, blob in zip(frame["chunk"], frame["blob"]):
                held[chunk] = held.get(chunk, 0) + unpack(blob)
        keys = sorted(held)
        yield pd.DataFrame({"chunk": keys, "blob": [zlib.compress(held[k].tobytes(), 1) for k in keys]})

    rows = packed.select("chunk", "blob").repartition("chunk").mapInPandas(add, "chunk int, blob binary")
    counts = np.zeros(size, dtype=np.int64)
    for row in rows.collect():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = unpack(bytes(row["blob"]))
    return counts


def bit_set(keys: DataFrame, size: int) -> np.ndarray:
    """``size`` bits, packed, with the bit of every row's 64-bit ``key`` set."""

    def packed_rows(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        blobs = [zlib.compress(part.tobytes(), 1) for part in parts.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "blob"])

    def fill(batches):
        bits = np.zeros(size, dtype=bool)
        for batch in batches:
            bits[slots(np.asarray(batch.column(0)), size)] = True
        parts = np.packbits(bits).reshape(-1, CHUNK)
        yield packed_rows({k: parts[k] for k in np.flatnonzero(parts.any(axis=1)).tolist()})

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(blob), np.uint8)
                held[chunk] = held[chunk] | part if chunk in held else part
        yield packed_rows(held)

    schema = "chunk int, blob binary"
    parts = keys.select(F.col("key").cast("bigint")).filter("key IS NOT NULL").mapInArrow(fill, schema)
    packed = np.zeros(size // 8, dtype=np.uint8)
    for row in parts.repartition("chunk").mapInArrow(add, schema).collect():
        packed[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(bytes(row["blob"])), np.uint8)
    return packed


def holds(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set."""
    slot = slots(keys, len(packed) * 8)
    return ((packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).astype(bool)


def slots(keys: np.ndarray, size: int) -> np.ndarray:
    spread = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
