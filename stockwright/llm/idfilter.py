"""A bit map of fixed size with the hashes of many ids: which rows of a table may belong to them.

It only saves shuffling rows that cannot match; an exact join follows, so its size never changes a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockwright.llm.hashing import mix

BITS = 1 << 24
CHUNK = 1 << 14  # bytes that travel together


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) & np.uint64(BITS - 1)).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """The bit map (2 MB) of all ``id`` (long); marked by tasks and or-ed in Spark."""

    def mark(batches):
        bits = np.zeros(BITS, bool)
        for batch in batches:
            bits[_bits(batch.column(0).to_numpy())] = True
        packed = np.packbits(bits).reshape(-1, CHUNK)
        full = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([packed[i].tobytes() for i in full], pa.binary())],
            names=["chunk", "bits"],
        )

    def merge(batches):
        merged: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(bits, np.uint8)
                merged[chunk] = merged[chunk] | part if chunk in merged else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(merged), pa.int32()), pa.array([b.tobytes() for b in merged.values()], pa.binary())],
            names=["chunk", "bits"],
        )

    kind = "chunk int, bits binary"
    found = ids.select("id").mapInArrow(mark, kind).repartition("chunk").mapInArrow(merge, kind).collect()
    out = np.zeros((BITS // 8 // CHUNK, CHUNK), np.uint8)
    for row in found:
        out[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def chosen(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the ids that the bit map may hold."""
    at = _bits(ids)
    return np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
