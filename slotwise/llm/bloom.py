"""Bloom filters over 64-bit keys, built by Spark tasks and given to others as a broadcast.

A filter only keeps rows out early: what passes is joined or compared exactly afterwards.  It is
built only if the number of keys, and so its size, is within a bound; the caller has another way
otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import textnum
from slotwise.llm.common import arrow_map, ship

MAX_KEYS = 40_000_000           # 64 MB
PROBES = 4
PART = 1 << 17                  # bytes of the filter in one row


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    a = textnum.mix(keys.astype(np.uint64))
    b = textnum.mix(a ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return (a[None, :] + b[None, :] * np.arange(PROBES, dtype=np.uint64)[:, None]) & np.uint64(bits - 1)


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _places(keys, len(bitmap) * 8)
    return ((bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(0)


def build(keys: DataFrame, column: str, max_keys: int = MAX_KEYS) -> np.ndarray | None:
    """The filter as bytes, about 12 bits a key; None for more than ``max_keys`` keys."""
    n = keys.count()
    if n > max_keys:
        return None
    size = max(PART, 1 << max(0, (12 * n // 8 - 1).bit_length()))

    def local(batches):
        bitmap = np.zeros(size, np.uint8)
        for batch in batches:
            at = _places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), size * 8).ravel()
            np.bitwise_or.at(bitmap, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        parts = bitmap.reshape(-1, PART)
        for k in np.flatnonzero(parts.any(1)):
            yield pa.RecordBatch.from_pydict({"part": pa.array([int(k)], pa.int32()), "bits": [parts[k].tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        out = np.zeros(PART, np.uint8)
        for x in table["bits"].to_pylist():
            out |= np.frombuffer(x, np.uint8)
        return pa.table({"part": table["part"][:1], "bits": [out.tobytes()]})

    ship(keys.sparkSession)
    parts = arrow_map(keys.select(F.col(column).cast("long")), local, "part int, bits binary")
    bitmap = np.zeros((size // PART, PART), np.uint8)
    for r in parts.groupBy("part").applyInArrow(merge, "part int, bits binary").toLocalIterator():
        bitmap[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return bitmap.ravel()
