"""Shared helpers of the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows in one Arrow batch; bounds the Python workers' memory on long texts.
BATCH_ROWS = 250


def arrow_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_ROWS`` rows, unless the session asks for fewer still.

    This is a setting of the session, and it must still hold when the frame runs,
    so it stays; other Arrow operators of the session get smaller batches by it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next task holds what the last one took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose worker gives its memory back after each partition."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(tidy, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and n else np.empty(0, np.uint8)
    return raw, offs - offs[0]


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """Polynomial hashes modulo 2**64 of any slices of a byte buffer, from one prefix sum."""

    def __init__(self, seed: int, size: int) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(2**40, 2**62)) * 8 + 5
        inverse = pow(base, -1, 2**64)
        self.powers, self.inverses = self._powers(base, size), self._powers(inverse, size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.ones(size, np.uint64)
        have = 1
        while have < size:
            take = min(have, size - have)
            out[have : have + take] = out[:take] * np.uint64(pow(base, have, 2**64))
            have += take
        return out

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((prefix[ends] - prefix[starts]) * self.inverses[starts])

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        n = len(prefix) - k
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix64((prefix[k:] - prefix[:n]) * self.inverses[:n])
