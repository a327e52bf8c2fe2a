"""Helpers shared by the operators: staged tables, Arrow batches, vector hashing.

Everything an operator wants to read twice is written once as Parquet into
the shared folder named by ``spark.checkpoint.dir`` (``stage``), so a lost
executor costs the tasks that are running, not the work already committed.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerflow.session import scratch_path

#: Text bytes handled by one numpy step inside a task; working arrays take
#: about a hundred times as much, whatever the size of the Arrow batch.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table, read by Spark only (no local path is opened)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets (int64) of a binary column's values within its buffer."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]
    return raw.astype(np.int64)


def data(column: pa.Array, at: np.ndarray) -> np.ndarray:
    """The bytes between the first and the last offset, as uint8, not copied."""
    buffer = column.buffers()[2]
    if buffer is None or not len(at):
        return np.zeros(0, np.uint8)
    return np.frombuffer(buffer, np.uint8)[at[0]:at[-1]]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (binary) holds about ``limit`` bytes
    per piece; a row larger than that is a piece of its own."""
    for batch in batches:
        at, start = offsets(batch.column(column)) if batch.num_rows else np.zeros(1, np.int64), 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def give_back() -> None:
    """Return memory that this Python worker holds but does not use: workers
    outlive their tasks, and what the last one needed is not the next one's."""
    SpanHash.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def lean(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A map task that gives memory back when it ends."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def binary_array(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column whose value i is ``flat[bounds[i]:bounds[i+1]]`` (bytes)."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())])


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: multiply and shift-xor, twice."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 20)) * np.uint64(0x9E3779B97F4A7C15))


#: 2^31 - 1, a prime: products of two residues fit 64 bits, and reducing them takes shifts.
PRIME = np.uint64((1 << 31) - 1)


def _folded(x: np.ndarray) -> np.ndarray:
    """Below 2^32 + 2 and the same residue, for x below 2^63."""
    return (x & PRIME) + (x >> np.uint64(31))


def _residue(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(x))
    return np.where(x >= PRIME, x - PRIME, x)


class SpanHash:
    """Hash of any byte span of a buffer in O(1), all with numpy.

    Two polynomials of the span's bytes modulo a prime, at two bases that were
    drawn once; each byte value stands for a drawn number, so spans of other
    lengths differ as well.  ``prefix[e] - prefix[s]`` is the polynomial times
    ``base**s``; multiplying by its inverse power takes the position out, and
    equal spans hash alike wherever they stand.  (Modulo a power of two there
    are texts that collide at every base.)  Powers are kept for the longest
    buffer seen.
    """

    BASES = (1_234_977_679, 811_570_583)
    _values = [(random_words(7 + k, 256) % (PRIME - np.uint64(1))) + np.uint64(1) for k in range(2)]
    _powers: list[np.ndarray] = []
    _inverse: list[np.ndarray] = []

    @classmethod
    def forget(cls) -> None:
        cls._powers, cls._inverse = [], []

    @classmethod
    def _grow(cls, n: int) -> None:
        if cls._powers and len(cls._powers[0]) > n:
            return

        def powers(base: int) -> np.ndarray:
            out = np.ones(1, np.uint64)
            while len(out) <= n + n // 4 + 64:
                out = np.concatenate([out, _residue(out * np.uint64(pow(base, len(out), int(PRIME))))])
            return out

        cls._powers = [powers(b) for b in cls.BASES]
        cls._inverse = [powers(pow(b, -1, int(PRIME))) for b in cls.BASES]

    def __init__(self, raw: np.ndarray):
        self._grow(len(raw))
        self.prefix = []
        for values, powers in zip(self._values, self._powers):
            prefix = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_folded(values[raw] * powers[:len(raw)]), out=prefix[1:])
            self.prefix.append(prefix)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        one, two = (_residue(_residue(prefix[end] - prefix[start]) * inverse[start]) for prefix, inverse in zip(self.prefix, self._inverse))
        return mix64(one << np.uint64(31) | two)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i]+lengths[i]-1`` for every i, joined."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
