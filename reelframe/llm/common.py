"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reelframe.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
"""A word: bytes between ASCII white space. ``bytes.split()`` cuts at the same six characters."""

U64 = np.uint64


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made. Only for tables that no result still reads."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``most_bytes`` of text; one row is never cut."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Lookup:
    """Positions of 64-bit keys by open addressing, for whole arrays at a time."""

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(U64)
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self._shift, self._mask = U64(64 - bits), (1 << bits) - 1
        self._keys = np.zeros(1 << bits, U64)
        self._at = np.full(1 << bits, -1, np.int32)
        left, slots = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self._at[slots] < 0
            first = np.unique(slots[free], return_index=True)[1]
            taken = np.flatnonzero(free)[first]
            self._at[slots[taken]] = left[taken]
            self._keys[slots[taken]] = keys[left[taken]]
            rest = np.ones(len(left), bool)
            rest[taken] = False
            left, slots = left[rest], (slots[rest] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 for absent ones."""
        keys = keys.astype(U64, copy=False)
        slots = self._slot(keys)
        found = self._at[slots]
        wrong = np.flatnonzero((found >= 0) & (self._keys[slots] != keys))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & self._mask
            found[wrong] = self._at[slots[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self._keys[slots[wrong]] != keys[wrong])]
        return found


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
