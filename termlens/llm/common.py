"""Helpers the operators share: reliable checkpoints, bounded text blocks, interval unions.

The folder for checkpoints is the one the session names in ``spark.checkpoint.dir``; a
scratch folder is made only for a local master that names none (tests).
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 1 << 19


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; unset is accepted on a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if spark.sparkContext.getCheckpointDir():
            return
        path = tempfile.mkdtemp(prefix="llm-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)


def shared_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share, for tables a job writes and reads again."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable copy of ``df`` in the shared folder: computed once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that ``column`` holds about ``limit`` bytes (or list items) a
    slice, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        length = pc.list_value_length if pa.types.is_list(col.type) else pc.binary_length
        sizes = pc.fill_null(length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its tasks, and what its
    allocator keeps would add to the next operator's needs."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass
    pa.default_memory_pool().release_unused()


def tidy(run):
    """Wrap a ``mapInArrow`` function so that its task ends by giving memory back."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[i] .. starts[i] + counts[i] - 1``."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser over an array of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
