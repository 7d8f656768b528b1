"""Helpers shared by the training-data operators: stage tables, column picking, text bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow.plans.materialize import release as drop_table
from scribeflow.plans.materialize import shuffles_dropped
from scribeflow.session import scratch_path

#: Rows turned into Python objects at a time, so an Arrow batch of long texts is never held twice.
SLICE_ROWS = 256


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: work used by several
    later steps runs once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*stages: DataFrame) -> None:
    """Delete stage tables that nothing reads any more."""
    for df in stages:
        drop_table(df)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (string, null becomes empty)."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit(*cols: Column) -> Column:
    """Uniform double in (0, 1) from the 64-bit hash of the columns."""
    h = F.xxhash64(*cols)
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    trim()


#: Drop what a worker keeps from task to task, if the task that ends has no use for it.
FORGET: list[Callable[[], None]] = []


def trim() -> None:
    """Give memory that a task has freed back to the machine: a worker lives on for other tasks."""
    for drop in FORGET:
        drop()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def local_path(uri: str) -> str:
    """The mounted path of a shared folder; only file systems that every worker mounts
    can be memory-mapped, so other schemes are refused."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"memory-mapped output needs a mounted folder, not {uri}")
    return uri


#: Bytes that part words: space and 0x09-0x0D.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        take = min(done, n - done)
        out[done:done + take] = out[:take] * step
        done += take
    return out


_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of all rows, and the rows' offsets into the words."""
    n = len(raw)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[raw]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (cut[:-1] | np.concatenate(([True], ~inside[:-1]))))
    ends = np.flatnonzero(inside & (cut[1:] | np.concatenate((~inside[1:], [True])))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class SpanHash:
    """64-bit hashes of byte spans, from prefix sums of a polynomial over the bytes."""

    def __init__(self, raw: np.ndarray, lower: bool = False):
        self.pre = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[_LOWER[raw] if lower else raw] * _powers(_BASE, len(raw)), out=self.pre[1:])
        self.back = _powers(_INVERSE, len(raw) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self.pre[ends] - self.pre[starts]) * self.back[starts] + (ends - starts + salt).astype(np.uint64))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word."""
    return SpanHash(raw, lower)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
