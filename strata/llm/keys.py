"""Which hashed keys of a batch of documents occur elsewhere, without shuffling occurrences.

Documents are dealt into batches of a few MB. A batch sends each distinct key
once (a key that a third of all documents share is one entry per batch), packed
as arrays, to the bucket of the key; the bucket sends back, packed as well,
which of the batch's keys meet a condition. Texts are shuffled once and
re-read by batch; occurrences never leave their batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 2 << 20     # text of a batch, up to 1 GB of text
BUCKET_KEYS = 1 << 18     # keys that meet in a bucket, about, up to 1 GB of text
MOST = 8                  # times those that a batch and a bucket grow to, which bounds a task's memory

PACKED = "batch int, bucket int, keys binary"
PACKED_ARROW = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])


def _growth(n_bytes: int) -> float:
    """Batches times buckets are the rows of a shuffle: both grow as the root of the text, so that rows grow as the text."""
    return min(MOST, max(1.0, (n_bytes / 2 ** 30) ** 0.5))


def batched(docs: DataFrame, n_bytes: int, *by: str) -> DataFrame:
    """``docs`` plus ``batch`` from a hash of the columns ``by``, even and the same in every run."""
    n = max(1, -(-n_bytes // int(BATCH_BYTES * _growth(n_bytes))))
    return docs.withColumn("batch", F.pmod(F.xxhash64(*by), F.lit(n)).cast("int"))


def bucket_count(n_bytes: int) -> int:
    """Buckets for about a key per six bytes of text."""
    return max(1, -(-(n_bytes // 6) // int(BUCKET_KEYS * _growth(n_bytes))))


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A bucket from a hash's upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def packed(batch: int, buckets: np.ndarray, values: np.ndarray) -> pa.Table:
    """A row per bucket from ascending ``buckets`` and the values that go there."""
    cut = np.flatnonzero(np.diff(buckets, prepend=-1)) if len(buckets) else np.empty(0, np.int64)
    bounds = (np.append(cut, len(buckets)) * values.itemsize).astype(np.int32)
    keys = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values))])
    return pa.Table.from_arrays([pa.array(np.full(len(cut), batch, np.int32)),
                                 pa.array(buckets[cut].astype(np.int32)), keys], schema=PACKED_ARROW)


def unpacked(table: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(row of each value, values) of packed rows."""
    keys = table.column("keys").to_pylist()
    n = np.array([len(k) for k in keys], np.int64) // np.dtype(dtype).itemsize
    return np.repeat(np.arange(len(keys)), n), np.frombuffer(b"".join(keys), dtype)


def replies(table: pa.Table, row: np.ndarray, values: np.ndarray) -> pa.Table:
    """Packed rows that hold ``values``, each under the batch and bucket of its ``row`` (ascending)."""
    cut = np.flatnonzero(np.diff(row, prepend=-1)) if len(row) else np.empty(0, np.int64)
    bounds = (np.append(cut, len(row)) * values.itemsize).astype(np.int32)
    keys = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values))])
    of = pa.array(row[cut])
    return pa.Table.from_arrays([table.column("batch").take(of).combine_chunks(), table.column("bucket").take(of).combine_chunks(), keys],
                                schema=PACKED_ARROW)


def member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values lie in an ascending array."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def per_batch(docs: DataFrame, fn, schema: str) -> DataFrame:
    return docs.groupBy("batch").applyInArrow(fn, schema)


def per_bucket(asked: DataFrame, fn) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(fn, PACKED)


def with_replies(docs: DataFrame, replied: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(documents of a batch, replies to it)`` for every batch."""
    return docs.groupBy("batch").cogroup(replied.groupBy("batch")).applyInArrow(fn, schema)
