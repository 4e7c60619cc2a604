"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.session import scratch_path

#: A join side is broadcast only when its measured size is at most this.
BROADCAST_MAX_BYTES = 16 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back:
    later steps read it from there, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows times ``row_bytes`` (an upper bound of a
    row's size) stay within ``max_bytes``; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as keep it apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column laid end to end, and the n + 1 offsets of
    its rows; null counts as empty. No per-row copies."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type)
    buffers = col.buffers()
    if len(col) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets.astype(np.int64) - int(offsets[0])
    if col.null_count:
        valid = col.is_valid().to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        if sizes[~valid].any():  # bytes under a null slot are not text
            data = data[np.repeat(valid, sizes)]
            offsets = np.concatenate([[0], np.cumsum(np.where(valid, sizes, 0))])
    return data, offsets


def slices(rows: pa.RecordBatch, text: int, max_bytes: int = 4 << 20):
    """Row ranges of a batch whose texts hold about ``max_bytes`` (at least one row each), so
    that what a task computes at once does not follow the size of Arrow's batches."""
    _, offsets = text_bytes(rows.column(text))
    at = 0
    while at < rows.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield rows.slice(at, end - at)
        at = end


_MUL = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, _MUL)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, _INV)]), dtype=np.uint64)
        return self.up, self.down


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte value times power of the multiplier, modulo 2**64:
    ``span_hash`` reads the hash of any span from them."""
    up, _ = POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end), independent of where they stand."""
    _, down = POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])
