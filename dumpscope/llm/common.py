"""Helpers that the operators share: written tables, bytes of an Arrow column, word hashes."""

from __future__ import annotations

import ctypes
import gc
import resource
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Texts handled at once in a task are cut into runs of about so many bytes.
RUN_BYTES = 4 << 20
#: Growth of a worker that is not worth giving back.
SPARE_BYTES = 8 << 20
#: Bytes that this process held when it last gave memory back.
_held = 0


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines see: ``spark.checkpoint.dir``, or where it is unset, as in tests, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def bounded_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on a session that has Spark's default gives Python a fifth of the rows at once.

    Whole texts are long: a batch of the default 10,000 rows takes some 35 MB, several times over in each task.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, "2000")
    return df


def _resident() -> int:
    """Bytes of memory that this process holds; 0 where the system does not tell."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * resource.getpagesize()
    except OSError:
        return 0


def release() -> None:
    """Give memory that the Python worker has freed back to the machine, if it has grown since the last time.

    Workers live on between tasks, and their allocators would keep the most that any task so far has needed. A collection takes
    longer than a small task, so workers that hold about what they held before go without.
    """
    global _held
    if 0 < _resident() <= _held + SPARE_BYTES:
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    _held = _resident()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    """A setting of the session that holds for what is run inside."""
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession):
    """What runs inside has its shuffle files removed when it ends: a written table is read back, never its shuffles.

    Otherwise they stay until the driver happens to collect its garbage, those of all steps so far at once.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def joined_by_bucket(spark: SparkSession):
    """Joins that run inside, of tables bucketed by some of the join's keys, move neither side."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false", "true")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder; later jobs start from there."""
    path = new_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """The same rows, written to the shared folder as a table bucketed and sorted by ``keys``.

    Joins on exactly ``keys`` with the table then move only the other side, and two such tables join without a
    shuffle: the rows stay where they were written. There are as many buckets as the session has shuffle partitions.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, *keys).sortBy(*keys).option("compression", "zstd").option("path", new_path(spark, name))
    with shuffles_dropped(spark):
        writer.saveAsTable(table)
    return spark.table(table)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each string; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def runs(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = RUN_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Consecutive rows of bounded total size, with the UTF-8 of their texts."""
    release()
    for batch in batches:
        texts = as_bytes(batch.column(text))
        ends = np.cumsum([len(x) for x in texts]) if texts else np.zeros(0, int)
        first = 0
        while first < len(texts):
            base = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(first, last - first), texts[first:last]
            first = last
        del batch, texts
    release()


class WordHash(dict):
    """64-bit hash of a word, remembered; forgets everything beyond a bound, which changes no result."""

    def __init__(self, bound: int = 250_000):
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_SHIFT = np.uint64(29)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of ordered pairs of hashes."""
    x = (left ^ (left >> _SHIFT)) * _FACTORS[0] + right
    x = (x ^ (x >> np.uint64(32))) * _FACTORS[1]
    return x ^ (x >> _SHIFT)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words; of the whole sequence if it is shorter; none of none."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    out = hashes[: len(hashes) - width + 1] + np.uint64(width)
    for k in range(1, width):
        out = mix(out, hashes[k : len(hashes) - width + 1 + k])
    return np.unique(out)


def as_long(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def crc_remainder(column: str, modulus: int):
    """``crc32(column as text) mod modulus`` as a Column; null keys count as the text ''."""
    from pyspark.sql import functions as F

    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc(data: bytes | memoryview) -> int:
    return zlib.crc32(data)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
