"""Token ids in a compact file format: frequency ranks, byte-aligned, with the control bytes apart.

Ids are replaced by their rank in the corpus, the most frequent first, so the commonest 256 take one byte, the next 65,280
two, and so on to four. Two control bits a value hold its number of bytes less one; four values share a control byte.
Control bytes and data bytes are separate planes, so a table of 256 rows gives the lengths of four values at once.

A file is a range of ``doc_id``; its rows are blocks of consecutive documents in ascending order with their position in
the whole id stream. Spark has no sink for bare binary files, so Parquet is the container, and its committer makes
writing safe when executors are lost. The ranks lie beside the blocks and are read back from there.

Null and empty texts have the end id alone. Rows that repeat a ``doc_id`` stand side by side, each with its own place.
Rows with a null ``doc_id`` come first. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.llm.common import bounded_batches, crc, new_path, runs, written
from dumpscope.llm.tokens import END_ID, encoder

#: Documents in a range; the driver keeps one number for each range.
DOCS_PER_RANGE = 10_000
BLOCK_IDS = 1 << 20
BLOCK = "shard int, start long, doc_ids array<long>, lengths array<int>, n long, control binary, data binary"

_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control plane and data plane of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    size = 1 + (values > 0xFF) + (values > 0xFFFF).astype(np.int8) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values; lengths come from a table by control byte."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    stops = np.cumsum(size, dtype=np.int64)
    plane = np.frombuffer(data + b"\0\0\0", np.uint8)
    first = stops - size
    out = plane[first].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > k)
        out[more] |= plane[first[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def token_stream(docs: DataFrame, path: str | None = None, docs_per_range: int = DOCS_PER_RANGE) -> DataFrame:
    """Documents in ascending ``doc_id`` by range: shard, ids before it in the shard, doc_id, number of ids, ids."""
    n = docs.select().count()
    dealt = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text")
    dealt = dealt.repartitionByRange(max(1, -(-n // docs_per_range)), "doc_id").sortWithinPartitions("doc_id")

    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before = encoder(path), 0
        shard = TaskContext.get().partitionId()
        kind, end = ("<u2" if own.size <= 1 << 16 else "<u4"), np.array([END_ID], "<u4").tobytes()
        for batch, texts in runs(batches):
            ids = [x + end for x in own.encode(texts)]
            lengths = np.array([len(x) // 4 for x in ids])
            starts = before + np.cumsum(lengths) - lengths
            before += int(lengths.sum())
            narrow = [np.frombuffer(x, "<u4").astype(kind).tobytes() for x in ids]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(ids), shard, np.int32)), pa.array(starts), batch.column("doc_id"),
                    pa.array(lengths.astype(np.int32)), pa.array(narrow, pa.binary()),
                ],
                names=["shard", "before", "doc_id", "n", "ids"],
            )

    return dealt.mapInArrow(tokenise, "shard int, before long, doc_id long, n int, ids binary")


def _wide(ids: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(ids), "<u2" if size <= 1 << 16 else "<u4")


def ranks(stream: DataFrame, size: int) -> DataFrame:
    """Count and rank of each of the ``size`` ids, by count, then id. The rows are bounded by the vocabulary."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_wide(batch.column("ids").to_pylist(), size), minlength=size)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], names=["id", "n"])

    spark = stream.sparkSession
    counts = stream.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    total = np.zeros(size, np.int64)
    for row in counts.collect():
        total[row["id"]] = row["n"]
    order = np.lexsort((np.arange(size), -total)).tolist()
    rows = [(int(i), k, int(total[i])) for k, i in enumerate(order)]
    return spark.createDataFrame(rows, "id int, rank int, n long").coalesce(1)


def write_ids(docs: DataFrame, folder: str, path: str | None = None, docs_per_range: int = DOCS_PER_RANGE) -> None:
    """Write ``folder``/ids and ``folder``/ranks."""
    stream = written(token_stream(docs, path, docs_per_range), "ids")
    size = encoder(path).size
    ranks(stream, size).write.parquet(f"{folder}/ranks")
    by_id = np.zeros(size, np.uint32)
    for row in docs.sparkSession.read.parquet(f"{folder}/ranks").collect():
        by_id[row["id"]] = row["rank"]
    # One number for each range.
    totals = {r["shard"]: r["n"] for r in stream.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    starts, total = np.zeros(max(totals, default=0) + 1, np.int64), 0
    for shard in sorted(totals):
        starts[shard], total = total, total + totals[shard]
    shared = docs.sparkSession.sparkContext.broadcast((by_id, starts))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, starts = shared.value
        for batch in batches:
            shards, before = batch.column("shard").to_numpy(), batch.column("before").to_numpy()
            lengths, keys = batch.column("n").to_numpy(), batch.column("doc_id").to_pylist()
            ids = batch.column("ids").to_pylist()
            apart = (shards[1:] != shards[:-1]) | (before[1:] != before[:-1] + lengths[:-1])
            stops, first = [*(np.flatnonzero(apart) + 1).tolist(), len(ids)], 0
            while first < len(ids):
                while stops[0] <= first:
                    stops.pop(0)
                sizes = np.cumsum(lengths[first : stops[0]])
                last = first + max(1, int(np.searchsorted(sizes, BLOCK_IDS, "right")))
                values = rank[_wide(ids[first:last], size)]
                control, data = encode_values(values)
                shard = int(shards[first])
                row = (shard, int(starts[shard] + before[first]), keys[first:last], lengths[first:last].tolist(), len(values), control, data)
                kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary())
                names = [f.split()[0] for f in BLOCK.split(", ")]
                yield pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)
                first = last

    stream.mapInArrow(encode, BLOCK).write.option("compression", "zstd").parquet(f"{folder}/ids")


def read_ids(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """Each document's place, number and checksum of ids, decoded from the files; ``keep_ids`` adds the ids."""
    table = spark.read.parquet(f"{folder}/ranks").collect()
    by_rank = np.zeros(len(table), np.uint32)
    for row in table:
        by_rank[row["rank"]] = row["id"]
    shared = spark.sparkContext.broadcast(by_rank)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                ids = shared.value[decode_values(row["control"], row["data"], row["n"])].astype("<u4").tobytes()
                lengths = np.array(row["lengths"], np.int64)
                stops = np.cumsum(lengths)
                parts = [ids[4 * (b - n) : 4 * b] for b, n in zip(stops.tolist(), row["lengths"], strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + stops - lengths), pa.array(lengths),
                    pa.array([crc(p) for p in parts], pa.int64()), *([pa.array(parts, pa.binary())] if keep_ids else []),
                ]
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return spark.read.parquet(f"{folder}/ids").mapInArrow(decode, schema)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` to the shared folder and read them back."""
    folder = new_path(docs.sparkSession, "idfile")
    write_ids(docs, folder, path)
    return read_ids(docs.sparkSession, folder)
