"""Pack tokenised documents into fixed-length sequences by first-fit decreasing in random groups.

A document's ids end with an end id. They are cut into pieces: full sequences first, then at most one half
sequence, then the rest. Pieces are dealt to groups at random, and each group is packed on its own: pieces in
decreasing length go to the first bin with room, which a tournament tree of bin capacities finds in logarithmic
time. No piece is over half a sequence unless it is full, so first-fit decreasing leaves little room.

Null or empty texts have the end id alone and are packed like any other. Rows that repeat a ``doc_id`` are packed each
for itself. Long texts are cut without limit. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import bounded_batches, crc, runs
from dumpscope.llm.tokens import END_ID, encoder

CAPACITY = 2048
PIECES_PER_GROUP = 8192
#: Bytes of text that a piece is reckoned to hold.
PIECE_BYTES = 4 * CAPACITY
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    full, rest = divmod(n, capacity)
    out, half = [capacity] * full, capacity // 2
    if rest > half:
        out.append(half)
        rest -= half
    return [*out, rest] if rest else out


def first_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, first-fit decreasing; ties go in the given order.

    ``tree[1]`` is the root of a tournament tree whose leaves are the free room of the bins.
    """
    total = int(lengths.sum())
    # At most one bin ends up half empty, so there are no more than twice the bins that the total needs, and one.
    leaves = 1 << max(0, (2 * (-(-total // capacity)) + 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        node >>= 1
        while node:
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
            node >>= 1
    return bins, offsets


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each document; ``keep_ids`` adds the ids, little-endian unsigned 32-bit, as ``ids``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, np.uint32(END_ID).astype("<u4").tobytes()
        for batch, texts in runs(batches):
            keys = batch.column("doc_id").to_pylist()
            columns: list[list] = [[] for _ in range(5 + keep_ids)]
            for key, ids in zip(keys, encode(texts), strict=True):
                view, start = memoryview(ids + end), 0
                n = len(view) // 4
                for length in cuts(n, capacity):
                    piece = view[4 * start : 4 * (start + length)]
                    row = (key, start, length, crc(piece), n, *([bytes(piece)] if keep_ids else ()))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    start += length
            kinds = [pa.int64()] * 5 + [pa.binary()] * keep_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES + ", ids binary" * keep_ids)


def packed(of: DataFrame, groups: int, capacity: int = CAPACITY, seed: int = 17) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. Sequence ids are unique: the group's number stands above 2^32."""

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        keys = [table.column(c) for c in ("doc_id", "start", "ids_crc32")]
        order = pa.compute.sort_indices(
            pa.table(keys, names=["a", "b", "c"]), [("a", "ascending"), ("b", "ascending"), ("c", "ascending")]
        )
        table = table.take(order)
        bins, offsets = first_fit(lengths[order.to_numpy()], capacity)
        sequence = (table.column("pack_group").to_numpy() << 32) + bins
        table = table.drop_columns("pack_group")
        return table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    import pyarrow.compute  # noqa: F401  pa.compute, also in the tasks

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in of.schema)
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.lit(seed)), F.lit(groups).cast("long"))
    dealt = of.withColumn("pack_group", group).groupBy("pack_group")
    return dealt.applyInArrow(pack, fields + ", sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP, keep_ids: bool = False
) -> DataFrame:
    """Tokenise, cut and pack ``docs``; a row for each piece. The number of groups follows rows and bytes, long texts included."""
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("size")
    rows = docs.agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("size")).first()
    groups = max(1, -(-(2 * rows["n"] + rows["size"] // PIECE_BYTES) // per_group))
    return packed(pieces(docs, path, capacity, keep_ids), groups, capacity)
