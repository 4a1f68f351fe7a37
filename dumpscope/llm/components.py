"""Connected components of a table of links, as joins and aggregates in a logarithmic number of rounds.

Each task first replaces its links by a forest that joins the same nodes. A table of up to ``BLOCK`` links after that, which is what
a task contracts at once, needs no rounds: one such contraction is the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import written


#: Links that a task contracts at once, some 50 MB in Python.
BLOCK = 1 << 18


def _forest(parent: dict[int, int]) -> pa.RecordBatch:
    """Links in which every node points at the least one of its component; empties ``parent``."""
    pairs = [(x, _root(parent, x)) for x in list(parent)]
    pairs = [(x, r) for x, r in pairs if x != r]
    parent.clear()
    return pa.record_batch([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["hi", "lo"])


def _root(parent: dict[int, int], x: int) -> int:
    while (p := parent.setdefault(x, x)) != x:
        parent[x] = x = parent[p]
    return x


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per ``BLOCK`` links, links of the same components in which every node points at the least one."""
    parent: dict[int, int] = {}
    seen = 0
    for batch in batches:
        for a, b in zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist(), strict=True):
            if seen == BLOCK:
                yield _forest(parent)
                seen = 0
            seen += 1
            a, b = _root(parent, a), _root(parent, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    yield _forest(parent)


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links from a larger to a smaller node."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    least = large.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = large.join(least, "hi")
    small = joined.filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return small.union(least.select("hi", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the least id it is connected with, of every node of ``links`` (a, b) but the least ones."""
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    pairs = written(pairs.mapInArrow(_contract, "hi long, lo long"), "links")
    if pairs.count() <= BLOCK:
        pairs = written(pairs.coalesce(1).mapInArrow(_contract, "hi long, lo long"), "links")
        return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    pairs = written(pairs.distinct(), "links")
    state = None
    while True:
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % (1 << 40))).first()
        if tuple(seen) == state:
            return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
        state = tuple(seen)
        pairs = written(_round(pairs), "links")
