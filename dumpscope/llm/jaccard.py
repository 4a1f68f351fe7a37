"""Similarity join of documents by the Jaccard coefficient of their n-gram sets.

The document by n-gram incidence matrix is multiplied with its transpose in blocks, one block of columns for each task, and
the overlap counts of the pairs are added up. Bounds from the set sizes keep the product sparse:

* Only a prefix of each set takes part. Under any order of the n-grams that all documents share, two sets of size n with enough
  overlap meet within the first ``n - ceil(t * n) + 1`` of each. The order is by hash, with frequent n-grams last.
* Pairs whose sizes alone rule the similarity out are never counted.
* A pair whose overlap within the prefixes plus all that could still lie behind them is too small is discarded.

The pairs that are left are compared exactly, on their whole sets. Documents with equal sets are one class and join as one.
Columns of more than ``DENSE`` documents do not give all their pairs at once: first only neighbours by size, which are compared,
and the linked documents are merged; then the pairs of different merged groups, so a group of thousands of near copies
costs about a chain of comparisons. No pair is left out, and no number of partners is limited.

A document without text or words has an empty set and is linked with nothing. A null ``doc_id`` is linked with nothing and
has no component. Rows that repeat a ``doc_id`` are one document: their links are pooled. Long texts are read whole. An
empty table gives no rows. Extra columns are ignored, and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import WordHash, as_bytes, as_long, bounded_batches, list_column, release, runs, shingles, written
from dumpscope.llm.components import components

WIDTH, PERCENT = 5, 80
#: Columns with more documents are dense.
DENSE = 32
#: An n-gram in so many prefixes is frequent; the order knows at most FREQUENT_MOST of them, the most frequent.
FREQUENT, FREQUENT_MOST = 16, 1 << 18
#: Id lists up to this many rows are broadcast, 8 bytes each; beyond, the join is shuffled.
BROADCAST_IDS = 1_000_000
#: Rounds of comparisons with the best linked document of each dense column, while so many pairs are apart. Neither
#: changes the result, only how many pairs are left to compare.
PIVOT_ROUNDS, MANY = 3, 200_000
#: Rows of a dense column in a block, and columns of a slice of its incidence matrix.
BLOCK, SLICE = 1024, 4096
PARSED_BYTES = 32 << 20
PAIRS = "a long, b long, n_a long, n_b long, seen int, chain int"


def set_of(text: bytes, width: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text."""
    return shingles(hashes.of(text.lower().split()), width)


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def frequent(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """Hashes of frequent n-grams, the most frequent last, counted over the prefixes in hash order of all documents."""

    def lowest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for _, texts in runs(batches):
            sets = [set_of(t, width, hashes) for t in texts]
            parts = [s[: prefix_length(len(s), percent)] for s in sets if len(s)]
            values, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64),) * 2
            yield pa.record_batch([pa.array(as_long(values)), pa.array(counts.astype(np.int64))], names=["h", "n"])

    counts = docs.select("text").mapInArrow(lowest, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(FREQUENT_MOST).collect()
    return np.array([r["h"] for r in reversed(rows)], np.int64)


def sketches(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Size, signature (null if empty) and prefix of each document's set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, width, percent))

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, late = WordHash(), shared.value.view(np.uint64)
        order = np.argsort(late)
        late = late[order]
        for batch, texts in runs(batches):
            sizes, signatures, prefixes = [], [], []
            for text in texts:
                s = set_of(text, width, hashes)
                sizes.append(len(s))
                signatures.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                take = prefix_length(len(s), percent) if len(s) else 0
                if len(late) and len(s):
                    at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                    known = late[at] == s
                    rare = s[~known]
                    if len(rare) < take:
                        rare = np.concatenate([rare, s[known][np.argsort(order[at[known]], kind="stable")]])
                    s = rare
                prefixes.append(as_long(s[:take]))
            lists = list_column(np.concatenate(prefixes), np.array([len(p) for p in prefixes]), pa.int64())
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), lists]
            yield pa.record_batch(columns, names=["doc_id", "n", "signature", "prefix"])

    own = docs.select(F.col("doc_id").cast("long"), "text")
    return own.mapInArrow(sketch, "doc_id long, n long, signature binary, prefix array<long>")


def _groups(batches: Iterable[pa.RecordBatch], names: list[str], keys: list[str]) -> Iterator[tuple[dict[str, np.ndarray], bool]]:
    """The columns of each run of equal ``keys`` in sorted batches, and whether it is the first or the last run.

    Runs of one row are left out in between: only the first and the last can go on in another task.
    """
    release()
    rest: dict[str, np.ndarray] | None = None
    edge = True
    for batch in batches:
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if rest is not None:
            now = {c: np.concatenate([rest[c], now[c]]) for c in names}
        if not len(now[keys[0]]):
            continue
        cuts = np.flatnonzero(np.logical_or.reduce([now[k][1:] != now[k][:-1] for k in keys])) + 1
        starts = np.concatenate([[0], cuts])
        wide = np.flatnonzero(np.diff(starts) > 1)
        if edge and len(cuts):
            wide = np.union1d(wide, [0])
        for k in wide.tolist():
            yield {c: now[c][starts[k] : starts[k + 1]] for c in names}, edge and k == 0
        edge &= not len(cuts)
        rest = {c: now[c][starts[-1] :] for c in names}
    if rest is not None:
        yield rest, True


def _emit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    """Pairs with the overlap counts that this task has seen, added up."""
    parts = [np.concatenate([r[k] for r in rows]) for k in range(4)]
    chain = np.concatenate([np.full(len(r[0]), r[4], np.int32) for r in rows])
    flip = parts[0] > parts[1]
    a, b = np.where(flip, parts[1], parts[0]), np.where(flip, parts[0], parts[1])
    n_a, n_b = np.where(flip, parts[3], parts[2]), np.where(flip, parts[2], parts[3])
    order = np.lexsort((b, a))
    a, b, n_a, n_b, chain = (x[order] for x in (a, b, n_a, n_b, chain))
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    seen = np.add.reduceat(1 - chain, first).astype(np.int32)
    linked = np.maximum.reduceat(chain, first)
    columns = [pa.array(x) for x in (a[first], b[first], n_a[first], n_b[first], seen, linked)]
    return pa.record_batch(columns, names=["a", "b", "n_a", "n_b", "seen", "chain"])


def _flushed(pairs: Iterator[tuple], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for pair in pairs:
        if len(pair[0]):
            rows.append(pair)
            size += len(pair[0])
        if size >= most:
            yield _emit(rows)
            rows, size = [], 0
    if rows:
        yield _emit(rows)


def _within(g: dict[str, np.ndarray], percent: int) -> Iterator[tuple]:
    """Pairs of a column, sorted by size, whose sizes allow the similarity."""
    ids, n = g["id"], g["n"]
    stops = np.searchsorted(n, n * 100 // percent, "right")
    for i in range(len(ids) - 1):
        js = np.arange(i + 1, stops[i])
        js = js[ids[js] != ids[i]]
        if len(js):
            yield np.full(len(js), ids[i]), ids[js], np.full(len(js), n[i]), n[js], 0


def _chain(g: dict[str, np.ndarray], percent: int) -> tuple:
    """Neighbours by size whose sizes allow the similarity."""
    near = (g["n"][:-1] * 100 >= percent * g["n"][1:]) & (g["id"][:-1] != g["id"][1:])
    return g["id"][:-1][near], g["id"][1:][near], g["n"][:-1][near], g["n"][1:][near], 1


def _passed(g: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows of a dense column, with ``h``; ``chain`` marks the ends of the run."""
    none, m = pa.nulls(len(g["h"]), pa.int64()), len(g["h"])
    ends = np.zeros(m, np.int32)
    ends[[0, -1]] = 1
    arrays = [pa.array(g["id"]), none, pa.array(g["n"]), none, pa.array(np.zeros(m, np.int32)), pa.array(ends), pa.array(g["h"])]
    return pa.record_batch(arrays, names=["a", "b", "n_a", "n_b", "seen", "chain", "h"])


def _product(columns: DataFrame, percent: int) -> DataFrame:
    """Pairs of sparse columns with their counts, chains of dense ones, and the rows of dense columns.

    Rows are dealt by range of (column, size), so a column of any size is spread over as many tasks as it needs. A
    run at either end of a task may go on in the next one and counts as dense.
    """
    names = ["h", "id", "n"]

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense: list[dict[str, np.ndarray]] = []

        def pairs() -> Iterator[tuple]:
            for g, edge in _groups(batches, names, ["h"]):
                if edge or len(g["h"]) > DENSE:
                    yield _chain(g, percent)
                    dense.append(g)
                else:
                    yield from _within(g, percent)

        for out in _flushed(pairs()):
            yield out.append_column("h", pa.nulls(out.num_rows, pa.int64()))
            while dense:
                yield _passed(dense.pop())
        while dense:
            yield _passed(dense.pop())

    dealt = columns.repartitionByRange("h", "n", "id").sortWithinPartitions("h", "n", "id")
    return dealt.mapInArrow(multiply, PAIRS + ", h long")


def _chained_ends(ends: DataFrame, percent: int) -> DataFrame:
    """Chains of the ends of the runs of a column that several tasks share, two rows for each task."""

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flushed(_chain(g, percent) for g, _ in _groups(batches, ["h", "id", "n"], ["h"]))

    return ends.repartition("h").sortWithinPartitions("h", "n", "id").mapInArrow(chain, PAIRS)


def _blocks(g: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Index pairs of a block of one dense column that could be similar, each where its first common column is.

    Overlaps over all dense columns come from products of slices of the incidence matrix with their transposes.
    """
    lists, m, h = g["columns"], len(g["h"]), g["h"][0]
    values, at = np.unique(np.concatenate(lists), return_inverse=True)
    rows = np.repeat(np.arange(m), [len(x) for x in lists])
    overlap, before = np.zeros((m, m), np.float32), np.zeros((m, m), np.float32)
    for first in range(0, len(values), SLICE):
        inside = (at >= first) & (at < first + SLICE)
        matrix = np.zeros((m, min(SLICE, len(values) - first)), np.float32)
        matrix[rows[inside], at[inside] - first] = 1
        overlap += matrix @ matrix.T
        earlier = matrix[:, values[first : first + SLICE] < h]
        before += earlier @ earlier.T
    n, component, own = g["n"], g["component"], g["own"]
    least, most = np.minimum.outer(n, n), np.maximum.outer(n, n)
    need = -(-percent * (least + most) // (100 + percent))
    could = (before == 0) & (overlap >= need - (-(-percent * most // 100) - 1)) & (100 * least >= percent * most)
    could &= component[:, None] != component
    if g["i"][0] != g["j"][0]:
        could &= own[:, None] != own
    return np.argwhere(np.triu(could, 1))


def _across(docs: DataFrame, labelled: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) within dense columns between different components, as far as they change components.

    Columns within one component, which is what near copies come to, are left out by an aggregate. The others are cut into
    blocks of rows and every two blocks meet in one place, so no task gets a whole column. The overlaps in dense columns
    first tell which documents have a partner at all; their texts join them, and the pairs are compared where they meet.
    Pairs never leave a task: what leaves is a forest.
    """
    stats = labelled.groupBy("h").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("m"))
    mixed = stats.filter("least <> most").select("h", F.expr(f"int((m - 1) div {BLOCK}) + 1").alias("blocks"))
    # A document has no more dense columns than its prefix is long.
    lists = labelled.groupBy("id").agg(F.array_sort(F.collect_set("h")).alias("columns"))
    rows = labelled.dropDuplicates(["h", "id"]).join(mixed, "h").join(lists, "id")
    rows = rows.withColumn("own", F.expr("int(pmod(xxhash64(id), blocks))"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    names, keys = ["h", "i", "j", "own", "id", "n", "component", "columns"], ["h", "i", "j"]

    def apart(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for g, _ in _groups(batches, names, keys):
            if (g["component"] != g["component"][0]).any():
                yield g

    def survivors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in apart(batches):
            some = np.unique(_blocks(g, percent))
            if len(some):
                kept = [pa.array(g[c][some]) for c in names[:-1]]
                lists = [g["columns"][k] for k in some.tolist()]
                kept.append(list_column(np.concatenate(lists), np.array([len(x) for x in lists]), pa.int64()))
                yield pa.record_batch(kept, names=names)

    schema = "h long, i int, j int, own int, id long, n long, component long, columns array<long>"
    dealt = rows.select(*names).repartition(*keys).sortWithinPartitions(*keys)
    some = written(dealt.mapInArrow(survivors, schema), "apart")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for g, _ in _groups(batches, [*names, "text"], keys):
            sets = [set_of(t or b"", width, hashes) for t in g["text"]]
            root: dict[int, int] = {}
            forest = []

            def find(x: int, root=root) -> int:
                while (p := root.get(x, x)) != x:
                    root[x] = x = root.get(p, p)
                return x

            component, ids = g["component"].tolist(), g["id"].tolist()
            for x, y in _blocks(g, percent).tolist():
                a, b = find(component[x]), find(component[y])
                if a != b and _similar(sets[x], sets[y], percent):
                    root[max(a, b)] = min(a, b)
                    forest.append((ids[x], ids[y]))
            yield _links(forest)

    texts = _texts(docs, some.select(F.col("id").alias("doc_id"))).select(F.col("doc_id").alias("id"), F.encode("text", "UTF-8").alias("text"))
    dealt = some.join(texts, "id").select(*names, "text").repartition(*keys).sortWithinPartitions(*keys)
    return written(dealt.mapInArrow(compare, "a long, b long"), "late")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    shared = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of some ids."""
    wanted = _small(written(ids.distinct(), "ids"))
    return docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi")


def links(docs: DataFrame, sketched: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between documents with different sets, as far as they change components: ``a``, ``b``.

    ``sketched`` has one row for each distinct set.
    """
    columns = sketched.select(F.explode("prefix").alias("h"), F.col("doc_id").alias("id"), "n")
    product = written(_product(columns, percent), "product")
    dense = product.filter("h IS NOT NULL").select("h", F.col("a").alias("id"), F.col("n_a").alias("n"), "chain")
    # How many of a document's prefix n-grams stand in dense columns, which the counts so far leave out.
    uncounted = dense.groupBy("id").agg(F.count("*").alias("more"))
    pairs = product.filter("h IS NULL").drop("h").union(_chained_ends(dense.filter("chain = 1").drop("chain"), percent))
    counted = pairs.groupBy("a", "b", "n_a", "n_b").agg(F.sum("seen").alias("seen"), F.max("chain").alias("chain"))
    more_a, more_b = (uncounted.select(F.col("id").alias(x), F.col("more").alias(f"more_{x}")) for x in "ab")
    counted = counted.join(more_a, "a", "left").join(more_b, "b", "left")
    could = F.col("seen") + F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0)))
    tested = written(counted.filter((F.col("chain") == 1) | _enough(could, percent)).select("a", "b"), "tested")
    found = compared(docs, tested, width, percent)
    dense, pivots = dense.drop("chain"), None
    for step in range(PIVOT_ROUNDS + 1):
        merged = components(found)
        labelled = dense.join(merged, "id", "left").withColumn("component", F.coalesce("component", "id"))
        labelled = written(labelled, "dense")
        if step == PIVOT_ROUNDS or not _many_apart(labelled):
            break
        # Near copies are often nearer to their origin than to each other, and the origin has the most links by now.
        ends = found.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
        ranked = labelled.join(ends, "id") if pivots is None else labelled.join(ends, "id").join(pivots, "id", "left_anti")
        best = ranked.groupBy("h").agg(F.max_by(F.struct("id", "n", "component"), F.struct("links", -F.col("id"))).alias("p"))
        near = labelled.join(best, "h").filter(f"component <> p.component AND least(n, p.n) * 100 >= {percent} * greatest(n, p.n)")
        near = near.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b"), F.col("p.id").alias("pivot")).distinct()
        near = written(near.join(tested, ["a", "b"], "left_anti"), "pivots")
        used = near.select(F.col("pivot").alias("id")).distinct()
        pivots = used if pivots is None else pivots.union(used)
        near = near.select("a", "b").distinct()
        found, tested = found.union(compared(docs, near, width, percent)), tested.union(near)
    # Pairs that share a sparse column have been compared or discarded, so the others share dense ones alone.
    return found.union(_across(docs, labelled, width, percent))


def _many_apart(labelled: DataFrame) -> bool:
    """Whether the dense columns hold many pairs of different components."""
    by = labelled.groupBy("h", "component").agg(F.count("*").alias("k")).groupBy("h")
    pairs = by.agg((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("pairs"))
    return (pairs.agg(F.sum("pairs").alias("pairs")).first()["pairs"] or 0) > MANY


def _enough(seen, percent: int):
    """Whether an overlap of the prefixes lets the whole overlap reach what the sizes ask for."""
    need = F.expr(f"({percent} * (n_a + n_b) + {100 + percent - 1}) div {100 + percent}")
    behind = F.expr(f"greatest(({percent} * n_a + 99) div 100, ({percent} * n_b + 99) div 100) - 1")
    return seen + behind >= need


def compared(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar, by their whole sets. Texts travel once for a document and once for a pair."""
    wanted = pairs.select(F.col("a").alias("head"), F.col("b").alias("doc_id"), F.lit(1).alias("part"))
    wanted = wanted.union(pairs.select("a", "a", F.lit(0)).distinct())
    texts = _texts(docs, wanted.select("doc_id"))
    dealt = texts.join(wanted, "doc_id").repartition("head").sortWithinPartitions("head", "part", "doc_id")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, head, sets = WordHash(), None, []
        parsed: dict[bytes, np.ndarray] = {}
        size = 0
        release()
        for batch in batches:
            out = []
            keys = (batch.column(c).to_pylist() for c in ("head", "part", "doc_id"))
            for (a, part, b), text in zip(zip(*keys, strict=True), as_bytes(batch.column("text")), strict=True):
                s = parsed.get(text)
                if s is None:
                    s = set_of(text, width, hashes)
                    size += len(text) + s.nbytes
                    if size > PARSED_BYTES:
                        parsed, size = {}, 0
                    parsed[text] = s
                if a != head:
                    head, sets = a, []
                if part == 0:
                    sets.append(s)
                    continue
                if any(_similar(first, s, percent) for first in sets):
                    out.append((a, b))
            yield _links(out)
        del parsed, sets, hashes
        release()

    return written(dealt.select("head", "part", "doc_id", "text").mapInArrow(compare, "a long, b long"), "similar")


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """A row for each document: ``doc_id``, ``n_shingles``, ``component_id``."""
    sketched = written(sketches(bounded_batches(docs), width, percent), "sketches")
    named = sketched.filter("signature IS NOT NULL AND doc_id IS NOT NULL")
    copies = named.groupBy("signature").agg(F.min("doc_id").alias("node"), F.count("*").alias("times"))
    copies = written(copies.filter("times > 1").select("signature", "node"), "copies")
    with_node = sketched.join(_small(copies), "signature", "left").withColumn("node", F.coalesce("node", "doc_id"))
    nodes = with_node.filter("signature IS NOT NULL AND doc_id = node").select("doc_id", "n", "prefix")
    merged = components(links(docs, nodes, width, percent))
    merged = merged.select(F.col("id").alias("node"), "component")
    out = with_node.select("doc_id", F.col("n").alias("n_shingles"), "node").join(merged, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents without those that are linked, over any number of links, with one of smaller ``doc_id``."""
    others = classes(docs, width, percent).filter("component_id < doc_id").select("doc_id").distinct()
    others = written(others.select(F.col("doc_id").alias("dropped_id")), "dropped")
    return docs.join(_small(others), docs["doc_id"].cast("long") == others["dropped_id"], "left_anti")
