"""Repeated byte strings removed by a depth-limited radix sort of suffixes.

Every whole text is taken as UTF-8 bytes (null: empty). A suffix is ordered only by its first ``WIDTH`` bytes, in
most-significant-digit passes: each pass puts the suffixes that are left into buckets by one more digit, and a bucket
that holds suffixes of one ``doc_id`` only is finished, since nothing in it can repeat across documents. The equal
groups at depth ``WIDTH`` are exactly the repeated windows; in each, every suffix of a document with a larger
``doc_id`` than the group's smallest is covered.

The first digit is a window's anchor: the least hash of its ``ANCHOR``-byte strings (leftmost on ties). Equal windows
have equal anchors, and a document holds only about 2 / (WIDTH - ANCHOR + 2) distinct anchors a byte, so this pass
counts anchors, not suffixes: a grouped aggregate of anchor to the least and largest ``doc_id``, combined in each task
before the shuffle, and a semi-join that tells each document its shared anchors. Only suffixes under a shared anchor
are made at all. Consecutive windows under the same anchor string form a run; a run whose bytes, with the anchor's
offset, a smaller ``doc_id`` also has is covered whole, by one row for the run (a grouped aggregate of its 128-bit key
and a join). The other runs are open. The least document with a window has it in an open run, and so has every other one whose own run is not
covered whole; so only open runs meet again. Their next digit is the anchor string with the ``SIDE`` bytes before or after it, one of which each window
holds whole: a run has a row for either side, and a side that the open runs of one ``doc_id`` only hold is finished. Only the
windows of the other sides go on, one row each. The last digit is the whole window, as two 64-bit hashes of its halves (128 bits): a
grouped aggregate of it to the least ``doc_id`` and a join of the suffixes with it, which adaptive execution splits
where one bucket is large, so a bucket of a third of all suffixes is no hot task.

Anchors, runs, sides and windows are judged in a fixed number of slices of their hashes, one after the other, so that what is shuffled of all
at once never lies on disk together. The texts are written once as a table bucketed by row id, so that joining them with what each row learns moves only
the smaller side; which texts are copies is written once, in the same buckets. Before that, a text equal to that of a smaller ``doc_id`` is covered whole (if it has a window) and takes no part:
each of its windows is in the smaller copy, which precedes every document that it could precede. No result changes.

The bytes under covered windows are removed (overlaps count; windows are judged on the input). Per row: doc_id,
n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of the bytes left. Matches never cross documents.
Texts under ``WIDTH`` bytes have no window. Rows with equal ``doc_id`` do not cover each other; a null ``doc_id`` is
smaller than no other and covers nothing, and nothing in it is covered. An empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import bounded_batches, bucketed, mix, runs, written

# Fixed values of the contract: window width in bytes.
WIDTH = 50
DIGIT = 25
#: Bytes of the strings whose least hash is a window's anchor. Short ones are shared by texts that repeat nothing, and then
#: all windows around them go on; long ones are more anchors a byte. No result depends on it.
ANCHOR = 24
#: Bytes beside an anchor string that make its next digit; a window has so many before or after it.
SIDE = (WIDTH - ANCHOR) // 2

#: Slices of anchors, runs, sides and windows, one after the other: what is shuffled of one is dropped before the next.
SLICES = 4
#: Texts handled at once, as one string, are cut into blocks of about so many bytes.
BLOCK = 1 << 18
#: Least of so many strings of a window by least of 2, 4, 8 and so on, the last step overlapping.
_STEPS = [1 << k for k in range((WIDTH - ANCHOR + 1).bit_length() - 1)]
_STEPS.append(WIDTH - ANCHOR + 1 - (1 << len(_STEPS)))
_SEEDS = (np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

MARKS = "a long, rid long, doc_id long"
RUNS = "k1 long, k2 long, rid long, doc_id long, first int, last int, off int"
SIDES = "side long, rid long, doc_id long, first int, last int"
SUFFIXES = "d1 long, d2 long, rid long, doc_id long, pos int"
RESULT = "rid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def digits(data: bytes, width: int = DIGIT, seed: np.uint64 = _SEEDS[0], at: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the ``width`` bytes (8 at least) that start at each position (as many as full digits fit), or at those of ``at``."""
    n = len(data) - width + 1
    h = np.full(max(n, 0) if at is None else len(at), seed, np.uint64)
    if n <= 0:
        return h
    with np.errstate(over="ignore"):  # arithmetic modulo 2**64
        for k in [*range(0, width - 8, 8), width - 8]:
            eight = np.ndarray(n, "<u8", data, k, (1,))  # the 8 bytes at each position
            h ^= eight if at is None else eight[at]
            h *= _MIX[0]
            h ^= h >> np.uint64(29)
        h *= _MIX[1]
    return h ^ (h >> np.uint64(32))


def anchors(data: bytes) -> np.ndarray:
    """Each window's anchor: the least hash of its ``ANCHOR``-byte strings (as int64)."""
    if len(data) < WIDTH:
        return np.zeros(0, np.int64)
    least = digits(data, ANCHOR, _SEEDS[1])
    for step in _STEPS:
        least = np.minimum(least[:-step], least[step:])
    return least.view(np.int64)


def _rows(
    batches: Iterable[pa.RecordBatch], keys: list[str], places: list[str], make: Callable[..., tuple], own: str = ""
) -> Iterator[pa.RecordBatch]:
    """Rows of blocks of texts: hashes, ``rid`` and ``doc_id``, then positions in the text.

    ``make`` takes a block as one string, the ends of its texts and their lists ``own`` with the number of rows in each; it gives
    each row's text in the block and the arrays.
    """
    for batch, texts in runs(batches, size=BLOCK):
        data, ends = b"".join(texts), np.cumsum([len(x) for x in texts])
        lists = []
        if own:
            column = batch.column(own)
            lists = [column.flatten(), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)]
        if len(data) < WIDTH:
            continue
        whose, *arrays = make(data, ends, *lists)
        if not len(whose):
            continue
        columns = [pa.array(x.view(np.int64)) for x in arrays[: len(keys)]]
        columns += [batch.column(x).take(pa.array(whose)) for x in ("rid", "doc_id")]
        columns += [pa.array(x.astype(np.int32)) for x in arrays[len(keys) :]]
        yield pa.RecordBatch.from_arrays(columns, names=[*keys, "rid", "doc_id", *places])


def _stretches(differs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of the stretches that end where ``differs`` from the window before and with their text, and their text.

    Windows over the end of a text are in none.
    """
    differs = np.concatenate([[True], differs])
    differs[(starts := ends[:-1])[starts < len(differs)]] = True
    first = np.flatnonzero(differs)
    whose = np.searchsorted(ends, first, "right")
    last = np.minimum(np.append(first[1:], len(differs)) - 1, ends[whose] - WIDTH)
    inside = last >= first
    return first[inside], last[inside], whose[inside]


def _shortened(values: np.ndarray) -> np.ndarray:
    """48 bits of each anchor, which take less disk; anchors that are only equal in these make runs that nothing else has."""
    return (values.view(np.uint64) >> np.uint64(16)).view(np.int64)


def _anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each text."""

    def distinct(data: bytes, ends: np.ndarray) -> tuple:
        values = anchors(data)
        first, _, whose = _stretches(values[1:] != values[:-1], ends)
        values = values[first]
        order = np.lexsort((values, whose))
        values, whose = values[order], whose[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (whose[1:] != whose[:-1])
        return whose[new], _shortened(values[new])

    return _rows(batches, ["a"], [], distinct)


def minimizers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Each window's anchor (as int64) and the position of the string that gives it."""
    least = digits(data, ANCHOR, _SEEDS[1])
    at = np.arange(len(least), dtype=np.int32)
    for step in _STEPS:
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
    return least.view(np.int64), at


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows under one shared anchor string: key of the run's bytes and anchor offset, first and last window and this offset."""

    def under_shared(data: bytes, ends: np.ndarray, shared: pa.Array, _) -> tuple:
        # Every text with an anchor that another one has, has it in its list.
        shared, values = shared.to_numpy(zero_copy_only=False), anchors(data)
        first, last, whose = _stretches(values[1:] != values[:-1], ends)
        hit = np.isin(_shortened(values[first]), shared)
        first, last, whose = first[hit], last[hit], whose[hit]
        off = np.zeros(len(first), np.int64)
        strings, left = digits(data, ANCHOR, _SEEDS[1]).view(np.int64), np.arange(len(first))
        while len(left):
            left = left[strings[first[left] + off[left]] != values[first[left]]]
            off[left] += 1
        if (last > first + off).any():  # the same string again inside a window
            values, at = minimizers(data)
            first, last, whose = _stretches(at[1:] != at[:-1], ends)
            hit = np.isin(_shortened(values[first]), shared)
            first, last, whose = first[hit], last[hit], whose[hit]
            off = at[first] - first
        # The four digits of the first and the last window hold every byte of the run.
        shape = ((off << 8) | (last - first)).astype(np.uint64)
        keys = [shape, shape]
        for start in (first, first + DIGIT, last, last + DIGIT):
            keys = [mix(key, digits(data, DIGIT, seed, start)) for key, seed in zip(keys, _SEEDS, strict=True)]
        base = ends[whose - 1] * (whose > 0)
        return whose, *keys, first - base, last - base, off

    return _rows(batches, ["k1", "k2"], ["first", "last", "off"], under_shared, "shared")


def sides(data: bytes, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sides of runs: number of the run, hash, first and last window.

    The last windows of a run have ``SIDE`` bytes after the anchor string, which is ``at``, those before them more in front of it.
    """
    front, behind = np.flatnonzero(first < at - SIDE), np.flatnonzero(last >= at - SIDE)
    before = digits(data, ANCHOR + SIDE, _SEEDS[0], at[front] - SIDE)
    after = digits(data, ANCHOR + SIDE, _SEEDS[1], at[behind])
    starts = np.concatenate([first[front], np.maximum(first, at - SIDE)[behind]])
    ends = np.concatenate([np.minimum(last, at - SIDE - 1)[front], last[behind]])
    return np.concatenate([front, behind]), np.concatenate([before, after]), starts, ends


def _in_block(ends: np.ndarray, found: pa.Array, rows: np.ndarray, *names: str) -> tuple[np.ndarray, ...]:
    """Text of each list entry, where the text begins, and the entry's fields."""
    whose = np.repeat(np.arange(len(ends)), rows)
    fields = [found.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in names]
    return whose, ends[whose - 1] * (whose > 0), *fields


def _sides(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sides of the runs that no smaller document has whole."""

    def of_runs(data: bytes, ends: np.ndarray, found: pa.Array, rows: np.ndarray) -> tuple:
        whose, base, first, last, off = _in_block(ends, found, rows, "first", "last", "off")
        run, key, first, last = sides(data, first + base, last + base, first + base + off)
        return whose[run], key, first - base[run], last - base[run]

    return _rows(batches, ["side"], ["first", "last"], of_runs, "runs")


def _suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the shared sides: rid, doc_id, pos and the two digits."""

    def windows(data: bytes, ends: np.ndarray, found: pa.Array, rows: np.ndarray) -> tuple:
        whose, base, first, last = _in_block(ends, found, rows, "first", "last")
        n = last - first + 1
        pos = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = pos + np.repeat(base, n)
        return np.repeat(whose, n), digits(data, at=at), digits(data, at=at + DIGIT), pos

    return _rows(batches, ["d1", "d2"], ["pos"], windows, "runs")


def _pass(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """The suffixes whose bucket (``keys``) holds more than one ``doc_id``, with the bucket's ``least``."""
    bounds = suffixes.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("largest"))
    shared = bounds.where(F.col("least") < F.col("largest")).select(*keys, "least")
    return suffixes.join(shared.hint("shuffle_hash"), keys)


def _in_slice(key: str, k: int) -> Column:
    """Slices go by upper bits; Spark deals partitions by a hash of the whole."""
    return F.shiftrightunsigned(key, 24) % SLICES == k


def _in_turn(make: Callable[[int], DataFrame], name: str) -> DataFrame:
    """All rows of the slices. Each is written, and so has its shuffle files dropped, before the next one is run."""
    return functools.reduce(DataFrame.unionByName, [written(make(k), name) for k in range(SLICES)])


def _with_lists(texts: DataFrame, rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The texts that have rows, with the list of these; the texts stay where they are."""
    return texts.join(rows.groupBy("rid").agg(F.collect_list(value).alias(name)).hint("shuffle_hash"), "rid")


def covered_ranges(texts: DataFrame) -> DataFrame:
    """rid, ranges: the byte ranges [start, end) of covered windows of each row that has any (``texts``: rid, doc_id, text)."""
    marks = written(texts.mapInArrow(_anchors, MARKS), "suffix_marks")

    def shared_marks(k: int) -> DataFrame:
        return _pass(marks.where(_in_slice("a", k)), ["a"]).select("a", "rid")

    shared = _in_turn(shared_marks, "suffix_shared")
    found = written(_with_lists(texts, shared, "shared", F.col("a")).mapInArrow(_runs, RUNS), "suffix_runs")

    def judged_runs(k: int) -> DataFrame:
        # A run whose bytes and anchor offset a smaller doc_id also has: each of its windows is in that document.
        own = found.where(_in_slice("k1", k))
        least = own.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"))
        judged = own.join(least.hint("shuffle_hash"), ["k1", "k2"])
        return judged.select("rid", "first", "last", "off", (F.col("doc_id") > F.col("least")).alias("whole"))

    judged = _in_turn(judged_runs, "suffix_judged")
    whole = judged.where("whole").select("rid", F.struct(F.col("first").alias("start"), (F.col("last") + WIDTH).alias("end")).alias("r"))
    open_runs = _with_lists(texts, judged.where(~F.col("whole")), "runs", F.struct("first", "last", "off"))
    halves = written(open_runs.mapInArrow(_sides, SIDES), "suffix_sides")

    def shared_sides(k: int) -> DataFrame:
        return _pass(halves.where(_in_slice("side", k)), ["side"]).select("rid", "first", "last")

    near = _in_turn(shared_sides, "suffix_near")
    suffixes = written(_with_lists(texts, near, "runs", F.struct("first", "last")).mapInArrow(_suffixes, SUFFIXES), "suffix_windows")

    def single_windows(k: int) -> DataFrame:
        return _pass(suffixes.where(_in_slice("d1", k)), ["d1", "d2"]).where(F.col("doc_id") > F.col("least")).select("rid", "pos")

    single = _in_turn(single_windows, "suffix_single")
    single = single.select("rid", F.struct(F.col("pos").alias("start"), (F.col("pos") + WIDTH).alias("end")).alias("r"))
    return whole.unionByName(single).groupBy("rid").agg(F.collect_list("r").alias("ranges"))


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in runs(batches, size=BLOCK):
        data, lengths = b"".join(texts), np.array([len(x) for x in texts], np.int64)
        ends, column = np.cumsum(lengths), batch.column("ranges")
        rows = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        _, base, first, last = _in_block(ends, column.flatten(), rows, "start", "end")
        copies = np.flatnonzero(batch.column("copy").to_numpy(zero_copy_only=False).astype(bool) & (lengths >= WIDTH))
        opened = np.concatenate([first + base, ends[copies] - lengths[copies]])
        closed = np.concatenate([last + base, ends[copies]])
        depth = np.bincount(opened, minlength=len(data) + 1) - np.bincount(closed, minlength=len(data) + 1)
        removed, raw = np.cumsum(depth[:-1]) > 0, np.frombuffer(data, np.uint8)
        out = {"n_removed": [], "n_spans": [], "kept_sha256": []}
        for text, end in zip(texts, ends.tolist(), strict=True):
            own = removed[end - len(text) : end]
            n = int(np.count_nonzero(own))
            spans = int(own[0]) + int(np.count_nonzero(own[1:] & ~own[:-1])) if n else 0
            kept = raw[end - len(text) : end][~own].tobytes() if n else text
            out["n_removed"].append(n)
            out["n_spans"].append(spans)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"), pa.array(lengths), pa.array(out["n_removed"], pa.int64()),
             pa.array(out["n_spans"], pa.int64()), pa.array(out["kept_sha256"], pa.string())],
            names=["rid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: rid, doc_id, n_bytes, n_removed, n_spans, kept_sha256 (module docstring)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = bounded_batches(docs).select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), text.alias("text"), F.sha2(text, 256).alias("digest")
    )
    # Bucketed by row: the joins on rid below move the small sides, never the texts. They move once, so that each bucket is one file.
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = bucketed(rows.repartition(buckets, "rid"), "suffix_texts", "rid")
    known = texts.where(F.col("doc_id").isNotNull())
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("first"))
    # A copy of a text with a smaller doc_id: every window of it is covered.
    copies = known.join(firsts, "digest").select("rid", (F.col("doc_id") > F.col("first")).alias("copy"))
    copies = bucketed(copies.repartition(buckets, "rid"), "suffix_copies", "rid")
    own = texts.join(copies.where(~F.col("copy")).select("rid").hint("shuffle_hash"), "rid", "left_semi").select("rid", "doc_id", "text")
    both = texts.join(copies.hint("shuffle_hash"), "rid", "left").join(covered_ranges(own).hint("shuffle_hash"), "rid", "left")
    copy = F.coalesce(F.col("copy"), F.lit(False)).alias("copy")
    return both.select("rid", "doc_id", "text", "ranges", copy).mapInArrow(_summaries, RESULT)
