"""Benchmark decontamination by spaced-seed hashing. Native: DataFrame and SQL functions only.

Fixed masks look at some positions of a window of words and ignore the others, so a seed still hits where a word at an
ignored position was replaced. Every position of every document is hashed under every mask and joined with the hashes
of the benchmark. A hit fixes a document, an item and how their words lie against each other; along that diagonal the words are
then compared, and the best stretch counts, where an equal word gains 1 and another loses ``PENALTY``. An overlap
of ``LEAST`` equal words, or of all words of an item shorter than that, is a leak.

The masks miss no leak. Within a best stretch the gain so far is above 0 after every word, so it begins with three equal words, and
with a penalty of 2 its first five equal words stand as one of the masks has them. Items of fewer words than a mask are hashed whole.

Words are runs of ASCII letters and digits and of non-ASCII characters, lower-cased, so case and punctuation do not matter. Null and empty texts, on
either side, match nothing. Rows that repeat a ``doc_id`` or an ``item_id`` are pooled: the best overlap counts. Long texts are read
whole. Ties between equally good diagonals go to the first in the document. Null ids match nothing. Empty tables give no rows.
Extra columns are ignored, and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import written

#: Positions that each mask looks at: every way in which the first five equal words of a best stretch can stand.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 3, 5), (0, 1, 2, 4, 5))
LEAST, PENALTY = 12, 2
#: Benchmark seeds and hit rows up to this many are broadcast, some 40 bytes each; beyond, the joins are shuffled.
BROADCAST_ROWS = 500_000

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _BREAK), "")


def seeds(texts: DataFrame, key: str, whole: Iterable[int] = ()) -> DataFrame:
    """``key``, ``at`` and ``seed`` of every full window of every mask of every text, and of windows of ``whole`` words."""
    df = texts.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), words_of("text").alias("words"))
    df = df.select(key, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    n = F.size("hashes")

    def under(number: int, mask: tuple[int, ...]) -> Column:
        windows = F.greatest(n - mask[-1], F.lit(0))
        out = F.transform(F.slice("hashes", mask[0] + 1, windows), lambda h: F.xxhash64(h, F.lit(number)))
        for k in mask[1:]:
            out = F.zip_with(out, F.slice("hashes", k + 1, windows), lambda a, b: F.xxhash64(a, b))
        return out

    masks = [*enumerate(MASKS), *((-size, tuple(range(size))) for size in whole)]
    df = df.filter(n > min(m[-1] for _, m in masks)).select(key, *[under(k, m).alias(f"m{i}") for i, (k, m) in enumerate(masks)])
    parts = F.explode(F.array(*[F.col(f"m{i}") for i in range(len(masks))])).alias("of_mask")
    return df.select(key, parts).select(key, F.posexplode("of_mask").alias("at", "seed"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that overlap: ``doc_id``, ``item_id``, number of equal words, where they stand."""
    items = benchmark.filter("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = F.size(words_of("text"))
    short = sorted(r[0] for r in items.select(size).filter((size > 0) & (size < len(MASKS[0]))).distinct().collect())
    tests = seeds(items, "item_id")
    for n in short:
        tests = tests.union(seeds(items.filter(size == n), "item_id", [n]))
    tests = written(tests.select("seed", "item_id", F.col("at").alias("item_at")).distinct(), "seeds")
    hits = seeds(docs, "doc_id", short).join(_small(tests), "seed")
    hits = written(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(_small(hits.select("doc_id").distinct()), "doc_id", "left_semi")
    found = found.select("doc_id", words_of("text").alias("doc_words"))
    wording = items.select("item_id", words_of("text").alias("item_words"))
    both = found.join(hits, "doc_id").join(wording, "item_id")
    first = F.greatest(-F.col("shift"), F.lit(0))
    n = F.least(F.size("item_words"), F.size("doc_words") - F.col("shift")) - first
    equal = F.zip_with(
        F.slice("item_words", first + 1, n), F.slice("doc_words", first + F.col("shift") + 1, n), lambda a, b: a == b
    )
    both = both.filter(n > 0).select("doc_id", "item_id", (first + F.col("shift")).alias("first"), F.size("item_words").alias("size"), equal.alias("equal"))
    # The best stretch so far, and the stretch that ends here: gain, equal words, start.
    start = F.expr(
        "named_struct('k', 0, 'best', named_struct('gain', 0, 'equal', 0, 'start', 0, 'stop', 0), "
        "'here', named_struct('gain', 0, 'equal', 0, 'start', 0))"
    )

    def step(acc: Column, e: Column) -> Column:
        here, k = acc["here"], acc["k"]
        on = here["gain"] > 0
        gain = F.when(on, here["gain"]).otherwise(0) + F.when(e, 1).otherwise(-PENALTY)
        equal = F.when(on, here["equal"]).otherwise(0) + F.when(e, 1).otherwise(0)
        begun = F.when(on, here["start"]).otherwise(k)
        now = F.struct(gain.alias("gain"), equal.alias("equal"), begun.alias("start"))
        stretch = F.struct(gain.alias("gain"), equal.alias("equal"), begun.alias("start"), (k + 1).alias("stop"))
        best = F.when(gain > acc["best"]["gain"], stretch).otherwise(acc["best"])
        return F.struct((k + 1).alias("k"), best.alias("best"), now.alias("here"))

    best = both.select("doc_id", "item_id", "first", "size", F.aggregate("equal", start, step, lambda acc: acc["best"]).alias("best"))
    leaks = best.filter(F.col("best.equal") >= F.least(F.lit(LEAST), F.col("size")))
    row = F.struct(
        F.col("best.equal").alias("equal"), (-F.col("first") - F.col("best.start")).alias("order"),
        (F.col("first") + F.col("best.start")).alias("first_word"), (F.col("first") + F.col("best.stop")).alias("stop_word"),
    )
    top = leaks.groupBy("doc_id", "item_id").agg(F.max(row).alias("top"))
    long = {c: F.col(f"top.{c}").cast("long") for c in ("first_word", "stop_word")}
    return top.select("doc_id", "item_id", F.col("top.equal").cast("long").alias("equal_words"), *[v.alias(c) for c, v in long.items()])


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item, all columns as given."""
    leaked = overlaps(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct()
    leaked = written(leaked, "leaked")
    return docs.join(_small(leaked), docs["doc_id"].cast("long") == leaked["leaked_id"], "left_anti")
