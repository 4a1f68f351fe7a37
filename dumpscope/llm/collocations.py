"""Phrase collocations by SETM: relations of occurrences, extended one word at a time by joins.

Texts are lower-cased in A-Z only, cut into pieces at ``PIECE`` and the pieces into words at ``GAP``. Everything is
counted per language (null: ``und``). The relation of occurrences of frequent words (row, piece and position, number of the word in its
language) is written once, after a grouped count of all words. For each length k from 1 to 4 the relation of occurrences of frequent k-word phrases is joined with the word
relation on row, piece and the position right after the phrase (a merge join of two relations in buckets by row, so neither moves),
the new phrases are counted by a grouped count, and only occurrences of phrases that reach ``LEAST`` are kept (a
join with the frequent groups) before the next length. A relation holds numbers only: a frequent phrase gets one when its
group is written, and is told by those of the phrase before and its last word; groups, not occurrences, carry the text. Every prefix of a frequent phrase is frequent, so no
phrase of 2 to 5 words with ``LEAST`` occurrences or more is missed.

A candidate of m words is cut after each k < m words into two frequent parts; l and r are their counts and
``floor(1000 * a * n / (l * r))`` the score of the cut, n the language's word count. The cut with the lowest score counts,
ties to the smallest k; products are exact decimals. Candidates inside a longer candidate with at least as many
occurrences are dropped. Each language's first ``TOP`` by score, count and phrase (UTF-8 byte order) are returned.

Null texts are empty and give no words; long texts are read whole; repeated rows count each time; an empty table gives
no rows; extra columns are not read. Rows are told apart by an id taken at the scan, so equal or null ``doc_id``
do not mix occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumpscope.llm.common import bucketed, joined_by_bucket, written

# Fixed values of the contract: piece ends, word gaps, least count, lengths, report size.
PIECE = r"[.,;:!?\x0A-\x0D]"
GAP = r"[\x20\x09]+"
LEAST = 100
SHORTEST, LONGEST = 2, 5
TOP = 2000
#: Frequent phrases of a length up to this many rows are broadcast; beyond, the semi-join is shuffled.
FEW = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT = "decimal(38,0)"


def split_words(rows: DataFrame) -> DataFrame:
    """One row per word occurrence: lang, rid, at, spelled (the word before it is lower-cased). ``at`` is the piece in its upper half and the word's position
    in the lower one, consecutive within a piece only."""
    pieces = rows.select("lang", "rid", F.posexplode(F.split("t", PIECE)).alias("piece", "p"))
    words = pieces.select("lang", "rid", "piece", F.posexplode(F.split("p", GAP)).alias("pos", "spelled"))
    # A gap at the start of a piece gives one empty word at position 0; the others follow without a hole.
    words = words.where(F.length("spelled") > 0)
    return words.select("lang", "rid", (F.shiftleft(F.col("piece").cast("long"), 32) + F.col("pos")).alias("at"), "spelled")


def occurrences(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The word occurrences, where the texts lie (for counts), and after the texts have moved once, by row."""
    lang, text = F.coalesce(F.col("lang"), F.lit("und")), F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(lang.alias("lang"), F.monotonically_increasing_id().alias("rid"), text.alias("t"))
    # Once texts have moved by row, every relation lies in buckets by row, and joins of them move nothing.
    moved = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rid")
    return split_words(rows), split_words(moved)


def numbered(counts: DataFrame, least: int) -> DataFrame:
    """The groups of ``least`` occurrences or more, with an ``id`` each."""
    return written(counts.where(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()), "frequent_counts")


def of_groups(occ: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """The occurrences of the groups. Few groups go to the occurrences, which then stay where they are."""
    return occ.join(F.broadcast(groups) if groups.count() <= FEW else groups, keys, how)


def frequent(occ: DataFrame, least: int = LEAST, keys: tuple[str, ...] = ("lang", "phrase"), ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """(groups by ``keys`` with their count ``f`` where f >= least and an ``id``, occurrences of those groups).

    With ``ids`` the occurrences have the ``id`` of their group in place of the keys.
    """
    counts = numbered(occ.groupBy(*keys).agg(F.count(F.lit(1)).alias("f")), least)
    if ids:
        return counts, of_groups(occ, counts.select(*keys, "id"), list(keys)).drop(*keys)
    return counts, of_groups(occ, counts.select(*keys), list(keys), "left_semi")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(every phrase of 1 to ``longest`` words with f >= least, with its word count k; word totals n per language)."""
    lying, moved = occurrences(docs)
    # Each spelling is lower-cased once, not each occurrence.
    spellings = lying.groupBy("lang", "spelled").agg(F.count(F.lit(1)).alias("f"))
    spellings = written(spellings.withColumn("phrase", F.translate("spelled", UPPER, LOWER)), "spellings")
    totals = spellings.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = numbered(spellings.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), least)
    # Only frequent words can extend a frequent phrase. The relations hold the numbers of phrases, and where their last word stands.
    known = spellings.join(counts.select("lang", "phrase", "id"), ["lang", "phrase"]).select("lang", "spelled", "id")
    level = of_groups(moved, written(known, "known_spellings"), ["lang", "spelled"])
    level = bucketed(level.select("rid", "at", "id"), "phrases1", "rid")
    names = first = counts.select("id", "lang", "phrase", "f")
    next_word = level.withColumnRenamed("id", "word")
    found = [names.withColumn("k", F.lit(1))]
    for k in range(1, longest):
        starts = level.select("rid", (F.col("at") + 1).alias("at"), F.col("id").alias("start"))
        longer = starts.join(next_word, ["rid", "at"])
        with joined_by_bucket(docs.sparkSession):
            counts, level = frequent(longer, least, ("start", "word"), ids=True)
            level = bucketed(level, f"phrases{k + 1}", "rid") if k + 1 < longest else level
        starts = names.select(F.col("id").alias("start"), "lang", F.col("phrase").alias("before"))
        ends = first.select(F.col("id").alias("word"), F.col("phrase").alias("last"))
        named = counts.join(starts, "start").join(ends, "word").select("id", "lang", F.concat_ws(" ", "before", "last").alias("phrase"), "f")
        names = written(named, "frequent_names")
        found.append(names.withColumn("k", F.lit(k + 1)))
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return written(union.drop("id"), "frequent_phrases"), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` candidates (module docstring)."""
    found, totals = phrases(docs, least)
    words = F.split("phrase", " ")
    candidates = found.where(F.col("k") >= SHORTEST).select("lang", "phrase", F.col("f").alias("a"), "k", words.alias("w"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*",
        F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    part = found.select("lang", "phrase", "f")
    cuts = cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    score = F.expr(f"(cast(1000 as {EXACT}) * cast(a as {EXACT}) * cast(n as {EXACT})) div (cast(l as {EXACT}) * cast(r as {EXACT}))")
    cuts = cuts.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), F.col("cut"), F.col("l"), F.col("r")).alias("c"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min("c").alias("c"))
    # Inner sub-phrases of 2 words or more of each candidate of 3 or more, with the candidate's count.
    inner = candidates.where(F.col("k") > SHORTEST).select(
        "lang", "a", "w", F.explode(F.sequence(F.lit(SHORTEST), F.col("k") - 1)).alias("m")
    )
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("i"))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), F.col("a").alias("outer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.col("outer").isNull() | (F.col("outer") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("c.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
    return ranked.select(
        "lang",
        F.col("rank").cast("long"),
        "phrase",
        F.col("a").cast("long"),
        F.col("c.l").cast("long").alias("l"),
        F.col("c.r").cast("long").alias("r"),
        F.col("n").cast("long"),
        F.col("c.score").cast("long").alias("score"),
        F.col("c.cut").cast("long").alias("cut"),
    )
