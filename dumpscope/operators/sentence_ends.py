"""Sentence ends learned from the corpus: abbreviations found by a log-likelihood ratio, kept as a table the splitter reads.

Counting (``period_counts``): every whitespace token of every text whose letters, with inner periods, end in one
period is an occurrence of its lower-cased type without that period ``with`` a period; the same type without a period
is an occurrence ``without`` one. ``n`` is all tokens, ``periods`` all tokens that end in a period. One grouped
aggregate over the whole corpus, with all tokens of no type in one group, gives both.

Scoring (``abbreviations``), after Kiss and Strunk's unsupervised detection: with ``k`` occurrences with a period of
``c`` in all, ``p = periods / n`` and ``q = 0.99``, the log-likelihood ratio is
``-2 * (k ln p + (c - k) ln(1 - p) - k ln q - (c - k) ln(1 - q))``; it is scaled by ``exp(-length)`` (letters without
periods), by the number of inner periods plus one, and by ``length ** -(c - k)``. A type is an abbreviation at a
score of ``THRESHOLD`` or more. The table is one row per type; the splitter reads it.

Splitting (``sentences``): a text is cut after ``.``, ``!`` or ``?`` followed by whitespace, as the plain splitter does,
and a piece is joined to the next (by one space) when it ends in a period after a known abbreviation. The last words of
a text's pieces are looked up as one list (``looked_up``): where the text lies when at most ``limit`` abbreviations are
known, else by a join; runs of pieces are then slices of the list, so no piece is moved. Null and empty texts have no
sentences, rows with equal or null keys stay apart, extra columns are not read; a corpus without periods learns no
abbreviation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.functions import text as tx
from dumpscope.operators.lookup import looked_up
from dumpscope.operators.small import INLINE_LIMIT

# Fixed values of the method: the probability of a period after an abbreviation, the score threshold.
ABBREVIATION_PERIOD = 0.99
THRESHOLD = 0.3
#: A type: letters and inner periods, lower-cased.
TYPE = r"^[a-z]+(?:\.[a-z]+)*$"
#: The lower-cased last token of a piece without its final period; null when it has none.
STEM = r"regexp_extract(lower(element_at(split(token, '[ \\t\\n\\x0B\\f\\r]+'), -1)), '(?s)^(.*)[.]$', 1)"


def period_counts(df: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(``word``, ``with_period``, ``without_period`` per type, null for all others; one row of ``n`` tokens and ``periods``)."""
    tokens = df.select(F.explode(tx.blank_tokens(F.lower(F.coalesce(F.col(text), F.lit(""))))).alias("t"))
    ends = F.endswith("t", F.lit("."))
    typed = tokens.select(F.when(ends, F.expr("substring(t, 1, length(t) - 1)")).otherwise(F.col("t")).alias("word"), ends.alias("dot"))
    counts = typed.groupBy(F.when(F.col("word").rlike(TYPE), F.col("word")).alias("word")).agg(
        F.count(F.when(F.col("dot"), 1)).alias("with_period"), F.count(F.when(~F.col("dot"), 1)).alias("without_period")
    )
    totals = counts.agg(F.sum(F.col("with_period") + F.col("without_period")).alias("n"), F.sum("with_period").alias("periods"))
    return counts, totals


def abbreviations(df: DataFrame, text: str) -> DataFrame:
    """``word``, ``with_period``, ``without_period``, ``score`` and ``abbreviation`` for every type of the corpus."""
    counts, totals = period_counts(df, text)
    k, c = F.col("with_period"), F.col("with_period") + F.col("without_period")
    q = F.lit(ABBREVIATION_PERIOD)
    counts = counts.where("word IS NOT NULL")
    # Two numbers.
    n, periods = totals.first()
    p = F.lit(periods / n if n else 0.0)

    def term(count: Column, prob: Column) -> Column:
        return F.when(count == 0, F.lit(0.0)).otherwise(count * F.log(prob))

    null = term(k, p) + term(c - k, 1 - p)
    alternative = term(k, q) + term(c - k, 1 - q)
    length = F.length(F.regexp_replace("word", r"\.", ""))
    inner = F.length("word") - length
    score = -2 * (null - alternative) * F.exp(-length) * (inner + 1) * F.pow(length, -(c - k))
    scored = counts.select("word", "with_period", "without_period", F.when(k > 0, score).otherwise(F.lit(0.0)).alias("score"))
    return scored.withColumn("abbreviation", F.col("score") >= THRESHOLD)


def sentences(df: DataFrame, key: str, text: str, known: DataFrame, limit: int = INLINE_LIMIT) -> DataFrame:
    """``key``, ``pos`` (from 0) and ``sentence``: the text's sentences, not cut after a known abbreviation."""
    abbrevs = known.where("abbreviation").select(F.col("word").alias("_word"), F.lit(True).alias("_value"))
    found = looked_up(df, key, tx.sentences(F.col(text)), abbrevs, form=STEM, limit=limit)
    # A piece starts a sentence unless the one before it is open.
    before = F.slice(F.concat(F.array(F.lit(None).cast("boolean")), "found"), 1, F.size("found"))
    starts = F.filter(F.transform(before, lambda is_open, i: F.when(is_open.isNull(), i)), lambda i: i.isNotNull())
    # Exploding keeps the lists columns of their own, that each use below reads and none computes anew.
    rows = found.select(key, F.explode(F.array(F.struct("tokens", starts.alias("starts")))).alias("_l")).select(key, "_l.*")
    ends = F.concat(F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))), F.array(F.size("tokens")))
    runs = F.filter(F.zip_with("starts", ends, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda r: r["a"].isNotNull())
    joined = F.transform(runs, lambda r: F.array_join(F.slice("tokens", r["a"] + 1, r["b"] - r["a"]), " "))
    long = rows.select(key, F.posexplode_outer(joined).alias("pos", "sentence")).filter("pos IS NOT NULL")
    return long.select(key, F.col("pos").cast("long").alias("pos"), "sentence")
