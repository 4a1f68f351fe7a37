"""Lexicon scoring of sentences, polarity counts and sentiment of ranked titles."""

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.functions import text as tx
from dumpscope.functions.markup import all_lines, pure_text
from dumpscope.operators.lineage import checkpointed
from dumpscope.operators.rank import average_rank
from dumpscope.operators.small import INLINE_LIMIT, broadcast_if_small, inline_values, sql_list
from dumpscope.operators.tokens import numbered

SCORES = "array<struct<pos:int,neg:int>>"


def _summed(lexicon: DataFrame) -> DataFrame:
    """The lexicon with one score per term; later lines of a term cannot be told apart, the highest counts."""
    scored = lexicon.filter("term IS NOT NULL AND score <> 0")
    return scored.groupBy("term").agg(F.max("score").cast("int").alias("score"))


def _inline_scores(df: DataFrame, key: str, text: str, entries: list, lower: bool) -> DataFrame:
    """Scores of each sentence with the lexicon as hash sets: one of all terms, one per score value."""
    terms = defaultdict(list)
    for row in entries:
        terms[row["score"]].append(row["term"])
    every = sql_list([row["term"] for row in entries]) or "NULL"
    cases = " ".join(f"WHEN word IN ({sql_list(terms[points])}) THEN {points}" for points in sorted(terms))
    score = f"CASE {cases} ELSE 0 END" if cases else "0"
    words = lambda sentence: tx.words(F.lower(sentence) if lower else sentence)
    split = df.select(key, F.transform(tx.sentences(F.col(text)), words).alias("_sentences"))
    scored = split.select(
        key,
        F.expr(
            f"transform(_sentences, words -> transform(filter(words, word -> word IN ({every})), word -> {score}))"
        ).alias("_sentences"),
    )
    total = "aggregate(points, 0, (total, p) -> total + {}(p, 0))"
    sums = f"struct({total.format('greatest')} AS pos, {total.format('least')} AS neg)"
    return scored.select(key, F.expr(f"transform(_sentences, points -> {sums})").cast(SCORES).alias("scores"))


def _joined_scores(df: DataFrame, key: str, text: str, lexicon: DataFrame, lower: bool) -> DataFrame:
    """Scores of each sentence from a join of its words with the lexicon."""
    split = numbered(df, key, tx.sentences(F.col(text)).alias("_sentences")).repartition("_id")
    sentences = split.select("_id", F.posexplode_outer("_sentences").alias("sid", "_sentence"))
    sentence = F.lower("_sentence") if lower else F.col("_sentence")
    words = sentences.select("_id", "sid", F.explode_outer(tx.words(sentence)).alias("term"))
    points = F.coalesce("score", F.lit(0))
    scored = words.join(lexicon, "term", "left").groupBy("_id", "sid")
    scored = scored.agg(
        F.sum(F.greatest(points, F.lit(0))).cast("int").alias("pos"),
        F.sum(F.least(points, F.lit(0))).cast("int").alias("neg"),
    )
    placed = F.when(F.col("sid").isNotNull(), F.struct("sid", "pos", "neg"))
    grouped = scored.groupBy("_id").agg(F.array_sort(F.collect_list(placed)).alias("_placed"))
    scores = F.transform("_placed", lambda s: F.struct(s["pos"].alias("pos"), s["neg"].alias("neg")))
    return grouped.select(F.col("_id.key").alias(key), scores.cast(SCORES).alias("scores"))


def sentence_scores(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, lower: bool = False, limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key`` and ``scores``: per sentence the sums of its words' positive and negative scores.

    Words match single-word terms exactly, or in lower case with ``lower``. A text that is null or empty has no
    sentences. A lexicon of up to ``limit`` terms is held in the expression, so every text is scored where
    it lies; a larger one is joined. Keys need not be unique.
    """
    lexicon = _summed(lexicon)
    entries = inline_values(lexicon, limit)
    if entries is None:
        return _joined_scores(df, key, text, lexicon, lower)
    return _inline_scores(df, key, text, entries, lower)


def sentences_long(scores: DataFrame, key: str) -> DataFrame:
    """One row per sentence: ``key``, ``sid``, ``pos``, ``neg``."""
    # The outer form: an inner one would filter on the list first and so score every text twice.
    rows = scores.select(key, F.posexplode_outer("scores").alias("sid", "score"))
    return rows.filter("sid IS NOT NULL").select(key, "sid", "score.pos", "score.neg")


def with_polarity(scores: DataFrame) -> DataFrame:
    """Replace ``scores`` by the numbers of positive, negative and neutral sentences."""

    def count(test) -> Column:
        return F.size(F.filter("scores", lambda s: test(s["pos"] + s["neg"]))).cast("long")

    others = [c for c in scores.columns if c != "scores"]
    return scores.select(
        *others,
        count(lambda net: net > 0).alias("pos"),
        count(lambda net: net < 0).alias("neg"),
        count(lambda net: net == 0).alias("neu"),
    )


def ranked_articles(ranked: DataFrame, articles: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rank``, ``title``, ``key``, ``pure_text`` of ranked titles and their articles.

    Null titles never match and duplicates multiply; ``how="left"`` keeps unmatched ranked titles. ``articles``
    has ``pure_text``, or the ``body`` of a segment, whose plain text is then made of the found ones only.
    A ranked list of checked size goes to the articles, also for the left join, which adds the unmatched
    titles to what was found.
    """
    column = "pure_text" if "pure_text" in articles.columns else "body"
    text = F.col(column) if column == "pure_text" else pure_text(all_lines(F.col(column)))
    found = articles.select(key, "title", column).join(broadcast_if_small(ranked), "title")
    found = found.select("rank", "title", key, text.alias("pure_text"))
    if how == "inner":
        return found
    if how != "left":
        raise ValueError(f"unknown join: {how}")
    return ranked.join(found.drop("title"), "rank", "left").select(found.columns)


def ranked_sentiment(
    ranked: DataFrame, articles: DataFrame, key: str, lexicon: DataFrame, limit: int = INLINE_LIMIT
) -> DataFrame:
    """``rank``, ``title``, ``pos``, ``neg``, ``neu`` for each ranked title found among the articles.

    The join comes first, so only the found articles are scored.
    """
    found = ranked_articles(ranked, articles, key)
    found = found.select(F.struct("rank", "title", key).alias("_row"), "pure_text")
    scores = with_polarity(sentence_scores(found, "_row", "pure_text", lexicon, limit=limit))
    return scores.select("_row.rank", "_row.title", "pos", "neg", "neu")


def rank_correlation(sentiment: DataFrame, stored: bool = False) -> DataFrame:
    """One row: number of films, Pearson and Spearman correlation of rank and net sentence polarity.

    The ranked rows are checkpointed, as ranking reads them several times and scoring must happen once. Rows that are
    ``stored`` already, as a written table, are read as they are.
    """
    net = sentiment.select("rank", (F.col("pos") - F.col("neg")).alias("net"))
    net = net if stored else checkpointed(net)
    placed = average_rank(average_rank(net, "rank", "_rank"), "net", "_net")
    return placed.agg(
        F.count("*").alias("n"), F.corr("rank", "net").alias("pearson"), F.corr("_rank", "_net").alias("spearman")
    )
