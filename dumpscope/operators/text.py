"""Dictionary text, stop words and word counts over article or document tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.functions import text as tx
from dumpscope.operators.articles import containing, non_redirects
from dumpscope.operators.small import INLINE_LIMIT
from dumpscope.operators.tokens import filter_tokens


def _filtered(df, key, tokens: Column, words, name, limit, **how) -> DataFrame:
    kept = filter_tokens(df, key, tokens, words, limit=limit, **how)
    return kept.select(key, tx.join_tokens(F.col("tokens")).alias(name))


def dictionary_text(
    df: DataFrame, key: str, text: str, dictionary: DataFrame, name: str = "text", limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key`` and the text reduced to dictionary words; a word's final period stays."""
    tokens = tx.dictionary_tokens(F.coalesce(text, F.lit("")))
    return _filtered(df, key, tokens, dictionary, name, limit, form=tx.DICTIONARY_FORM)


def tokenise(
    df: DataFrame, key: str, text: str, stop_words: DataFrame, name: str = "text", limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key`` and the lower-case tokens of the text without stop words, joined by blanks."""
    tokens = tx.lower_tokens(F.coalesce(text, F.lit("")))
    return _filtered(df, key, tokens, stop_words, name, limit, keep=False)


def remove_stop_words(
    df: DataFrame,
    key: str,
    text: str,
    stop_words: DataFrame,
    split: str = "whitespace",
    name: str = "text",
    limit: int = INLINE_LIMIT,
) -> DataFrame:
    """``key`` and the text without stop words, case kept, on whitespace tokens or on words."""
    splitters = {"whitespace": tx.blank_tokens, "words": tx.words}
    tokens = splitters[split](F.coalesce(text, F.lit("")))
    return _filtered(df, key, tokens, stop_words, name, limit, keep=False)


def word_counts(df: DataFrame, text: str, stop_words: DataFrame) -> DataFrame:
    """``word``, ``n`` over all texts without stop words.

    Words are counted before stop words leave: tasks shuffle one row per distinct word, however hot, and
    the anti-join sees the vocabulary instead of the tokens.
    """
    tokens = df.select(F.explode(tx.lower_tokens(F.col(text))).alias("word"))
    counts = tokens.groupBy("word").agg(F.count("*").alias("n"))
    return counts.join(stop_words.select("word"), "word", "left_anti")


def top_words(df: DataFrame, text: str, stop_words: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most used words; ties by word."""
    return word_counts(df, text, stop_words).orderBy(F.desc("n"), "word").limit(k)


def keyword_texts(
    segments: DataFrame, key: str, keyword: str, dictionary: DataFrame, limit: int = INLINE_LIMIT
) -> DataFrame:
    """Dictionary text of the articles that are no redirects and contain the keyword."""
    chosen = containing(non_redirects(segments), keyword)
    return dictionary_text(chosen, key, "body", dictionary, limit=limit)


def keyword_count(segments: DataFrame, keyword: str) -> DataFrame:
    """One row: articles that are no redirects and contain the keyword.

    The dictionary text keeps every article, so counting needs none of it.
    """
    return containing(non_redirects(segments), keyword).agg(F.count("*").alias("n"))
