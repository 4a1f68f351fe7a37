"""Readers of the small side tables: lexicon, words, stop words and ranked titles."""

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.functions.titles import ascii_only, normalise_title, strip
from dumpscope.operators.rank import with_position
from dumpscope.schema import ENTITIES, LEMMAS, LEXICON, WORD_TAGS


def _tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.csv(path, sep="\t", quote="", schema=schema)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Sentiment lexicon lines ``term<TAB>score``."""
    return _tsv(spark, path, LEXICON)


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """Lemma lines ``word<TAB>pos<TAB>lemma``, pos being ``v`` or ``n``."""
    return _tsv(spark, path, LEMMAS)


def read_word_tags(spark: SparkSession, path: str) -> DataFrame:
    """Part-of-speech lines ``word<TAB>tag``."""
    return _tsv(spark, path, WORD_TAGS)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Gazetteer lines ``phrase<TAB>tag``, phrase words separated by one blank."""
    return _tsv(spark, path, ENTITIES)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Word dictionary, one word per line; stripped, blanks dropped, distinct."""
    words = spark.read.text(path).select(strip("value").alias("word"))
    return words.filter("word <> ''").distinct()


def default_stop_words(spark: SparkSession) -> DataFrame:
    """Spark's own English stop-word list, as a constant so that Catalyst knows its size."""
    words = " ".join(StopWordsRemover.loadDefaultStopWords("english"))
    return spark.range(1, numPartitions=1).select(F.explode(F.split(F.lit(words), " ")).alias("word"))


def read_titles(spark: SparkSession, path: str | list[str], fold_ascii: bool = False) -> DataFrame:
    """Ranked title list as ``rank`` (0-based line number) and normalised ``title``.

    With ``fold_ascii`` the titles lose their non-ASCII characters as articles do, so that both can join.
    """
    ranked = with_position(spark.read.text(path), "rank")
    raw = ascii_only(F.col("value")) if fold_ascii else F.col("value")
    return ranked.select("rank", normalise_title(raw).alias("title"))
