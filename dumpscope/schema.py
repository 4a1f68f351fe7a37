"""Explicit schemas of the library's tables."""

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

ARTICLE = T.StructType(
    [
        T.StructField("article_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("lines", STRINGS),
        T.StructField("wikilinks", STRINGS),
        T.StructField("headings", STRINGS),
        T.StructField("headings_level2", STRINGS),
        T.StructField("headings_level3", STRINGS),
        T.StructField("headings_level4", STRINGS),
        T.StructField("headings_level5", STRINGS),
        T.StructField("text_in_bold", STRINGS),
        T.StructField("pure_text", T.StringType()),
    ]
)
LEXICON = T.StructType([T.StructField("term", T.StringType()), T.StructField("score", T.IntegerType())])
WORDS = T.StructType([T.StructField("word", T.StringType())])
RANKED_TITLES = T.StructType([T.StructField("rank", T.LongType()), T.StructField("title", T.StringType())])
LEMMAS = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("pos", T.StringType()), T.StructField("lemma", T.StringType())]
)
WORD_TAGS = T.StructType([T.StructField("word", T.StringType()), T.StructField("tag", T.StringType())])
ENTITIES = T.StructType([T.StructField("phrase", T.StringType()), T.StructField("tag", T.StringType())])
