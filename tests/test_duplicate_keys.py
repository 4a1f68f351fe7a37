"""Token operators give the same rows in place and joined, for keys that repeat or are null."""

import pytest

from dumpscope.functions import text as tx
from dumpscope.operators import lexical, sentiment
from dumpscope.operators.tokens import filter_tokens
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "good a"), (1, "bad good. good"), (None, "bad x"), (None, ""), (2, None)]
    return spark.createDataFrame(rows, "id long, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_filtered(spark, df):
    words = spark.createDataFrame([("good",), ("bad",)], "word string")
    run = lambda limit: rows(filter_tokens(df, "id", tx.words(F.coalesce("text", F.lit(""))), words, limit=limit))
    assert run(10) == run(0) and len(run(0)) == 5


def test_scored(spark, df):
    lexicon = spark.createDataFrame([("good", 2), ("bad", -1)], "term string, score int")
    run = lambda limit: rows(sentiment.sentence_scores(df, "id", "text", lexicon, lower=True, limit=limit))
    assert run(10) == run(0) and len(run(0)) == 5
    assert sum(s["pos"] for _, scores in run(0) for s in scores or []) == 6


def test_tagged(spark, df):
    entities = spark.createDataFrame([("good", "G"), ("bad good.", "B")], "phrase string, tag string")
    run = lambda limit: rows(lexical.entity_tags(df, "id", "text", entities, limit=limit))
    assert run(10) == run(0) and len(run(0)) == 5


def test_lemmas_keep_rows(spark, df):
    tags = spark.createDataFrame([("good", "JJ")], "word string, tag string")
    lemmas = spark.createDataFrame([("bad", "n", "worse")], "word string, pos string, lemma string")
    assert len(rows(lexical.lemmatise(df, "id", "text", tags, lemmas))) == 5
    assert len(rows(lexical.keep_tagged(df, "id", "text", tags))) == 5
