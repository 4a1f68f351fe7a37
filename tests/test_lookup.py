"""Word-table lookups: in place and joined alike, and what they move."""

import pytest
from pyspark.sql import functions as F

from dumpscope.functions import text as tx
from dumpscope.operators import lexical, lookup, sentence_ends
from dumpscope.operators import context_tags as ct

TEXTS = [
    "the dogs were running, it's a\\b dogs",
    "no hit at all",
    "",
    None,
    "  dogs ",
    "the dogs. a dog runs! runs the dogs? 0 1 2",
    "Dr. No met Dr. Who. Who met. Dr. No",
]


def documents(spark):
    # Keys repeat and are null.
    rows = [(None if k % 3 == 0 else k % 2, t) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "k long, text string")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def sorted_rows(df):
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("limit", [0, 100])
def test_values_of_every_kind(spark, limit):
    df = documents(spark)
    kind = "_word string, _value struct<a:array<struct<t:string,e:double>>,b:string,c:boolean>"
    rows = [("dogs", ([("N'N", -1.25e-7), ("V", -float(2**70))], None, True)), ("a\\b", ([], "it's", False)), ("it's", (None, "\\", None))]
    # ' 0', ' 1', .. look like the words of the rows that carry tokens.
    rows += [(f" {k}", (None, "never", None)) for k in range(20)] + [(None, (None, "null", None))]
    table = spark.createDataFrame(rows, kind)
    values = {w: v for w, v in rows if w}
    plain = lambda v: None if v is None else (None if v.a is None else [tuple(x) for x in v.a], v.b, v.c)
    found = lookup.looked_up(df, "k", tx.blank_tokens(F.col("text")), table, limit=limit).collect()
    assert len(found) == len(TEXTS)
    assert sorted(repr((r.k, r.tokens)) for r in found) == sorted(repr((None if k % 3 == 0 else k % 2, (t or "").split())) for k, t in enumerate(TEXTS))
    for r in found:
        assert [plain(v) for v in r.found] == [values.get(t) for t in r.tokens]


@pytest.mark.parametrize("limit", [0, 100])
def test_empty_table_and_null_tokens(spark, limit):
    df = documents(spark)
    none = spark.createDataFrame([], "_word string, _value string")
    for r in lookup.looked_up(df, "k", tx.blank_tokens(F.col("text")), none, limit=limit).collect():
        assert r.found == [None] * len(r.tokens)
    holes = spark.createDataFrame([(1, ["a", None, "b"]), (1, None)], "k long, t array<string>")
    table = spark.createDataFrame([("A", 7)], "_word string, _value int")
    got = lookup.looked_up(holes, "k", F.col("t"), table, form="upper(token)", limit=limit)
    assert sorted((r.tokens, r.found) for r in got.collect()) == [([], []), (["a", None, "b"], [7, None, None])]


def word_tables(spark):
    tags = spark.createDataFrame([("the", "DT"), ("dogs", "NNS"), ("running,", "VBG"), ("were", "VBD"), ("runs", "VBZ"), ("runs", "NNS"), ("dog", "NN")], "word string, tag string")
    lemmas = spark.createDataFrame([("dogs", "n", "dog"), ("were", "v", "be"), ("runs", "v", "run"), ("runs", "n", "run's")], "word string, pos string, lemma string")
    tagged = spark.createDataFrame([("s", 0, "the", "DT"), ("s", 1, "dogs", "NNS"), ("s", 2, "runs", "VBZ")], "sentence string, pos int, word string, tag string")
    return tags, lemmas, tagged


def test_lemmas_move_no_token(spark):
    """a small word table is read where the texts lie; joined, the rows are the same."""
    df, (tags, lemmas, _) = documents(spark), word_tables(spark)
    inline = lexical.lemmatise(df, "k", "text", tags, lemmas)
    assert exchanges(inline) == 0
    assert "the dog be running, it's a\\b dog" in [r.text for r in inline.collect()]
    assert sorted_rows(lexical.lemmatise(df, "k", "text", tags, lemmas, limit=0)) == sorted_rows(inline)
    kept = lexical.keep_tagged(df, "k", "text", tags)
    assert exchanges(kept) == 0 and sorted_rows(lexical.keep_tagged(df, "k", "text", tags, limit=0)) == sorted_rows(kept)


def test_lemmas_in_context_move_no_token(spark):
    """no token is shuffled for a small lexicon; joined, the rows are the same."""
    df, (tags, lemmas, tagged) = documents(spark), word_tables(spark)
    inline = ct.tag_in_context(df, "k", "text", tags, tagged, lemmas=lemmas)
    assert exchanges(inline) == 0
    joined = ct.tag_in_context(df, "k", "text", tags, tagged, lemmas=lemmas, limit=0)
    assert sorted_rows(joined) == sorted_rows(inline)
    words = [tuple(w) for r in inline.collect() for w in r.words if w.token in ("runs", "were")]
    assert ("were", None, "be", None) in words and all(w[2:] == ("run", "run's") for w in words if w[0] == "runs")


def test_long_sentence_in_context(spark):
    """a sentence costs its length; one of 60,000 words of two tags each is one row."""
    _, _, tagged = word_tables(spark)
    tags, n = word_tables(spark)[0], 60_000
    df = spark.createDataFrame([(1, "runs " * n)], "k long, text string")
    (row,) = ct.tag_in_context(df, "k", "text", tags, tagged).collect()
    assert len(row.words) == n and {w.tag for w in row.words} <= {"VBZ", "NNS"}


def test_tags_that_the_table_lacks(spark):
    """a word whose tags all lack moves ends every path, as in the fold over the SQL map; the next sentence is as before."""
    tagged = spark.createDataFrame([("s", 0, "the", "DT"), ("s", 1, "dogs", "NNS")], "sentence string, pos int, word string, tag string")
    tags = spark.createDataFrame([("the", "DT"), ("dogs", "NNS"), ("odd", "ZZ"), ("half", "ZZ"), ("half", "DT")], "word string, tag string")
    df = spark.createDataFrame([(1, "the odd dogs. the odd! half dogs")], "k long, text string")
    for limit in (0, 100):
        (row,) = ct.tag_in_context(df, "k", "text", tags, tagged, limit=limit).collect()
        assert [(w.token, w.tag) for w in row.words] == [
            ("the", None), ("odd", None), ("dogs.", None), ("the", "DT"), ("odd!", "X"), ("half", "DT"), ("dogs", "NNS"),
        ]


def test_learned_sentences_move_no_piece(spark):
    """pieces stay in their text; joined, the rows are the same."""
    df = documents(spark)
    known = spark.createDataFrame([("dr", True), ("met", False)], "word string, abbreviation boolean")
    inline = sentence_ends.sentences(df, "k", "text", known)
    assert exchanges(inline) == 0
    assert sorted_rows(sentence_ends.sentences(df, "k", "text", known, limit=0)) == sorted_rows(inline)
    got = [(r.pos, r.sentence) for r in inline.collect() if "Dr" in r.sentence]
    assert sorted(got) == [(0, "Dr. No met Dr. Who."), (2, "Dr. No")]


def test_joined_entities_group_only_hits(spark):
    """of a text's n-grams only phrases reach the grouping, next to one row that carries the tokens."""
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "x y"), (None, None)], "k long, text string")
    phrases = spark.createDataFrame([("b c", "P"), ("b", "Q")], "phrase string, _tag string")
    found = lexical._joined_hits(df, "k", tx.blank_tokens(F.col("text")), phrases, [1, 2])
    got = sorted((str(r.k), r._tokens, [(h.n, h.tag) for h in r._hits]) for r in found.collect())
    letters, none = ["a", "b", "c", "d", "e"], (0, "O")
    long = [none, (2, "P"), none, none, none]
    assert got == [("1", letters, long), ("1", letters, long), ("2", ["x", "y"], [none, none]), ("None", [], [])]
    hits = lookup.joined_hits(
        df, "k", tx.blank_tokens(F.col("text")), F.expr("transform(tokens, (t, i) -> struct(i AS pos, 1 AS n, t AS word))"),
        phrases.select(F.col("phrase").alias("_word"), F.col("_tag").alias("_value")),
    )
    assert sorted(len(r.hits) for r in hits.collect()) == [0, 0, 1, 1]
