import random

import brute
import pytest

from dumpscope.functions import text as tx
from dumpscope.operators import lexical, text as txt
from dumpscope.operators.tokens import explode_tokens, filter_tokens, regroup_tokens
from dumpscope.sources.tables import default_stop_words

LIMITS = [100, 0]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def values(df, column="text"):
    return [r[column] for r in sorted(df.collect(), key=lambda r: r["id"])]


def words_of(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_sentences(apply):
    cases = ["One. Two! Three? Four", "Dr. Who. ", " \n", "", None, "a.b. c", "End.\n", "x...  y"]
    assert apply(tx.sentences, cases) == [
        ["One.", "Two!", "Three?", "Four"], ["Dr.", "Who."], [], [], [], ["a.b.", "c"], ["End."], ["x...", "y"],
    ]


def test_words_and_tokens(apply):
    assert apply(tx.words, ["It's 3 o'clock, Sam."]) == [["It's", "3", "o'clock", "Sam"]]
    assert apply(tx.lower_tokens, ["It's A-1 -- b"]) == [["it", "s", "a", "1", "b"]]
    assert apply(tx.blank_tokens, [" a\t b\nc ", ""]) == [["a", "b", "c"], []]


def test_dictionary_tokens(apply):
    rng = random.Random(3)
    tokens = ["".join(rng.choice("ab'.-9(é") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    expected = [[w for w in [brute.dictionary_word(t)] if w] if t.isascii() else [] for t in tokens]
    assert apply(tx.dictionary_tokens, tokens) == expected
    assert apply(tx.dictionary_tokens, ["Don't (so). foo-bar foo-b 9lives word."]) == [
        ["don't", "so", "foo", "lives", "word."]
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_dictionary_text(spark, limit):
    df = texts(spark, ["The Cat sat. Naïve cat's (end).", "", None, "none here"])
    words = words_of(spark, "the", "cat", "sat", "end", "cat", None)
    kept = txt.dictionary_text(df, "id", "text", words, limit=limit)
    assert values(kept) == ["the cat sat. end", "", "", ""]


@pytest.mark.parametrize("limit", LIMITS)
def test_stop_words(spark, limit):
    df = texts(spark, ["The cat and the dog, and I.", "", None, "and the"])
    stop = words_of(spark, "the", "and", "i")
    assert values(txt.remove_stop_words(df, "id", "text", stop, limit=limit)) == ["The cat dog, I.", "", "", ""]
    kept = txt.remove_stop_words(df, "id", "text", stop, split="words", limit=limit)
    assert values(kept) == ["The cat dog I", "", "", ""]
    assert values(txt.tokenise(df, "id", "text", stop, limit=limit)) == ["cat dog", "", "", ""]


def test_odd_words_stay_literal(spark):
    df = texts(spark, ["a'b c\\d e\"f g%h i"])
    for limit in LIMITS:
        kept = filter_tokens(df, "id", tx.blank_tokens(df["text"]), words_of(spark, "a'b", "c\\d", 'e"f', "g%h"), limit=limit)
        assert values(kept, "tokens") == [["a'b", "c\\d", 'e"f', "g%h"]]
        none = filter_tokens(df, "id", tx.blank_tokens(df["text"]), words_of(spark).limit(0), limit=limit)
        assert values(none, "tokens") == [[]]


def test_word_counts(spark):
    df = texts(spark, ["b a the a", "A c c B", None, ""])
    counts = txt.word_counts(df, "text", words_of(spark, "the"))
    assert {tuple(r) for r in counts.collect()} == {("a", 3), ("b", 2), ("c", 2)}
    assert [tuple(r) for r in txt.top_words(df, "text", default_stop_words(spark), 2).collect()] == [("b", 2), ("c", 2)]


def test_default_stop_words(spark):
    words = [r["word"] for r in default_stop_words(spark).collect()]
    assert len(words) == 181 and {"the", "and", "don't"} <= set(words)


def test_explode_and_regroup(spark):
    df = texts(spark, ["a b a", "", None])
    tokens = explode_tokens(df, "id", tx.blank_tokens(df["text"]))
    assert values(regroup_tokens(tokens, "id"), "tokens") == [["a", "b", "a"], [], []]


def test_lemmas_and_tags(spark):
    df = texts(spark, ["dogs were running the runs", "", None])
    tags = spark.createDataFrame(
        [("dogs", "NNS"), ("were", "VBD"), ("running", "VBG"), ("runs", "NNS"), ("the", "DT"), ("dog", "NN"), ("run", "VB")],
        "word string, tag string",
    )
    lemmas = spark.createDataFrame(
        [("dogs", "n", "dog"), ("were", "v", "be"), ("running", "v", "run"), ("running", "n", "running!"), ("runs", "v", "run?"),
         ("runs", "n", "run")],
        "word string, pos string, lemma string",
    )
    assert values(lexical.lemmatise(df, "id", "text", tags, lemmas)) == ["dog be run the run", "", ""]
    assert values(lexical.keep_tagged(df, "id", "text", tags)) == [" dogs were running runs ", " ", " "]
    assert values(lexical.keep_tagged(df, "id", "text", tags, ("DT",))) == [" the ", " ", " "]
    for limit in LIMITS:
        chain = lexical.normalise_text(df, "id", "text", words_of(spark, "were"), tags, lemmas, limit=limit)
        assert values(chain) == [" dog run run ", " ", " "]


@pytest.mark.parametrize("limit", LIMITS)
def test_entity_tags(spark, limit):
    rng = random.Random(5)
    lines = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    phrases = {"a b": "X", "a b c d": "Y", "b": "Z", "c c": "W", "d a b": "V", "c d a a a": "U"}
    table = spark.createDataFrame(list(phrases.items()), "phrase string, tag string")
    tagged = lexical.entity_tags(texts(spark, lines + [None]), "id", "text", table, limit=limit)
    found = [[tuple(p) for p in pairs] for pairs in values(tagged, "tags")]
    assert found == [brute.entity_tags(line.split(), phrases) for line in lines] + [[]]


@pytest.mark.parametrize("limit", [0, -1])
def test_no_entities(spark, limit):
    none = spark.createDataFrame([], "phrase string, tag string")
    tagged = lexical.entity_tags(texts(spark, ["a b"]), "id", "text", none, limit=limit)
    assert [tuple(p) for p in values(tagged, "tags")[0]] == [("a", "O"), ("b", "O")]
