"""Learned sentence ends: abbreviations from period counts, and a splitter that does not cut after them."""

import math

from dumpscope.operators import sentence_ends as se


def test_abbreviations_are_learned_and_kept(spark):
    # Words that end sentences here also stand inside them, as they do in any larger corpus.
    texts = ["Dr. Smith met Dr. Jones. Jones met Smith there. There it rained and rained."] * 30
    texts += ["The dog ran. It sat and ran away. Away it sat."] * 30 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["word"]: r for r in se.abbreviations(docs, "text").collect()}
    assert found["dr"]["abbreviation"] and found["dr"]["with_period"] == 60 and found["dr"]["without_period"] == 0
    assert not any(found[w]["abbreviation"] for w in ("jones", "there", "rained", "ran", "sat", "away"))
    # The score by the formula, by hand.
    n = sum(len((t or "").split()) for t in texts)
    p = sum(w.endswith(".") for t in texts for w in (t or "").split()) / n
    k = c = 60
    expected = -2 * (k * math.log(p) - k * math.log(0.99)) * math.exp(-2) * 1 * 2 ** -(c - k)
    assert abs(found["dr"]["score"] - expected) < 1e-9
    got = {(r["doc_id"], r["pos"]): r["sentence"] for r in se.sentences(docs, "doc_id", "text", se.abbreviations(docs, "text")).collect()}
    assert got[(0, 0)] == "Dr. Smith met Dr. Jones." and got[(0, 1)] == "Jones met Smith there." and (0, 3) not in got
    assert got[(31, 1)] == "It sat and ran away."
    assert not any(k[0] in (60, 61) for k in got)


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert se.abbreviations(docs, "text").collect() == []
    assert se.sentences(docs, "doc_id", "text", se.abbreviations(docs, "text")).collect() == []
