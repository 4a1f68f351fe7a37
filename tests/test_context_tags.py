"""Tags in context against every tag path of each sentence, scored by the same counted model."""

import itertools
import math
import random

from dumpscope.operators import context_tags as ct

TAGGED = "sentence string, pos int, word string, tag string"


def model(rows):
    """Transitions and emissions from (sentence, pos, word, tag) rows, by the module's formulas."""
    by_sentence = {}
    for s, p, w, t in rows:
        by_sentence.setdefault(s, []).append((p, w, t))
    pairs, words, tags = {}, {}, {}
    for items in by_sentence.values():
        prev = ct.START
        for _, w, t in sorted(items):
            pairs[(prev, t)] = pairs.get((prev, t), 0) + 1
            words[(w, t)] = words.get((w, t), 0) + 1
            tags[t] = tags.get(t, 0) + 1
            prev = t
    n_tags = len(set(tags) | {ct.UNKNOWN})
    total = {}
    for (p, _), c in pairs.items():
        total[p] = total.get(p, 0) + c
    vocabulary = len({w for w, _ in words})

    def move(p, t):
        c = pairs.get((p, t))
        return math.log((c + 1) / (total[p] + n_tags)) if c else math.log(1 / (total.get(p, 0) + n_tags))

    def emit(w, t):
        return math.log((words.get((w, t), 0) + 1) / (tags.get(t, 0) + vocabulary))

    return move, emit


def brute(tokens, lexicon, move, emit):
    options = [sorted(lexicon.get(w, [])) or [ct.UNKNOWN] for w in tokens]
    best = None
    for path in itertools.product(*options):
        score, prev = 0.0, ct.START
        for w, t in zip(tokens, path):
            score = score + move(prev, t) + (0.0 if t == ct.UNKNOWN and w not in lexicon else emit(w, t))
            prev = t
        if best is None or score > best[0] + 1e-12:
            best = (score, list(path))
    return best[1] if best else []


def test_tags_in_context_equal_every_path(spark):
    rng = random.Random(11)
    lexicon = {"the": ["DT"], "a": ["DT"], "runs": ["NNS", "VBZ"], "dog": ["NN"], "walks": ["NNS", "VBZ"], "fast": ["JJ", "RB"]}
    rows = []
    for k in range(40):
        words = ["the", "dog", "runs", "fast"] if k % 2 else ["the", "runs", "a", "walks", "dog"]
        tags = ["DT", "NN", "VBZ", "RB"] if k % 2 else ["DT", "NNS", "DT", "NNS", "NN"]
        if k % 7 == 0:
            tags = [rng.choice(lexicon[w]) for w in words]
        rows += [(f"s{k}", i, w, t) for i, (w, t) in enumerate(zip(words, tags))]
    tagged = spark.createDataFrame(rows, TAGGED)
    words = spark.createDataFrame([(w, t) for w, ts in lexicon.items() for t in ts], "word string, tag string")
    texts = [
        "the dog runs fast. the runs a walks dog!",
        "runs walks fast unknown the runs",
        "",
        None,
        "a   dog\twalks. walks",
    ]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(1, texts[1], "again")], "doc_id long, text string, extra string")
    got = {}
    for r in ct.tag_in_context(docs, "doc_id", "text", words, tagged).collect():
        got.setdefault(r["doc_id"], []).append([(w["token"], w["tag"]) for w in r["words"]])
    move, emit = model(rows)
    from dumpscope.functions import text as tx
    from pyspark.sql import functions as F

    sentences = [r["s"] for r in docs.select(tx.sentences(F.col("text")).alias("s")).orderBy("doc_id").collect()]
    for k, text in enumerate(texts):
        expected = []
        for sentence in (spark.createDataFrame([(text,)], "t string").select(tx.sentences(F.col("t")).alias("s")).first()["s"]):
            tokens = sentence.split()
            expected += list(zip(tokens, brute(tokens, lexicon, move, emit)))
        assert all(g == expected for g in got[k]), (k, got[k], expected)
    assert len(got[1]) == 2 and len(sentences) == 6
    # The same ambiguous word takes the tag that its context favours.
    first = dict(enumerate(got[0][0]))
    assert first[2] == ("runs", "VBZ") and first[5] == ("runs", "NNS")


def test_too_many_tags_are_refused(spark):
    rows = [("s", i, f"w{i}", f"T{i}") for i in range(ct.MAX_TAGS + 1)]
    try:
        ct.transitions(spark.createDataFrame(rows, TAGGED))
    except ValueError:
        return
    raise AssertionError("a tag set beyond MAX_TAGS was accepted")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tagged = spark.createDataFrame([], TAGGED)
    words = spark.createDataFrame([], "word string, tag string")
    assert ct.tag_in_context(docs, "doc_id", "text", words, tagged).collect() == []
    one = spark.createDataFrame([(1, "x y.")], "doc_id long, text string")
    (row,) = ct.tag_in_context(one, "doc_id", "text", words, tagged).collect()
    assert [(w["token"], w["tag"]) for w in row["words"]] == [("x", ct.UNKNOWN), ("y.", ct.UNKNOWN)]
