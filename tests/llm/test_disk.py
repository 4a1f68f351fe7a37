"""What the operators leave on disk or move between tasks."""

import time

from pyspark.sql import functions as F

from dumpscope.llm import classifier, collocations, common


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = []
    while files.hasNext():
        names.append(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    """pipeline, op9, op12, op13: the shuffles of a written table go when it is written, and the rows stay."""
    before = shuffle_files(spark)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    grouped = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    tables = [common.written(grouped, "grouped"), common.bucketed(grouped, "grouped", "k")]
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == setting
    assert all(sorted(map(tuple, t.collect())) == [(k, 100) for k in range(10)] for t in tables)


def test_learning_moves_no_text(spark, monkeypatch):
    """pipeline: the classifier's source texts are read where they lie; only statistics meet the labels."""
    plans = []
    monkeypatch.setattr(classifier, "written", lambda df, name: plans.append(plan(df)) or common.written(df, name))
    docs = spark.createDataFrame([(k, "some words " * (k % 7)) for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 40, 3)], "doc_id long, quality int")
    classifier.keep_good(docs, labels, docs).collect()
    assert len(plans) == 1 and "Join" not in plans[0] and "Exchange" not in plans[0]


def test_few_frequent_phrases_move_no_occurrence(spark, monkeypatch):
    """op12: occurrences stay where they are for few frequent phrases; shuffled, the rows are the same."""
    rows = [(("en", "de", None)[k % 3], k, 0, 0, f"w{k % 11}") for k in range(60)]
    occ = spark.createDataFrame(rows, "lang string, rid long, piece int, pos int, phrase string").na.fill("und", ["lang"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        _, few = collocations.frequent(occ, 2)
        assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" not in plan(few)
        monkeypatch.setattr(collocations, "FEW", 0)
        _, many = collocations.frequent(occ, 2)
        assert "SortMergeJoin" in plan(many) and sorted(many.collect()) == sorted(few.collect()) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_relations_join_in_their_buckets(spark, monkeypatch):
    """op12: texts move once by row; the join of phrases with the next word moves neither side."""
    plans = []
    monkeypatch.setattr(collocations, "bucketed", lambda df, name, *keys: plans.append(plan(df)) or common.bucketed(df, name, *keys))
    docs = spark.createDataFrame([(k, "a b a b. c", "en") for k in range(8)], "doc_id long, text string, lang string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found, _ = collocations.phrases(docs, 2, 3)
        assert {(r.phrase, r.f) for r in found.collect()} == {("a", 16), ("b", 16), ("c", 8), ("a b", 16), ("b a", 8), ("a b a", 8), ("b a b", 8)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    first, *others = plans
    assert first.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" in others[-1] and not any("Exchange hashpartitioning" in p for p in others)


def test_few_links_need_no_rounds(spark, monkeypatch):
    """pipeline, op1: links that fit one task are contracted there; beyond, rounds of joins give the same components."""
    from dumpscope.llm import components

    pairs = [(k, k + 3) for k in range(0, 60)] + [(100, 7), (200, 201), (201, 200), (5, 5), (-4, 8), (300, 299)]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    rounds, once = [], components._round
    monkeypatch.setattr(components, "_round", lambda df: rounds.append(1) or once(df))
    few = sorted(map(tuple, components.components(links).collect()))
    assert not rounds
    monkeypatch.setattr(components, "BLOCK", 4)
    assert sorted(map(tuple, components.components(links).collect())) == few and rounds
    assert (8, -4) in few and (201, 200) in few and (100, 1) in few and (300, 299) in few and (5, -4) in few
    assert components.components(links.limit(0)).collect() == []


def test_small_tasks_collect_no_garbage(monkeypatch):
    """pipeline, op1: a worker that has not grown gives nothing back."""
    calls = []
    monkeypatch.setattr(common, "_held", 0)
    monkeypatch.setattr(common.gc, "collect", lambda: calls.append(1))
    for _ in range(5):
        common.release()
    assert len(calls) == 1


def test_model_is_met_in_slices(spark, monkeypatch):
    """op9: every place lies in one slice, each slice is written by itself, and the number of slices changes no score."""
    from dumpscope.llm import lm

    words = "the cat sat on a mat and the dog sat on the cat".split()
    rows = [(k, " ".join(words[(k * j) % len(words)] for j in range(k % 23))) for k in range(60)] + [(None, "the cat"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = []
    monkeypatch.setattr(lm, "written", lambda df, name: names.append(name) or common.written(df, name))

    def scores(slices):
        monkeypatch.setattr(lm, "SLICES", slices)
        return sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.score, 9), round(r.base_score, 9)) for r in lm.scored(docs).collect())

    assert scores(1) == scores(3)
    assert names.count("place_scores") == 4
    flat = lm.as_long(lm.WordHash().of([b"%d" % (k % 37) for k in range(200)])).view("uint64")
    lengths = lm.np.array([150, 50])
    own = [lm._places(flat, lengths, k, 5)[0] for k in range(5)]
    assert sorted(lm.np.concatenate(own).tolist()) == list(range(200)) and all(len(x) < 200 for x in own)


def test_places_move_once(spark, monkeypatch):
    """op9: the places of a slice move in one exchange and their sums in another; no row of a place or triple is joined."""
    from dumpscope.llm import lm

    plans = {}
    monkeypatch.setattr(lm, "written", lambda df, name: plans.setdefault(name, []).append(plan(df)) or common.written(df, name))
    docs = spark.createDataFrame([(k, "a b a b c " * (k % 4)) for k in range(40)], "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = lm.scored(docs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted((r.doc_id, r.n_tokens) for r in out) == [(k, 5 * (k % 4) + 1) for k in range(40)]
    assert len(plans["place_scores"]) == lm.SLICES
    for p in plans["place_scores"]:
        assert p.count("Exchange ") == 2 and p.count("Join") == 1 and "Aggregate" not in p and "Window" not in p, p


def test_frequent_words_are_dealt_to_several_buckets(spark, monkeypatch):
    """op9: small pieces, and words before with their places in many buckets, give the scores of large ones."""
    import random

    from dumpscope.llm import lm

    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(150)]
    rows += [(k, "of the w1 of the w2") for k in range(200, 260)] + [(None, "of the w1"), (3, "the of w1"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, frequent_words = [], lm.frequent_words
    monkeypatch.setattr(lm, "frequent_words", lambda *a: found.append(frequent_words(*a)) or found[-1])

    def scores():
        return sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.score, 9), round(r.base_score, 9)) for r in lm.scored(docs).collect())

    whole = scores()
    for name, value in (("PIECE", 100), ("PART", 40), ("BUCKET", 50)):
        monkeypatch.setattr(lm, name, value)
    assert scores() == whole and len(whole) == 213 and any(r[1] for r in whole)
    assert not len(found[0].hashes) and len(found[1].hashes) > 3 and found[1].parts.max() > 3 and lm.BEGIN in found[1].hashes
    assert lm.bucket_count(spark, 10_000) == 50 > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_windows_are_judged_in_slices(spark, monkeypatch):
    """op13: anchors, runs and windows of a slice are written before the next; fast anchors are the least strings of each window."""
    import numpy as np

    from dumpscope.llm import suffix_dedup as sd

    data = bytes(np.random.default_rng(1).integers(97, 100, 400, np.uint8))
    g = sd.digits(data, sd.ANCHOR, sd._SEEDS[1])
    spans = np.lib.stride_tricks.sliding_window_view(g, sd.WIDTH - sd.ANCHOR + 1)
    assert (sd.anchors(data) == spans.min(axis=1).view(np.int64)).all()
    least, at = sd.minimizers(data)
    assert (least == sd.anchors(data)).all() and (at == np.arange(len(spans)) + spans.argmin(axis=1)).all()
    names = []
    monkeypatch.setattr(sd, "written", lambda df, name: names.append(name) or common.written(df, name))
    one = data.decode()
    rows = [(1, one), (2, "x" * 70 + one[40:200]), (3, one[100:149]), (4, one[60:110] + "?" + one[:300]), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r.doc_id: (r.n_removed, r.n_spans) for r in sd.dedup(docs).collect()}
    assert removed == {1: (0, 0), 2: (160, 1), 3: (0, 0), 4: (350, 2), None: (0, 0)}
    for name in ("suffix_shared", "suffix_judged", "suffix_single"):
        assert names.count(name) == sd.SLICES


def test_windows_of_lone_sides_are_not_made(spark, monkeypatch):
    """op13: windows come only from anchor strings whose surroundings several open documents have; the copies are told once."""
    import numpy as np

    from dumpscope.llm import suffix_dedup as sd

    made, tables = {}, []
    monkeypatch.setattr(sd, "written", lambda df, name: made.setdefault(name, []).append(out := common.written(df, name)) or out)
    monkeypatch.setattr(sd, "bucketed", lambda df, name, *keys: tables.append(name) or common.bucketed(df, name, *keys))
    rng = np.random.default_rng(3)
    letters = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    # Whole passages under text of their own, and strings of 30 bytes, too short to repeat a window.
    passage, short = letters(3000), [letters(30) for _ in range(40)]
    rows = [(k, letters(60) + passage + letters(60) + "".join(letters(40) + x for x in short)) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    removed = {r.doc_id: (r.n_removed, r.n_spans) for r in sd.dedup(docs).collect()}
    assert removed == {0: (0, 0), **{k: (3000, 1) for k in range(1, 4)}}
    (windows,) = made["suffix_windows"]
    assert 0 < windows.count() < 400  # one a byte of the passage and of each short string before: over 3000
    assert tables == ["suffix_texts", "suffix_copies"]


def test_sides_hold_every_window_once(monkeypatch):
    """op13: each window of a run lies in one side, and equal windows have equal sides."""
    import numpy as np

    from dumpscope.llm import suffix_dedup as sd

    one = bytes(np.random.default_rng(4).integers(97, 100, 300, np.uint8))
    seen = {}
    for data in (one, b"x" * 17 + one[40:200] + b"y", one[100:150]):
        _, at = sd.minimizers(data)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        _, keys, starts, ends = sd.sides(data, first, np.append(first[1:], len(at)) - 1, at[first])
        windows = [(data[w : w + sd.WIDTH], int(k)) for k, a, b in zip(keys, starts, ends, strict=True) for w in range(a, b + 1)]
        assert sorted(w for w, _ in windows) == sorted(data[w : w + sd.WIDTH] for w in range(len(at)))
        assert all(seen.setdefault(w, k) == k for w, k in windows)
    assert (sd.digits(one, 37, at=np.array([3, 50])) == sd.digits(one, 37)[[3, 50]]).all()


def test_relations_hold_numbers(spark, monkeypatch):
    """op12: no relation of occurrences that is written has text in it; pieces and languages keep phrases apart."""
    kinds = []
    monkeypatch.setattr(collocations, "bucketed", lambda df, name, *keys: kinds.append(dict(df.dtypes)) or common.bucketed(df, name, *keys))
    rows = [(k, "New york new york, of new. York\tof", ("en", None)[k % 2]) for k in range(6)] + [(None, None, "en"), (9, " ,. ", "de")]
    found, totals = collocations.phrases(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 3)
    expected = {("new", 9, 1), ("york", 9, 1), ("of", 6, 1), ("new york", 6, 2), ("york new", 3, 2), ("of new", 3, 2), ("york of", 3, 2)}
    expected |= {("new york new", 3, 3), ("york new york", 3, 3), ("new york new york", 3, 4)}
    assert {(r.lang, r.phrase, r.f, r.k) for r in found.collect()} == {(x, *e) for x in ("en", "und") for e in expected}
    assert {(r.lang, r.n) for r in totals.collect()} == {("en", 24), ("und", 24)}
    assert len(kinds) == 4 and all(set(k.values()) == {"bigint"} for k in kinds)
