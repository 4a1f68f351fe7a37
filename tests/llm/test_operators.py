"""Every operator against a brute-force version, on odd rows: null, empty, long and repeated texts, ties, clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from dumpscope.llm import (
    classifier, decontaminate, html_text, idfile, jaccard, licences, lm, packing, quality_rules, tokens, warc,
)

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, n long, words string, seed int, row string, h string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "Ähre", "stone", "blue,", "river.", "it's", "x9", "一二"]) + rng.choice(["", "a", "en"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 40, 120, 300, 300, 60)]
    near = base[2].split()
    near[7] = "changed"
    out = [None, "", " \n\t ", "one", "A b C d", *base, base[2], base[2], " ".join(near), prose(rng, 9000)]
    out += ["under the MIT License; apache license\nversion 2 Apache License, Version 2.0", "!!! ### $$$ | | " * 40]
    return out + ["Same line.\nSame line.\n" * 30, "<|endoftext|> x<|EndOfText|>", "  lead  and trail  "]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, k, "w", 1, "r", "h") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_encoder_equals_the_tokenizer(texts):
    own = tokens.Encoder()
    odd = ["né'll 'S x's", "…a.b «é»", "ﬁ Å", "×÷ é×é", "a\xa0b\x1cc", "İI ΑΣ", "日本。x", "12 1a2b", "a<|startoftext|>b"]
    given = [(t or "").encode() for t in [*texts, *odd]]
    expected = [np.asarray(own.tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes() for t in given]
    assert own.encode(given) == expected
    assert own.encode(given) == expected
    assert tokens.Encoder(cache_words=2).encode(given) == expected


def ids_of(texts):
    tokenizer = tokens.Encoder().tokenizer
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]


def test_id_file_round_trip(docs, texts, none):
    start, expected = 0, []
    for k, ids in enumerate(ids_of(texts)):
        expected.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in idfile.round_trip(docs).collect()) == expected
    assert idfile.round_trip(none).collect() == []


def test_variable_length_values():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1001):
        values = rng.integers(0, 1 << rng.integers(1, 33, n), n).astype(np.uint32) if n else np.zeros(0, np.uint32)
        assert (idfile.decode_values(*idfile.encode_values(values), n) == values).all()


def test_first_fit_decreasing():
    rng = random.Random(2)
    for _ in range(20):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(1, 200))]
        bins, offsets = packing.first_fit(np.array(sizes), 64)
        room, expected = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            if k == len(room):
                room.append(64)
            expected[i] = (k, 64 - room[k])
            room[k] -= sizes[i]
        assert [(int(b), int(o)) for b, o in zip(bins, offsets, strict=True)] == [expected[i] for i in range(len(sizes))]


def test_packing(docs, texts, none):
    ids = ids_of(texts)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack_documents(docs, per_group=16).collect():
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans, whole in [(pieces[k], len(x)) for k, x in enumerate(ids)] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == whole if whole else at <= packing.CAPACITY
    assert packing.pack_documents(none).collect() == []


def rule_counts(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, texts, none):
    rows = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for k, text in enumerate(texts):
        own = rule_counts(text)
        assert tuple(rows[k][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == own
        assert rows[k]["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (rows[k]["base_failed"] and rows[k]["kept"])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, r in rows.items() if r["kept"])
    assert quality_rules.judge(none).collect() == quality_rules.keep_good(none).collect() == []


def test_rule_weights_recover_known_accuracies():
    rng = random.Random(3)
    patterns, share = collections.Counter(), 0.2
    for _ in range(20000):
        junk = rng.random() < share
        votes = [(-1 if rng.random() < 0.6 else 1) if junk else (-1 if rng.random() < 0.002 else 1) for _ in range(5)]
        patterns[tuple(v if rng.random() < 0.8 else 0 for v in votes)] += 1
    found, tables = quality_rules.estimate(patterns)
    assert abs(found - share) < 0.02
    assert all(abs(t[-1][1] - 0.6) < 0.04 and t[-1][0] < 0.01 for t in tables)


def test_classifier_separates(spark, none):
    rng = random.Random(4)
    rows, labels = [(0, None), (1, ""), (2, "")], []
    for k in range(3, 400):
        good = k % 4 > 0
        rows.append((k, " ".join(w if good else w.upper() + "###" for w in prose(rng, rng.randint(30, 200)).split())))
        labels.append((k, int(good)))
    labels += [labels[0], (None, 1), (9999, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    out = {r["doc_id"]: r for r in classifier.classify(docs, known).collect()}
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out.values())
    held = [(out[k]["predicted"], good) for k, good in labels if k in out and out[k]["held_out"]]
    assert held and all(p == good for p, good in held)
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in out.items())
    kept = {r["doc_id"] for r in classifier.keep_good(docs, known).collect()}
    assert kept == {k for k, r in out.items() if r["predicted"]}
    assert classifier.classify(none, known).collect() == []
    same = classifier.classify(docs, known.filter("quality = 1")).select("score").distinct().collect()
    assert len(same) == 1 and same[0]["score"] > 0.9


def components(texts, width, percent):
    sets = []
    for text in texts:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return [(k, len(s), root[k]) for k, s in enumerate(sets)]


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_similarity_classes(docs, texts, none, width, percent):
    expected = components(texts, width, percent)
    assert sorted(tuple(r) for r in jaccard.classes(docs, width, percent).collect()) == expected
    kept = jaccard.keep_one(docs, width, percent)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, _, c in expected if k == c]
    assert jaccard.classes(none, width, percent).collect() == []


def test_dense_columns(spark, monkeypatch):
    """Large groups of near copies and of texts that share a passage, with tiny bounds so that every path is taken."""
    for name, value in (("DENSE", 3), ("BLOCK", 4), ("SLICE", 8), ("MANY", 5), ("FREQUENT", 3), ("BROADCAST_IDS", 0)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(6)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    origin, passage = [word() for _ in range(60)], [word() for _ in range(40)]
    texts = []
    for _ in range(30):
        copy = list(origin)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = word()
        texts.append(" ".join(copy))
        texts.append(" ".join(passage + [word() for _ in range(rng.randint(0, 12))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in jaccard.classes(df, 4, 85).collect()) == components(texts, 4, 85)


def test_decontamination(spark, docs, none):
    rng = random.Random(8)
    words = [f"v{k}" for k in range(4000)]
    items = [" ".join(rng.sample(words, n)) for n in (15, 38, 59, 12, 7)] + [None, "", "a b"]
    swapped = items[1].split()
    for k in (5, 16, 27):
        swapped[k] = "other"
    half = items[2].split()[:10]
    fill = lambda n: rng.choices(["red", "tree", "so", "go", "up"], k=n)
    given = {
        1: [*fill(50), *items[0].upper().split(), *fill(9)], 2: [*swapped, *fill(20)], 3: [*fill(5), *half, *fill(5)],
        4: fill(500), 5: [*items[3].split(), *fill(3), *items[4].split()], 6: [*fill(9000), *items[2].split(), *items[0].split()],
    }
    rows = [(k, ", ".join(t)) for k, t in given.items()] + [(7, None), (8, ""), (None, items[0]), (1, "again")]
    benchmark = spark.createDataFrame([*enumerate(items), (None, items[0])], "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontaminate.overlaps(df, benchmark).collect()}
    assert found == {
        (1, 0): (15, 50, 65), (2, 1): (35, 0, 38), (5, 3): (12, 0, 12), (6, 2): (59, 9000, 9059), (6, 0): (15, 9059, 9074),
    } | ({(5, 4): (7, 15, 22)} if len(items[4].split()) > min(m[-1] for m in decontaminate.MASKS) else {})
    clean = decontaminate.keep_clean(df, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {3, 4, 7, 8, None}
    assert decontaminate.overlaps(none, benchmark).collect() == decontaminate.overlaps(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).columns == docs.columns


def best_stretch(equal):
    best, here = (0, 0), (0, 0)
    for e in equal:
        gain, n = here if here[0] > 0 else (0, 0)
        here = (gain + 1, n + 1) if e else (gain - decontaminate.PENALTY, n)
        best = here if here[0] > best[0] else best
    return best[1]


def test_masks_hit_every_accepted_pattern():
    for n in range(12, 19):
        for bits in range(1 << n):
            equal = [bits >> k & 1 for k in range(n)]
            if sum(equal) >= decontaminate.LEAST and best_stretch(equal) >= decontaminate.LEAST:
                hit = any(all(equal[i + k] for k in m) for m in decontaminate.MASKS for i in range(n - m[-1]))
                assert hit, (n, equal)


def test_sparse_copies_and_short_items_leak(spark):
    words = [f"v{k}" for k in range(100)]
    items = [words[:38], words[40:55], words[60:64], words[70:72], words[80:81]]
    changed = lambda item, at: ["x" if at(k) else w for k, w in enumerate(item)]
    texts = [
        changed(items[0], lambda k: k % 4 == 3), changed(items[1], lambda k: k in (3, 7, 11)), ["y", *items[2], "z"],
        [*items[3], "y"], ["y", *items[4]], [words[70], "y", words[71], *words[60:63]],
    ]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["equal_words"] for r in decontaminate.overlaps(df, benchmark).collect()}
    assert found == {(0, 0): 27, (1, 1): 12, (2, 2): 4, (3, 3): 2, (4, 4): 1}


def test_licences(docs, texts, none):
    rows = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for k, text in enumerate(texts):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
        at = [(i, n) for n, p in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts, names = [i for i, _ in at], sorted({n for _, n in at})
        expected = (len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(names))
        assert tuple(rows[k][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == expected
        assert set(names) <= set(rows[k]["labels"].split(",")) | {""} and 0 <= rows[k]["score"] <= 1
    assert licences.scan(none).collect() == []


def test_template_markup():
    def accepted(template, text):
        words = text.encode().split()
        return {(i, j) for _, i, j in licences.Automaton([template]).matches(words)}

    nested = "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> e"
    assert [accepted(nested, t) for t in ("a e", "a b d e", "a b c d e", "a b e", "a c d e")] == [{(0, 2)}, {(0, 4)}, {(0, 5)}, set(), set()]
    gap = "x <<var;max=2>> y"
    assert [bool(accepted(gap, t)) for t in ("x y", "x 1 y", "x 1 2 y", "x 1 2 3 y", "x y y")] == [True, True, True, False, True]
    assert accepted(gap, "x y y") == {(0, 3)}
    with pytest.raises(ValueError, match="not closed"):
        licences.Automaton(["a <<beginOptional>> b"])


def test_html_text(spark, none):
    menu, foot = "<nav><a href=/a>Home</a></nav>", "<footer>Foot</footer>"
    page = lambda body: f"<html><head><title>T</title><style>p{{}}</style></head><body>{menu}{body}{foot}"
    long = "word " * 60
    cases = {
        1: (page(f"<div class='ad x'>Buy</div><article class='post-17'><h1>A &amp; B</h1><p>{long}<br>end<p>x &lt; y</article>"),
            f"A & B\n{long}end\nx < y"),
        2: (page("<article class='post-2'><p>short</p><script>var t='</p>';</script><section id=comments><p>" + long + "</p></section></article>"), "short"),
        3: (page(f"<div id=content><p>{long}</p></div><div class=sidebar>{long}</div><form>{long}</form>"), long.strip()),
        4: (None, ""), 5: ("", ""), 6: ("plain <b>text</b>\n only", "plain text only"), 7: (page("<article></article>"), ""),
        8: ("<p title=\"a > b\">quoted</p><!-- <p>no</p> --><p>two", "quoted\ntwo"),
    }
    rows = [(k, f"http://h{k // 3}.example/x", html, "t") for k, (html, _) in cases.items()]
    pages = spark.createDataFrame([*rows, rows[0], (9, None, "<p>x</p>", "t")], "page_id long, url string, html string, text string")
    out = [(r["page_id"], r["text"], r["n_chars"]) for r in html_text.main_text(pages).collect()]
    assert sorted(set(out)) == [*((k, t, len(t)) for k, (_, t) in cases.items()), (9, "x", 1)] and len(out) == 10
    assert html_text.main_text(none.selectExpr("doc_id AS page_id", "text AS url", "text AS html")).collect() == []


def test_warc_round_trip(spark, none):
    big, odd = "x" * 1500, "WARC/1.0\r\n\r\nContent-Length: 3\r\n\r\né" * 50
    rows = [(1, "u", big), (2, "u\r\nX: y", big), (3, None, big), (4, "u", odd), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""), (3, None, big)]
    pages = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, n int, digest string")
    expected = []
    for k, _, html in rows:
        payload = (html or "").encode()
        later = max([j for j, _, other in rows if other == html])
        revisit = len(payload) >= 1000 and k < later
        expected.append((k, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", later if revisit else None))
    out = warc.round_trip(pages).drop("url").collect()
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert warc.round_trip(none.selectExpr("doc_id AS page_id", "text AS url", "text AS html")).collect() == []


def test_lm_scores(docs, texts, none):
    rows = {r["doc_id"]: r for r in lm.scored(docs).collect()}
    tokens_of = {k: [*WORD.findall(lower(t)), "\n"] for k, t in enumerate(texts)}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in tokens_of}
    count = collections.Counter(t for k, ts in tokens_of.items() if not held[k] for t in ts)
    n, v = sum(count.values()), len(count)
    for k, ts in tokens_of.items():
        base = sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        r = rows[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(ts), sum(count[t] > 0 for t in ts), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
    assert lm.scored(none).collect() == []


def test_automaton_is_a_distribution_and_equals_plain_backoff():
    rng = np.random.default_rng(7)
    texts = [rng.integers(1, 6, rng.integers(1, 9)) for _ in range(40)]  # word ids; 5 stands for the end
    begin = 6
    count = collections.Counter(int(w) for t in texts for w in t)
    words = lm.Words(np.arange(5), np.array([count[k] for k in range(1, 6)]), np.arange(1, 6), 5, sum(count.values()), 5, len(texts))
    grams = collections.Counter()
    for t in texts:
        ids = [begin, *map(int, t)]
        grams.update((a << 21) | b for a, b in zip(ids, ids[1:], strict=False))
        grams.update((a << 42) | (b << 21) | c for a, b, c in zip(ids, ids[1:], ids[2:], strict=False))
    model = lm.automaton(words, np.array(list(grams), np.int64), np.array(list(grams.values())))
    alone = words.logp(np.append(0.0, words.counts))  # 0 stands for any unknown word
    arcs = dict(zip(model.keys.tolist(), zip(model.logp, model.onto, strict=True), strict=True))

    def plain(ids):
        state, total = begin, 0.0
        for w in map(int, ids):
            while (hit := arcs.get((state << 21) | w)) is None and state:
                total, state = total + model.backoff[state], int(model.fail[state])
            total, state = (total + hit[0], int(hit[1])) if hit else (total + alone[w], w)
        return total

    lengths = np.array([len(t) for t in texts])
    got = model.scores(np.concatenate(texts), alone[np.concatenate(texts)], lengths)
    assert got == pytest.approx([plain(t) for t in texts])
    for state in ([], [1], [2, 3], [4, 4]):
        assert sum(10 ** (plain([*state, w]) - plain(state)) for w in range(6)) == pytest.approx(1)


def test_lm_scores_use_every_ngram(spark):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(60)] + ["w1 unseen w2 w3", "w3 w4 w5 twice twice"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    ids = {w: k for k, w in enumerate([*words, "unseen", "twice", "\n"], 1)}
    begin = len(ids) + 1
    runs = [[ids[t] for t in [*text.split(), "\n"]] for text in texts]
    train = [r for r, h in zip(runs, held, strict=True) if not h]
    count = collections.Counter(w for r in train for w in r)
    known = [w for w in ids.values() if count[w]]
    shape = (np.array([count[w] for w in known]), np.array(known), len(known), sum(count.values()), len(known), len(train))
    grams = collections.Counter()
    for r in train:
        r = [begin, *r]
        grams.update((a << 21) | b for a, b in zip(r, r[1:], strict=False))
        grams.update((a << 42) | (b << 21) | c for a, b, c in zip(r, r[1:], r[2:], strict=False))
    model = lm.automaton(lm.Words(np.array(known), *shape), np.array(list(grams), np.int64), np.array(list(grams.values())))
    alone = model.words.logp(np.array([count[w] for w in range(begin)], float))
    flat = np.array([w for r in runs for w in r])
    expected = model.scores(flat, alone[flat], np.array([len(r) for r in runs]))
    got = {r["doc_id"]: r["score"] for r in lm.scored(docs).collect()}
    assert any(held) and [got[k] for k in range(len(texts))] == pytest.approx(expected.tolist(), rel=1e-6)
    pairs = np.array([[1, 2**63 + 5], [7, 2**64 - 1]], np.uint64)
    rows = spark.createDataFrame(pairs.view(np.int64).T.tolist(), "a long, b long").selectExpr("xxhash64(a, b) AS h").collect()
    assert [r["h"] for r in rows] == lm.pair(*pairs).view(np.int64).tolist()
