"""Conversation repair, phrase collocations and suffix dedup against brute-force versions, on odd rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from dumpscope.llm import collocations, conversations, suffix_dedup

CONVERSATIONS = "conv_id long, turn long, role string, text string, extra string"


# Conversation repair


def brute_repair(rows):
    """Every edit sequence with at most n + 2 inserts, none dearer than the best so far: the least (cost, audit) whose roles spell (s?(ua)+)?."""
    kinds = conversations.faults(rows)
    best = None
    pattern = re.compile("(s?(ua)+)?")

    def walk(i, roles, cost, audit, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and pattern.fullmatch(roles):
            if best is None or (cost, audit) < best:
                best = (cost, audit)
        if inserts:
            for r in "ua":
                walk(i, roles + r, cost + 2, audit + "I", inserts - 1)
        if i < len(rows):
            role, kind = rows[i][0], kinds[i]
            walk(i + 1, roles, cost + 3, audit + "D", inserts)
            if kind not in ("blank", "duplicate"):
                extra = 1 if kind == "truncated" else 0
                for r in "sua":
                    if role[:1] == r:
                        walk(i + 1, roles + r, cost + extra, audit + "K", inserts)
                    elif r != "s":
                        walk(i + 1, roles + r, cost + 2 + extra, audit + "R", inserts)

    walk(0, "", 0, "", len(rows) + 2)
    return best


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", " ", ""]
    texts = ["Hello.", "Hello", "  ", "", "Sure! ok?", "cut mid", "Hello.", "x\n"]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_branch_and_bound_equals_enumeration():
    rng = random.Random(3)
    for n in [0, 1, 2, 3, 4, 5] * 8:
        rows = random_rows(rng, n)
        cost, audit, repaired = conversations.repair(rows)
        assert (cost, audit) == brute_repair(rows), rows
        initials = "".join(r[:1] for r, _ in repaired)
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_repair_of_long_conversations_is_valid_and_bounded():
    rng = random.Random(4)
    rows = random_rows(rng, 400)
    cost, audit, repaired = conversations.repair(rows)
    assert len(audit) >= 400 and cost <= 3 * 400
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in repaired))
    good = [("system", "Be brief.")] + [(r, f"Turn {k}.") for k in range(300) for r in ("user", "assistant")]
    assert conversations.repair(good)[:2] == (0, "K" * len(good))


def expected_conversation(conv_id, rows):
    """Damage and summary in plain Python, by the contract."""
    damaged = []
    for turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        damaged += [(turn, role, text)] * (2 if kind == 3 else 1)
    damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return conversations.summary(conv_id, [t for t, _, _ in damaged], [(r, x) for _, r, x in damaged])


def test_conversations_against_plain_python(spark):
    rng = random.Random(6)
    rows = []
    for conv in [None, *range(40)]:
        for turn in [None, *range(rng.randint(0, 7))]:
            role, text = rng.choice(["user", "assistant", "system", None]), rng.choice(["Hi.", "Hi", None, "", "Ok!", "x" * 5000])
            rows.append((conv, turn, role, text, "clash"))
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    got = {r["conv_id"]: r.asDict() for r in conversations.repaired(df).collect()}
    groups = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        groups[conv].append((turn, role, text))
    assert set(got) == set(groups)
    for conv, members in groups.items():
        assert got[conv] == expected_conversation(conv, members)


def test_conversation_without_rows_after_damage(spark):
    # Find a conversation whose only turn is dropped.
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.", "x")], CONVERSATIONS)
    (row,) = conversations.repaired(df).collect()
    assert (row["cost"], row["audit"], row["blank"], row["gaps"]) == (0, "", 0, 0)
    assert row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert conversations.repaired(spark.createDataFrame([], CONVERSATIONS)).collect() == []


# Phrase collocations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_collocations(rows, least, top):
    count, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, c in count.items():
        cands = {p: a for p, a in c.items() if len(p) >= 2 and a >= least}
        rows_ = []
        for p, a in cands.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            n = total[lang]
            score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((lang, " ".join(p), a, c[p[:k]], c[p[k:]], n, score, k))
        rows_.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, rank + 1, *r[1:]) for rank, r in enumerate(rows_[:top])]
    return sorted(out)


def test_collocations_against_brute_force(spark):
    rng = random.Random(8)
    vocab = ["the", "of", "New", "york", "ÄRa", "x\xa0y", "a", "b", "c"]
    rows = []
    for k in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        text = " ".join(w + rng.choice(["", "", "", ",", ".", "\t", "\n"]) for w in words)
        rows.append((k % 50, text, rng.choice(["en", "de", None]), "s", 0))
    rows += [(None, None, "en", "s", 0), (99, "", None, "s", 0), (7, "new york new york. " * 300, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=4, top=7).collect())
    assert got == brute_collocations([(r[0], r[1], r[2]) for r in rows], 4, 7)
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []


def test_scores_beyond_64_bits(spark):
    # 1000 * a * n exceeds 2**63 only for huge corpora; the arithmetic is exact decimals all the same.
    assert collocations.EXACT == "decimal(38,0)"
    a, n, l, r = 10**9, 10**13, 2 * 10**9, 3 * 10**9
    (row,) = spark.sql(f"SELECT (cast(1000 as decimal(38,0)) * {a} * {n}) div (cast({l} as decimal(38,0)) * {r}) AS s").collect()
    assert row["s"] == 1000 * a * n // (l * r)


# Suffix dedup


def brute_dedup(rows):
    out = []
    for rid, (doc_id, text) in enumerate(rows):
        data = (text or "").encode()
        removed = [False] * len(data)
        if doc_id is not None:
            earlier = [(t or "").encode() for d, t in rows if d is not None and d < doc_id]
            for p in range(len(data) - 50 + 1):
                if any(data[p : p + 50] in e for e in earlier):
                    removed[p : p + 50] = [True] * 50
        spans = sum(1 for i, x in enumerate(removed) if x and (i == 0 or not removed[i - 1]))
        kept = bytes(b for b, x in zip(data, removed) if not x)
        out.append((doc_id, len(data), sum(removed), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup_against_brute_force(spark):
    rng = random.Random(9)
    shared = "A passage that many documents share, long enough to count: ÄÖÜ 一二三 and so on."
    rows = []
    for k in range(30):
        words = [rng.choice(["alpha", "beta", "gamma", "δέλτα", "e"]) for _ in range(rng.randint(0, 60))]
        text = " ".join(words)
        if k % 3 == 0:
            cut = rng.randint(0, len(text))
            text = text[:cut] + shared + text[cut:]
        rows.append((rng.randint(0, 12), text))
    rows += [(None, shared), (50, None), (51, ""), (52, shared[:49]), (53, shared * 3), (3, rows[0][1]), (3, rows[0][1])]
    rows += [(60, "x" * 20000), (61, "x" * 20000 + "y")]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(4)
    got = sorted((tuple(r) for r in suffix_dedup.dedup(df).drop("rid").collect()), key=repr)
    assert got == brute_dedup(rows)
    assert suffix_dedup.dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_digits_are_windows():
    data = bytes(range(256)) * 3
    h = suffix_dedup.digits(data)
    assert len(h) == len(data) - suffix_dedup.DIGIT + 1
    assert h[0] == h[256] and h[1] != h[0]
    assert len(suffix_dedup.digits(b"short")) == 0
    assert len({int(x) for x in itertools.islice(h, 256)}) == 256


def test_collocation_query_equals_its_sql(spark):
    from dumpscope.llm.queries import ORACLES, QUERIES
    from tools.compare import connect, rows_of

    sf_dir = "/root/testdata/sf0.01"
    cursor = connect(sf_dir).execute(ORACLES["op12_collocations"])
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    df = QUERIES["op12_collocations"](spark, sf_dir)
    assert expected and rows_of(df.columns, df.collect()) == expected
