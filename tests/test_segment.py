import random

import brute
import pytest
from golden import DUMP
from pyspark.sql import functions as F

from dumpscope.constants import END_MARKER, TITLE_MARKER
from dumpscope.functions.markup import lines
from dumpscope.functions.titles import ascii_only, normalise_title
from dumpscope.operators.articles import extract
from dumpscope.operators.segment import segment
from dumpscope.sources.dump import kept_marker, read_dump


def parsed(spark, path, **how):
    rows = segment(read_dump(spark, path), **how).select("title", lines(F.col("body")).alias("lines")).collect()
    return sorted(((r["title"], r["lines"]) for r in rows), key=repr)


def test_titles(apply):
    assert apply(normalise_title, [*brute.TITLES, None]) == [*brute.TITLES.values(), None]


def test_title_namespaces(apply):
    names = ["Wikipedia:X", "2001:_X", "Lagaan: Once", "File:x"]
    kept = apply(lambda c: normalise_title(c, namespaces=["Wikipedia", "File"]), names)
    assert kept == [None, "2001: X", "Lagaan: Once", None]


def test_ascii(apply):
    assert apply(ascii_only, ["naïve 日本 x", "plain", "", None]) == ["nave  x", "plain", "", None]


def test_golden(spark, tmp_path):
    (tmp_path / "part0").write_bytes(DUMP.encode())
    found = parsed(spark, str(tmp_path))
    titles = sorted(str(t) for t, _ in found)
    assert titles == sorted(["A,B", "None", "None", "None", "Twice", "Twice", "Redirected", "Cyclist"])
    by_title = dict(found)
    assert by_title["Cyclist"] == ["Nave text about a unicycle.", "Second line"]
    assert ("Twice", ["second", f"{TITLE_MARKER} Inner", "still the second"]) in found
    dropped = parsed(spark, str(tmp_path), match="prefix")
    assert sorted(t for t, _ in dropped) == ["A,B", "Cyclist", "Redirected", "Twice", "Twice"]


def test_policies(spark, tmp_path):
    (tmp_path / "part0").write_bytes(DUMP.encode())
    drop = parsed(spark, str(tmp_path), on_bad_title="drop")
    assert len(drop) == 5 and all(t for t, _ in drop)
    null = parsed(spark, str(tmp_path), match="prefix", on_bad_title="null")
    assert len(null) == 8
    with pytest.raises(ValueError):
        segment(read_dump(spark, str(tmp_path)), match="other")


def random_file(rng):
    pieces = [
        f"{TITLE_MARKER} Good_{rng.randint(0, 9)}", f"{TITLE_MARKER} File:x", f" {TITLE_MARKER}\tOdd one",
        f"x {TITLE_MARKER} y", TITLE_MARKER, END_MARKER, END_MARKER, END_MARKER + " tail", "body", "", "[[a]]",
        "$$$===", "a longer body line", TITLE_MARKER + "%41", f"cut {END_MARKER}", f"[[cut]] {END_MARKER} on", "é" * 12,
        "é" * 12 + f"{TITLE_MARKER} Far_{rng.randint(0, 9)}", f"{TITLE_MARKER[:9]}é{TITLE_MARKER[9:]} Inside", "été\r",
    ]
    return "\n".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) + rng.choice(["", "\n"])


@pytest.mark.parametrize("match", ["contains", "prefix"])
def test_segments_like_a_line_scanner(spark, tmp_path, match):
    rng = random.Random(7)
    files = [random_file(rng) for _ in range(60)]
    for i, text in enumerate(files):
        (tmp_path / f"part{i:03d}").write_text(text)
    expected = sorted(brute.articles(files, match == "prefix"), key=repr)
    assert parsed(spark, str(tmp_path), match=match) == expected


def test_text_before_an_end_marker_is_extracted(spark, tmp_path):
    (tmp_path / "part0").write_text(f"{TITLE_MARKER} T\nfirst\nTail [[Linked]] {END_MARKER}\n")
    for match in ("contains", "prefix"):
        row = extract(segment(read_dump(spark, str(tmp_path)), match=match)).first()
        assert (row["lines"], row["wikilinks"], row["pure_text"]) == (["first"], ["Linked"], "first Tail Linked  ")


def test_truncated_articles_are_dropped(spark, tmp_path):
    for n in range(1, len(kept_marker())):
        (tmp_path / f"part{n}").write_text(f"{TITLE_MARKER} T\nbody\n{END_MARKER[:n]}")
    assert parsed(spark, str(tmp_path)) == [] == parsed(spark, str(tmp_path), match="prefix")
    assert len(kept_marker()) == 17


def test_file_splits_change_nothing(spark, tmp_path):
    (tmp_path / "part0").write_text("\n".join(DUMP.replace("ï", "i").replace("\r", "") for _ in range(20)))
    whole = parsed(spark, str(tmp_path))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "37")
        assert read_dump(spark, str(tmp_path)).rdd.getNumPartitions() > 100
        assert parsed(spark, str(tmp_path)) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_gzip(spark, tmp_path):
    import gzip

    (tmp_path / "part0.gz").write_bytes(gzip.compress(DUMP.encode()))
    assert len(parsed(spark, str(tmp_path))) == 8


def test_ids_are_unique(spark, tmp_path):
    (tmp_path / "part0").write_bytes(DUMP.encode())
    (tmp_path / "part1").write_bytes(DUMP.encode())
    ids = [r["article_id"] for r in segment(read_dump(spark, str(tmp_path))).collect()]
    assert len(ids) == len(set(ids)) == 16
