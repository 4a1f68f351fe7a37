import pathlib

import pytest
from golden import DUMP

from dumpscope.__main__ import parser, run
from dumpscope.plans import article_report
from dumpscope.sources import sinks, tables


@pytest.fixture()
def dump(tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    (folder / "part0").write_bytes(DUMP.encode())
    return str(folder)


def text_of(path):
    return sorted(line for f in pathlib.Path(path).glob("part-*") for line in f.read_text().splitlines())


def test_report(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the first
        run(spark, parser().parse_args(["report", dump, "--output", out]))
    stats = {r["metric"]: r for r in spark.read.parquet(f"{out}/metric_stats").collect()}
    links = stats["wikilinks"]
    assert (links["articles"], links["total"], links["min"], links["max"]) == (8, 4, 0, 2)
    assert links["mean"] == 0.5 and round(links["stdev"], 9) == round(0.5**0.5, 9)
    levels = spark.read.parquet(f"{out}/heading_levels").collect()[0]
    assert tuple(levels) == (2, 1, 1, 0, 0)
    top = spark.read.parquet(f"{out}/top_wikilinks").orderBy("n", ascending=False).collect()
    assert [tuple(r) for r in top[:2]] == [("A,B", 2), ("Redirected", 1)]
    assert len(top) == 5
    assert spark.read.parquet(f"{out}/links_per_article").collect()[0][0] == 0
    words = {r["word"]: r["n"] for r in spark.read.parquet(f"{out}/top_words").collect()}
    assert words["title"] == 1 and words["second"] == 3 and "of" not in words
    assert article_report.line_count(spark, dump).collect()[0][0] == len(DUMP.replace("\r", "").split("\n"))


def test_link_counts(spark, dump, tmp_path):
    out = str(tmp_path / "links")
    run(spark, parser().parse_args(["link-counts", dump, "--output", out]))
    assert text_of(out) == ["A,B\t2", "Cyclist\t0", "Redirected\t1", "Twice\t0", "Twice\t0"]


def test_ranked_sentiment(spark, dump, tmp_path):
    articles = str(tmp_path / "articles")
    article_report.articles_table(spark, dump, articles)
    (tmp_path / "titles.txt").write_text("Twice\nMissing\nA%2CB\nCyclist\n", encoding="utf-8")
    (tmp_path / "lexicon.tsv").write_text("stop\t-2\nsecond\t3\n\"quoted\t1\ncan't stand\t-3")
    out = str(tmp_path / "films")
    args = ["ranked-sentiment", articles, "--titles", str(tmp_path / "titles.txt"), "--lexicon"]
    run(spark, parser().parse_args([*args, str(tmp_path / "lexicon.tsv"), "--output", out]))
    rows = sorted(tuple(r) for r in spark.read.parquet(out).select("rank", "title", "pos", "neg", "neu").collect())
    assert rows == [(0, "Twice", 0, 0, 1), (0, "Twice", 1, 0, 0), (2, "A,B", 0, 1, 1), (3, "Cyclist", 0, 0, 2)]


def test_entities(spark, dump, tmp_path):
    articles = str(tmp_path / "articles")
    article_report.articles_table(spark, dump, articles)
    (tmp_path / "entities.tsv").write_text("Plain start\tPERSON\nSecond\tO1\n")
    args = ["entities", articles, "--entities", str(tmp_path / "entities.tsv"), "--output", str(tmp_path / "tags")]
    run(spark, parser().parse_args(args))
    tags = spark.read.parquet(str(tmp_path / "tags"))
    assert tags.count() == 8
    found = tags.selectExpr("inline(tags)").filter("tag <> 'O'").collect()
    assert sorted(tuple(r) for r in found) == [("Plain", "PERSON"), ("Second", "O1"), ("start", "PERSON")]


def test_own_markers(spark, tmp_path):
    (tmp_path / "dump").write_text("@@T@@ One\na\n##END##\n@@T@@ Two\nb\n##END##\n")
    how = {"title_marker": "@@T@@", "end_marker": "##END##"}
    found = article_report.articles_table(spark, str(tmp_path / "dump"), str(tmp_path / "table"), **how)
    assert sorted(tuple(r) for r in found.select("title", "lines").collect()) == [("One", ["a"]), ("Two", ["b"])]


def test_line_count_and_keyword(spark, dump, tmp_path):
    run(spark, parser().parse_args(["line-count", dump, "--output", str(tmp_path / "lines")]))
    assert spark.read.parquet(str(tmp_path / "lines")).first()[0] == len(DUMP.replace("\r", "").split("\n"))
    (tmp_path / "words").write_text("unicycle\nline\n")
    run(spark, parser().parse_args(["keyword", dump, "--dictionary", str(tmp_path / "words"), "--output", str(tmp_path / "k")]))
    assert spark.read.parquet(str(tmp_path / "k/count")).first()[0] == 1
    assert [r["text"] for r in spark.read.parquet(str(tmp_path / "k/texts")).collect()] == ["unicycle. line"]


def test_normalise(spark, dump, tmp_path):
    articles = str(tmp_path / "articles")
    article_report.articles_table(spark, dump, articles)
    # A word with several tags counts as each of them, and as a verb for its lemma.
    (tmp_path / "tags").write_text("about\tIN\nline\tDT\nline\tVB\nrule\tNN\n")
    (tmp_path / "lemmas").write_text("line\tv\trule\nline\tn\tother\n")
    args = ["normalise", articles, "--tags", str(tmp_path / "tags"), "--lemmas", str(tmp_path / "lemmas")]
    run(spark, parser().parse_args([*args, "--output", str(tmp_path / "out")]))
    texts = [r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(texts) == 8 and " rule " in texts


def test_side_tables(spark, tmp_path):
    (tmp_path / "lexicon.tsv").write_text("good\t3\ncan't stand\t-3\n\"odd\t1")
    rows = tables.read_lexicon(spark, str(tmp_path / "lexicon.tsv")).collect()
    assert [tuple(r) for r in rows] == [("good", 3), ("can't stand", -3), ('"odd', 1)]
    (tmp_path / "words.txt").write_text(" cat \ndog\n\ncat\n")
    assert sorted(r[0] for r in tables.read_words(spark, str(tmp_path / "words.txt")).collect()) == ["cat", "dog"]
    (tmp_path / "lemmas.tsv").write_text("dogs\tn\tdog\n")
    assert tuple(tables.read_lemmas(spark, str(tmp_path / "lemmas.tsv")).first()) == ("dogs", "n", "dog")
    (tmp_path / "tags.tsv").write_text("dogs\tNNS\n")
    assert tuple(tables.read_word_tags(spark, str(tmp_path / "tags.tsv")).first()) == ("dogs", "NNS")


def test_titles(spark, tmp_path):
    path = tmp_path / "titles.txt"
    path.write_text("First_Film\nAmélie\n2001: A Title\n", encoding="utf-8")
    rows = tables.read_titles(spark, str(path)).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [(0, "First Film"), (1, "Amélie"), (2, None)]
    folded = tables.read_titles(spark, str(path), fold_ascii=True).orderBy("rank").collect()
    assert folded[1]["title"] == "Amlie"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([('say "hi"', 2), (None, 1)], "title string, n int")
    sinks.write_titles(df, str(tmp_path / "t"))
    assert text_of(tmp_path / "t") == ['say "hi"']
    sinks.write_counts(df.filter("n = 2"), str(tmp_path / "c"))
    assert text_of(tmp_path / "c") == ['say "hi"\t2']
    sinks.write_table(df, str(tmp_path / "p"), partition_by=["n"])
    assert {p.name for p in (tmp_path / "p").glob("n=*")} == {"n=1", "n=2"}
