import pytest
from pyspark.sql import functions as F

from dumpscope.operators import sentiment
from dumpscope.operators.rank import average_rank, with_position
from dumpscope.operators.small import broadcast_if_small
from dumpscope.operators.stats import count_rows

LIMITS = [100, 0]
TEXTS = ["Good day. Bad bad good! Plain", "", None, "good good. bad."]


@pytest.fixture()
def lexicon(spark):
    return spark.createDataFrame([("good", 3), ("bad", -2), ("meh", 0), ("not good", -4)], "term string, score int")


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


def ordered(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_scores(docs, lexicon, limit):
    scores = sentiment.sentence_scores(docs, "id", "text", lexicon, limit=limit)
    found = [[tuple(s) for s in r["scores"]] for r in scores.orderBy("id").collect()]
    assert found == [[(0, 0), (3, -2), (0, 0)], [], [], [(6, 0), (0, -2)]]
    assert dict(scores.dtypes)["scores"] == sentiment.SCORES
    polarity = ordered(sentiment.with_polarity(scores), "id", "pos", "neg", "neu")
    assert polarity == [(0, 1, 0, 2), (1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 1, 0)]
    assert ordered(sentiment.sentences_long(scores, "id"), "id", "sid", "pos", "neg") == [
        (0, 0, 0, 0), (0, 1, 3, -2), (0, 2, 0, 0), (3, 0, 6, 0), (3, 1, 0, -2),
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_lower(docs, lexicon, limit):
    scores = sentiment.sentence_scores(docs, "id", "text", lexicon, lower=True, limit=limit)
    assert [tuple(s) for s in scores.orderBy("id").first()["scores"]] == [(3, 0), (3, -4), (0, 0)]


@pytest.mark.parametrize("limit", LIMITS)
def test_ranked(spark, docs, lexicon, limit):
    ranked = spark.createDataFrame([(0, "A"), (1, None), (2, "B"), (3, "C"), (4, "A")], "rank long, title string")
    titles = F.when(F.col("id") == 3, "B").when(F.col("id") < 2, "A")
    articles = docs.select("id", titles.alias("title"), F.col("text").alias("pure_text"))
    inner = sentiment.ranked_articles(ranked, articles, "id")
    assert ordered(inner, "rank", "id") == [(0, 0), (0, 1), (2, 3), (4, 0), (4, 1)]
    assert count_rows(inner).collect()[0]["n"] == 5
    left = sentiment.ranked_articles(ranked, articles, "id", "left")
    assert ordered(left.filter("id IS NULL"), "rank") == [(1,), (3,)]
    films = sentiment.ranked_sentiment(ranked, articles, "id", lexicon, limit=limit)
    assert ordered(films, "rank", "title", "pos", "neg", "neu") == [
        (0, "A", 0, 0, 0), (0, "A", 1, 0, 2), (2, "B", 1, 1, 0), (4, "A", 0, 0, 0), (4, "A", 1, 0, 2),
    ]


def test_broadcast_needs_a_small_table(spark):
    df = spark.range(10).selectExpr("id", "repeat('x', 100) AS t")
    hinted = lambda **limits: "ResolvedHint" in broadcast_if_small(df, **limits)._jdf.queryExecution().analyzed().toString()
    assert hinted() and hinted(rows=10)
    assert not hinted(rows=9) and not hinted(size=900)


def test_correlation(spark):
    rows = [(0, 5, 1), (1, 4, 0), (2, 1, 0), (3, 1, 0), (4, 0, 9)]
    films = spark.createDataFrame(rows, "rank long, pos long, neg long")
    (row,) = sentiment.rank_correlation(films).collect()
    assert row["n"] == 5
    assert round(row["spearman"], 6) == round(-9 / 90**0.5, 6)  # ranks 1..5 against 4.5 4.5 2.5 2.5 1
    assert round(row["pearson"], 6) == round(films.selectExpr("corr(rank, pos - neg)").collect()[0][0], 6)


@pytest.mark.parametrize("width", [1_000_000, 2])
def test_average_rank(spark, width):
    df = spark.createDataFrame([(v,) for v in (5, -3, 5, 0, 7, -3, -3, None)], "v long")
    assert ordered(average_rank(df, "v", "r", width), "v", "r") == sorted(
        [(-3, 2.0), (-3, 2.0), (-3, 2.0), (0, 4.0), (5, 5.5), (5, 5.5), (7, 7.0)], key=repr
    )


def test_positions_follow_file_order(spark, tmp_path):
    lines = [f"title {i}" for i in range(500)]
    (tmp_path / "a.txt").write_text("\n".join(lines[:10]))
    (tmp_path / "b.txt").write_text("\n".join(lines[10:]) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        rows = with_position(spark.read.text(str(tmp_path)), "rank").orderBy("rank").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [(r["rank"], r["value"]) for r in rows] == list(enumerate(lines))
