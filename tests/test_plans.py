import re

import pytest

from conftest import SF_DIR
from dumpscope.catalog.queries import QUERIES
from dumpscope.operators import sentiment, stats, text
from dumpscope.operators.articles import extract, with_counts
from dumpscope.operators.segment import segment
from dumpscope.plans.link_counts import link_counts
from dumpscope.sources.dump import read_dump
from dumpscope.sources.tables import default_stop_words
from golden import DUMP


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def articles(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("articles")
    (folder / "dump").write_bytes(DUMP.encode())
    with_counts(extract(segment(read_dump(spark, str(folder / "dump"))))).write.parquet(str(folder / "table"))
    return spark.read.parquet(str(folder / "table"))


def test_no_python_and_no_products(spark):
    for name, query in QUERIES.items():
        found = plan(query(spark, SF_DIR))
        assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", found), name


def test_statistics_are_one_narrow_scan(articles):
    found = plan(stats.metric_stats(articles))
    assert found.count("FileScan") == 1
    assert "ReadSchema: struct<n_wikilinks:int,n_headings:int,n_text_in_bold:int>" in found


def test_top_lists_keep_k_rows_per_task(articles):
    found = plan(stats.top_articles(articles, "wikilinks"))
    assert "TakeOrderedAndProject" in found and "Exchange" not in found
    assert "PushedFilters: [IsNotNull(title), Not(EqualTo(title,))]" in found
    assert "ReadSchema: struct<title:string,n_wikilinks:int>" in found


def test_link_counts_do_not_shuffle(spark, articles, tmp_path):
    for i in range(64):
        (tmp_path / f"part{i}").write_bytes(DUMP.encode())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert "Exchange" not in plan(link_counts(read_dump(spark, str(tmp_path))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_scoring_with_a_small_lexicon_does_not_shuffle(spark, articles):
    lexicon = spark.createDataFrame([("good", 3)], "term string, score int")
    found = plan(sentiment.with_polarity(sentiment.sentence_scores(articles, "article_id", "pure_text", lexicon)))
    assert "Exchange" not in found and "INSET" not in found
    many = spark.range(1000).selectExpr("concat('w', id) AS term", "int(id % 11 - 5) AS score")
    found = plan(sentiment.sentence_scores(articles, "article_id", "pure_text", many))
    assert "Exchange" not in found and "INSET" in found


def test_joined_scoring_shuffles_texts_once(spark, articles):
    many = spark.range(1000).selectExpr("concat('w', id) AS term", "int(id % 11 - 5) AS score")
    found = plan(sentiment.sentence_scores(articles, "article_id", "pure_text", many, limit=10))
    assert "BroadcastHashJoin" in found
    assert len(re.findall(r"Exchange hashpartitioning\(_id#", found)) == 1


def test_words_are_counted_before_the_shuffle(spark, articles):
    found = plan(text.word_counts(articles, "pure_text", default_stop_words(spark)))
    assert "BroadcastHashJoin" in found and "SortMergeJoin" not in found
    assert re.search(r"HashAggregate.*\n.*Exchange hashpartitioning\(word.*\n.*HashAggregate", found)
