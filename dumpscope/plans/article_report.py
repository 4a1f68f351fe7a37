"""The main job: parse a dump once into a table and report on it."""

from pyspark.sql import DataFrame, SparkSession

from dumpscope.operators import stats
from dumpscope.operators.articles import extract, with_counts
from dumpscope.operators.segment import segment
from dumpscope.operators.text import top_words
from dumpscope.sources.dump import read_dump, read_lines
from dumpscope.sources.sinks import write_table


def articles_table(spark: SparkSession, dump: str | list[str], path: str, **how) -> DataFrame:
    """Parse the dump, write the articles with their list lengths as Parquet, and read them back.

    Every report scans the written columns it needs; the dump itself is parsed once. ``how`` goes to ``segment``, its
    markers to the reader too.
    """
    markers = {k: v for k, v in how.items() if k in ("end_marker", "title_marker")}
    write_table(with_counts(extract(segment(read_dump(spark, dump, **markers), **how))), path)
    return spark.read.parquet(path)


def reports(articles: DataFrame, stop_words: DataFrame, k: int = 20) -> dict[str, DataFrame]:
    """Reports on an articles table by name: statistics, heading levels, top lists and top words."""
    found = {
        "metric_stats": stats.metric_stats(articles),
        "heading_levels": stats.heading_level_totals(articles),
        "links_per_article": stats.mean_floor(articles),
        "top_words": top_words(articles, "pure_text", stop_words, k),
    }
    for metric in stats.METRICS:
        found[f"top_{metric}"] = stats.top_articles(articles, metric, k)
    return found


def line_count(spark: SparkSession, dump: str | list[str]) -> DataFrame:
    """One row: raw lines of the dump."""
    return stats.count_rows(read_lines(spark, dump), "lines")
