"""Counts, one-pass statistics and top lists."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.operators.articles import titled

METRICS = ("wikilinks", "headings", "text_in_bold")
LEVELS = ("headings", "headings_level2", "headings_level3", "headings_level4", "headings_level5")


def length(df: DataFrame, column: str):
    """Length of a list column, read from its count column where the table has one."""
    counted = f"n_{column}"
    return F.col(counted) if counted in df.columns else F.size(column)


def list_counts(articles: DataFrame, column: str) -> DataFrame:
    """``title``, ``n``: list length per article."""
    return articles.select("title", length(articles, column).alias("n"))


def top_articles(articles: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` titled articles with the longest lists; ties by title."""
    return list_counts(titled(articles), column).orderBy(F.desc("n"), "title").limit(k)


def metric_stats(articles: DataFrame, metrics=METRICS) -> DataFrame:
    """One row per metric: article count, total, mean, min, max and population deviation, in one pass."""
    sizes = articles.select(*[length(articles, m).alias(m) for m in metrics])
    aggregates = [
        F.struct(
            F.lit(m).alias("metric"),
            F.count("*").alias("articles"),
            F.coalesce(F.sum(m), F.lit(0)).alias("total"),
            F.avg(m).alias("mean"),
            F.min(m).alias("min"),
            F.max(m).alias("max"),
            F.stddev_pop(m).alias("stdev"),
        )
        for m in metrics
    ]
    return sizes.agg(F.array(*aggregates).alias("rows")).select(F.inline("rows"))


def heading_level_totals(articles: DataFrame) -> DataFrame:
    """One row: total headings overall and per level."""
    return articles.agg(*[F.coalesce(F.sum(length(articles, c)), F.lit(0)).alias(c) for c in LEVELS])


def mean_floor(articles: DataFrame, column: str = "wikilinks") -> DataFrame:
    """One row: whole number of list entries per article."""
    sizes = articles.select(length(articles, column).alias("n"))
    return sizes.agg(F.expr("sum(n) div count(*)").alias("mean_floor"))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))
