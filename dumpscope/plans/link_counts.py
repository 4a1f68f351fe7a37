"""The link-count job: outgoing links of every article with a good title, as text lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.functions.markup import wikilinks_nested
from dumpscope.operators.segment import segment
from dumpscope.sources.dump import read_dump
from dumpscope.sources.sinks import write_counts


def link_counts(records: DataFrame) -> DataFrame:
    """``title``, ``n`` per article, nested links included; one stage without a shuffle."""
    articles = segment(records, match="prefix")
    return articles.select("title", F.size(wikilinks_nested(F.col("body"))).alias("n"))


def run(spark: SparkSession, dump: str | list[str], output: str) -> None:
    write_counts(link_counts(read_dump(spark, dump)), output)
