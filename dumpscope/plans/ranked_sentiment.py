"""The ranked-title job: sentiment of the articles of a ranked title list, against their ranks."""

from pyspark.sql import DataFrame, SparkSession

from dumpscope.operators.sentiment import rank_correlation, ranked_sentiment
from dumpscope.sources.sinks import write_table
from dumpscope.sources.tables import read_lexicon, read_titles


def run(
    spark: SparkSession, articles: DataFrame, titles: str, lexicon: str, output: str, fold_ascii: bool = False
) -> dict[str, DataFrame]:
    """Write the sentence polarity of each found title, and correlate the written rows with the ranks."""
    ranked = read_titles(spark, titles, fold_ascii)
    write_table(ranked_sentiment(ranked, articles, "article_id", read_lexicon(spark, lexicon)), output)
    sentiment = spark.read.parquet(output)
    return {"sentiment": sentiment, "correlation": rank_correlation(sentiment, stored=True)}
