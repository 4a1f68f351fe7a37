"""Command line: ``python -m dumpscope report|line-count|link-counts|keyword|normalise|ranked-sentiment|entities``."""

import argparse

from pyspark.sql import DataFrame, SparkSession

from dumpscope.constants import DEFAULT_KEYWORD
from dumpscope.operators.lexical import entity_tags, normalise_text
from dumpscope.operators.segment import segment
from dumpscope.operators.text import keyword_count, keyword_texts
from dumpscope.plans import article_report, link_counts, ranked_sentiment
from dumpscope.sources import tables
from dumpscope.sources.dump import read_dump
from dumpscope.sources.sinks import write_table


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dumpscope")
    jobs = top.add_subparsers(dest="job", required=True)
    report = jobs.add_parser("report", help="parse a dump and write its articles and reports")
    report.add_argument("dump", nargs="+")
    report.add_argument("--output", required=True)
    report.add_argument("--stop-words", help="word list; Spark's English list by default")
    count = jobs.add_parser("line-count", help="count the raw lines of a dump")
    count.add_argument("dump", nargs="+")
    count.add_argument("--output", required=True)
    keyword = jobs.add_parser("keyword", help="count articles with a keyword, and write their dictionary text")
    keyword.add_argument("dump", nargs="+")
    keyword.add_argument("--dictionary", required=True)
    keyword.add_argument("--keyword", default=DEFAULT_KEYWORD)
    keyword.add_argument("--output", required=True)
    chain = jobs.add_parser("normalise", help="stop words out, lemmas in, content words only, from written articles")
    chain.add_argument("articles")
    chain.add_argument("--tags", required=True)
    chain.add_argument("--lemmas", required=True)
    chain.add_argument("--stop-words", help="word list; Spark's English list by default")
    chain.add_argument("--output", required=True)
    links = jobs.add_parser("link-counts", help="write the link count of each article")
    links.add_argument("dump", nargs="+")
    links.add_argument("--output", required=True)
    ranked = jobs.add_parser("ranked-sentiment", help="sentiment of ranked titles from written articles")
    ranked.add_argument("articles")
    ranked.add_argument("--titles", required=True)
    ranked.add_argument("--lexicon", required=True)
    ranked.add_argument("--output", required=True)
    ranked.add_argument("--fold-ascii", action="store_true")
    entities = jobs.add_parser("entities", help="tag entities in written articles")
    entities.add_argument("articles")
    entities.add_argument("--entities", required=True)
    entities.add_argument("--output", required=True)
    return top


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a result and show what was written, so that it is computed once."""
    write_table(df, path)
    found = df.sparkSession.read.parquet(path)
    found.show(truncate=False)
    return found


def stop_words(spark: SparkSession, path: str | None) -> DataFrame:
    return tables.read_words(spark, path) if path else tables.default_stop_words(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "report":
        articles = article_report.articles_table(spark, args.dump, f"{args.output}/articles")
        for name, df in article_report.reports(articles, stop_words(spark, args.stop_words)).items():
            written(df, f"{args.output}/{name}")
    elif args.job == "line-count":
        written(article_report.line_count(spark, args.dump), args.output)
    elif args.job == "keyword":
        articles = segment(read_dump(spark, args.dump), match="prefix")
        written(keyword_count(articles, args.keyword), f"{args.output}/count")
        words = tables.read_words(spark, args.dictionary)
        write_table(keyword_texts(articles, "article_id", args.keyword, words), f"{args.output}/texts")
    elif args.job == "normalise":
        articles, stop = spark.read.parquet(args.articles), stop_words(spark, args.stop_words)
        tags, lemmas = tables.read_word_tags(spark, args.tags), tables.read_lemmas(spark, args.lemmas)
        write_table(normalise_text(articles, "article_id", "pure_text", stop, tags, lemmas), args.output)
    elif args.job == "link-counts":
        link_counts.run(spark, args.dump, args.output)
    elif args.job == "ranked-sentiment":
        articles = spark.read.parquet(args.articles)
        found = ranked_sentiment.run(spark, articles, args.titles, args.lexicon, args.output, args.fold_ascii)
        for df in found.values():
            df.show(truncate=False)
    else:
        articles = spark.read.parquet(args.articles)
        known = tables.read_entities(spark, args.entities)
        write_table(entity_tags(articles, "article_id", "pure_text", known), args.output)


if __name__ == "__main__":
    run(SparkSession.builder.appName("dumpscope").getOrCreate(), parser().parse_args())
