"""The articles table and filters on it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.constants import DEFAULT_KEYWORD, REDIRECT_PREFIX
from dumpscope.functions import markup

LISTS = (
    "wikilinks",
    "headings",
    "headings_level2",
    "headings_level3",
    "headings_level4",
    "headings_level5",
    "text_in_bold",
)


def extract(segments: DataFrame, bold_mode: str = "lookaround") -> DataFrame:
    """Article columns from ``title`` and ``body``; all other columns are kept in front.

    Lines and heading lines are found first, as several columns are made of them.
    """
    body = F.col("body")
    others = [c for c in segments.columns if c not in ("title", "body")]
    found = segments.select(
        *others, "title", "body", markup.all_lines(body).alias("_lines"), markup.heading_lines(body).alias("_headings")
    )
    headings = [markup.headings_among(F.col("_headings"), c).alias(c) for c in LISTS if c.startswith("headings")]
    return found.select(
        *others,
        "title",
        F.slice("_lines", 1, F.size("_lines") - 1).alias("lines"),
        markup.wikilinks(body).alias("wikilinks"),
        *headings,
        markup.bold(body, bold_mode).alias("text_in_bold"),
        markup.pure_text(F.col("_lines")).alias("pure_text"),
    )


def with_counts(articles: DataFrame) -> DataFrame:
    """Add ``n_<list>`` length columns, so that reports over a written table read integers only."""
    return articles.select("*", *[F.size(c).alias(f"n_{c}") for c in LISTS])


def non_redirects(segments: DataFrame) -> DataFrame:
    """Articles whose first line does not start a redirect."""
    return segments.filter(~F.startswith("body", F.lit(REDIRECT_PREFIX)))


def containing(segments: DataFrame, keyword: str = DEFAULT_KEYWORD) -> DataFrame:
    """Articles with the keyword on some line."""
    return segments.filter(F.contains("body", F.lit(keyword)))


def lookup(articles: DataFrame, title: str) -> DataFrame:
    """All articles of a title."""
    return articles.filter(F.col("title") == title)


def titled(articles: DataFrame) -> DataFrame:
    """Articles whose title is neither null nor empty."""
    return articles.filter("title <> ''")
