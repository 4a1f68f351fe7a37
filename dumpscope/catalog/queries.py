"""Named queries over the given tables, one per operator or job."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.catalog import wikify as wk
from dumpscope.functions import citations, markup
from dumpscope.functions import text as tx
from dumpscope.functions.titles import ascii_only, normalise_title
from dumpscope.operators import articles as art
from dumpscope.operators import context_tags, lexical, sentence_ends, sentiment, stats
from dumpscope.operators import text as txt
from dumpscope.operators.rank import with_position
from dumpscope.operators.segment import segment
from dumpscope.sources.tables import default_stop_words

KEYWORD = "theaea"
LOOKUP = "Page, 12"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _segments(spark, sf_dir, **how) -> DataFrame:
    return segment(wk.page_records(spark, sf_dir), **how)


def _articles(spark, sf_dir, **how) -> DataFrame:
    return art.extract(_segments(spark, sf_dir, **how))


def _documents(spark, sf_dir) -> DataFrame:
    return wk.documents(spark, sf_dir)


def _document_articles(spark, sf_dir) -> DataFrame:
    return art.extract(segment(wk.document_records(spark, sf_dir)))


def _long(df: DataFrame, key: str, values, name: str) -> DataFrame:
    # The outer form: an inner one would filter on the list first and so compute it twice.
    rows = df.select(key, F.posexplode_outer(values).alias("pos", name)).filter("pos IS NOT NULL")
    return rows.withColumn("pos", F.col("pos").cast("long"))


# Sources and parsing


@query
def line_count(spark, sf_dir):
    lines = wk.page_records(spark, sf_dir).select(F.explode(F.split("value", "\n")))
    return stats.count_rows(lines)


@query
def ascii_lines(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", ascii_only(F.col("text")).alias("text_ascii"))


@query
def title_normalise(spark, sf_dir):
    parts = wk.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    name, kind = F.col("p_name"), F.col("p_partkey") % 8
    raw = (
        F.when(kind == 0, F.concat(F.lit("  "), F.translate(name, " ", "_"), F.lit("\t")))
        .when(kind == 1, F.regexp_replace(name, " ", "%20"))
        .when(kind == 2, F.regexp_replace(name, " ", "%252520"))
        .when(kind == 3, F.concat(name, F.lit("%ZZ")))
        .when(kind == 4, F.concat(F.lit("Portal:"), name))
        .when(kind == 5, F.concat(name, F.lit("%C3%A9")))
        .when(kind == 6, F.concat(name, F.lit("%25%34%31")))
        .otherwise(F.concat(name, F.lit(" a+b: %2Bc")))
    )
    return parts.select("p_partkey", normalise_title(raw).alias("title"))


@query
def articles_parsed(spark, sf_dir):
    n_lines = F.size(markup.lines(F.col("body"))).cast("long")
    return _segments(spark, sf_dir).select("page_id", "title", n_lines.alias("n_lines"))


@query
def articles_prefix(spark, sf_dir):
    n_chars = F.length("body").cast("long")
    return _segments(spark, sf_dir, match="prefix").select("page_id", "title", n_chars.alias("n_chars"))


@query
def raw_lines(spark, sf_dir):
    return _long(_segments(spark, sf_dir), "page_id", markup.lines(F.col("body")), "line")


@query
def article_count(spark, sf_dir):
    return stats.count_rows(_articles(spark, sf_dir), "articles")


@query
def preview_articles(spark, sf_dir):
    return _articles(spark, sf_dir).select("page_id", "title", "pure_text").orderBy("page_id").limit(5)


# Markup


@query
def page_links_long(spark, sf_dir):
    return _long(_articles(spark, sf_dir), "page_id", "wikilinks", "topic")


@query
def page_links_nested(spark, sf_dir):
    return _long(_segments(spark, sf_dir), "page_id", markup.wikilinks_nested(F.col("body")), "topic")


@query
def link_counts_cursor(spark, sf_dir):
    n = F.size(markup.wikilinks_nested(F.col("body"))).cast("long")
    return _segments(spark, sf_dir, match="prefix").select("title", n.alias("n"))


@query
def headings_long(spark, sf_dir):
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("found")) for c in stats.LEVELS]
    found = _articles(spark, sf_dir).select("page_id", F.inline(F.array(*kinds)))
    return found.select("page_id", "kind", F.explode_outer("found").alias("heading")).filter("heading IS NOT NULL")


@query
def bold_long(spark, sf_dir):
    return _long(_articles(spark, sf_dir), "page_id", "text_in_bold", "bold")


@query
def bold_paired(spark, sf_dir):
    return _long(_segments(spark, sf_dir), "page_id", markup.bold(F.col("body"), "paired"), "bold")


@query
def text_lines(spark, sf_dir):
    return _long(_segments(spark, sf_dir), "page_id", markup.prose_lines(markup.lines(F.col("body"))), "line")


@query
def plain_text(spark, sf_dir):
    return _articles(spark, sf_dir).select("page_id", "pure_text")


@query
def plain_text_all_lines(spark, sf_dir):
    plain = markup.plain_text(markup.lines(F.col("body")), "\n")
    return _segments(spark, sf_dir).select("page_id", plain.alias("plain"))


@query
def markup_stripped(spark, sf_dir):
    return _segments(spark, sf_dir).select("page_id", markup.strip_markup(F.col("body")).alias("stripped"))


@query
def refs(spark, sf_dir):
    return _long(_segments(spark, sf_dir), "page_id", citations.refs(F.col("body")), "ref")


@query
def external_urls(spark, sf_dir):
    return _long(_segments(spark, sf_dir), "page_id", citations.external_urls(F.col("body")), "url")


@query
def citation_uris(spark, sf_dir):
    uris = citations.citation_uris(citations.refs(F.col("body")))
    return _long(_segments(spark, sf_dir), "page_id", uris, "uri")


@query
def citation_domains(spark, sf_dir):
    uris = citations.citation_uris(citations.refs(F.col("body")))
    return _long(_segments(spark, sf_dir), "page_id", citations.domains(uris), "domain")


@query
def url_domains(spark, sf_dir):
    domains = citations.domains(citations.external_urls(F.col("body")))
    return _long(_segments(spark, sf_dir), "page_id", domains, "domain")


# Article filters


@query
def non_redirects(spark, sf_dir):
    return art.non_redirects(_segments(spark, sf_dir)).select("page_id", "title")


@query
def keyword_articles(spark, sf_dir):
    return art.containing(_segments(spark, sf_dir), KEYWORD).select("page_id", "title")


@query
def keyword_texts(spark, sf_dir):
    chosen = _segments(spark, sf_dir, match="prefix")
    return txt.keyword_texts(chosen, "page_id", KEYWORD, wk.dictionary(spark, sf_dir))


@query
def keyword_count(spark, sf_dir):
    return txt.keyword_count(_segments(spark, sf_dir, match="prefix"), KEYWORD)


@query
def lookup_title(spark, sf_dir):
    return art.lookup(_articles(spark, sf_dir), LOOKUP).select("page_id", "title", "pure_text")


@query
def titled_articles(spark, sf_dir):
    return art.titled(_articles(spark, sf_dir)).select("page_id", "title")


# Statistics


@query
def link_counts(spark, sf_dir):
    counts = stats.list_counts(_articles(spark, sf_dir), "wikilinks")
    return counts.select("title", F.col("n").cast("long").alias("n"))


def _top(spark, sf_dir, column):
    top = stats.top_articles(_articles(spark, sf_dir), column)
    return top.select("title", F.col("n").cast("long").alias("n"))


@query
def top20_links(spark, sf_dir):
    return _top(spark, sf_dir, "wikilinks")


@query
def top20_headings(spark, sf_dir):
    return _top(spark, sf_dir, "headings")


@query
def top20_bold(spark, sf_dir):
    return _top(spark, sf_dir, "text_in_bold")


@query
def metric_stats(spark, sf_dir):
    rows = stats.metric_stats(_articles(spark, sf_dir))
    return rows.select(
        "metric",
        "articles",
        "total",
        F.round("mean", 6).alias("mean"),
        F.col("min").cast("long").alias("min"),
        F.col("max").cast("long").alias("max"),
        F.round("stdev", 6).alias("stdev"),
    )


@query
def heading_level_totals(spark, sf_dir):
    return stats.heading_level_totals(_articles(spark, sf_dir))


@query
def avg_links_floor(spark, sf_dir):
    return stats.mean_floor(_articles(spark, sf_dir))


# Text


@query
def abbreviations(spark, sf_dir):
    """Types of the corpus with their period counts and abbreviation score (F4, learned)."""
    found = sentence_ends.abbreviations(_documents(spark, sf_dir), "text")
    return found.select("word", "with_period", "without_period", (F.round("score", 6) + 0.0).alias("score"), "abbreviation")


@query
def learned_sentences_long(spark, sf_dir):
    """Sentences that are not cut after a learned abbreviation (F4)."""
    docs = _documents(spark, sf_dir)
    return sentence_ends.sentences(docs, "doc_id", "text", sentence_ends.abbreviations(docs, "text"))


@query
def sentences_long(spark, sf_dir):
    return _long(_documents(spark, sf_dir), "doc_id", tx.sentences(F.col("text")), "sentence")


@query
def words_long(spark, sf_dir):
    return _long(_documents(spark, sf_dir), "doc_id", tx.words(F.col("text")), "word")


@query
def tokenised_text(spark, sf_dir):
    return txt.tokenise(_documents(spark, sf_dir), "doc_id", "text", default_stop_words(spark))


@query
def stopwords_removed(spark, sf_dir):
    stop = default_stop_words(spark)
    return txt.remove_stop_words(_document_articles(spark, sf_dir), "doc_id", "pure_text", stop)


@query
def stopwords_removed_words(spark, sf_dir):
    stop = default_stop_words(spark)
    return txt.remove_stop_words(_documents(spark, sf_dir), "doc_id", "text", stop, split="words")


@query
def word_count_top20(spark, sf_dir):
    return txt.top_words(_document_articles(spark, sf_dir), "pure_text", default_stop_words(spark))


@query
def word_counts(spark, sf_dir):
    return txt.word_counts(_documents(spark, sf_dir), "text", default_stop_words(spark))


@query
def dictionary_text(spark, sf_dir):
    return txt.dictionary_text(_documents(spark, sf_dir), "doc_id", "text", wk.dictionary(spark, sf_dir))


@query
def dictionary_text_joined(spark, sf_dir):
    words = wk.dictionary(spark, sf_dir)
    return txt.dictionary_text(_documents(spark, sf_dir), "doc_id", "text", words, limit=0)


# Sentiment and ranked titles


@query
def sentence_scores(spark, sf_dir):
    scores = sentiment.sentence_scores(_documents(spark, sf_dir), "doc_id", "text", wk.lexicon(spark, sf_dir))
    return sentiment.sentences_long(scores, "doc_id").select(
        "doc_id", *[F.col(c).cast("long").alias(c) for c in ("sid", "pos", "neg")]
    )


@query
def doc_polarity(spark, sf_dir):
    scores = sentiment.sentence_scores(_documents(spark, sf_dir), "doc_id", "text", wk.lexicon(spark, sf_dir))
    return sentiment.with_polarity(scores)


@query
def doc_polarity_joined(spark, sf_dir):
    lexicon = wk.lexicon(spark, sf_dir)
    scores = sentiment.sentence_scores(_documents(spark, sf_dir), "doc_id", "text", lexicon, limit=0)
    return sentiment.with_polarity(scores)


@query
def doc_polarity_lower(spark, sf_dir):
    lexicon = wk.lexicon(spark, sf_dir)
    scores = sentiment.sentence_scores(_documents(spark, sf_dir), "doc_id", "text", lexicon, lower=True)
    return sentiment.with_polarity(scores)


@query
def article_polarity(spark, sf_dir):
    articles = _document_articles(spark, sf_dir).select(F.struct("title", "doc_id").alias("article"), "pure_text")
    scores = sentiment.sentence_scores(articles, "article", "pure_text", wk.lexicon(spark, sf_dir))
    return sentiment.with_polarity(scores).select("article.title", "article.doc_id", "pos", "neg", "neu")


@query
def title_positions(spark, sf_dir):
    return with_position(wk.table(spark, sf_dir, "labels").select("doc_id"), "rank")


@query
def ranked_titles(spark, sf_dir):
    return wk.ranked_titles(spark, sf_dir)


@query
def title_texts(spark, sf_dir):
    return _document_articles(spark, sf_dir).select("title", "pure_text")


def _ranked(spark, sf_dir, how):
    documents = segment(wk.document_records(spark, sf_dir))
    return sentiment.ranked_articles(wk.ranked_titles(spark, sf_dir), documents, "doc_id", how)


@query
def ranked_title_texts(spark, sf_dir):
    return _ranked(spark, sf_dir, "inner").select("title", "pure_text")


@query
def ranked_title_left(spark, sf_dir):
    return _ranked(spark, sf_dir, "left").select("rank", "title", "doc_id", "pure_text")


@query
def ranked_title_count(spark, sf_dir):
    return stats.count_rows(_ranked(spark, sf_dir, "inner"))


def _sentiment(spark, sf_dir):
    ranked, documents = wk.ranked_titles(spark, sf_dir), segment(wk.document_records(spark, sf_dir))
    return sentiment.ranked_sentiment(ranked, documents, "doc_id", wk.lexicon(spark, sf_dir))


@query
def ranked_title_sentiment(spark, sf_dir):
    return _sentiment(spark, sf_dir)


@query
def rank_sentiment_corr(spark, sf_dir):
    rows = sentiment.rank_correlation(_sentiment(spark, sf_dir))
    return rows.select("n", F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


# Lexical tables


@query
def lemma_text(spark, sf_dir):
    tags, lemmas = wk.word_tags(spark, sf_dir), wk.lemmas(spark, sf_dir)
    return lexical.lemmatise(_documents(spark, sf_dir), "doc_id", "text", tags, lemmas)


@query
def pos_filtered(spark, sf_dir):
    return lexical.keep_tagged(_documents(spark, sf_dir), "doc_id", "text", wk.word_tags(spark, sf_dir))


def _in_context(spark, sf_dir, **more):
    tags, tagged = wk.ambiguous_word_tags(spark, sf_dir), wk.tagged_benchmark(spark, sf_dir)
    return context_tags.tag_in_context(_documents(spark, sf_dir), "doc_id", "text", tags, tagged, **more)


@query
def context_tagged(spark, sf_dir):
    """Every token of every document with its tag chosen in context (F9, F10)."""
    return _long(_in_context(spark, sf_dir), "doc_id", "words", "w").select("doc_id", "pos", "w.token", "w.tag")


@query
def pos_context(spark, sf_dir):
    """Nouns, adjectives and verbs by their tag in context, framed by blanks (F10)."""
    kept = F.filter("words", lambda w: w["tag"].isin(*lexical.CONTENT_TAGS))
    return _in_context(spark, sf_dir).select("doc_id", lexical.framed(F.transform(kept, lambda w: w["token"])).alias("text"))


@query
def lemma_context(spark, sf_dir):
    """Each token replaced by its verb lemma if its tag in context is verbal, else by its noun lemma (F9)."""
    rows = _in_context(spark, sf_dir, lemmas=wk.lemmas(spark, sf_dir))
    form = F.transform("words", lambda w: F.coalesce(F.when(F.lower(w["tag"]).contains("v"), w["v"]).otherwise(w["n"]), w["token"]))
    return rows.select("doc_id", F.array_join(form, " ").alias("text"))


@query
def normalised_text(spark, sf_dir):
    stop, tags, lemmas = default_stop_words(spark), wk.word_tags(spark, sf_dir), wk.lemmas(spark, sf_dir)
    return lexical.normalise_text(_documents(spark, sf_dir), "doc_id", "text", stop, tags, lemmas)


def _entity_tags(spark, sf_dir, **how):
    tagged = lexical.entity_tags(_documents(spark, sf_dir), "doc_id", "text", wk.entities(spark, sf_dir), **how)
    rows = tagged.select("doc_id", F.posexplode_outer("tags").alias("pos", "pair")).filter("pos IS NOT NULL")
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "pair.token", "pair.tag")


@query
def entity_tags(spark, sf_dir):
    return _entity_tags(spark, sf_dir)


@query
def entity_tags_joined(spark, sf_dir):
    return _entity_tags(spark, sf_dir, limit=0).groupBy("doc_id", "tag").agg(F.count("*").alias("n"))
