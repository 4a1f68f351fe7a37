"""Adaptor: the given tables as dump records and side tables.

The given tables hold no wiki markup, so web pages are rendered into it by fixed rules. The rules are plain
pattern/replacement pairs that Java and RE2 read alike, so that the SQL oracles can apply them too.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dumpscope.constants import TITLE_MARKER
from dumpscope.functions.text import words
from dumpscope.functions.titles import ascii_only, normalise_title
from dumpscope.operators.rank import with_position
from dumpscope.sources.dump import kept_marker, spread

RULES = [
    (r"[^\x00-\x7F]", ""),
    (r"[\r\n]", " "),
    (r"<script>.*?</script>|<style>.*?</style>", ""),
    (r"<title>(.*?)</title>", "\n===\\1===\n"),
    (r"<h1>(.*?)</h1>", "\n==\\1==\n"),
    (r'<a href="([^"]*)">(.*?)</a>', r"[[\1|\2]]"),
    (r"<b>([A-Za-z0-9_ ]+)", r"'''\1'''"),
    (r"<nav>", "\n====Nav====\n[[File:nav.png|thumb|[[Nav]]]]\n"),
    (r'<div class="ad">(.*?)</div>', "\n{{ad|\\1}}\n"),
    (r"<footer>&copy; (\S+).*?</footer>", "\n=====Source=====\n<ref>url=http://\\1/ x</ref>\n"),
    (r"<(?:p|br|article)>", "\n"),
    (r"</?(?:html|head|meta|body|nav|ul|li|h1|p|article|br|title)[^>]*>|<!DOCTYPE[^>]*>", ""),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def record(title: Column, body: Column) -> Column:
    """A dump record as the reader yields it: title line, body lines, start of the end marker.

    Exploding it from a one-element array makes it a column of its own as a scanned one is; otherwise the
    optimizer would copy the whole rendering into every filter on it.
    """
    text = F.concat(F.lit(TITLE_MARKER + " "), title, F.lit("\n"), body, F.lit("\n" + kept_marker()))
    return F.explode(F.array(text))


def page_body() -> Column:
    body = F.col("html")
    for pattern, replacement in RULES:
        body = F.regexp_replace(body, pattern, replacement.replace("\\1", "$1").replace("\\2", "$2"))
    redirect = F.when(F.col("page_id") % 10 == 0, "#REDIRECT\n").otherwise("")
    return F.concat(redirect, F.lit("["), F.col("url"), F.lit(" source]\n"), body)


def page_title() -> Column:
    number = F.col("page_id").cast("string")
    wiki = F.concat(F.lit("Wikipedia:Page_"), number)
    return F.when(F.col("page_id") % 7 == 0, wiki).otherwise(F.concat(F.lit("Page%2C_"), number))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id``, ``value`` for each web page."""
    return spread(table(spark, sf_dir, "pages"), "page_id").select("page_id", record(page_title(), page_body()).alias("value"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``value`` for each document; two neighbours share a title."""
    title = F.concat(F.lit("Doc_"), F.floor(F.col("doc_id") / 2).cast("string"))
    return documents(spark, sf_dir).select("doc_id", record(title, F.col("text")).alias("value"))


def ranked_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rank``, ``title``: the labelled documents in file order; every tenth title is a bad one."""
    ranked = with_position(table(spark, sf_dir, "labels").select("doc_id"), "rank")
    prefix = F.when(F.col("rank") % 10 == 9, "Part:_Doc_").otherwise("Doc%20")
    return ranked.select("rank", normalise_title(F.concat(prefix, "doc_id")).alias("title"))


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``: distinct words of the benchmark texts."""
    text = ascii_only(F.col("text"))
    return table(spark, sf_dir, "benchmark").select(F.explode(words(text)).alias("word")).distinct()


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_words(spark, sf_dir).select(F.lower("word").alias("word")).distinct()


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``term``, ``score``: benchmark words scored from -5 to 5 by a rule."""
    score = (F.length("word") * 7 + F.ascii("word")) % 11 - 5
    return benchmark_words(spark, sf_dir).select(F.col("word").alias("term"), score.alias("score"))


def word_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``, ``tag``: benchmark words tagged by their endings."""
    tag = (
        F.when(F.endswith("word", F.lit("ing")), "VBG")
        .when(F.endswith("word", F.lit("ed")), "VBD")
        .when(F.endswith("word", F.lit("s")), "NNS")
        .when(F.endswith("word", F.lit("tion")), "NN")
        .otherwise("DT")
    )
    return benchmark_words(spark, sf_dir).select("word", tag.alias("tag"))


def ambiguous_word_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``, ``tag``: benchmark words with every tag that their ending allows, one row each."""
    tags = (
        F.when(F.endswith("word", F.lit("ing")), F.array(F.lit("VBG"), F.lit("NN")))
        .when(F.endswith("word", F.lit("ed")), F.array(F.lit("VBD"), F.lit("JJ")))
        .when(F.endswith("word", F.lit("s")), F.array(F.lit("NNS"), F.lit("VBZ")))
        .when(F.endswith("word", F.lit("tion")), F.array(F.lit("NN")))
        .otherwise(F.array(F.lit("DT")))
    )
    return benchmark_words(spark, sf_dir).select("word", F.explode(tags).alias("tag"))


def tagged_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sentence``, ``pos``, ``word``, ``tag``: benchmark sentences tagged by a context rule.

    A word with several tags is nominal (its first tag of ``NN``, ``NNS``, ``JJ``) after a word whose only tag is
    ``DT``, else verbal (its first ``VB`` tag).
    """
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split(ascii_only(F.col("text")), r"[.!?]")).alias("sn", "s"))
    tokens = rows.select(F.struct("item_id", "sn").alias("sentence"), F.posexplode(words(F.col("s"))).alias("pos", "word"))
    options = ambiguous_word_tags(spark, sf_dir).groupBy("word").agg(F.array_sort(F.collect_list("tag")).alias("tags"))
    found = tokens.join(options, "word")
    before = F.lag("tags").over(Window.partitionBy("sentence").orderBy("pos"))
    nominal = F.filter("tags", lambda t: t.isin("NN", "NNS", "JJ"))
    verbal = F.filter("tags", lambda t: t.startswith("VB"))
    after_dt = F.coalesce(before == F.array(F.lit("DT")), F.lit(False))
    tag = F.when(F.size("tags") == 1, F.col("tags")[0]).when(after_dt & (F.size(nominal) > 0), nominal[0]).when(F.size(verbal) > 0, verbal[0])
    return found.select("sentence", "pos", "word", F.coalesce(tag, F.col("tags")[0]).alias("tag"))


def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``, ``pos``, ``lemma``: benchmark words without their endings."""
    base = benchmark_words(spark, sf_dir)
    verb = base.select("word", F.lit("v").alias("pos"), F.regexp_replace("word", "(?:ing|ed)$", "").alias("lemma"))
    noun = base.select("word", F.lit("n").alias("pos"), F.regexp_replace("word", "s$", "").alias("lemma"))
    return verb.unionByName(noun).filter("lemma <> word")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``phrase``, ``tag``: phrases of one to three tokens of every nine tokens of the benchmark texts."""
    tokens = F.split(F.col("text"), " ")
    nines = F.transform(F.sequence(F.lit(1), F.size(tokens), F.lit(9)), lambda at: F.slice(tokens, at, 9))
    rows = table(spark, sf_dir, "benchmark").select(F.explode(nines).alias("t"))
    phrases = [
        (F.array_join(F.slice("t", 1, 3), " "), "PERSON"),
        (F.array_join(F.slice("t", 2, 2), " "), "ORGANIZATION"),
        (F.array_join(F.slice("t", 5, 2), " "), "LOCATION"),
        (F.array_join(F.slice("t", 9, 1), " "), "LOCATION"),
    ]
    pairs = F.array(*[F.struct(p.alias("phrase"), F.lit(t).alias("tag")) for p, t in phrases])
    return rows.select(F.inline(pairs)).distinct()
