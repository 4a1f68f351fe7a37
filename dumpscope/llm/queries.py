"""The named queries of the operators, one for each, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.llm import collocations, conversations, suffix_dedup
from dumpscope.llm import classifier, decontaminate, html_text, idfile, jaccard, licences, lm, packing, quality_rules, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"), width=4, percent=85)


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*base, "p_clean")


@query
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.round_trip(table(spark, sf_dir, "documents"))


@query
def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(spark, sf_dir, "conversations"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("rid")


ORACLES["op12_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS rid,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, rid, unnest(ps) AS s, generate_subscripts(ps, 1) AS pi
  FROM (SELECT lang, rid, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS ps FROM d)
), o AS (
  SELECT lang, rid, pi, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT lang, rid, pi, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p)
), nx AS (
  SELECT lang, word AS w1,
         lead(word, 1) OVER q AS w2, lead(word, 2) OVER q AS w3, lead(word, 3) OVER q AS w4, lead(word, 4) OVER q AS w5
  FROM o WINDOW q AS (PARTITION BY rid, pi ORDER BY pos)
), g AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM nx
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM nx WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM nx WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM nx WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM nx WHERE w5 IS NOT NULL
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase
), tot AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, c.ws, j AS cut,
         array_to_string(c.ws[1 : j], ' ') AS lp, array_to_string(c.ws[j + 1 : c.k], ' ') AS rp
  FROM cand c JOIN (SELECT unnest(range(1, 5)) AS j) u ON u.j < c.k
), scored AS (
  SELECT x.lang, x.phrase, x.a, x.cut, l.f AS l, r.f AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * x.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts x
  JOIN f l ON l.lang = x.lang AND l.phrase = x.lp
  JOIN f r ON r.lang = x.lang AND r.phrase = x.rp
  JOIN tot t ON t.lang = x.lang
), best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM scored
  ) WHERE o = 1
), inner_ AS (
  SELECT c.lang, array_to_string(c.ws[i : i + m - 1], ' ') AS phrase, max(c.a) AS outer_a
  FROM cand c JOIN (SELECT unnest(range(2, 5)) AS m) mm ON mm.m < c.k
  JOIN (SELECT unnest(range(1, 5)) AS i) ii ON ii.i <= c.k - mm.m + 1
  GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.outer_a IS NULL OR i.outer_a < b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score, CAST(cut AS BIGINT) AS cut
FROM ranked WHERE rank <= 2000
"""
