"""Table-driven lemmas, part-of-speech filter and entity tags, by lookups in word tables and joins with phrases."""

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.constants import ADJECTIVE_TAGS, NOUN_TAGS, VERB_TAGS
from dumpscope.functions import text as tx
from dumpscope.operators.lookup import dense, joined_hits, looked_up
from dumpscope.operators.small import INLINE_LIMIT, inline_values, sql_list
from dumpscope.operators.tokens import filter_tokens

CONTENT_TAGS = NOUN_TAGS + ADJECTIVE_TAGS + VERB_TAGS
OUTSIDE = "O"


def _tagged(word_tags: DataFrame, tags) -> DataFrame:
    """``_word``, ``_value``: words with any of the tags, as they are."""
    known = word_tags.filter(F.col("tag").isin(*tags)).select(F.col("word").alias("_word")).distinct()
    return known.withColumn("_value", F.col("_word"))


def _lemmatised(word_tags: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``_word``, ``_value``: the verb lemma of words of which any tag has a ``v``, else the noun lemma, or null.

    One row for each word that either table knows, from one aggregate over both.
    """
    is_verb, no = F.lower("tag").contains("v"), F.lit(None).cast("string")
    of_pos = [F.when(F.col("pos") == p, F.col("lemma")).alias(p) for p in "vn"]
    facts = word_tags.select("word", is_verb.alias("verb"), no.alias("v"), no.alias("n"))
    facts = facts.union(lemmas.select("word", F.lit(False), *of_pos)).filter("word IS NOT NULL")
    known = facts.groupBy(F.col("word").alias("_word")).agg(F.max("verb").alias("verb"), F.min("v").alias("v"), F.min("n").alias("n"))
    return known.select("_word", F.when(F.col("verb"), F.col("v")).otherwise(F.col("n")).alias("_value"))


def _content(word_tags: DataFrame, lemmas: DataFrame, tags=CONTENT_TAGS) -> DataFrame:
    """``_word``, ``_value``: the lemmas, or words without one, that have any of the tags; the word tables are joined first."""
    forms = _lemmatised(word_tags, lemmas).select(F.col("_word").alias("_from"), F.coalesce("_value", "_word").alias("_form"))
    forms = forms.join(_tagged(word_tags, tags), F.col("_form") == F.col("_word"))
    return forms.select(F.col("_from").alias("_word"), F.col("_form").alias("_value"))


def framed(tokens: Column) -> Column:
    """A blank, then every token followed by a blank."""
    return F.concat(F.lit(" "), F.array_join(F.transform(tokens, lambda t: F.concat(t, F.lit(" "))), ""))


def _kept(found: DataFrame, key: str, name: str) -> DataFrame:
    """``key`` and the values that were found, framed by blanks."""
    return found.select(key, framed(F.filter("found", lambda t: t.isNotNull())).alias(name))


def lemmatise(
    df: DataFrame, key: str, text: str, word_tags: DataFrame, lemmas: DataFrame, name: str = "text", limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key`` and the text with every whitespace token replaced by its lemma, if there is one."""
    known = _lemmatised(word_tags, lemmas).filter("_value IS NOT NULL")
    found = looked_up(df, key, tx.blank_tokens(F.col(text)), known, limit=limit)
    replaced = F.zip_with("tokens", "found", lambda token, lemma: F.coalesce(lemma, token))
    return found.select(key, tx.join_tokens(replaced).alias(name))


def keep_tagged(
    df: DataFrame, key: str, text: str, word_tags: DataFrame, tags=CONTENT_TAGS, name: str = "text", limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key`` and the whitespace tokens of the text whose tag is one of ``tags``, framed by blanks."""
    return _kept(looked_up(df, key, tx.blank_tokens(F.col(text)), _tagged(word_tags, tags), limit=limit), key, name)


def normalise_text(
    df: DataFrame,
    key: str,
    text: str,
    stop_words: DataFrame,
    word_tags: DataFrame,
    lemmas: DataFrame,
    name: str = "text",
    limit: int = INLINE_LIMIT,
) -> DataFrame:
    """Stop words out, lemmas in, then nouns, adjectives and verbs only; each token is looked up once in the joined word tables."""
    words = tx.words(F.coalesce(text, F.lit("")))
    kept = filter_tokens(df, key, words, stop_words, keep=False, limit=limit)
    return _kept(looked_up(kept, key, F.col("tokens"), _content(word_tags, lemmas), limit=limit), key, name)


def _grams(n: int, tokens: str = "_tokens") -> Column:
    """The n-gram at each position, null at the last ones, by pairing the token list with itself moved on."""
    phrases = F.col(tokens)
    for k in range(1, n):
        moved = F.slice(tokens, k + 1, F.greatest(F.size(tokens), F.lit(1)))
        phrases = F.zip_with(phrases, moved, lambda a, b: F.concat(a, F.lit(" "), b))
    return phrases


def _inline_hits(texts: DataFrame, key: str, entries: list) -> DataFrame:
    """Longest hit per position, with the phrases as hash sets, one for each length and tag."""
    sets = defaultdict(lambda: defaultdict(list))
    for row in entries:
        sets[row["_n"]][row["_tag"]].append(row["phrase"])
    none = f"transform(_tokens, t -> struct(0 AS n, '{OUTSIDE}' AS tag))"
    texts = texts.select(key, "_tokens", F.expr(none).alias("_hits"))
    for n in sorted(sets):
        members = sql_list([p for phrases in sets[n].values() for p in phrases])
        cases = " ".join(f"WHEN g IN ({sql_list(phrases)}) THEN {sql_list([tag])}" for tag, phrases in sets[n].items())
        tag = f"CASE WHEN g IN ({members}) THEN CASE {cases} END END"
        found = texts.select(key, "_tokens", "_hits", _grams(n).alias("_grams"))
        found = found.select(key, "_tokens", "_hits", F.expr(f"transform(_grams, g -> {tag})").alias("_found"))
        longer = F.zip_with(
            "_hits",
            "_found",
            lambda hit, tag: F.when(tag.isNotNull(), F.struct(F.lit(n).alias("n"), tag.alias("tag"))).otherwise(hit),  # noqa: B023
        )
        texts = found.select(key, "_tokens", longer.alias("_hits"))
    return texts


def _joined_hits(df: DataFrame, key: str, tokens: Column, phrases: DataFrame, lengths: list[int]) -> DataFrame:
    """Longest hit per position, from a join of all n-grams with the phrases; only n-grams that are phrases are grouped."""

    def placed(n: int) -> Column:
        return F.transform(_grams(n, "tokens"), lambda p, i: F.struct(i.alias("pos"), F.lit(n).alias("n"), p.alias("word")))

    every = F.concat(F.array().cast("array<struct<pos:int,n:int,word:string>>"), *[placed(n) for n in sorted(lengths)])
    table = phrases.select(F.col("phrase").alias("_word"), F.col("_tag").alias("_value"))
    found = joined_hits(df, key, tokens, every, table)

    following = F.concat(F.slice("hits", 2, F.greatest(F.size("hits"), F.lit(1))), F.array(F.lit(None)))
    pairs = F.zip_with("hits", following, lambda h, f: F.struct(h.alias("hit"), f["pos"].alias("next")))
    longest = F.filter(pairs, lambda p: p["hit"].isNotNull() & ~p["hit"]["pos"].eqNullSafe(p["next"]))
    texts = found.select(key, "tokens", F.transform(longest, lambda p: p["hit"]).alias("_longest"))
    none = F.struct(F.lit(0).alias("n"), F.lit(OUTSIDE).alias("tag"))
    hits = dense(F.col("_longest"), F.size("tokens"), lambda h: F.struct(h["n"].alias("n"), h["value"].alias("tag")), none)
    return texts.select(key, F.col("tokens").alias("_tokens"), hits.alias("_hits"))


def entity_tags(
    df: DataFrame, key: str, text: str, entities: DataFrame, name: str = "tags", limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key`` and, per whitespace token, a (token, tag) pair from the longest phrase that starts first.

    Up to ``limit`` phrases are held in the expression, and every text is tagged where it lies. More are joined with
    the word n-grams of the lengths they have; an n-gram finds at most one phrase, whichever words are common, and
    only n-grams that found one are grouped by text again.
    Per text, the longest hit of each position becomes one letter, and a pattern of one alternative per
    length reads the letters from left to right, skipping what a chosen phrase covers. Tokens outside
    phrases are tagged ``O``.
    """
    phrases = entities.filter("phrase <> ''").groupBy("phrase").agg(F.min("tag").alias("_tag"))
    sized = phrases.withColumn("_n", F.size(F.split("phrase", " ")))
    tokens = F.coalesce(tx.blank_tokens(F.col(text)), F.array().cast("array<string>"))
    entries = inline_values(sized, limit)
    if entries is not None:
        lengths = sorted({row["_n"] for row in entries})
        texts = _inline_hits(df.select(key, tokens.alias("_tokens")), key, entries)
    else:
        lengths = sorted(row[0] for row in sized.select("_n").distinct().collect())
        texts = _joined_hits(df, key, tokens, phrases, lengths)

    letters = [chr(0x100 + n) for n in range(max(lengths, default=0) + 1)]
    readings = "|".join([letters[n] + "." * (n - 1) for n in reversed(lengths)] + [letters[0]])
    coded = F.array_join(F.transform("_hits", lambda h: F.get(F.lit(letters), h["n"])), "")
    chosen = F.regexp_extract_all(coded, F.lit(readings), F.lit(0))
    texts = texts.select(key, "_tokens", "_hits", chosen.alias("_chosen"))

    # Lists are only paired by position: a list used inside a function of another's elements would be
    # computed anew for every element.
    offsets = F.flatten(F.transform("_chosen", lambda c: F.sequence(F.lit(0), F.length(c) - 1)))
    first = F.zip_with("_hits", offsets, lambda h, o: F.when(o == 0, h["tag"]))
    starts = F.filter(first, lambda tag: tag.isNotNull())
    tags = F.flatten(F.zip_with(starts, "_chosen", lambda tag, c: F.array_repeat(tag, F.length(c))))
    pairs = F.zip_with("_tokens", tags, lambda token, tag: F.struct(token.alias("token"), tag.alias("tag")))
    return texts.select(key, pairs.alias(name))
