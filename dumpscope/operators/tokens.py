"""Token tables and membership filters on token lists.

A token list is looked up in one of two ways. A word table with at most ``INLINE_LIMIT`` rows becomes a hash set
inside the expression, so each row is filtered where it is. A larger one is joined: rows are spread by their
key before they are exploded, so the regrouping that follows needs no further shuffle when the join is
broadcast, and only the tokens that were found are grouped again. No join carries a hint: Catalyst broadcasts a
side below its size threshold and otherwise sort-merges, where adaptive execution splits hot words.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.operators.lookup import id_of, looked_up
from dumpscope.operators.small import INLINE_LIMIT, inline_values, sql_list


def numbered(df: DataFrame, key: str, *values: Column) -> DataFrame:
    """``_id``, a number of the row with its ``key``, and the values: rows with equal or null keys stay apart."""
    return df.select(id_of(key).alias("_id"), *values)


def explode_tokens(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``key``, ``pos``, ``token``: one row per token, or one of nulls for an empty list.

    ``key`` must be unique in ``df``.
    """
    rows = df.select(key, tokens.alias("_tokens")).repartition(key)
    return rows.select(key, F.posexplode_outer("_tokens").alias("pos", "token"))


def regroup_tokens(tokens: DataFrame, key: str, name: str = "tokens") -> DataFrame:
    """``key`` and its token list in position order; null tokens are left out."""
    placed = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    grouped = tokens.groupBy(key).agg(F.array_sort(F.collect_list(placed)).alias("_placed"))
    return grouped.select(key, F.col("_placed.token").alias(name))


def filter_tokens(
    df: DataFrame,
    key: str,
    tokens: Column,
    words: DataFrame,
    keep: bool = True,
    form: str = "token",
    limit: int = INLINE_LIMIT,
) -> DataFrame:
    """``key`` and the ``tokens`` whose ``form`` is (or with ``keep=False`` is not) in ``words``.

    ``form`` is a SQL expression over ``token``. Every row stays, if need be with an empty list; keys need not be
    unique.
    """
    known = words.select(F.col(words.columns[0]).alias("_word")).filter("_word IS NOT NULL")
    rows = inline_values(known, limit)
    if rows is not None:
        members = sql_list(sorted({r["_word"] for r in rows})) or "NULL"
        test = f"coalesce({form} IN ({members}), false) = {str(keep).lower()}"
        listed = df.select(key, tokens.alias("_tokens"))
        return listed.select(key, F.expr(f"filter(_tokens, token -> {test})").alias("tokens"))
    table = known.distinct().withColumn("_value", F.lit(True))
    found = looked_up(df, key, tokens, table, form=form, limit=0)
    marked = F.arrays_zip(F.col("tokens").alias("token"), F.col("found").alias("found"))
    kept = F.filter(marked, lambda t: t["found"].isNotNull() if keep else t["found"].isNull())
    return found.select(key, F.transform(kept, lambda t: t["token"]).alias("tokens"))
