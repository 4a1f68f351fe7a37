"""Values of a word table for every token of a list, found where the text lies or by a join.

A table of at most ``limit`` rows goes into the expression as an array of small maps, one for each hash of a word, so
that every token is looked up where it is, in constant time, and nothing is shuffled. A larger one is joined: a text
is moved once by its number and gives one row that carries its tokens and one row for each token. Only the first and
the tokens that were found are grouped again; the others leave at the join. No join carries a hint.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dumpscope.operators.small import INLINE_LIMIT, inline_values, sql_list

#: Maps in the array of an inline table.
BUCKETS = 4096


def id_of(key: str) -> Column:
    """A number of the row with its ``key``: rows with equal or null keys stay apart."""
    return F.struct(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"))


def _literal(value, kind: T.DataType) -> str:
    """SQL text of a collected value."""
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    if isinstance(kind, T.StringType):
        return sql_list([value])
    if isinstance(kind, T.ArrayType):
        return f"array({', '.join(_literal(v, kind.elementType) for v in value)})"
    if isinstance(kind, T.StructType):
        return f"named_struct({', '.join(f'{sql_list([f.name])}, {_literal(value[f.name], f.dataType)}' for f in kind)})"
    if isinstance(kind, T.DoubleType):
        return f"{value!r}D"
    return str(value).lower()


def _inline(tokens: str, rows: list, kind: T.DataType, form: str) -> Column:
    """The value of every element of the column ``tokens``; ``rows`` are (word, value, bucket)."""
    if not rows:
        return F.expr(f"transform({tokens}, token -> CAST(NULL AS {kind.simpleString()}))")
    maps: dict[int, list[str]] = {}
    for word, value, bucket in rows:
        maps.setdefault(bucket, []).append(f"{sql_list([word])}, {_literal(value, kind)}")
    table = ", ".join(f"map({', '.join(maps[b])})" if b in maps else "NULL" for b in range(BUCKETS))
    words = tokens if form == "token" else f"transform({tokens}, token -> {form})"
    found = f"try_element_at(get(array({table}), pmod(hash(word), {BUCKETS})), word)"
    return F.expr(f"transform({words}, word -> {found})")


def joined_hits(df: DataFrame, key: str, tokens: Column, places: Column, table: DataFrame) -> DataFrame:
    """``key``, ``tokens`` and ``hits``: (``pos``, ``n``, ``value``) of the ``places`` found in ``table``, in order.

    ``places`` are structs of ``pos``, ``n`` and ``word`` made from the column ``tokens``; ``table`` has one row for
    each ``_word`` with its ``_value``. The row that carries the tokens has a word of its own, as one null word for
    all of them would be one hot key.
    """
    # A fixed number of partitions is not coalesced: the rows made of a partition are several times its texts.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = df.withColumn("_id", id_of(key)).repartition(partitions, "_id")
    lists = moved.select("_id", F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    own = F.concat(F.lit(" "), F.col("_id.row").cast("string"))
    carrier = F.struct(F.lit(-1).alias("pos"), F.lit(0).alias("n"), own.alias("word"), F.col("tokens").alias("tokens"))
    sought = F.transform(
        F.filter(places, lambda p: p["word"].isNotNull()),
        lambda p: F.struct(p["pos"].alias("pos"), p["n"].alias("n"), p["word"].alias("word"), F.lit(None).cast("array<string>").alias("tokens")),
    )
    rows = lists.select("_id", F.explode(F.concat(F.array(carrier), sought)).alias("_p")).select("_id", "_p.*")
    found = rows.join(table, F.col("word") == F.col("_word"), "left").filter("pos < 0 OR _word IS NOT NULL")
    hit = F.when(F.col("pos") >= 0, F.struct("pos", "n", F.col("_value").alias("value")))
    grouped = found.groupBy("_id").agg(F.first("tokens", ignorenulls=True).alias("tokens"), F.array_sort(F.collect_list(hit)).alias("hits"))
    return grouped.select(F.col("_id.key").alias(key), "tokens", "hits")


def dense(hits: Column, size: Column, value, empty: Column) -> Column:
    """``value`` of each hit at its position, ``empty`` at the others; ``hits`` have one entry at most for a position."""
    none = F.struct(size.alias("pos"))
    places = F.transform(hits, lambda h: F.struct(h["pos"].alias("pos")))
    following = F.concat(F.slice(places, 2, F.greatest(F.size(hits), F.lit(1))), F.array(none))
    runs = F.zip_with(
        hits,
        following,
        lambda h, f: F.when(h.isNotNull(), F.concat(F.array(value(h)), F.array_repeat(empty, f["pos"] - h["pos"] - 1))),
    )
    before = F.array_repeat(empty, F.coalesce(F.get(hits, F.lit(0))["pos"], size))
    return F.concat(before, F.flatten(F.filter(runs, lambda r: r.isNotNull())))


def looked_up(
    df: DataFrame, key: str, tokens: Column, table: DataFrame, form: str = "token", limit: int = INLINE_LIMIT
) -> DataFrame:
    """``key``, ``tokens`` and ``found``, the value in ``table`` of each token's ``form``, or null.

    ``table`` has one row for each ``_word``, with its ``_value``; null words match nothing. ``form`` is a SQL
    expression over ``token``. Every row of ``df`` stays, null lists as empty ones; keys need not be unique.
    """
    table = table.select("_word", "_value").filter("_word IS NOT NULL")
    kind = table.schema["_value"].dataType
    rows = inline_values(table.select("_word", "_value", F.expr(f"pmod(hash(_word), {BUCKETS})")), limit)
    if rows is not None:
        lists = df.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
        return lists.select(key, "tokens", _inline("tokens", rows, kind, form).alias("found"))
    places = F.expr(f"transform(transform(tokens, token -> {form}), (word, i) -> struct(i AS pos, 1 AS n, word AS word))")
    hits = joined_hits(df, key, tokens, places, table)
    found = dense(F.col("hits"), F.size("tokens"), lambda h: h["value"], F.lit(None).cast(kind))
    return hits.select(key, "tokens", found.alias("found"))
