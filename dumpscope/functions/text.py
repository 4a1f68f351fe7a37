"""Sentences, words and tokens."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumpscope.functions.titles import strip


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; null gives an empty array."""
    parts = F.array_remove(F.split(strip(text), r"(?<=[.!?])\s+"), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """Runs of letters, digits and apostrophes, case kept."""
    return F.regexp_extract_all(text, F.lit("[A-Za-z0-9']+"), F.lit(0))


def lower_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def blank_tokens(text: Column) -> Column:
    """Whitespace-separated tokens."""
    return F.array_remove(F.split(text, r"[ \t\n\x0B\f\r]+"), "")


def dictionary_tokens(text: Column) -> Column:
    """Lower-case whitespace tokens reduced to their run of ``[a-z'.]``.

    Foreign characters may stand before or after the run, and one more letter may follow the gap (``(so).``
    gives ``so``); a token with a longer second run is no word.
    """
    printable = F.filter(blank_tokens(F.lower(text)), lambda t: t.rlike(r"^[\x21-\x7E]+$"))
    run = F.transform(
        printable,
        lambda t: F.regexp_extract(t, r"^[^a-z'.]*([a-z'.]+)(?:[^a-z'.]+[a-z'.])?[^a-z'.]*$", 1),
    )
    return F.array_remove(run, "")


# SQL form of a token as looked up in the dictionary: without one final period.
DICTIONARY_FORM = "regexp_replace(token, '[.]$', '')"


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")
