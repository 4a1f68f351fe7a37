"""Dump records to articles: one row per complete article with its title and body."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.constants import END_MARKER, TITLE_MARKER, WHITESPACE
from dumpscope.functions.titles import ascii_only, normalise_title, strip, unix_newlines
from dumpscope.sources.dump import kept_marker


def segment(
    records: DataFrame,
    match: str = "contains",
    on_bad_title: str | None = None,
    to_ascii: bool = True,
    namespaces: list[str] | None = None,
    title_marker: str = TITLE_MARKER,
    end_marker: str = END_MARKER,
) -> DataFrame:
    """Articles of the records: all columns but ``value``, then ``title`` and ``body``.

    ``match="contains"`` accepts markers anywhere in a line and takes the last blank-separated piece of the
    title line; a bad title becomes null. ``match="prefix"`` wants markers at the start of a line, takes the
    last whitespace-separated piece, and starts the article at the first title line with a good title,
    dropping it when there is none. ``on_bad_title`` ("null" or "drop") overrides the default of each.
    Records without title line or end marker are junk or truncated and give no row. Every line of
    ``body`` ends with a newline; text before an end marker in the middle of a line stands last, without one.

    Records are cleaned before markers are looked for, once: a filter on titles, which the optimizer moves down, finds
    the cleaned text as a column.
    """
    if match not in ("contains", "prefix"):
        raise ValueError(f"unknown marker match: {match}")
    on_bad_title = on_bad_title or ("null" if match == "contains" else "drop")
    if on_bad_title not in ("null", "drop"):
        raise ValueError(f"unknown bad-title policy: {on_bad_title}")
    clean = ascii_only if to_ascii else (lambda text: text)
    normalise = lambda token: normalise_title(token, namespaces)
    kept = kept_marker(end_marker, title_marker)
    if match == "contains":
        articles = _containing(records, title_marker, kept, clean, normalise)
    else:
        articles = _prefixed(records, title_marker, kept, clean, normalise, on_bad_title)
    return articles.filter("title IS NOT NULL") if on_bad_title == "drop" else articles


def _finish(articles: DataFrame, others: list[str], kept: str) -> DataFrame:
    """Cut the line end of the title and the rest of the end marker off ``_text``."""
    body = F.substr("_text", F.lit(2), F.greatest(F.length("_text") - len(kept) - 1, F.lit(0)))
    return articles.select(*others, "title", body.alias("body"))


def _cleaned(records: DataFrame, kept: str, clean) -> DataFrame:
    """Complete records with ``_clean``, a newline and the cleaned text; exploding makes it a column that no filter computes anew."""
    others = [c for c in records.columns if c != "value"]
    text = F.concat(F.lit("\n"), unix_newlines(clean(F.col("value"))))
    return records.filter(F.col("value").endswith(kept)).select(*others, F.explode(F.array(text)).alias("_clean"))


def _containing(records: DataFrame, marker: str, kept: str, clean, normalise) -> DataFrame:
    others = [c for c in records.columns if c != "value"]
    at = F.locate(marker, F.col("_clean"))
    rest = F.substr("_clean", at)
    # The title line must be complete: a line that also ends the record opens no article.
    complete = _cleaned(records, kept, clean).filter((at > 0) & rest.contains("\n"))
    before = F.substring_index(F.substr("_clean", F.lit(1), at - 1), "\n", -1)
    after = F.substring_index(rest, "\n", 1)
    title = normalise(F.substring_index(strip(F.concat(before, after)), " ", -1))
    text = F.substr(rest, F.length(after) + 1)
    return _finish(complete.select(*others, title.alias("title"), text.alias("_text")), others, kept)


def _prefixed(records: DataFrame, marker: str, kept: str, clean, normalise, on_bad_title: str) -> DataFrame:
    others = [c for c in records.columns if c != "value"]

    def title_of(line: Column) -> Column:
        blanks = F.translate(strip(line), WHITESPACE, " " * len(WHITESPACE))
        return normalise(F.substring_index(blanks, " ", -1))

    cleaned = _cleaned(records, kept, clean)
    title_line = r"(?d)\n\Q" + marker + r"\E[^\n]*(?=\n)"
    found = F.regexp_extract_all("_clean", F.lit(title_line), F.lit(0))
    titles = cleaned.select(*others, "_clean", F.transform(found, title_of).alias("_titles"))
    good = F.array_position(F.transform("_titles", lambda t: t.isNotNull()), F.lit(True)).cast("int")
    start = F.greatest(good, F.least(F.size("_titles"), F.lit(1))) if on_bad_title == "null" else good
    started = titles.select("*", start.alias("_start")).filter("_start > 0")
    openings = F.split("_clean", r"\n\Q" + marker + r"\E(?=[^\n]*\n)")
    rest = F.array_join(F.slice(openings, F.col("_start") + 1, F.size("_titles") + 1), "\n" + marker)
    rest = started.select(*others, F.element_at("_titles", F.col("_start")).alias("title"), rest.alias("_rest"))
    line = F.length(F.substring_index("_rest", "\n", 1))
    return _finish(rest.select(*others, "title", F.substr("_rest", line + 1).alias("_text")), others, kept)
