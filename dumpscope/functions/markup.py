"""Structure of an article body: links, headings, bold, prose and plain text.

A body is one string in which every line ends with a newline, but for a last one that an end marker cut. All patterns stay inside a line unless they
say ``(?s)``, so one pass over the body gives what a loop over lines would. Plain text alone works on the list of
lines, as it can skip most of them.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumpscope.constants import (
    BOLD_BETWEEN,
    BOLD_PAIRED,
    HEADING_PATTERNS,
    LINK,
    NESTED_LINK,
    NO_PLAIN_TEXT,
    PRINTABLE,
    PROSE_LINE,
    SPANS,
)
from dumpscope.functions.titles import strip


def all_lines(body: Column) -> Column:
    """The body's lines, and what stands before an end marker in the middle of a line, or an empty text."""
    return F.split(body, "\n")


def lines(body: Column) -> Column:
    """The body's complete lines; an empty body has none."""
    parts = all_lines(body)
    return F.slice(parts, 1, F.size(parts) - 1)


def clean_link(link: Column) -> Column:
    """Topic of a link: the part before the first ``|``, then before the first ``#``."""
    return F.substring_index(F.substring_index(link, "|", 1), "#", 1)


def _topics(links: Column) -> Column:
    return F.filter(
        F.transform(links, clean_link), lambda t: (t != "") & ~t.contains(":") & t.rlike(PRINTABLE)
    )


def wikilinks(body: Column) -> Column:
    """Topics of ``[[..]]`` links, non-overlapping, each up to the next ``]]``."""
    return _topics(F.regexp_extract_all(body, F.lit(LINK), F.lit(1)))


def wikilinks_nested(body: Column) -> Column:
    """Topics of every ``[[`` that some ``]]`` follows on its line, nested ones included, stripped."""
    raw = F.regexp_extract_all(body, F.lit(NESTED_LINK), F.lit(1))
    return _topics(F.transform(raw, strip))


def heading_lines(body: Column) -> Column:
    """Whole lines that are headings of any level."""
    return F.regexp_extract_all(body, F.lit(HEADING_PATTERNS["headings"]), F.lit(0))


def headings_among(found: Column, kind: str = "headings") -> Column:
    """Of some heading lines those of a kind (all, or ``headings_level2`` .. ``headings_level5``), without ``=``."""
    if kind != "headings":
        found = F.filter(found, lambda h: h.rlike(HEADING_PATTERNS[kind]))
    return F.transform(found, lambda h: F.btrim(h, F.lit("=")))


def headings(body: Column, kind: str = "headings") -> Column:
    return headings_among(heading_lines(body), kind)


def bold(body: Column, mode: str = "lookaround") -> Column:
    """Runs of word and space characters between ``'''`` marks.

    ``lookaround`` consumes no marks, so the text between two bold runs counts as well; ``paired``
    takes marks two by two.
    """
    patterns = {"lookaround": BOLD_BETWEEN, "paired": BOLD_PAIRED}
    if mode not in patterns:
        raise ValueError(f"unknown bold mode: {mode}")
    # The lookaround starts at the last quote of a mark, so that only quotes are looked back from.
    return F.regexp_extract_all(body, F.lit(patterns[mode]), F.lit(1))


def prose_lines(found: Column) -> Column:
    """Only the lines that start with a word character, or with ``[[`` that opens no file link."""
    return F.filter(found, lambda x: x.rlike(PROSE_LINE))


def _without_spans(found: Column, opening: str, closing: str) -> Column:
    """Cut closed spans, the rest after an opening and all up to the first closing out of each line.

    Most lines hold neither mark, so a plain search decides whether a pattern runs at all.
    """
    a, b = re.escape(opening), re.escape(closing)

    def closed(line: Column) -> Column:
        cut = F.regexp_replace(F.regexp_replace(line, f"(?d){a}.*?{b}", ""), f"(?d){a}.*", "")
        return F.when(line.contains(opening), cut).otherwise(line)

    def unopened(line: Column) -> Column:
        cut = F.replace(F.regexp_replace(line, f"(?d)^.*?{b}", ""), F.lit(closing), F.lit(""))
        return F.when(line.contains(closing), cut).otherwise(line)

    return F.transform(F.transform(found, closed), unopened)


def plain_text(found: Column, end: str) -> Column:
    """Drop templates, references and their unbalanced remains per line, then all other markup characters.

    ``end`` follows each line.
    """
    cut = found
    for opening, closing in SPANS:
        cut = _without_spans(cut, opening, closing)
    text = F.array_join(F.transform(cut, lambda line: F.concat(line, F.lit(end))), "")
    # An intersection of classes: Java runs the complement of their union about eight times slower.
    return F.regexp_replace(text, NO_PLAIN_TEXT, "")


def pure_text(found: Column) -> Column:
    """Plain text of the prose among the lines, each followed by a blank."""
    return plain_text(prose_lines(found), " ")


def strip_markup(body: Column) -> Column:
    """Remove comments, references with their contents, and all remaining tags."""
    body = F.regexp_replace(body, r"(?s)<!--.*?-->", "")
    body = F.regexp_replace(body, r"<ref(?:\s[^<>]*)?/>", "")
    body = F.regexp_replace(body, r"(?s)<ref(?:\s[^<>]*)?>.*?</ref>", "")
    return F.regexp_replace(body, r"</?\w[^<>]*>", "")
