"""Title and character normalisation."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumpscope.constants import PRINTABLE_HEX, WHITESPACE


def ascii_only(text: Column) -> Column:
    """Drop every non-ASCII character; a text of as many bytes as characters has none."""
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(
        F.regexp_replace(text, r"[^\x00-\x7F]", "")
    )


def strip(text: Column) -> Column:
    """Strip ASCII whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def unix_newlines(text: Column) -> Column:
    """End every line with a plain newline."""
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)


def normalise_title(raw: Column, namespaces: list[str] | None = None) -> Column:
    """Blank-separated, percent-decoded title, or null when it cannot be one.

    A decoded ``%25`` is itself the start of a new escape (``%2541`` reads ``A``), so a run of ``25`` after
    a percent sign collapses first; what is left must then decode to printable ASCII. By default a title
    whose first word ends in a colon is null; with ``namespaces`` only those prefixes are.
    """
    title = F.translate(strip(raw), "_", " ")
    title = F.regexp_replace(title, "%(?:25)+", "%")
    decoded = F.try_url_decode(F.replace(title, F.lit("+"), F.lit("%2B")))
    prefix = r"\w*" if namespaces is None else "(?:" + "|".join(re.escape(n) for n in namespaces) + ")"
    bad = title.rlike(f"%(?!{PRINTABLE_HEX})") | decoded.rlike(f"^{prefix}:")
    return F.when(~bad, decoded)
