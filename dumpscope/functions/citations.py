"""References, external links, citation addresses and their domains."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumpscope.constants import ABSOLUTE_URI, CITATION_KEY, CITATION_URI, DOMAIN, EXTERNAL_LINK, OPENED_REF, REF_CLOSE


def refs(body: Column) -> Column:
    """Text from the nearest ``<ref `` or ``<ref>`` to each ``</ref>``, across lines; self-closing tags open nothing."""
    closed = F.split(body, REF_CLOSE)
    closed = F.slice(closed, 1, F.size(closed) - 1)
    opened = F.filter(closed, lambda p: p.rlike(OPENED_REF))
    return F.transform(opened, lambda p: F.regexp_extract(p, OPENED_REF, 1))


def external_urls(body: Column) -> Column:
    """First ``[http://..]`` or ``[https://..]`` of each line, up to its first blank."""
    return F.regexp_extract_all(body, F.lit(EXTERNAL_LINK), F.lit(1))


def citation_uris(references: Column) -> Column:
    """First ``url=`` of each reference, up to a blank or ``|``."""
    cited = F.filter(references, lambda r: r.contains(CITATION_KEY))
    return F.transform(cited, lambda r: F.regexp_extract(r, CITATION_URI, 1))


def domains(uris: Column) -> Column:
    """Distinct domains in order of first appearance."""
    absolute = F.filter(uris, lambda u: u.rlike(ABSOLUTE_URI))
    return F.array_distinct(F.transform(absolute, lambda u: F.regexp_extract(u, DOMAIN, 1)))
