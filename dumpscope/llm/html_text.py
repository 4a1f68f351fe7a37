"""Main text of web pages by consensus of a host's pages on where the text stands.

First every page's containers are scored by the text in them that is not navigation and not links. Each page votes, with shares
of its scores, for generalised paths of tags and classes (numbers in class names are one sign), and the votes of a host's
pages are added in Spark. Then every page is read again and the blocks inside its host's winning path are its text; a page
that has nothing there uses its own best container. Parts that are never text, such as menus, notices, forms and
comments, are left out by tag, class, id or role.

Null and empty pages give an empty text. Pages without a host in their url vote together. Ties between paths go to the first in
order. Pages that repeat count and return once each. Long pages are read whole; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Winning paths up to this many hosts are broadcast, some 100 bytes each; beyond, the join is salted.
BROADCAST_HOSTS = 200_000
SALTS = 16

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NUMBER = re.compile(r"\d+")
_PART = re.compile(r"[^a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object xmp noembed noframes".split())
NEVER = frozenset("nav footer aside form button select dialog menu head header label fieldset figure-ad".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("html body main article section div td center blockquote".split())
#: Start tags that end an open element of the same kind.
SIBLINGS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
    "table ul figure".split()
)
#: Words in class, id and role names of parts that are not the article.
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promoted promotion related recommended reply replies respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags toolbar widget contentinfo complementary gdpr "
    "alert login".split()
)
#: How much a container's name speaks for it.
FAVOURED = {"article": 4.0, "main": 3.0, "body": 0.6, "html": 0.5}
CONTENT = frozenset("article content entry post story text main body".split())


def _attributes(raw: str) -> tuple[str, bool, frozenset[str]]:
    """Generalised classes, whether the part is not text, and the words of its names."""
    if not raw or "=" not in raw and "hidden" not in raw.lower():
        return "", False, frozenset()
    classes, words, hidden = [], set(), False
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value == "true"
        else:
            words.update(_PART.split(value))
            if name == "class":
                classes += _NUMBER.sub("#", value).split()
    return "".join(f".{c}" for c in sorted(set(classes))), hidden or bool(words & NOT_TEXT), frozenset(words)


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """Container path, text and number of characters inside links of each block of text, in page order."""
    stack: list[tuple[str, str, bool]] = []  # tag, generalised name if a container, not text
    path: tuple[str, ...] = ()
    muted, links, inside = 0, 0, 0
    text: list[str] = []
    at = 0

    def flush() -> tuple[tuple[str, ...], str, int] | None:
        nonlocal inside
        joined = " ".join(html.unescape("".join(text)).split())
        out = (path, joined, inside) if joined else None
        text.clear()
        inside = 0
        return out

    def close(to: int) -> None:
        nonlocal path, muted, links
        while len(stack) > to:
            tag, name, mute = stack.pop()
            muted -= mute
            links -= tag == "a"
            if name:
                path = path[:-1]

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if not muted and m.start() > at:
            text.append(page[at : m.start()])
            inside += (m.start() - at) * bool(links)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ending, raw = bool(m[1] or m[4]), m[3] if m[2] else m[6]
        if tag in RAW:
            if not ending and not raw.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        block = tag not in INLINE
        if block and (out := flush()):
            yield out
        if ending:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in VOID:
            continue
        ends = SIBLINGS.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else set())
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k)
                    break
                if stack[k][1] or stack[k][0] in ("table", "ul", "ol", "dl"):
                    break
        names, mute, words = _attributes(raw)
        if tag == "header" or tag in ("html", "body", "main", "article"):
            # The article's own head is text, and names that a theme gives the whole page say nothing.
            mute = tag == "header" and not any(x.startswith(("article", "main")) for x in path)
        else:
            mute |= tag in NEVER
        name = ""
        if tag in CONTAINERS:
            name = tag + names + ("+" if words & CONTENT else "")
            path = (*path, name)
        stack.append((tag, name, mute))
        muted += mute
        links += tag == "a"
        if raw.endswith("/") and block and tag not in CONTAINERS:
            close(len(stack) - 1)
    if not muted and at < len(page):
        text.append(page[at:])
    if out := flush():
        yield out


def scores(found: list[tuple[tuple[str, ...], str, int]]) -> dict[str, float]:
    """Score of each container path of a page; the shares of a page sum to 1."""
    out: dict[str, float] = defaultdict(float)
    for path, text, inside in found:
        for k in range(len(path) + 1):
            tag = path[k - 1].split(".")[0].rstrip("+") if k else ""
            weight = FAVOURED.get(tag, 0.5 if not k else 1.0) * (1.5 if k and path[k - 1].endswith("+") else 1.0)
            out[">".join(path[:k])] += weight * max(0, len(text) - 2 * inside)
    total = sum(out.values())
    return {p: s / total for p, s in out.items()} if total else {}


def text_at(found: list[tuple[tuple[str, ...], str, int]], winner: str) -> str:
    steps = tuple(winner.split(">")) if winner else ()
    return "\n".join(t for path, t, _ in found if path[: len(steps)] == steps)


def _host():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def winners(pages: DataFrame) -> DataFrame:
    """``host`` and ``path``: where the pages of a host have their text, by their added votes."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, str], float] = defaultdict(float)
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for path, share in scores(list(blocks(page or ""))).items():
                    total[host, path] += share
            hosts, paths = [h for h, _ in total], [p for _, p in total]
            columns = [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(total.values(), pa.float64())]
            yield pa.record_batch(columns, names=["host", "path", "votes"])

    votes = pages.select(_host().alias("host"), "html").mapInArrow(vote, "host string, path string, votes double")
    # Rounded, as the order of adding must not decide between equals.
    total = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    best = F.min(F.struct(-F.col("votes"), "path"))
    return total.groupBy("host").agg(best.alias("best")).select("host", F.col("best.path").alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page, and the ``path`` that its text came from."""
    from dumpscope.llm.common import written

    own = pages.select(F.col("page_id").cast("long"), "url", "html").withColumn("host", _host())
    best = written(winners(pages), "paths")
    if best.count() <= BROADCAST_HOSTS:
        own = own.join(F.broadcast(best), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
        spread = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = own.withColumn("salt", salt).join(spread, ["host", "salt"], "left")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = [], []
            for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True):
                found = list(blocks(page or ""))
                text = text_at(found, path) if path is not None else ""
                if found and not text:
                    own = scores(found)
                    path = min(own, key=lambda p: (-own[p], p), default="")
                    text = text_at(found, path)
                texts.append(text)
                paths.append(path)
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(paths, pa.string())]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), *columns], names=["page_id", "url", "text", "n_chars", "path"])

    own = own.select("page_id", "url", "html", "path")
    return own.mapInArrow(extract, "page_id long, url string, text string, n_chars long, path string")
