"""SQL oracles: the rows each named query must give, computed by another engine.

Where the rendered markup allows it, an oracle reads the answer off the raw web page instead of the rendered
text, so that it shares nothing with the parser it checks.
"""

from dumpscope.catalog.queries import KEYWORD, LOOKUP
from dumpscope.catalog.wikify import RULES

# The default English stop words of Spark.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is
are was were be been being have has had having do does did doing a an the and but if or because as until
while of at by for with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()

ORACLES: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace_all(text: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(replacement)}, 'g')"


def chain(text: str, *patterns: str) -> str:
    for pattern in patterns:
        text = replace_all(text, pattern)
    return text


def find_all(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, {q(pattern)}, {group})"


def ascii_text(text: str) -> str:
    return replace_all(text, r"[^\x00-\x7F]")


def long(key: str, values: str, name: str, source: str) -> str:
    """One row per list entry with its position."""
    return (
        f"SELECT {key}, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS {name} "
        f"FROM (SELECT {key}, {values} AS l FROM {source})"
    )


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join(ctes) + " "


BLANK = r"[ \t\n\x0B\f\r]+"
STRIPPED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORD = "[A-Za-z0-9']+"
TITLE = "CASE WHEN page_id % 7 <> 0 THEN 'Page, ' || page_id END"

# Raw pages, and pages rendered by the same rules.
HTML = f"html AS (SELECT page_id, url, {replace_all(ascii_text('html'), '[\\r\\n]', ' ')} AS h FROM pages)"
_rendered = "html"
for _pattern, _replacement in RULES:
    _rendered = replace_all(_rendered, _pattern, _replacement)
PAGES = (
    f"pg AS (SELECT page_id, {TITLE} AS title, "
    f"CASE WHEN page_id % 10 = 0 THEN '#REDIRECT' || chr(10) ELSE '' END || "
    f"'[' || {ascii_text('url')} || ' source]' || chr(10) || {_rendered} || chr(10) AS body FROM pages)"
)
# Documents as articles.
DOCS = (
    "dc AS (SELECT doc_id, 'Doc ' || (doc_id // 2) AS title, "
    f"{replace_all(ascii_text('text'), '\\r\\n?', chr(10))} || chr(10) AS body FROM documents)"
)


def lines(source: str, key: str) -> str:
    body = "list_slice(string_split(body, chr(10)), 1, -2)"
    return f"ln AS ({long(key, body, 'line', source)})"


PROSE = r"regexp_matches(line, '^(?:\w|\[\[)') AND NOT starts_with(line, '[[File:')"
PLAIN = chain(
    "line",
    r"\{\{.*?\}\}",
    r"\{\{.*$",
    r"^.*?\}\}",
    r"\}\}",
    r"<ref.*?</ref>",
    r"<ref.*$",
    r"^.*?</ref>",
    r"</ref>",
    r"[^\w\s.!,?]",
)


def pure(source: str, key: str) -> str:
    return (
        f"pure AS (SELECT s.{key}, s.title, coalesce(p.pure_text, '') AS pure_text FROM {source} s LEFT JOIN "
        f"(SELECT {key}, string_agg({PLAIN} || ' ', '' ORDER BY pos) AS pure_text FROM ln WHERE {PROSE} GROUP BY {key}) p "
        f"ON s.{key} = p.{key})"
    )


PAGE_LINES = [PAGES, lines("pg", "page_id")]
PAGE_PURE = [*PAGE_LINES, pure("pg", "page_id")]
DOC_PURE = [DOCS, lines("dc", "doc_id"), pure("dc", "doc_id")]

# Counts per page, read off the raw page.
HREFS = find_all("h", '<a href="([^"]*)">', 1)
TOPICS = f"list_transform({HREFS}, lambda x: split_part(split_part(x, '|', 1), '#', 1))"
FOOTER = r"<footer>&copy; (\S+).*?</footer>"
HEADINGS = {
    "headings_level2": find_all("h", "<h1>(.*?)</h1>", 1),
    "headings_level3": find_all("h", "<title>(.*?)</title>", 1),
    "headings_level4": f"list_transform({find_all('h', '<nav>')}, lambda x: 'Nav')",
    "headings_level5": f"list_transform({find_all('h', FOOTER)}, lambda x: 'Source')",
}
ALL_HEADINGS = "list_concat({})".format(", ".join(HEADINGS.values()))
BOLD = find_all("h", "<b>([A-Za-z0-9_ ]+)", 1)
HOSTS = find_all("h", FOOTER, 1)
COUNTS = (
    f"counts AS (SELECT page_id, {TITLE} AS title, len({HREFS}) AS wikilinks, len({ALL_HEADINGS}) AS headings, "
    f"len({BOLD}) AS text_in_bold FROM html)"
)

ORACLES["line_count"] = (
    with_(PAGES) + "SELECT CAST(sum(len(string_split(body, chr(10))) + 1) AS BIGINT) AS n FROM pg"
)
ORACLES["ascii_lines"] = f"SELECT doc_id, {ascii_text('text')} AS text_ascii FROM documents"
ORACLES["title_normalise"] = """
SELECT p_partkey, CASE p_partkey % 8
  WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name WHEN 7 THEN p_name || ' a+b: +c' END AS title
FROM part"""
ORACLES["articles_parsed"] = (
    with_(*PAGE_LINES)
    + "SELECT pg.page_id, any_value(title) AS title, count(*) AS n_lines FROM pg JOIN ln USING (page_id) GROUP BY pg.page_id"
)
ORACLES["articles_prefix"] = (
    with_(PAGES) + "SELECT page_id, title, length(body) AS n_chars FROM pg WHERE title IS NOT NULL"
)
ORACLES["raw_lines"] = with_(*PAGE_LINES) + "SELECT page_id, pos, line FROM ln"
ORACLES["article_count"] = "SELECT count(*) AS articles FROM pages"
ORACLES["preview_articles"] = (
    with_(*PAGE_PURE) + "SELECT page_id, title, pure_text FROM pure ORDER BY page_id LIMIT 5"
)
ORACLES["page_links_long"] = with_(HTML) + long("page_id", TOPICS, "topic", "html")
NESTED = f"list_concat(list_transform({find_all('h', '<nav>')}, lambda x: 'Nav'), {TOPICS})"
ORACLES["page_links_nested"] = with_(HTML) + long("page_id", NESTED, "topic", "html")
ORACLES["link_counts_cursor"] = (
    with_(HTML) + f"SELECT {TITLE} AS title, len({NESTED}) AS n FROM html WHERE page_id % 7 <> 0"
)
ORACLES["headings_long"] = with_(HTML) + " UNION ALL ".join(
    f"SELECT page_id, '{kind}' AS kind, unnest({found}) AS heading FROM html"
    for kind, found in {"headings": ALL_HEADINGS, **HEADINGS}.items()
)
ORACLES["bold_long"] = with_(HTML) + long("page_id", BOLD, "bold", "html")
ORACLES["bold_paired"] = ORACLES["bold_long"]
ORACLES["text_lines"] = (
    with_(*PAGE_LINES)
    + "SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS BIGINT) AS pos, line "
    + f"FROM ln WHERE {PROSE}"
)
ORACLES["plain_text"] = with_(*PAGE_PURE) + "SELECT page_id, pure_text FROM pure"
ORACLES["plain_text_all_lines"] = (
    with_(*PAGE_LINES)
    + f"SELECT page_id, string_agg({PLAIN} || chr(10), '' ORDER BY pos) AS plain FROM ln GROUP BY page_id"
)
STRIPPED_MARKUP = chain(
    "body", r"(?s)<!--.*?-->", r"<ref(?:\s[^<>]*)?/>", r"(?s)<ref(?:\s[^<>]*)?>.*?</ref>", r"</?\w[^<>]*>"
)
ORACLES["markup_stripped"] = with_(PAGES) + f"SELECT page_id, {STRIPPED_MARKUP} AS stripped FROM pg"
ORACLES["refs"] = with_(HTML) + long(
    "page_id", f"list_transform({HOSTS}, lambda x: 'url=http://' || x || '/ x')", "ref", "html"
)
ORACLES["citation_uris"] = with_(HTML) + long(
    "page_id", f"list_transform({HOSTS}, lambda x: 'http://' || x || '/')", "uri", "html"
)
ORACLES["citation_domains"] = with_(HTML) + long("page_id", f"list_distinct({HOSTS})", "domain", "html")
ORACLES["external_urls"] = f"SELECT page_id, CAST(0 AS BIGINT) AS pos, {ascii_text('url')} AS url FROM pages"
ORACLES["url_domains"] = (
    "SELECT page_id, CAST(0 AS BIGINT) AS pos, "
    f"regexp_extract({ascii_text('url')}, {q(r'^\w+://([^/?\s$]*)')}, 1) AS domain FROM pages"
)
ORACLES["non_redirects"] = f"SELECT page_id, {TITLE} AS title FROM pages WHERE page_id % 10 <> 0"
ORACLES["keyword_articles"] = (
    with_(PAGES) + f"SELECT page_id, title FROM pg WHERE contains(body, {q(KEYWORD)})"
)
CHOSEN = f"page_id % 10 <> 0 AND title IS NOT NULL AND contains(body, {q(KEYWORD)})"
ORACLES["keyword_count"] = with_(PAGES) + f"SELECT count(*) AS n FROM pg WHERE {CHOSEN}"
ORACLES["lookup_title"] = (
    with_(*PAGE_PURE) + f"SELECT page_id, title, pure_text FROM pure WHERE title = {q(LOOKUP)}"
)
ORACLES["titled_articles"] = f"SELECT page_id, {TITLE} AS title FROM pages WHERE page_id % 7 <> 0"
ORACLES["link_counts"] = with_(HTML, COUNTS) + "SELECT title, wikilinks AS n FROM counts"
for _name, _metric in (("links", "wikilinks"), ("headings", "headings"), ("bold", "text_in_bold")):
    ORACLES[f"top20_{_name}"] = (
        with_(HTML, COUNTS)
        + f"SELECT title, {_metric} AS n FROM counts WHERE title IS NOT NULL ORDER BY n DESC, title LIMIT 20"
    )
ORACLES["metric_stats"] = with_(HTML, COUNTS) + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, count(*) AS articles, CAST(sum({m}) AS BIGINT) AS total, round(avg({m}), 6) AS mean, "
    f"min({m}) AS min, max({m}) AS max, round(stddev_pop({m}), 6) AS stdev FROM counts"
    for m in ("wikilinks", "headings", "text_in_bold")
)
ORACLES["heading_level_totals"] = (
    with_(HTML)
    + "SELECT "
    + ", ".join(
        f"CAST(sum(len({found})) AS BIGINT) AS {kind}"
        for kind, found in {"headings": ALL_HEADINGS, **HEADINGS}.items()
    )
    + " FROM html"
)
ORACLES["avg_links_floor"] = (
    with_(HTML, COUNTS) + "SELECT CAST(sum(wikilinks) // count(*) AS BIGINT) AS mean_floor FROM counts"
)

# Text.
SPLIT = f"regexp_replace(trim({{}}, {STRIPPED}), {q(r'([.!?])' + BLANK)}, '\\1' || chr(1), 'g')"


def sentence_list(text: str) -> str:
    return f"list_filter(string_split({SPLIT.format(text)}, chr(1)), lambda x: x <> '')"


def blank_list(text: str) -> str:
    return f"list_filter(string_split_regex({text}, {q(BLANK)}), lambda x: x <> '')"


STOPS = "[" + ", ".join(q(w) for w in STOP_WORDS) + "]"


def without_stops(tokens: str) -> str:
    return f"array_to_string(list_filter({tokens}, lambda x: NOT list_contains({STOPS}, x)), ' ')"


ORACLES["sentences_long"] = long("doc_id", sentence_list("text"), "sentence", "documents")
ORACLES["words_long"] = long("doc_id", find_all("text", WORD), "word", "documents")
ORACLES["tokenised_text"] = (
    f"SELECT doc_id, {without_stops(find_all('lower(text)', '[a-z0-9]+'))} AS text FROM documents"
)
ORACLES["stopwords_removed"] = (
    with_(*DOC_PURE) + f"SELECT doc_id, {without_stops(blank_list('pure_text'))} AS text FROM pure"
)
ORACLES["stopwords_removed_words"] = (
    f"SELECT doc_id, {without_stops(find_all('text', WORD))} AS text FROM documents"
)
COUNTED = (
    "SELECT word, count(*) AS n FROM (SELECT unnest({}) AS word FROM {}) "
    f"WHERE NOT list_contains({STOPS}, word) GROUP BY word"
)
ORACLES["word_count_top20"] = (
    with_(*DOC_PURE)
    + COUNTED.format(find_all("lower(pure_text)", "[a-z0-9]+"), "pure")
    + " ORDER BY n DESC, word LIMIT 20"
)
ORACLES["word_counts"] = COUNTED.format(find_all("lower(text)", "[a-z0-9]+"), "documents")

BENCH = f"bw AS (SELECT DISTINCT unnest({find_all(ascii_text('text'), WORD)}) AS word FROM benchmark)"
RUN = r"^[^a-z'.]*([a-z'.]+)(?:[^a-z'.]+[a-z'.])?[^a-z'.]*$"


def dictionary_text(source: str, key: str, text: str) -> str:
    printable = f"list_filter({blank_list(f'lower({text})')}, lambda x: regexp_matches(x, {q('^[!-~]+$')}))"
    runs = f"list_transform({printable}, lambda x: regexp_extract(x, {q(RUN)}, 1))"
    return (
        with_(PAGES, BENCH, "dict AS (SELECT DISTINCT lower(word) AS word FROM bw)", f"tk AS ({long(key, runs, 'token', source)})")
        + f"SELECT s.{key}, coalesce(t.text, '') AS text FROM {source} s LEFT JOIN "
        + f"(SELECT {key}, string_agg(token, ' ' ORDER BY pos) AS text FROM tk JOIN dict "
        + f"ON regexp_replace(token, {q(r'\.$')}, '') = word WHERE token <> '' GROUP BY {key}) t ON s.{key} = t.{key}"
    )


ORACLES["dictionary_text"] = dictionary_text("documents", "doc_id", "text")
ORACLES["dictionary_text_joined"] = ORACLES["dictionary_text"]
ORACLES["keyword_texts"] = dictionary_text("pg", "page_id", "body") + f" WHERE {CHOSEN.replace('page_id', 's.page_id')}"

# Sentiment.
LEXICON = "lex AS (SELECT word AS term, (length(word) * 7 + ascii(word)) % 11 - 5 AS score FROM bw)"


def scored(source: str, key: str, text: str, lower: bool = False) -> list[str]:
    words = find_all("lower(sentence)" if lower else "sentence", WORD)
    return [
        BENCH,
        LEXICON,
        f"se AS ({long(key, sentence_list(text), 'sentence', source)})",
        f"wo AS (SELECT {key}, pos AS sid, unnest({words}) AS term FROM se)",
        f"hits AS (SELECT {key}, sid, sum(greatest(score, 0)) AS p, sum(least(score, 0)) AS n "
        f"FROM wo JOIN lex USING (term) GROUP BY {key}, sid)",
        f"sc AS (SELECT se.{key}, se.pos AS sid, CAST(coalesce(p, 0) AS BIGINT) AS pos, CAST(coalesce(n, 0) AS BIGINT) AS neg "
        f"FROM se LEFT JOIN hits ON se.{key} = hits.{key} AND se.pos = hits.sid)",
        f"po AS (SELECT s.{key}, count(*) FILTER (pos + neg > 0) AS pos, count(*) FILTER (pos + neg < 0) AS neg, "
        f"count(*) FILTER (pos + neg = 0) AS neu FROM {source} s LEFT JOIN sc ON s.{key} = sc.{key} GROUP BY s.{key})",
    ]


ORACLES["sentence_scores"] = with_(*scored("documents", "doc_id", "text")) + "SELECT doc_id, sid, pos, neg FROM sc"
ORACLES["doc_polarity"] = with_(*scored("documents", "doc_id", "text")) + "SELECT doc_id, pos, neg, neu FROM po"
ORACLES["doc_polarity_joined"] = ORACLES["doc_polarity"]
ORACLES["doc_polarity_lower"] = (
    with_(*scored("documents", "doc_id", "text", lower=True)) + "SELECT doc_id, pos, neg, neu FROM po"
)

# Ranked titles.
RANKED = (
    "ranked AS (SELECT rank, CASE WHEN rank % 10 <> 9 THEN 'Doc ' || doc_id END AS title FROM "
    "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rank FROM labels))"
)
ORACLES["title_positions"] = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rank FROM labels"
ORACLES["ranked_titles"] = with_(RANKED) + "SELECT rank, title FROM ranked"
ORACLES["title_texts"] = with_(*DOC_PURE) + "SELECT title, pure_text FROM pure"
ORACLES["ranked_title_texts"] = (
    with_(RANKED, *DOC_PURE) + "SELECT title, pure_text FROM ranked JOIN pure USING (title)"
)
ORACLES["ranked_title_left"] = (
    with_(RANKED, *DOC_PURE) + "SELECT rank, title, doc_id, pure_text FROM ranked LEFT JOIN pure USING (title)"
)
ORACLES["ranked_title_count"] = (
    with_(RANKED, DOCS) + "SELECT count(*) AS n FROM ranked JOIN dc USING (title)"
)
FILMS = [
    RANKED,
    *DOC_PURE,
    *scored("pure", "doc_id", "pure_text"),
    "films AS (SELECT rank, title, pos, neg, neu FROM ranked JOIN pure USING (title) JOIN po USING (doc_id))",
]
ORACLES["ranked_title_sentiment"] = with_(*FILMS) + "SELECT rank, title, pos, neg, neu FROM films"
AVERAGE_RANK = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"
ORACLES["article_polarity"] = (
    with_(*DOC_PURE, *scored("pure", "doc_id", "pure_text"))
    + "SELECT title, doc_id, pos, neg, neu FROM pure JOIN po USING (doc_id)"
)
ORACLES["rank_sentiment_corr"] = (
    with_(*FILMS, "net AS (SELECT rank AS x, pos - neg AS y FROM films)")
    + "SELECT count(*) AS n, round(corr(x, y), 6) AS pearson, round(corr(a, b), 6) AS spearman FROM "
    + f"(SELECT x, y, {AVERAGE_RANK.format('x')} AS a, {AVERAGE_RANK.format('y')} AS b FROM net)"
)

# Lexical tables.
TAGS = (
    "tags AS (SELECT word, CASE WHEN word LIKE '%ing' THEN 'VBG' WHEN word LIKE '%ed' THEN 'VBD' "
    "WHEN word LIKE '%s' THEN 'NNS' WHEN word LIKE '%tion' THEN 'NN' ELSE 'DT' END AS tag FROM bw)"
)
LEMMAS = (
    "lem AS (SELECT * FROM (SELECT word, 'v' AS p, regexp_replace(word, '(?:ing|ed)$', '') AS lemma FROM bw "
    "UNION ALL SELECT word, 'n', regexp_replace(word, 's$', '') FROM bw) "
    "WHERE lemma <> word)"
)
LEMMATISED = (
    "lm AS (SELECT doc_id, pos, coalesce(lemma, token) AS token FROM tk LEFT JOIN tags ON token = tags.word "
    "LEFT JOIN lem ON token = lem.word AND p = CASE WHEN contains(lower(tag), 'v') THEN 'v' ELSE 'n' END)"
)
CONTENT = "tag IN ('VBG', 'VBD', 'NNS', 'NN')"


def document_tokens(tokens: str) -> list[str]:
    return [BENCH, TAGS, LEMMAS, f"tk AS ({long('doc_id', tokens, 'token', 'documents')})", LEMMATISED]


def regrouped(text: str, source: str, empty: str) -> str:
    return (
        f"SELECT d.doc_id, coalesce(t.text, {q(empty)}) AS text FROM documents d LEFT JOIN "
        f"(SELECT doc_id, {text} AS text FROM {source} GROUP BY doc_id) t ON d.doc_id = t.doc_id"
    )


FRAMED = "' ' || string_agg(token || ' ', '' ORDER BY pos)"
ORACLES["lemma_text"] = with_(*document_tokens(blank_list("text"))) + regrouped(
    "string_agg(token, ' ' ORDER BY pos)", "lm", ""
)
ORACLES["pos_filtered"] = with_(*document_tokens(blank_list("text"))) + regrouped(
    FRAMED, f"tk JOIN tags ON token = word AND {CONTENT}", " "
)
UNSTOPPED = f"list_filter({find_all('text', WORD)}, lambda x: NOT list_contains({STOPS}, x))"
ORACLES["normalised_text"] = with_(*document_tokens(UNSTOPPED)) + regrouped(
    FRAMED, f"lm JOIN tags ON token = word AND {CONTENT}", " "
)
_phrases = " UNION ALL ".join(
    f"SELECT array_to_string(list_slice(t, {a}, {b}), ' ') AS phrase, '{tag}' AS tag FROM bt"
    for a, b, tag in ((1, 3, "PERSON"), (2, 3, "ORGANIZATION"), (5, 6, "LOCATION"), (9, 9, "LOCATION"))
)
ORACLES["entity_tags"] = (
    with_(
        "tt AS (SELECT string_split(text, ' ') AS t FROM benchmark)",
        "bt AS (SELECT t[k : k + 8] AS t FROM (SELECT t, unnest(range(1, len(t) + 1, 9)) AS k FROM tt))",
        f"ph AS (SELECT phrase, min(tag) AS tag FROM ({_phrases}) WHERE phrase <> '' GROUP BY phrase)",
        f"tk AS ({long('doc_id', blank_list('text'), 'token', 'documents')})",
        "ng AS (SELECT doc_id, pos, 1 AS n, token AS phrase FROM tk UNION ALL SELECT a.doc_id, a.pos, 2, a.token || ' ' || b.token "
        "FROM tk a JOIN tk b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 UNION ALL "
        "SELECT a.doc_id, a.pos, 3, a.token || ' ' || b.token || ' ' || c.token FROM tk a JOIN tk b ON a.doc_id = b.doc_id "
        "AND b.pos = a.pos + 1 JOIN tk c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2)",
        "best AS (SELECT doc_id, pos, max(n) AS n, arg_max(tag, n) AS tag FROM ng JOIN ph USING (phrase) GROUP BY doc_id, pos)",
        "nxt AS (SELECT doc_id, pos, min(pos) OVER (PARTITION BY doc_id ORDER BY pos "
        "RANGE BETWEEN n FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pos FROM best)",
        "run AS (SELECT doc_id, min(pos) AS pos FROM best GROUP BY doc_id UNION ALL "
        "SELECT nxt.doc_id, nxt.next_pos FROM run JOIN nxt ON run.doc_id = nxt.doc_id AND run.pos = nxt.pos "
        "WHERE nxt.next_pos IS NOT NULL)",
        "spans AS (SELECT run.doc_id, unnest(range(run.pos, run.pos + b.n)) AS pos, b.tag FROM run JOIN best b "
        "ON run.doc_id = b.doc_id AND run.pos = b.pos)",
    )
    + "SELECT tk.doc_id, tk.pos, tk.token, coalesce(spans.tag, 'O') AS tag FROM tk LEFT JOIN spans "
    + "ON tk.doc_id = spans.doc_id AND tk.pos = spans.pos"
)
ORACLES["entity_tags_joined"] = (
    f"SELECT doc_id, tag, count(*) AS n FROM ({ORACLES['entity_tags']}) GROUP BY doc_id, tag"
)

# Tags in context: the bigram model counted from the tagged benchmark, Viterbi as a fold over each sentence.
_IN = "'NN', 'NNP', 'NNPS', 'NNS', 'JJ', 'JJR', 'JJS', 'VB', 'VBD', 'VBG', 'VBN', 'VBP', 'VBZ'"
_NOMINAL = "lambda t: t IN ('NN', 'NNS', 'JJ')"
_VERBAL = "lambda t: starts_with(t, 'VB')"
_NONE = "struct_pack(tag := NULL::VARCHAR, score := '-inf'::DOUBLE, path := []::VARCHAR[])"
_MOVE = "coalesce(map_extract_value(m, p.tag || ' ' || c.tag), map_extract_value(m, p.tag))"
_BEST = (
    f"list_reduce(st, lambda b, p: CASE WHEN p.score + {_MOVE} > b.score THEN "
    f"struct_pack(tag := c.tag, score := p.score + {_MOVE}, path := list_append(p.path, c.tag)) ELSE b END, {_NONE})"
)
_STEP = (
    f"list_transform(list_transform(x.cands, lambda c: struct_pack(e := c.emit, b := {_BEST})), "
    "lambda z: struct_pack(tag := z.b.tag, score := z.b.score + z.e, path := z.b.path))"
)
_START = "[struct_pack(tag := '<s>', score := 0.0::DOUBLE, path := []::VARCHAR[])]"
CONTEXT = [
    BENCH,
    "amb AS (SELECT word, unnest(CASE WHEN word LIKE '%ing' THEN ['VBG', 'NN'] WHEN word LIKE '%ed' THEN ['VBD', 'JJ'] "
    "WHEN word LIKE '%s' THEN ['NNS', 'VBZ'] WHEN word LIKE '%tion' THEN ['NN'] ELSE ['DT'] END) AS tag FROM bw)",
    "opt AS (SELECT word, list_sort(list(tag)) AS tags FROM amb GROUP BY word)",
    f"bs AS (SELECT item_id, unnest(s) AS st, generate_subscripts(s, 1) AS sn FROM "
    f"(SELECT item_id, regexp_split_to_array({ascii_text('text')}, '[.!?]') AS s FROM benchmark))",
    f"bt AS (SELECT item_id, sn, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM "
    f"(SELECT item_id, sn, {find_all('st', WORD)} AS w FROM bs))",
    "gf AS (SELECT bt.*, opt.tags, lag(opt.tags) OVER (PARTITION BY item_id, sn ORDER BY pos) AS before FROM bt JOIN opt USING (word))",
    f"gold AS (SELECT item_id, sn, pos, word, coalesce(CASE WHEN len(tags) = 1 THEN tags[1] "
    f"WHEN coalesce(before = ['DT'], false) AND len(list_filter(tags, {_NOMINAL})) > 0 THEN list_filter(tags, {_NOMINAL})[1] "
    f"WHEN len(list_filter(tags, {_VERBAL})) > 0 THEN list_filter(tags, {_VERBAL})[1] END, tags[1]) AS tag FROM gf)",
    "pc AS (SELECT prev, tag, count(*) AS c FROM (SELECT coalesce(lag(tag) OVER (PARTITION BY item_id, sn ORDER BY pos), '<s>') AS prev, "
    "tag FROM gold) GROUP BY prev, tag)",
    "pt AS (SELECT prev, sum(c) AS total FROM pc GROUP BY prev)",
    "nt AS (SELECT count(*) AS t FROM (SELECT tag FROM gold UNION SELECT 'X'))",
    "alltags AS (SELECT tag FROM gold UNION SELECT 'X' UNION SELECT '<s>')",
    "tr AS (SELECT map_from_entries(list(struct_pack(k := k, v := v))) AS m FROM ("
    "SELECT a.tag AS k, ln(1 / (coalesce(pt.total, 0) + nt.t)) AS v FROM alltags a LEFT JOIN pt ON pt.prev = a.tag, nt "
    "UNION ALL SELECT pc.prev || ' ' || pc.tag, ln((pc.c + 1) / (pt.total + nt.t)) FROM pc JOIN pt USING (prev), nt))",
    "vc AS (SELECT count(DISTINCT word) AS v FROM gold)",
    "wc AS (SELECT word, tag, count(*) AS c FROM gold GROUP BY word, tag)",
    "tc AS (SELECT tag, count(*) AS ct FROM gold GROUP BY tag)",
    "cand AS (SELECT word, list_sort(list(struct_pack(tag := a.tag, emit := ln((coalesce(wc.c, 0) + 1) / (coalesce(tc.ct, 0) + vc.v))))) "
    "AS cands FROM (SELECT DISTINCT word, tag FROM amb) a LEFT JOIN wc USING (word, tag) LEFT JOIN tc USING (tag), vc GROUP BY word)",
    f"ds AS (SELECT doc_id, unnest(s) AS st, generate_subscripts(s, 1) AS sn FROM (SELECT doc_id, {sentence_list('text')} AS s FROM documents))",
    f"dt AS (SELECT doc_id, sn, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, sn, {blank_list('st')} AS w FROM ds))",
    "sent AS (SELECT doc_id, sn, list(struct_pack(pos := pos, token := token, "
    "cands := coalesce(cand.cands, [struct_pack(tag := 'X', emit := 0.0::DOUBLE)])) ORDER BY pos) AS t "
    "FROM dt LEFT JOIN cand ON dt.token = cand.word GROUP BY doc_id, sn)",
    f"fin AS (SELECT doc_id, sn, t, list_reduce(t, lambda st, x: {_STEP}, {_START}) AS final FROM sent, tr)",
    f"vit AS (SELECT doc_id, sn, t, list_reduce(final, lambda b, s: CASE WHEN s.score > b.score THEN s ELSE b END, {_NONE}).path AS path FROM fin)",
    "ct AS (SELECT doc_id, sn, unnest(t).token AS token, unnest(path) AS tag, generate_subscripts(path, 1) AS i FROM vit)",
    "cx AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sn, i) - 1 AS BIGINT) AS pos, token, tag FROM ct)",
]
ORACLES["context_tagged"] = with_(*CONTEXT) + "SELECT doc_id, pos, token, tag FROM cx"
ORACLES["pos_context"] = with_(*CONTEXT) + regrouped(FRAMED, f"cx WHERE tag IN ({_IN})", " ")
ORACLES["lemma_context"] = with_(*CONTEXT, LEMMAS) + regrouped(
    "string_agg(coalesce(CASE WHEN contains(lower(tag), 'v') THEN v.lemma ELSE n.lemma END, token), ' ' ORDER BY pos)",
    "cx LEFT JOIN (SELECT word, min(lemma) AS lemma FROM lem WHERE p = 'v' GROUP BY word) v ON token = v.word "
    "LEFT JOIN (SELECT word, min(lemma) AS lemma FROM lem WHERE p = 'n' GROUP BY word) n ON token = n.word",
    "",
)

# Sentence ends learned from the corpus.
_TERM = "CASE WHEN ({0}) = 0 THEN 0.0 ELSE ({0}) * ln({1}) END"
_K, _C = "with_period", "(with_period + without_period)"
_LEN = "length(replace(word, '.', ''))"
_LOWER = "lower(coalesce(text, ''))"
ABBREVIATIONS = [
    f"tk AS (SELECT unnest({blank_list(_LOWER)}) AS t FROM documents)",
    "ty AS (SELECT CASE WHEN ends_with(t, '.') THEN left(t, length(t) - 1) ELSE t END AS word, ends_with(t, '.') AS dot FROM tk)",
    "tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE dot) AS periods FROM ty)",
    "cnt AS (SELECT word, count(*) FILTER (WHERE dot) AS with_period, count(*) FILTER (WHERE NOT dot) AS without_period "
    "FROM ty WHERE regexp_full_match(word, '[a-z]+(\\.[a-z]+)*') GROUP BY word)",
    "pr AS (SELECT CASE WHEN n = 0 THEN 0.0 ELSE periods / n END AS p FROM tot)",
    "ab AS (SELECT word, with_period, without_period, CASE WHEN with_period > 0 THEN -2 * ("
    + _TERM.format(_K, "p") + " + " + _TERM.format(f"{_C} - {_K}", "1 - p") + " - "
    + _TERM.format(_K, "0.99") + " - " + _TERM.format(f"{_C} - {_K}", "1 - 0.99")
    + f") * exp(-{_LEN}) * (length(word) - {_LEN} + 1) * pow({_LEN}, -({_C} - {_K})) ELSE 0.0 END AS score FROM cnt, pr)",
]
ORACLES["abbreviations"] = with_(*ABBREVIATIONS) + (
    "SELECT word, with_period, without_period, round(score, 6) + 0.0 AS score, score >= 0.3 AS abbreviation FROM ab"
)
ORACLES["learned_sentences_long"] = with_(
    *ABBREVIATIONS,
    f"pc AS (SELECT doc_id, unnest(s) AS piece, generate_subscripts(s, 1) - 1 AS p FROM (SELECT doc_id, {sentence_list('text')} AS s FROM documents))",
    f"la AS (SELECT *, lower(list_last(string_split_regex(piece, {q(BLANK)}))) AS last FROM pc)",
    "fl AS (SELECT doc_id, p, piece, coalesce(CASE WHEN ends_with(last, '.') THEN left(last, length(last) - 1) END "
    "IN (SELECT word FROM ab WHERE score >= 0.3), false) AS open FROM la)",
    "st AS (SELECT *, CASE WHEN coalesce(lag(open) OVER (PARTITION BY doc_id ORDER BY p), false) THEN 0 ELSE 1 END AS s FROM fl)",
    "nm AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS n FROM st)",
) + "SELECT doc_id, CAST(n AS BIGINT) AS pos, string_agg(piece, ' ' ORDER BY p) AS sentence FROM nm GROUP BY doc_id, n"
