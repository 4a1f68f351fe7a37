import random

import brute
from golden import DUMP
from pyspark.sql import functions as F

from dumpscope.functions import citations, markup
from dumpscope.operators.articles import containing, extract, lookup, non_redirects, titled, with_counts
from dumpscope.operators.segment import segment
from dumpscope.schema import ARTICLE
from dumpscope.sources.dump import read_dump

PIECES = [
    "[[", "]]", "|", "#", ":", "a", "Bc", " ", "'''", "'", "==", "=", "{{", "}}", "<ref", "</ref>", ">", "<ref>",
    "[[File:", "_", ".", "\t", "\x01", "/>", "9", "*", "[", "]", "\n",
]


def random_bodies(n, seed, pieces=PIECES, length=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, length))) + "\n" for _ in range(n)]


BODIES = random_bodies(3000, 1) + ["", "\n", "\n\n"]


PURE = lambda body: markup.pure_text(markup.lines(body))
PLAIN = lambda body: markup.plain_text(markup.lines(body), "\n")


def per_line(function):
    return [[x for line in body.split("\n")[:-1] for x in function(line)] for body in BODIES]


def test_lines(apply):
    assert apply(markup.lines, BODIES) == [b.split("\n")[:-1] for b in BODIES]


def test_wikilinks(apply):
    assert apply(markup.wikilinks, BODIES) == per_line(brute.wikilinks)
    assert apply(markup.wikilinks_nested, BODIES) == per_line(brute.nested)


def test_link_cases(apply):
    body = "[[a|b]] [[a#b]] [[File:x]] [[]] [[c [[d]] [[|x]] [[ e ]]\n[[open\n[[File:i|t|[[in]] x]]\n"
    assert apply(markup.wikilinks, [body]) == [["a", "a", "c [[d", " e "]]
    assert apply(markup.wikilinks_nested, [body]) == [["a", "a", "c [[d", "d", "e", "in"]]


def test_bold(apply):
    assert apply(markup.bold, BODIES) == per_line(brute.bold)
    assert apply(markup.bold, ["'''a''' b '''c'''\n", "'''''x'''''\n", "'''a\n'''\n"]) == [["a", " b ", "c"], ["x"], []]
    paired = apply(lambda c: markup.bold(c, "paired"), ["'''a''' b '''c'''\n", "'''a-b'''\n"])
    assert paired == [["a", "c"], []]


def test_headings(apply):
    assert apply(markup.headings, BODIES) == per_line(brute.headings)
    for level in (2, 3, 4, 5):
        found = apply(lambda c: markup.headings(c, f"headings_level{level}"), BODIES)  # noqa: B023
        assert found == per_line(lambda line: brute.headings(line, level))  # noqa: B023


def test_heading_cases(apply):
    body = "==A==\n==AB==\n===CD===\n======Fg======\n====\n==x== \n=y=\n=====E5=====\n"
    assert apply(markup.headings, [body]) == [["A", "AB", "CD", "Fg", "", "E5"]]
    assert apply(lambda c: markup.headings(c, "headings_level2"), [body]) == [["AB"]]
    assert apply(lambda c: markup.headings(c, "headings_level3"), [body]) == [["CD"]]
    assert apply(lambda c: markup.headings(c, "headings_level5"), [body]) == [["E5"]]


def test_plain_text(apply):
    assert apply(PURE, BODIES) == [brute.pure(b.split("\n")[:-1]) for b in BODIES]
    assert apply(PLAIN, BODIES) == ["".join(brute.plain(x) + "\n" for x in b.split("\n")[:-1]) for b in BODIES]


def test_plain_text_cases(apply):
    cases = {
        "a [[cat|Cat]] can't\n": "a catCat cant ",
        "x {{t {{u}} v}} y\n": " y ",  # the inner closing ends the span, the outer one cuts the start
        "x {{open\nclose}} y\n": "x   y ",
        "x <ref>r</ref> y<ref name=q/> z\n": "x  y ",
        "* item\n'''Lead''' text\n\n[[File:a]] b\n[[c]] d\n": "c d ",
        "": "",
    }
    assert apply(PURE, list(cases)) == list(cases.values())


def test_refs(apply):
    assert apply(citations.refs, BODIES) == [brute.ref_bodies(b) for b in BODIES]
    cases = ["<ref>a\nb</ref> </ref><ref name=x>c</ref>\n", "<references/>\n<ref>d</ref>\n", "<ref>open\n",
             "<ref name=a/> loose </ref>\n", "<ref>a<ref name=b/>c</ref>\n", "<references>x</ref>\n"]
    assert apply(citations.refs, cases) == [["a\nb", " name=x>c"], ["d"], [], [], ["a<ref name=b/>c"], []]


def test_urls(apply):
    body = "x [http://a.b/c d] [http://e.f]\n[https://g.h?q=1]\n[http://open\n[ftp://no]\n[http:// i]\n"
    assert apply(citations.external_urls, [body]) == [["http://a.b/c", "https://g.h?q=1", "http://"]]


def test_uris_and_domains(apply):
    refs = ["x url= http://x.y/z|t", "archiveurl=http://b.c url=http://d.e", "none", "url=|q", "url=x.y", "url=http://x.y"]
    uris = apply(citations.citation_uris, [refs], "array<string>")
    assert uris == [["http://x.y/z", "http://b.c", "", "x.y", "http://x.y"]]
    assert apply(citations.domains, uris + [["s://a?b", "s://c$d", "s:///e"]], "array<string>") == [
        ["x.y", "b.c"],
        ["a", "c", ""],
    ]


def test_strip_markup(apply):
    cases = {
        "a <b>bold</b><br/>c\n": "a boldc\n",
        "x<!-- c\nd -->y\n": "xy\n",
        "p<ref name=n>in\nside</ref>q<ref name=m/>r<references/>\n": "pqr\n",
        "1 < 2 > 0\n": "1 < 2 > 0\n",
    }
    assert apply(markup.strip_markup, list(cases)) == list(cases.values())


def test_huge_body(apply):
    body = "word [[link]] '''b''' <ref>x</ref> {{t}} < " * 50_000 + "\n"
    assert len(apply(markup.wikilinks, [body])[0]) == 50_000
    assert len(apply(citations.refs, [body])[0]) == 50_000
    assert len(apply(citations.refs, ["<ref>" + "a< " * 400_000 + "</ref>\n"])[0][0]) == 1_200_000
    assert len(apply(markup.strip_markup, [body])[0]) > 0
    assert len(apply(PURE, [body])[0]) > 0
    assert apply(citations.external_urls, ["[http " * 20_000 + "\n"]) == [[]]


def test_articles(spark, tmp_path):
    (tmp_path / "part0").write_bytes(DUMP.encode())
    segments = segment(read_dump(spark, str(tmp_path)))
    articles = extract(segments)
    assert articles.columns == ARTICLE.names
    assert [f.dataType.simpleString() for f in articles.schema] == [f.dataType.simpleString() for f in ARTICLE]
    (row,) = lookup(articles, "A,B").collect()
    assert row["wikilinks"] == ["alpha", "beta"]
    assert row["headings"] == ["History", "Early years"]
    assert row["headings_level2"] == ["History"] and row["headings_level3"] == ["Early years"]
    assert row["text_in_bold"] == ["Bold"]
    assert row["pure_text"] == "Plain start of alphaAlpha and betapart. More text  here, cant stop! "
    assert {r["title"] for r in non_redirects(segments).collect()} == {"A,B", "Twice", "Cyclist", None}
    assert [r["title"] for r in containing(segments).collect()] == ["Cyclist"]
    assert titled(articles).count() == 5
    counted = with_counts(articles).filter("title = 'A,B'").select("n_wikilinks", "n_headings").collect()
    assert [tuple(r) for r in counted] == [(2, 2)]
    assert articles.select(F.sum(F.size("wikilinks"))).collect()[0][0] == 4
