"""Extraction by windows equals a tree that is built page by page."""

import html as entities
import json
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from presswork.operators import extraction as x


class Node:
    def __init__(self, name, attrs=(), parent=None):
        self.name, self.attrs, self.parent, self.items = name, dict(attrs), parent, []

    def up(self):
        node = self.parent
        while node:
            yield node
            node = node.parent

    def all(self):
        for item in self.items:
            if isinstance(item, Node):
                yield item
                yield from item.all()

    def text(self, drop=lambda n: False):
        return "".join(item if isinstance(item, str) else " " if item.name == "br" else "" if drop(item) else item.text(drop) for item in self.items)


class Tree(HTMLParser):
    """Closes paragraphs at blocks and items at the next of their list."""

    def __init__(self, text):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("root")
        self.feed(re.sub(r"(?is)<(script|style|noscript|svg|template)\b.*?</\1\s*>", " ", re.sub(r"(?s)<!--.*?-->", " ", text)))
        self.close()

    def shut(self, name, stop=()):
        node = self.now
        while node.name not in ("root", name, *stop):
            node = node.parent
        if node.name == name:
            self.now = node.parent

    def handle_starttag(self, name, attrs):
        if name in x.BLOCKS:
            self.shut("p")
        if name == "li":
            self.shut("li", ("ul", "ol"))
        node = Node(name, [(k, v or "") for k, v in attrs], self.now)
        self.now.items.append(node)
        if name not in x.VOID:
            self.now = node

    def handle_endtag(self, name):
        if name in x.BLOCKS and name != "p":
            self.shut("p")
        self.shut(name)

    def handle_data(self, data):
        self.now.items.append(data)


def squeezed(t):
    return " ".join(t.replace("\xa0", " ").split())


def around(node):
    return node.name in ("nav", "aside") or any(c in node.attrs.get("class", "") for c in x.AROUND)


def brute_lines(node, tree):
    out = []
    for e in node.all():
        if e.name not in ("p", "h2", "h3", "li") or around(e) or any(around(u) for u in e.up()):
            continue
        inner = [u.name for u in e.up()]
        if "p" in inner or "li" in inner:
            continue
        t = squeezed(e.text(around))
        if t and not any(p in t.lower() for p in x.PROMO) and t not in out:
            out.append(t)
    return "\n\n".join(out)


def brute_onward(tree):
    articles = [n for n in tree.root.all() if n.name == "article"]
    found = []
    for n in articles[0].all() if len(articles) == 1 else ():
        if n.name != "a" or not n.attrs.get("href") or any(u.name in ("nav", "aside", "footer") or "related" in u.attrs.get("class", "") or "social" in u.attrs.get("class", "") for u in n.up()):
            continue
        if re.match(x.ONWARD, squeezed(n.text()).lower()):
            found.append(n.attrs["href"])
    return found


NESTED = {
    "div in div": "<div class='x'><div class='article-body'><div><p>One</p><div><p>Two <b>bold</b></p></div></div><p>Three</p></div><p>Outside</p></div>",
    "article in article": "<article><p>A</p><article><p>B</p></article><p>C</p></article><p>D</p>",
    "unclosed": "<article><p>One<p>Two <b>x<div><p>Three</div><p>Four</article><p>Five",
    "lists": "<article><ul><li>a<li>b <ul><li>b1</li><li>b2</ul> tail</li></ul><p>p <a href='/x'>link</a> text</p><ol><li><p>in li</p></li></ol></article>",
    "around": "<article><p>Keep</p><aside><p>Gone</p><div><p>Gone too</p></div></aside><div class='box related-links'><div><p>Gone</p></div><p>Gone</p></div><p>Kept <span class='social'>share</span> on</p></article>",
    "repeats": "<article><p>Same</p><p>Same</p><h2>Head</h2><p>Subscribe now for more</p><h3>Head</h3><p>Head</p></article>",
    "stray": "</div></p><article><p>One</div></p><p>Two</p></article></article><p>Three</p>",
    "microdata": "<div itemprop=\"articleBody\"><p>x &amp; y &lt;z&gt; &quot;q&quot;</p></div><div itemprop='articleBody'></div><div itemprop='articleBody'><p>third</p></div>",
    "scripts": "<article><script>var t='<p>no</p>';</script><!-- <p>no</p> --><style>p{}</style><p>yes</p></article>",
    "onward": "<article><p>Text</p><a href='https://b.example/full'>Read <i>more</i> ...</a><aside><a href='/no'>read more</a></aside><a href='/other'>Continue reading</a><a href='/third'>read full story</a></article>",
    "void": "<article><p>a<br>b<img src='x'>c<hr></p><p>d</p></article>",
    "upper": "<ARTICLE><P>Big</P><DIV CLASS='Entry-Content entry-content'><P>Inner</P></DIV></ARTICLE>",
    "empty": "",
}


@pytest.fixture(scope="module")
def nested(spark):
    df = spark.createDataFrame([(k, "https://a.example/story", v) for k, v in NESTED.items()], "k string, url string, html string")
    every, about = x.candidates(df)
    return every.collect(), about.collect()


def test_regions_equal_a_tree(nested):
    every, _ = nested
    for key, text in NESTED.items():
        tree, want = Tree(text), []
        articles = [n for n in tree.root.all() if n.name == "article"]
        if len(articles) == 1:
            want.append(("single article element", brute_lines(articles[0], tree)))
        for c in x.CLASSES:
            want += [(f"article selector: {c}", brute_lines(n, tree)) for n in [n for n in tree.root.all() if c in n.attrs.get("class", "").split()][:2]]
        want += [("microdata articleBody", brute_lines(n, tree)) for n in [n for n in tree.root.all() if n.attrs.get("itemprop") == "articleBody"][:2]]
        got = [(r["method"], r["text"]) for r in every if r["k"] == key and r["method"] not in ("whole page", "table article cell")]
        assert sorted(got) == sorted(want), key


def test_links_equal_a_tree(nested):
    from urllib.parse import urljoin

    _, about = nested
    for r in about:
        want = [urljoin("https://a.example/story", h) for h in brute_onward(Tree(NESTED[r["k"]]))][:2]
        assert (r["links"] or []) == want, r["k"]


def test_pages_equal_a_tree(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    every, _ = x.candidates(pages.select(F.col("page_id").cast("string").alias("k"), "url", "html"))
    got = {r["k"]: r["text"] for r in every.where("method = 'single article element'").collect()}
    n = 0
    for r in pages.collect():
        tree = Tree(r["html"])
        articles = [a for a in tree.root.all() if a.name == "article"]
        if len(articles) == 1:
            n += 1
            assert got[str(r["page_id"])] == brute_lines(articles[0], tree), r["page_id"]
    assert n == len(got) and n > 10


def ld(*values):
    return "".join(f'<script type="application/ld+json">{json.dumps(v) if not isinstance(v, str) else v}</script>' for v in values)


def walk(v):
    if isinstance(v, dict):
        yield v
    for c in v.values() if isinstance(v, dict) else v if isinstance(v, list) else ():
        yield from walk(c)


def test_structured_data(spark):
    long = "word " * 120
    pages = {
        "graph": [{"@graph": [{"@type": "WebPage", "mainEntity": {"@type": ["Thing", "NewsArticle"], "articleBody": long}}, {"@type": "BlogPosting", "isAccessibleForFree": "False"}]}],
        "list": [[{"@type": "Article", "isAccessibleForFree": False, "articleBody": {"no": "text"}}], "{not json", {"@type": "Person"}],
        "deep": [{"a": {"b": [{"c": {"d": [[{"@type": "ReportageNewsArticle", "articleBody": "x", "isAccessibleForFree": True}]]}}]}}],
        "none": [5, "null", []],
    }
    df = spark.createDataFrame([(k, ld(*v)) for k, v in pages.items()], "k string, html string")
    got = sorted(((r["k"], r["body"], r["closed"]) for r in x.structured(df).collect()), key=repr)
    want = []
    for k, values in pages.items():
        for v in values:
            for o in walk(v if not isinstance(v, str) else []):
                if any(t in str(o.get("@type", "")) for t in x.ARTICLES):
                    body = o.get("articleBody")
                    want.append((k, body if isinstance(body, str) else None, o.get("isAccessibleForFree") in (False, "false", "False")))
    assert got == sorted(want, key=repr) and len(got) == 4
    assert x.structured(df.limit(0)).count() == 0


def page(body, head=""):
    return f"<html><head><title>A title of a story</title>{head}</head><body>{body}</body></html>"


def test_choice(spark):
    whole, part = "<p>" + "Long text here. " * 40 + "</p>", "<p>" + "Some text. " * 15 + "</p>"
    cases = {
        "single": (page(f"<article>{whole}</article>"), "candidate", "single article element"),
        "selector wins": (page(f"<article>{whole}<div class='entry-content'>{whole}<p>x</p></div></article>"), "candidate", "article selector: entry-content"),
        "structured wins": (page(f"<article>{whole}</article>", ld({"@type": "Article", "articleBody": "<p>" + "Data text. " * 60 + "</p>"})), "candidate", "structured articleBody"),
        "closed": (page(f"<article>{part}</article>", ld({"@type": "Article", "isAccessibleForFree": False, "articleBody": "hidden " * 90})), "partial", "single article element"),
        "walled": (page(f"<article>{whole}</article><div>Subscribe to read this article</div>"), "partial", "single article element"),
        "wall in the footer": (page(f"<article>{whole}</article><footer>Subscribe to read this article</footer>"), "candidate", "single article element"),
        "part": (page(f"<article>{part}</article>"), "partial", "single article element"),
        "cut short": (page(f"<article>{whole}<p>And so on...</p></article>"), "partial", "single article element"),
        "goes on": (page(f"<article>{whole}<p><a href='https://other.example/full-story'>Read more</a></p></article>"), "partial", "single article element"),
        "unanchored": (page(whole), "missing", None),
        "og": (page(whole, "<meta property='og:type' content='article'>"), "candidate", "whole page"),
        "hollow marker": (page(f"<div class='entry-content'></div>{whole}", "<meta property='og:type' content='article'>"), "missing", None),
        "listing": (page("".join(f"<article>{part}</article>" for _ in range(10)) + whole, "<meta property='og:type' content='article'>"), "missing", None),
        "cell": (page(f"<table><tr><td><table><tr><td>{whole * 2}</td><td>x</td></tr></table></td></tr></table>"), "candidate", "table article cell"),
        "refused": (page(f"<h1>Just a moment...</h1><article>{whole}</article>"), "missing", None),
        "empty": ("", "missing", None),
        "null": (None, "missing", None),
    }
    rows = [(i, "https://a.example/x", h, 1) for i, (h, *_) in enumerate(cases.values())]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, k int")
    found = x.extract(df).collect()
    assert len(found) == len(rows) + 1
    got = {r["page_id"]: r for r in found}
    for i, (name, (_, quality, method)) in enumerate(cases.items()):
        assert (got[i]["quality"], got[i]["method"]) == (quality, method), name
        assert bool(got[i]["text"]) == (quality != "missing"), name
    assert got[list(cases).index("goes on")]["links"] == ["https://other.example/full-story"]
    assert got[0]["title"] == "A title of a story" and entities.unescape("&amp;") == "&"
    assert x.extract(df.limit(0)).count() == 0
