"""Article text of HTML pages, as Columns: what is no content goes, paragraphs are read from
the article element or from the whole page, and the result is judged by its size, its title
and its wording. One pass, no Python.

Defined cases: null and empty pages have no paragraphs and are missing; an element that is
not closed is text to the end of the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose contents are no article text.
OUTSIDE = ("script", "style", "noscript", "svg", "nav", "aside", "footer", "form")
#: Characters of a whole article and of a part of one, and articles that make a listing.
WHOLE, PART, LISTING = 600, 150, 8
#: Wording of a paywall, and titles of pages that are no article.
WALLS = r"subscribe to (?:read|continue)|subscribers only|sign in to continue reading|log in to read"
REFUSALS = r"just a moment|access denied|attention required|verify you are human|captcha|page not found|404 not found"
#: Entities of HTML that text of articles holds; the ampersand comes last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def plain(html: Column) -> Column:
    """Text without tags and entities, with single spaces."""
    text = F.regexp_replace(html, r"<[^>]*>", " ")
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def content(html: Column) -> Column:
    """The page without comments and without the elements OUTSIDE."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", " ")
    for name in OUTSIDE:
        out = F.regexp_replace(out, rf"(?is)<{name}\b.*?</{name}>", " ")
    return out


def paragraphs(region: Column) -> Column:
    """The texts of p elements; a p ends where it is closed or the next begins."""
    found = F.split(region, r"(?i)<p\b[^>]*>")
    cut = F.transform(F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))), lambda x: plain(F.get(F.split(x, r"(?i)</p>"), F.lit(0))))
    return F.filter(cut, lambda x: x != "")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, title, method, quality, reason, n_paragraphs, characters and text of
    pages(page_id, html)."""
    # generators keep the optimizer from reading a page again for every column
    body = pages.select("page_id", F.explode(F.array(content(F.col("html")))).alias("body"))
    article = F.regexp_extract("body", r"(?is)<article\b[^>]*>(.*?)</article>", 1)
    articles = F.regexp_count("body", F.lit(r"(?i)<article\b"))
    single = (articles == 1) & (article != "")
    read = body.select(
        "page_id", articles.alias("articles"), F.when(single, "single article element").otherwise("whole page").alias("method"),
        plain(F.coalesce(F.nullif(F.regexp_extract("body", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1), F.lit("")), F.regexp_extract("body", r"(?is)<title\b[^>]*>(.*?)</title>", 1))).alias("title"),
        F.explode(F.array(paragraphs(F.when(single, article).otherwise(F.col("body"))))).alias("found"),
    )
    text = F.array_join("found", "\n\n")
    judged = read.select("page_id", "title", "method", "articles", F.size("found").cast("long").alias("n_paragraphs"), F.explode(F.array(text)).alias("text"))
    size = F.length("text")
    reason = (
        F.when(F.lower("title").rlike(REFUSALS), "challenge or error page").when((F.col("articles") >= LISTING) & (size < WHOLE), "listing")
        .when(size < PART, "too short").when(F.lower("text").rlike(WALLS), "paywall").when(size < WHOLE, "short")
    )
    quality = F.when(reason.isNull(), "candidate").when(reason.isin("paywall", "short"), "partial").otherwise("missing")
    return judged.select("page_id", "title", "method", quality.alias("quality"), reason.alias("reason"), "n_paragraphs", size.cast("long").alias("characters"), "text")


def oracle_sql() -> str:
    """The same by DuckDB, in the order of the text."""
    body = r"regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', ' ', 'g')"
    for name in OUTSIDE:
        body = rf"regexp_replace({body}, '(?is)<{name}\b.*?</{name}>', ' ', 'g')"

    def bare(x: str) -> str:
        out = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
        for name, sign in ENTITIES:
            out = "replace({}, '{}', '{}')".format(out, name, sign.replace("'", "''"))
        return rf"trim(regexp_replace({out}, '[\x20\x09-\x0D]+', ' ', 'g'))"

    heading, title = r"regexp_extract(body, '(?is)<h1\b[^>]*>(.*?)</h1>', 1)", r"regexp_extract(body, '(?is)<title\b[^>]*>(.*?)</title>', 1)"
    return rf"""WITH b AS (SELECT page_id, {body} AS body FROM pages),
a AS (SELECT *, len(regexp_extract_all(body, '(?i)<article\b')) AS articles, regexp_extract(body, '(?is)<article\b[^>]*>(.*?)</article>', 1) AS article FROM b),
r AS (SELECT page_id, articles, articles = 1 AND article <> '' AS single, {bare(f"CASE WHEN {heading} <> '' THEN {heading} ELSE {title} END")} AS title, regexp_split_to_array(CASE WHEN articles = 1 AND article <> '' THEN article ELSE body END, '(?i)<p\b[^>]*>') AS p FROM a),
f AS (SELECT *, list_filter(list_transform(p[2:], lambda x: {bare("regexp_split_to_array(x, '(?i)</p>')[1]")}), lambda x: x <> '') AS found FROM r),
t AS (SELECT *, array_to_string(found, chr(10) || chr(10)) AS text FROM f),
j AS (SELECT *, CASE WHEN regexp_matches(lower(title), '{REFUSALS}') THEN 'challenge or error page' WHEN articles >= {LISTING} AND length(text) < {WHOLE} THEN 'listing' WHEN length(text) < {PART} THEN 'too short' WHEN regexp_matches(lower(text), '{WALLS}') THEN 'paywall' WHEN length(text) < {WHOLE} THEN 'short' END AS reason FROM t)
SELECT page_id, title, CASE WHEN single THEN 'single article element' ELSE 'whole page' END AS method, CASE WHEN reason IS NULL THEN 'candidate' WHEN reason IN ('paywall', 'short') THEN 'partial' ELSE 'missing' END AS quality, reason, len(found) AS n_paragraphs, length(text) AS characters, text FROM j"""
