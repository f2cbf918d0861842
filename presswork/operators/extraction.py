"""Articles of HTML pages by balanced elements, structured data and a choice among candidates.

A page is an ordered table of tags and texts. The depth of an element's name is a running sum over
its tags, and an element ends where its name is back at the depth it began at: opening and closing
tags of one depth alternate, so the end is the next tag of that page, name and depth. A p also ends
where a block begins or ends, a li where the next one of its list does. Everything is windows over
(page, name, depth) or a page; no page is parsed by itself, and texts of copies are read once.

Candidates are the body an article's structured data gives, elements whose class or itemprop says
that they are one, a single article element, a table cell, and the whole page; the best by quality,
method and length stays.

Defined cases: null and empty pages are missing; an element that is never closed goes to the page's
end; a closing tag that closes nothing is ignored by all other names; structured data that is no
JSON is ignored; pages are told apart by id, URL and HTML, and rows that repeat give a row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions import urls
from presswork.functions.pages import plain
from presswork.plans.lineage import cut

# What marks an article's body, its surroundings, offers, walls and refusals.
CLASSES = ("post-content", "post__content", "banner-text", "story-content", "tbl_art", "article-body", "entry-content", "body-copy", "article-content__content")
AROUND = ("related", "std-banner", "cfm-yml", "social")
PROMO = ("get full access for", "subscribe now", "unlimited access to all premium", "ad-free browsing", "mobile-optimised reading", "weekly newsletters", "search option is now available", "for subscriptions on news from china daily", "for more visit china daily", "stand with the standard", "the standard group plc")
WALLS = ("get full access for", "renew in to keep enjoying", "subscribe to read this article")
REFUSALS = ("just a moment", "access denied", "attention required", "captcha", "page not found", "404 not found")
ARTICLES = ("NewsArticle", "Article", "BlogPosting")
ONWARD = r"^(?:read more|continue reading|read (?:the )?full (?:article|story))\s*[.…]*$"
CUT_SHORT = r"(?i)(?:\.\.\.|…|read more|continue reading)\s*$"
WHOLE, PART, CELL, LISTING = 400, 100, 1000, 8

#: Elements without an end, and elements at which a paragraph ends.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
BLOCKS = ("address", "article", "aside", "blockquote", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul")
FAR = 2**31 - 1


def holds(text: Column, some: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for x in some:
        found = found | text.contains(x)
    return found


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, the empty text without one."""
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def events(pages: DataFrame) -> DataFrame:
    """(k, pos, raw, name, close) of pages(k, html): tags and texts in order, without comments and what
    scripts and styles hold; name is empty for texts."""
    body = F.regexp_replace(F.regexp_replace("html", r"(?s)<!--.*?-->", " "), r"(?is)<(script|style|noscript|svg|template)\b.*?</\1\s*>", " ")
    rows = pages.select("k", F.posexplode(F.regexp_extract_all(body, F.lit(r"(?s)<[^>]*>|[^<]+|<"), F.lit(0))).alias("pos", "raw"))
    name = F.lower(F.regexp_extract("raw", r"^</?([A-Za-z][A-Za-z0-9]*)[^>]*>", 1))
    return rows.select("k", "pos", "raw", name.alias("name"), F.col("raw").startswith("</").alias("close"))


def elements(rows: DataFrame) -> DataFrame:
    """(k, name, s, e, raw): the elements of events, from their opening tag to where they end."""
    tags = rows.where((F.col("name") != "") & ~F.col("name").isin(*VOID))
    depth = F.sum(F.when(F.col("close"), -1).otherwise(1)).over(Window.partitionBy("k", "name").orderBy("pos"))
    levels = tags.withColumn("level", depth + F.col("close").cast("int"))
    end = F.lead("pos").over(Window.partitionBy("k", "name", "level").orderBy("pos"))
    return levels.select("k", "name", F.col("pos").alias("s"), F.coalesce(end, F.lit(FAR)).alias("e"), "raw", "close").where("not close").drop("close")


def lines_at(rows: DataFrame, found: DataFrame, regions: DataFrame) -> DataFrame:
    """(k, s, e) of the elements that are lines of text: p, h2, h3 and li, the outer ones where they nest;
    a li that holds a region is none."""
    blocks = rows.where(F.col("name").isin(*BLOCKS))
    after = F.lead("pos").over(Window.partitionBy("k").orderBy("pos"))
    paragraphs = blocks.withColumn("next", after).where("name = 'p' and not close").select("k", F.col("pos").alias("s"), F.coalesce("next", F.lit(FAR)).alias("e"))
    lists = rows.where("name in ('ul', 'ol', 'li')")
    depth = F.sum(F.when(F.col("name") == "li", 0).when(F.col("close"), -1).otherwise(1)).over(Window.partitionBy("k").orderBy("pos"))
    levels = lists.withColumn("level", depth + F.when((F.col("name") != "li") & F.col("close"), 1).otherwise(0)).where("name = 'li' or close")
    ends = F.lead("pos").over(Window.partitionBy("k", "level").orderBy("pos"))
    items = levels.withColumn("next", ends).where("name = 'li' and not close").select("k", F.col("pos").alias("s"), F.coalesce("next", F.lit(FAR)).alias("e"))
    around = items.join(regions.select("k", F.col("s").alias("r")), "k").where("r > s and r < e").select("k", "s").distinct()
    items = items.join(around, ["k", "s"], "left_anti")
    heads = found.where("name in ('h2', 'h3')").select("k", "s", "e")
    every = paragraphs.unionByName(items).unionByName(heads)
    outer = F.max("e").over(Window.partitionBy("k").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    return every.withColumn("outer", outer).where("outer is null or outer <= s").drop("outer")


def _texts(rows: DataFrame, spans: DataFrame, without: DataFrame | None) -> DataFrame:
    """(k, s, text) of spans (k, s, e) that don't overlap, without what lies within `without`."""
    marked = rows.join(spans.select("k", F.col("s").alias("pos"), F.col("s").alias("b"), F.col("e").alias("until")), ["k", "pos"], "left")
    if without is not None:
        ends = without.groupBy("k", F.col("s").alias("pos")).agg(F.max("e").alias("gone"))
        marked = marked.join(ends, ["k", "pos"], "left")
    order = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(order)
    marked = marked.select("k", "pos", "raw", "name", last("b").alias("b"), last("until").alias("until"), *([F.max("gone").over(order).alias("gone")] if without is not None else []))
    inside = marked.where("(name = '' or name = 'br') and pos < until" + (" and (gone is null or pos > gone)" if without is not None else ""))
    said = inside.select("k", "b", F.struct("pos", F.when(F.col("name") == "", F.col("raw")).otherwise(" ").alias("raw")).alias("x"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["raw"]), "")
    return said.groupBy("k", F.col("b").alias("s")).agg(whole.alias("t")).select("k", "s", plain(F.col("t")).alias("text")).where("text <> ''")


def structured(pages: DataFrame) -> DataFrame:
    """(k, kind, body, closed) of the articles that pages' JSON-LD describes, at whatever depth: objects
    whose @type names one of ARTICLES; closed: isAccessibleForFree is false. VARIANT values are
    taken apart level by level until no level holds objects or lists."""
    spark = pages.sparkSession
    pattern = r"""(?is)<script\b[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script\s*>"""
    rows = pages.select("k", F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("json"))
    level = rows.select("k", F.try_parse_json("json").alias("v")).where("v is not null")
    found = None
    while True:
        kind = F.schema_of_variant("v")
        level = cut(level.select("k", F.to_json("v").alias("json"), kind.startswith("OBJECT").alias("object")).where(kind.rlike("^(OBJECT|ARRAY)")))
        if level.isEmpty():
            break
        now = level.select("k", "object", F.parse_json("json").alias("v"))
        get = lambda path, t: F.try_variant_get("v", path, t)
        kinds = F.coalesce(F.to_json(get("$['@type']", "variant")), F.lit(""))
        free = F.coalesce(F.lower(get("$.isAccessibleForFree", "string")), F.lit("")) == "false"
        body = F.when(F.schema_of_variant(get("$.articleBody", "variant")) == "STRING", get("$.articleBody", "string"))
        mine = now.where("object").select("k", kinds.alias("kind"), body.alias("body"), free.alias("closed")).where(holds(F.col("kind"), ARTICLES))
        found = mine if found is None else found.unionByName(mine)
        level = now.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("value"))).select("k", F.col("value").alias("v"))
    return found if found is not None else spark.createDataFrame([], "k string, kind string, body string, closed boolean")


def onward(rows: DataFrame, found: DataFrame, pages: DataFrame) -> DataFrame:
    """(k, links): where a page's single article says that it goes on, two links at most."""
    single = found.where("name = 'article'").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("a"), F.min("e").alias("z")).where("n = 1")
    about = F.col("name").isin("nav", "aside", "footer") | holds(attribute(F.col("raw"), "class"), ("related", "social"))
    anchors = found.where("name = 'a'").join(single, "k").where("s > a and s < z").select("k", "s", "e", F.trim(plain(attribute(F.col("raw"), "href"))).alias("href"))
    labels = _texts(rows, anchors, found.where(about).select("k", "s", "e")).where(F.lower("text").rlike(ONWARD))
    links = anchors.where("href <> ''").join(labels, ["k", "s"]).join(pages.select("k", "url"), "k")
    target = links.select("k", "s", "url", urls.joined(F.col("url"), F.col("href")).alias("to")).where(urls.part(F.col("to"), "PROTOCOL").isin("http", "https") & urls.part(F.col("to"), "HOST").isNotNull() & urls.part(F.col("to"), "USERINFO").isNull())
    inner = F.regexp_extract(F.coalesce(urls.part(F.col("to"), "PATH"), F.lit("")), urls.REPLAY, 1)
    plain_ = F.when((urls.host(F.col("to")) == "web.archive.org") & inner.startswith("http://"), F.regexp_replace(inner, "^http", "https"))
    ways = target.select("k", "s", "url", F.posexplode(F.array_compact(F.array("to", plain_))).alias("n", "to")).where("to <> url")
    first = ways.groupBy("k", "to").agg(F.min(F.struct("s", "n")).alias("at"))
    return first.groupBy("k").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("at", "to"))), lambda x: x["to"]), 1, 2).alias("links"))


def candidates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of pages(k, url, html): (k, method, specificity, anchored, text) for each candidate, and a row a
    page (k, title, schemas, paywall, articles, links)."""
    rows = cut(events(pages))
    found = cut(elements(rows))
    schemas = cut(structured(pages))
    named = attribute(F.col("raw"), "class")
    tokens = F.split(F.trim(named), r"\s+")
    by_class = found.select("k", "s", "e", F.explode(F.array_intersect(tokens, F.array(*map(F.lit, CLASSES)))).alias("c"))
    by_class = by_class.join(pages.select("k", "url"), "k").where("c <> 'banner-text' or contains(url, 'kenyastar.com')")
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("s"))
    marked = by_class.withColumn("n", nth("k", "c")).where("n <= 2").select("k", "s", "e", F.concat(F.lit("article selector: "), F.col("c")).alias("method"), F.lit(3).alias("specificity"))
    data = found.where(attribute(F.col("raw"), "itemprop") == "articleBody").withColumn("n", nth("k")).where("n <= 2")
    data = data.select("k", "s", "e", F.lit("microdata articleBody").alias("method"), F.lit(3).alias("specificity"))
    own = found.where("name = 'article'").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    single = own.where("n = 1").select("k", "s", "e", F.lit("single article element").alias("method"), F.lit(2).alias("specificity"))
    regions = cut(marked.unionByName(data).unionByName(single))

    surroundings = found.where(F.col("name").isin("nav", "aside") | holds(named, AROUND)).select("k", "s", "e")
    lines = cut(_texts(rows, lines_at(rows, found, regions), surroundings).where(~holds(F.lower("text"), PROMO)))
    below = found.where("name in ('footer', 'form', 'header')").select("k", F.col("s").alias("fs"), F.col("e").alias("fe"))
    apart = lines.join(below, "k").where("s > fs and s < fe").select("k", "s").distinct()
    told = F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"])), "\n\n")
    inside = regions.join(lines.select("k", F.col("s").alias("line"), "text"), "k").where("line > s and line < e")
    bodies = inside.groupBy("k", "s", "method", "specificity").agg(told.alias("text"))
    # an element that is marked and empty speaks against what is found elsewhere
    bodies = regions.join(bodies, ["k", "s", "method", "specificity"], "left").select("k", "method", "specificity", F.coalesce("text", F.lit("")).alias("text"))
    page = lines.join(apart, ["k", "s"], "left_anti").select("k", F.col("s").alias("line"), "text").groupBy("k").agg(told.alias("text")).select("k", F.lit("whole page").alias("method"), F.lit(0).alias("specificity"), "text")
    cells = found.where("name = 'td'").withColumn("next", F.lead("s").over(Window.partitionBy("k").orderBy("s"))).where("next is null or next > e")
    cell = _texts(rows, cells.select("k", "s", "e"), None).where(F.length("text") > CELL).groupBy("k").agg(F.max(F.struct(F.length("text").alias("n"), (-F.col("s")).alias("s"), "text")).alias("x"))
    cell = cell.select("k", F.lit("table article cell").alias("method"), F.lit(1).alias("specificity"), F.col("x.text").alias("text")).where(~holds(F.lower("text"), PROMO))

    start = rows.groupBy("k").agg(F.min("pos").alias("s")).withColumn("e", F.lit(FAR))
    visible = _texts(rows, start, found.where("name in ('nav', 'footer')").select("k", "s", "e")).select("k", holds(F.lower("text"), WALLS).alias("walled"))
    heads = _texts(rows, found.where("name in ('h1', 'title')").select("k", "s", "e"), None).join(found.select("k", "s", "name"), ["k", "s"])
    title = heads.groupBy("k").agg(F.min(F.struct((F.col("name") == "title").alias("t"), "s", "text")).alias("x")).select("k", F.col("x.text").alias("title"))
    known = schemas.groupBy("k").agg(F.count(F.lit(1)).alias("schemas"), F.max("closed").alias("closed"))
    og = rows.where("name = 'meta'").where((attribute(F.col("raw"), "property") == "og:type") & (attribute(F.col("raw"), "content") == "article")).select("k").distinct().withColumn("og", F.lit(True))
    articles = own.groupBy("k").agg(F.count(F.lit(1)).alias("articles"))
    about = pages.select("k")
    for more in (title, known, visible, og, articles, onward(rows, found, pages)):
        about = about.join(more, "k", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    paywall = yes("closed") | yes("walled")
    # no continuation links of a page that a wall cuts short
    about = cut(about.select("k", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("schemas", F.lit(0)).alias("schemas"), paywall.alias("paywall"), yes("og").alias("og"), F.coalesce("articles", F.lit(0)).alias("articles"), F.when(~paywall, F.col("links")).alias("links")))
    given = schemas.where("body is not null").select("k", F.lit("structured articleBody").alias("method"), F.lit(4).alias("specificity"), plain(F.col("body")).alias("text"))
    given = given.join(about.where("not paywall").select("k"), "k")
    every = bodies.unionByName(page).unionByName(cell).unionByName(given)
    return every, about


def extract(pages: DataFrame) -> DataFrame:
    """page_id, title, method, quality, reason, paywall, links, candidates (how many) and text of
    pages(page_id, url, html)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    keyed = pages.select("page_id", F.sha2(F.concat_ws("\0", F.to_json(F.struct("page_id")), blank("url"), blank("html")), 256).alias("k"), "url", "html")
    once = cut(keyed.select("k", "url", F.coalesce("html", F.lit("")).alias("html")).dropDuplicates(["k"]))
    every, about = candidates(once)
    marked = F.col("method").startswith("article selector") | F.col("method").startswith("microdata")
    hollow = every.where(marked).groupBy("k").agg((F.max(F.length("text")) < PART).alias("hollow"))
    rows = every.join(about, "k").join(hollow, "k", "left")
    parsed = F.col("method") == "whole page"
    anchored = F.when(parsed, ((F.col("schemas") > 0) | F.col("og")) & ~F.coalesce("hollow", F.lit(False))).otherwise(True)
    n = F.length("text")
    short = F.coalesce(F.size("links") > 0, F.lit(False)) | F.col("text").rlike(CUT_SHORT)
    fine = (n >= WHOLE) & anchored & ~F.col("paywall") & ~short
    quality = F.when(fine, 2).when((n >= PART) & (anchored | (F.col("schemas") > 0) | F.col("paywall")), 1).otherwise(0)
    judged = rows.withColumn("q", quality)
    best = judged.groupBy("k").agg(F.max(F.struct("q", "specificity", n.alias("n"), "method", "text")).alias("b"), F.count(F.lit(1)).alias("candidates"), F.max((F.col("q") == 2) & (marked | (F.col("specificity") == 4))).alias("sure"))
    out = about.join(best, "k", "left")
    refused = holds(F.lower("title"), REFUSALS)
    listing = (F.col("schemas") == 0) & ~F.col("paywall") & (F.col("articles") > LISTING) & ~F.coalesce("sure", F.lit(False))
    q = F.when(refused | listing, 0).otherwise(F.coalesce("b.q", F.lit(0)))
    reason = (
        F.when(refused, "challenge or error page").when(listing, "listing").when(q == 2, "passes structural checks").when(F.col("paywall"), "paywall")
        .otherwise("truncated or insufficient")
    )
    told = out.select(
        "k", "title", F.when(q > 0, F.col("b.method")).alias("method"), F.element_at(F.array(F.lit("missing"), F.lit("partial"), F.lit("candidate")), q + 1).alias("quality"), reason.alias("reason"),
        "paywall", F.coalesce("links", F.array().cast("array<string>")).alias("links"), F.coalesce("candidates", F.lit(0)).alias("candidates"), F.when(q > 0, F.col("b.text")).otherwise("").alias("text"),
    )
    return keyed.select("page_id", "k").join(told, "k").drop("k")
