"""Browsing stories: which outlets cover a country, when, and with which URLs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.text import tokens
from presswork.functions.domains import BROADCAST
from presswork.operators.classify import places
from presswork.plans.lineage import cut

PAGE = 20


def origin(name: str, country: str) -> Column:
    """Whether an observation comes from the country, by estimate, by domain or by both."""
    est, dom = F.col("estimated_country") == country, F.col("domain_country") == country
    return {"gdelt": est, "cctld": dom, "both": est & dom}[name]


def mode(name: str, country: str) -> Column:
    """Whether an observation is about the country: any, about it, about the pair only."""
    about = F.array_contains("countries", country)
    return {"broad": F.lit(True), "both": about, "only_pair": about & (F.size("countries") == 2)}[name]


def select(obs: DataFrame, country: str, mode_name: str = "broad", origin_name: str = "gdelt", place: bool = False) -> DataFrame:
    rows = obs.where(origin(origin_name, country) & mode(mode_name, country))
    return rows.where(F.array_contains("specific_location_countries", country)) if place else rows


def dated(rows: DataFrame, start: date, end: date) -> DataFrame:
    return rows.where(F.col("day").between(F.lit(start), F.lit(end)))


def of_outlet(rows: DataFrame, outlet: str) -> DataFrame:
    return rows.where(F.col("outlet") == outlet) if outlet else rows


def outlets(rows: DataFrame, start: date, end: date) -> DataFrame:
    """URLs of each outlet within the dates, most first."""
    return dated(rows, start, end).groupBy("outlet").agg(F.count_distinct("url").alias("count")).orderBy(F.desc("count"), "outlet")


def timeline(rows: DataFrame, outlet: str = "") -> DataFrame:
    """URLs of each month; the dates of the selection do not apply."""
    return of_outlet(rows, outlet).groupBy(F.trunc("day", "MM").alias("month")).agg(F.count_distinct("url").alias("count")).orderBy("month")


def overview(rows: DataFrame, start: date, end: date, outlet: str = "") -> DataFrame:
    """Outlets and months in one result, told apart by kind."""
    by = outlets(rows, start, end).select(F.lit("outlet").alias("kind"), "outlet", "count")
    when = timeline(rows, outlet).select(F.lit("timeline").alias("kind"), F.col("month").alias("bucket"), "count")
    return by.unionByName(when, allowMissingColumns=True)


def totals(rows: DataFrame, start: date, end: date, outlet: str = "") -> DataFrame:
    """count and websites as sums over outlets: a URL under two outlets counts twice."""
    found = of_outlet(outlets(rows, start, end), outlet)
    return found.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.count(F.lit(1)).alias("websites"))


def latest(rows: DataFrame, start: date, end: date, downloads: DataFrame | None = None, only_downloaded: bool = False) -> DataFrame:
    """A row for each URL within the dates: first and last day, and what the last day says;
    of rows on one day the one with the smallest outlet. download_status from
    downloads(url, status), of which saved and partial count."""
    chosen = dated(rows, start, end)
    got = None
    if downloads is not None:
        got = downloads.where(F.col("status").isin("saved", "partial")).groupBy("url").agg(F.max("status").alias("download_status"))
        if only_downloaded:
            chosen = chosen.join(got, "url", "left_semi")
    said = F.struct("outlet", "countries", "specific_location_countries", "estimated_country", "domain_country")
    # max_by takes the last day; ties go to the smallest outlet
    best = F.min(F.struct((-F.unix_date("day")).alias("o"), F.coalesce("outlet", F.lit("")).alias("t"), said.alias("s")))
    found = chosen.groupBy("url").agg(F.min("day").alias("first_observed"), F.max("day").alias("last_observed"), best.alias("b")).select("url", "first_observed", "last_observed", "b.s.*")
    return found.join(got, "url", "left") if got is not None else found


def totals_by_url(rows: DataFrame, start: date, end: date, outlet: str = "") -> DataFrame:
    """count and websites over URLs, each under the outlet of its last day."""
    found = of_outlet(latest(rows, start, end), outlet)
    return found.agg(F.count(F.lit(1)).alias("count"), F.count_distinct("outlet").alias("websites"))


def stories(rows: DataFrame, start: date, end: date, outlet: str = "", page: int = 0, size: int = PAGE) -> DataFrame:
    """A page of stories, last observed first: for each outlet and URL the first and last day
    and the evidence of the last."""
    said = F.struct("countries", "specific_location_countries", "estimated_country", "domain_country")
    grouped = of_outlet(dated(rows, start, end), outlet).groupBy("outlet", "url").agg(F.min("day").alias("first_observed"), F.max("day").alias("last_observed"), F.max_by(said, "day").alias("latest"))
    flat = grouped.select("outlet", "url", "first_observed", "last_observed", "latest.*")
    return flat.orderBy(F.desc("last_observed"), "url", "outlet").offset(page * size).limit(size)


def pages(count: Column, size: int = PAGE) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / size)).cast("long")


def article_places(obs: DataFrame, country: str, day: date, url: str) -> DataFrame:
    """The places of the country that an article names: one row."""
    rows = obs.where((F.col("day") == F.lit(day)) & (F.col("url") == url))
    return rows.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(places(F.col("raw_locations"), F.lit(country)))))).alias("places"))


def search(rows: DataFrame, words: str, columns: list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """Rows that hold the words in some column, ignoring case; codes are searched by their
    labels too."""
    needle = words.lower()
    hit = F.lit(False)
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]) if labels else None
    for c in columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        hit = hit | F.lower(text).contains(needle)
        if names is not None:
            hit = hit | F.lower(F.coalesce(names[F.col(c)], text)).contains(needle)
    return rows.where(hit)


def sort_by(rows: DataFrame, column: str, descending: bool, allowed: tuple[str, ...]) -> DataFrame:
    """Rows by a column that the caller may choose, nulls as the empty text, then outlet."""
    if column not in allowed:
        raise ValueError(f"cannot sort by {column}")
    kind = dict(rows.dtypes)[column]
    key = F.coalesce(F.col(column), F.lit("")) if kind == "string" else F.col(column)
    return rows.orderBy(key.desc() if descending else key.asc(), F.col("outlet").asc_nulls_first())


def opened_by(docs: DataFrame, items: DataFrame, words: int = 12) -> DataFrame:
    """doc_id, item_id for docs(doc_id, text) that hold the first words of items(item_id, text)
    somewhere (E4). Each word of a document is hashed once and each run of words from its words'
    hashes; runs meet the openings by hash in one scan, so nothing but hits leaves it, and hits
    are compared as text. Openings are broadcast, BROADCAST of them a scan."""
    w = tokens(F.col("text"))
    openings = items.withColumn("w", w).where(F.size("w") >= words).select("item_id", F.array_join(F.slice("w", 1, words), " ").alias("run"))
    mixed = lambda get: F.xxhash64(*[get(j) for j in range(words)])
    split = F.split("run", " ")
    wanted = cut(openings.select("item_id", "run", mixed(lambda j: F.xxhash64(F.get(split, F.lit(j)))).alias("k")))
    hashed = docs.select("doc_id", F.explode(F.array(w)).alias("w")).where(F.size("w") >= words).select("doc_id", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("x"))
    runs = hashed.select("doc_id", "w", "x", F.explode(F.sequence(F.lit(0), F.size("x") - words)).alias("at"))
    runs = runs.select("doc_id", "w", "at", mixed(lambda j: F.get("x", F.col("at") + j)).alias("k"))
    passes = max(1, -(-wanted.count() // BROADCAST))
    found = None
    for n in range(passes):
        met = runs.join(F.broadcast(wanted.where(F.pmod("k", F.lit(passes)) == n)), "k")
        met = met.where(F.array_join(F.slice("w", F.col("at") + 1, words), " ") == F.col("run")).select("doc_id", "item_id")
        found = met if found is None else found.unionByName(met)
    return found.distinct()
