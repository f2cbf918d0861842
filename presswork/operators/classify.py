"""From raw geo-tagged documents to classified observations of a URL on a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions import domains
from presswork.plans.lineage import cut

#: Location types that name a place below a country.
SPECIFIC = ("2", "3", "4", "5")
GROUPS = ("Chinese", "Local", "Third country", "Unknown or uncertain")


def locations(raw: Column) -> Column:
    """Fields of each location in an array of `type#name#country#...;...` strings."""
    return F.flatten(F.transform(raw, lambda r: F.transform(F.split(F.coalesce(r, F.lit("")), ";"), lambda x: F.split(x, "#"))))


def countries(raw: Column, code: str = "^[A-Z]{2}$") -> Column:
    """Sorted distinct country codes of all locations."""
    found = F.transform(locations(raw), lambda p: F.get(p, F.lit(2)))
    return F.array_sort(F.array_distinct(F.filter(found, lambda c: F.coalesce(c.rlike(code), F.lit(False)))))


def specific_countries(raw: Column, types: tuple[str, ...] = SPECIFIC) -> Column:
    found = F.filter(locations(raw), lambda p: F.get(p, F.lit(0)).isin(*types) & F.get(p, F.lit(2)).isNotNull())
    return F.array_sort(F.array_distinct(F.transform(found, lambda p: F.get(p, F.lit(2)))))


def places(raw: Column, country: Column, types: tuple[str, ...] = SPECIFIC) -> Column:
    """Sorted distinct names of the country's places."""
    found = F.filter(locations(raw), lambda p: (F.size(p) > 2) & (F.get(p, F.lit(2)) == country) & F.get(p, F.lit(0)).isin(*types))
    return F.array_sort(F.array_distinct(F.transform(found, lambda p: F.get(p, F.lit(1)))))


#: Second-level labels below which countries register names, as in co.uk or com.au.
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gob", "gov", "gouv", "mil", "ne", "net", "nom", "or", "org", "sch")


def _domain(host: Column) -> Column:
    suffix = r"[^.]+\.(?:" + "|".join(SECOND_LEVEL) + r")\.[a-z]{2}"
    return F.nullif(F.regexp_extract(host, rf"(?:^|\.)({suffix}|[^.]+\.[^.]+)$", 1), F.lit(""))


def registrable_domain(url: Column) -> Column:
    """The registrable domain of a URL's host without a public suffix list, null without one: its
    last two labels, or three where a country's two letters follow one of SECOND_LEVEL. With a
    list, ``domains.registrable`` tells it for all hosts at once."""
    return _domain(domains.host(url))


def last_label(outlet: Column) -> Column:
    """What follows the last dot of an outlet; null without a dot."""
    return F.nullif(F.regexp_extract(F.lower(F.rtrim(outlet, F.lit("."))), r"\.([^.]+)$", 1), F.lit(""))


def json_pairs(spark: SparkSession, text: str) -> DataFrame:
    """(key, value) of a JSON array of pairs that arrives as a parameter."""
    rows = spark.sql("SELECT explode(from_json(:pairs, 'array<array<string>>')) AS item", args={"pairs": text})
    return rows.select(F.get("item", F.lit(0)).alias("key"), F.get("item", F.lit(1)).alias("value"))


def unambiguous(pairs: DataFrame) -> DataFrame:
    """A value for each lower-cased key: null where the key is given several."""
    return pairs.groupBy(F.lower("key").alias("key")).agg(F.when(F.count_distinct("value") == 1, F.max("value")).alias("value"))


def with_evidence(docs: DataFrame, outlets: DataFrame, suffixes: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """docs(day, url, v2locations) whose url is http(s), with outlet, estimated_country and
    domain_country. What a URL says, it says by its host: each distinct host gets its domain
    (by a public suffix list's rules, if given: ``domains.rules``) and meets both mappings,
    and the rows meet that one table of hosts, which is broadcast where it was counted to be
    small and joined by a shuffle else."""
    # a generator keeps the optimizer from reading a URL again for each use of its host
    rows = docs.where(F.col("url").rlike("(?i)^https?://")).select("*", F.explode(F.array(domains.host(F.col("url")))).alias("host"))
    hosts = rows.select("host").where("host is not null").distinct()
    named = domains.registrable(hosts, rules) if rules is not None else hosts.select("host", _domain(F.col("host")).alias("domain"))
    named = cut(named.withColumnRenamed("domain", "outlet"))
    estimated = unambiguous(outlets).select(F.col("key").alias("o_key"), F.col("value").alias("estimated_country"))
    domain = unambiguous(suffixes).select(F.col("key").alias("s_key"), F.col("value").alias("domain_country"))
    known = named.join(estimated, F.col("outlet") == F.col("o_key"), "left").join(domain, last_label(F.col("outlet")) == F.col("s_key"), "left")
    known = cut(known.select(F.col("host").alias("_host"), "outlet", "estimated_country", "domain_country"))
    return rows.join(domains.small(known), F.col("host") == F.col("_host"), "left").drop("host", "_host")


def outlet_country(est: Column, dom: Column) -> Column:
    return F.when(est.isNotNull() & dom.isNotNull() & (est != dom), None).otherwise(F.coalesce(est, dom))


def basis(est: Column, dom: Column) -> Column:
    return F.when(est != dom, "conflict").when(est == dom, "estimate_domain_agree").when(est.isNotNull(), "estimate_only").when(dom.isNotNull(), "domain_only").otherwise("unknown")


def outlet_group(country: Column, pivot: str, target: str) -> Column:
    return F.when(country == pivot, GROUPS[0]).when(country == target, GROUPS[1]).when(country.isNull(), GROUPS[3]).otherwise(GROUPS[2])


def observations(docs: DataFrame, pivot: str, target: str, code: str = "^[A-Z]{2}$") -> DataFrame:
    """docs(day, url, outlet, estimated_country, domain_country, v2locations) grouped to one
    row for each day, URL and classification."""
    keys = ["day", "url", "outlet", "estimated_country", "domain_country"]
    grouped = docs.groupBy(*keys).agg(F.array_sort(F.collect_set("v2locations")).alias("raw_locations"), F.count(F.lit(1)).alias("source_records"))
    est, dom, raw = F.col("estimated_country"), F.col("domain_country"), F.col("raw_locations")
    return grouped.select(
        "*", countries(raw, code).alias("countries"), specific_countries(raw).alias("specific_location_countries"),
        outlet_country(est, dom).alias("outlet_country"), basis(est, dom).alias("classification_basis"),
    ).withColumn("outlet_group", outlet_group(F.col("outlet_country"), pivot, target))


def pair_candidates(obs: DataFrame, pivot: str, target: str) -> DataFrame:
    """Observations about the pair: published by one about the other, or about both."""
    has = lambda c: F.array_contains("countries", c)
    by = F.col("outlet_country")
    return obs.where(((by == pivot) & has(target)) | ((by == target) & has(pivot)) | (has(pivot) & has(target)))


def by_source_country(obs: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """A row for each source country that published an observation by estimate or domain, among
    the given ones or all: the theta cross join rewritten as an explode of at most two
    candidates."""
    some = F.array_compact(F.array_distinct(F.array("estimated_country", "domain_country")))
    if sources is not None:
        obs = obs.where(F.col("estimated_country").isin(*sources) | F.col("domain_country").isin(*sources))
        some = F.filter(some, lambda c: c.isin(*sources))
    return obs.withColumn("source_country", F.explode(some))


def catalog_codes(obs: DataFrame, pivot: str) -> DataFrame:
    """Distinct codes by which anything was published, without the pivot."""
    return obs.select(F.explode(F.array("estimated_country", "domain_country")).alias("code")).where(F.col("code").isNotNull() & (F.col("code") != pivot)).distinct().orderBy("code")


def filter_matrix(obs: DataFrame, about: str) -> DataFrame:
    """outlet_group, filter, daily_observations, unique_urls, websites: five filters on what
    observations mention, counted for each group (A24). Rows are folded to one a URL and
    outlet, with a count for each filter, before they are spread over the filters."""
    named, place = F.array_contains("countries", about), F.array_contains("specific_location_countries", about)
    pair = named & (F.size("countries") == 2)
    tests = {"broad": F.lit(True), "both": named, "only_pair": pair, "only_pair_specific": pair & place, "specific": place}
    folded = obs.groupBy("outlet_group", "url", "outlet").agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    spread = folded.select("outlet_group", "url", "outlet", F.explode(F.array(*[F.struct(F.lit(x).alias("filter"), F.col(x).alias("n")) for x in tests])).alias("x")).select("outlet_group", "url", "outlet", "x.*")
    hit = lambda c: F.count_distinct(F.when(F.col("n") > 0, F.col(c)))
    return spread.groupBy("outlet_group", "filter").agg(F.sum("n").alias("daily_observations"), hit("url").alias("unique_urls"), hit("outlet").alias("websites"))
