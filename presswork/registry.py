"""Queries over the driver's tables, with the SQL that each must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.functions import domains, urls
from presswork.functions import pages as page_functions
from presswork.functions import text as texts
from presswork.operators import audit, browse, classify, collection, export, extraction, packing
from presswork.plans.lineage import cut, shared_dir
from presswork.sources import arrays, proxy
from presswork.sources.proxy import CODE, EVENTS_SQL, OBS_SQL, PIVOT, RAW_SQL, TARGET
from presswork.sources.tables import table
from presswork.streaming import expiry, outbox, pacing, snapshots, stateful

START, END = date(2016, 1, 1), date(2019, 12, 31)
MISSING = [date(2016, 2, 15), date(2017, 7, 1), date(2017, 7, 2), date(2019, 12, 31)]
NOW = datetime(2024, 1, 20)
#: When work is claimed: the last results of some articles lie before it, of others after.
CLAIMED = datetime(2024, 1, 30)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


#: Queries that return days, and the columns that hold them: both sides give them as text.
DAYS = {
    "day": "classify_observations country_candidates_cross daily_histogram origin_gdelt origin_cctld origin_both mode_broad mode_both mode_only_pair article_places search_rows joined_export",
    "bucket": "audit_grouping_sets audit_by_day audit_by_month audit_by_year browse_overview",
    "period": "calendar_spine",
    "month": "browse_timeline",
    "first_observed last_observed": "stories_by_url stories_page input_rollup",
    "first_observed": "pilot_sample",
    "last_observed": "downloaded_semi_join download_status_join",
}


def query(sql: str | None = None):
    def put(function):
        name = function.__name__
        days = [c for columns, names in DAYS.items() if name in names.split() for c in columns.split()]

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = function(spark, sf_dir)
            return found.withColumns({c: F.col(c).cast("string") for c in days}) if days else found

        _QUERIES[name] = run
        if sql:
            _SQL[name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in days)}) FROM ({sql})" if days else sql
        return function

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return classify.observations(proxy.raw_documents(spark, d), PIVOT, TARGET, CODE)


def _events(spark: SparkSession, d: str) -> DataFrame:
    return proxy.result_events(spark, d)


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return collection.latest(_events(spark, d), ["run_id", "article_id"])


def _text(c: str) -> F.Column:
    return F.array_join(c, ";").alias(c)


OBS = "WITH " + OBS_SQL
EV = "WITH " + EVENTS_SQL
RANGE = f"day BETWEEN DATE '{START}' AND DATE '{END}'"
SEL = {"gdelt": "estimated_country = '{c}'", "cctld": "domain_country = '{c}'", "both": "estimated_country = '{c}' AND domain_country = '{c}'"}
FACTS = OBS + f""", fact AS (SELECT day, outlet_group, outlet, outlet_country, estimated_country, domain_country, classification_basis, count(DISTINCT url) AS article_count FROM facts GROUP BY ALL),
au AS (
  SELECT CASE WHEN grouping(bucket) = 0 THEN 'timeline' WHEN grouping(outlet) = 0 THEN 'outlet' ELSE 'summary' END AS kind,
    bucket, outlet_group, outlet, outlet_country, estimated_country, domain_country, classification_basis,
    CAST(sum(article_count) AS BIGINT) AS articles, count(DISTINCT outlet) AS active_outlets, count(DISTINCT day) AS active_days
  FROM (SELECT *, CAST(date_trunc('{{interval}}', day) AS DATE) AS bucket FROM fact WHERE {RANGE})
  GROUP BY GROUPING SETS ((bucket, outlet_group), (outlet_group), (outlet_group, outlet, outlet_country, estimated_country, domain_country, classification_basis)))"""


# -- classification ---------------------------------------------------------------------

@query("WITH " + RAW_SQL + """, d AS (SELECT *, regexp_extract(lower(regexp_extract(url, '^https?://([^/]+)', 1)), '([^.]+\\.[^.]+)$', 1) AS o FROM raw_documents),
m AS (SELECT o AS k, CASE WHEN count(DISTINCT c) = 1 THEN max(c) END AS v FROM (SELECT DISTINCT o, CASE WHEN CAST(substr(string_split(o, '.')[1], 2) AS INT) % 3 = 0 THEN estimated_country ELSE domain_country END AS c FROM d) WHERE c IS NOT NULL GROUP BY o),
s(k, v) AS (VALUES ('n1','N01'),('n2','N02'),('n3','N03'),('n4','N04'),('n5',NULL),('n9','N09'),('n7','N07')),
e AS (SELECT d.day, d.url, d.o AS outlet, m.v AS est, s.v AS dom FROM d LEFT JOIN m ON d.o = m.k LEFT JOIN s ON string_split(d.o, '.')[2] = s.k)
SELECT outlet, est AS estimated_country, dom AS domain_country,
  CASE WHEN est <> dom THEN 'conflict' WHEN est = dom THEN 'estimate_domain_agree' WHEN est IS NOT NULL THEN 'estimate_only' WHEN dom IS NOT NULL THEN 'domain_only' ELSE 'unknown' END AS classification_basis,
  count(*) AS records FROM e GROUP BY ALL""")
def classify_documents(spark: SparkSession, d: str) -> DataFrame:
    """Registrable domain, mappings with ambiguity, evidence and basis."""
    raw = cut(proxy.raw_documents(spark, d).select("day", "url", "estimated_country", "domain_country", "v2locations"))
    key = classify.registrable_domain(F.col("url"))
    value = F.when(F.substring_index(F.substring(key, 2, 99), ".", 1).cast("int") % 3 == 0, F.col("estimated_country")).otherwise(F.col("domain_country"))
    outlets = raw.select(key.alias("key"), value.alias("value")).where("value is not null").distinct()
    suffixes = classify.json_pairs(spark, '[["n1","N01"],["n2","N02"],["N3","N03"],["n4","N04"],["n5","N05"],["n5","N06"],["n9","N09"],["n7","N07"]]')
    rows = classify.with_evidence(raw.select("day", "url", "v2locations"), outlets, suffixes)
    est, dom = F.col("estimated_country"), F.col("domain_country")
    return rows.groupBy("outlet", est, dom, classify.basis(est, dom).alias("classification_basis")).agg(F.count(F.lit(1)).alias("records"))


@query(OBS + f""" SELECT day, url, outlet, outlet_country, classification_basis, estimated_country, domain_country, outlet_group, array_to_string(countries, ';') AS countries, array_to_string(raw_locations, '|') AS raw_locations, CAST(source_records AS BIGINT) AS source_records
FROM facts WHERE (outlet_country = '{PIVOT}' AND list_contains(countries, '{TARGET}')) OR (outlet_country = '{TARGET}' AND list_contains(countries, '{PIVOT}')) OR (list_contains(countries, '{PIVOT}') AND list_contains(countries, '{TARGET}'))""")
def classify_observations(spark: SparkSession, d: str) -> DataFrame:
    """Observations about the pair."""
    rows = classify.pair_candidates(_obs(spark, d), PIVOT, TARGET)
    return rows.select("day", "url", "outlet", "outlet_country", "classification_basis", "estimated_country", "domain_country", "outlet_group", _text("countries"), F.array_join("raw_locations", "|").alias("raw_locations"), "source_records")


@query("""SELECT lower(o_orderpriority || '-' || CAST(o_custkey AS VARCHAR)) AS key, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN max(o_orderstatus) END AS value FROM orders GROUP BY 1""")
def ambiguous_mapping(spark: SparkSession, d: str) -> DataFrame:
    """A mapping whose keys may be given several values."""
    pairs = table(spark, d, "orders").select(F.concat_ws("-", "o_orderpriority", F.col("o_custkey").cast("string")).alias("key"), F.col("o_orderstatus").alias("value"))
    return classify.unambiguous(pairs)


@query(OBS + f""" SELECT source_country, day, url FROM (SELECT DISTINCT unnest(list_distinct([estimated_country, domain_country])) AS source_country, day, url, outlet FROM obs) WHERE source_country IN ('{PIVOT}', '{TARGET}', 'N14')""")
def country_candidates_cross(spark: SparkSession, d: str) -> DataFrame:
    """Observations for each source country."""
    return classify.by_source_country(_obs(spark, d), [PIVOT, TARGET, "N14"]).select("source_country", "day", "url", "outlet").distinct().drop("outlet")


@query(OBS + f" SELECT DISTINCT code FROM (SELECT unnest([estimated_country, domain_country]) AS code FROM obs) WHERE code IS NOT NULL AND code <> '{PIVOT}'")
def catalog_codes(spark: SparkSession, d: str) -> DataFrame:
    """Countries to choose from."""
    return classify.catalog_codes(_obs(spark, d), PIVOT)


# -- the audit --------------------------------------------------------------------------

def _audit(spark: SparkSession, d: str, interval: str = "week") -> DataFrame:
    return audit.audit(audit.daily(_obs(spark, d)), START, END, interval)


@query(FACTS.replace("{interval}", "week") + " SELECT * FROM au")
def audit_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: timeline, summary and outlets in one pass."""
    return _audit(spark, d)


for _interval in ("day", "month", "year"):
    def _one(spark: SparkSession, d: str, interval: str = _interval) -> DataFrame:
        return _audit(spark, d, interval)

    _one.__name__ = f"audit_by_{_interval}"
    query(FACTS.replace("{interval}", _interval) + " SELECT * FROM au")(_one)


@query(FACTS.replace("{interval}", "week") + """, g(outlet_group) AS (VALUES ('Chinese'), ('Local'), ('Third country'), ('Unknown or uncertain')),
o AS (SELECT outlet_group, arg_min(outlet, (-articles, outlet)) FILTER (coalesce(outlet, '') <> '') AS largest_outlet, max(articles) FILTER (coalesce(outlet, '') <> '') AS most, sum(articles) FILTER (coalesce(outlet, '') = '') AS missing FROM au WHERE kind = 'outlet' GROUP BY 1)
SELECT g.outlet_group, coalesce(articles, 0) AS articles, coalesce(active_outlets, 0) AS active_outlets, coalesce(active_days, 0) AS active_days, largest_outlet,
  coalesce(most, 0) AS largest_outlet_articles, CAST(coalesce(missing, 0) AS BIGINT) AS missing_domain_articles
FROM g LEFT JOIN (SELECT * FROM au WHERE kind = 'summary') s USING (outlet_group) LEFT JOIN o USING (outlet_group)""")
def audit_summary_shape(spark: SparkSession, d: str) -> DataFrame:
    """Zero-filled groups, the largest known outlet, articles without one (A2)."""
    return audit.summary(_audit(spark, d))


_PERIODS = FACTS.replace("{interval}", "month") + f""", cal AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS day),
sp AS (SELECT CAST(date_trunc('month', day) AS DATE) AS period, count(*) AS expected_days, count(*) FILTER (day NOT IN ({", ".join(f"DATE '{x}'" for x in MISSING)})) AS available_days FROM cal GROUP BY 1),
g(outlet_group) AS (VALUES ('Chinese'), ('Local'), ('Third country'), ('Unknown or uncertain')),
pr AS (SELECT period, g.outlet_group, expected_days, available_days, coalesce(articles, 0) AS articles, coalesce(active_outlets, 0) AS active_outlets FROM sp CROSS JOIN g LEFT JOIN (SELECT * FROM au WHERE kind = 'timeline') t ON t.bucket = period AND t.outlet_group = g.outlet_group)"""


def _periods(spark: SparkSession, d: str) -> DataFrame:
    return audit.periods(_audit(spark, d, "month").where("kind = 'timeline'"), START, END, "month", MISSING)


@query(_PERIODS + " SELECT * FROM pr")
def calendar_spine(spark: SparkSession, d: str) -> DataFrame:
    """Every period and group, with available days."""
    return _periods(spark, d).select("period", "outlet_group", "expected_days", "available_days", "articles", "active_outlets")


@query(_PERIODS + """, e AS (SELECT period, bool_and(available_days = expected_days) AS whole, bool_and((active_outlets >= 1 AND articles >= 3) OR outlet_group NOT IN ('Chinese', 'Local')) AS good FROM pr GROUP BY 1),
c AS (SELECT count(*) FILTER (whole) AS complete, count(*) FILTER (NOT whole) AS excluded, count(*) FILTER (whole AND good) AS passing FROM e)
SELECT *, round(100.0 * passing / nullif(complete, 0), 6) AS percent, coalesce(100.0 * passing / nullif(complete, 0) >= 50, FALSE) AS meets FROM c""")
def coverage_assessment(spark: SparkSession, d: str) -> DataFrame:
    """Do enough complete periods reach the minimums."""
    return audit.assess(_periods(spark, d), 1, 3, 50).withColumn("percent", F.round("percent", 6))


@query(OBS + f""" , r AS (SELECT url, unnest(list_distinct(list(day))) AS day FROM obs GROUP BY url), cal AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, count(url) AS count FROM cal LEFT JOIN r USING (day) GROUP BY day""")
def daily_histogram(spark: SparkSession, d: str) -> DataFrame:
    """URLs a day over rows that have several days."""
    rows = _obs(spark, d).groupBy("url").agg(F.collect_set("day").alias("days"))
    return audit.histogram(rows, audit.calendar(spark, START, END))


@query(FACTS.replace("{interval}", "year") + " SELECT outlet_group, outlet, articles, rn AS rank FROM (SELECT *, row_number() OVER (PARTITION BY outlet_group ORDER BY articles DESC, coalesce(outlet, ''), coalesce(classification_basis, ''), coalesce(outlet_country, ''), coalesce(estimated_country, ''), coalesce(domain_country, '')) AS rn FROM au WHERE kind = 'outlet') WHERE rn BETWEEN 3 AND 6")
def ranked_outlets(spark: SparkSession, d: str) -> DataFrame:
    """A page of each group's outlets by articles."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    order = Window.partitionBy("outlet_group").orderBy(F.desc("articles"), *map(blank, ("outlet", "classification_basis", "outlet_country", "estimated_country", "domain_country")))
    rows = _audit(spark, d, "year").where("kind = 'outlet'").withColumn("rank", F.row_number().over(order).cast("long"))
    return rows.where("rank between 3 and 6").select("outlet_group", "outlet", "articles", "rank")


# -- browsing ---------------------------------------------------------------------------

for _name, _where in SEL.items():
    def _one(spark: SparkSession, d: str, name: str = _name) -> DataFrame:
        return browse.select(_obs(spark, d), TARGET, "broad", name).select("day", "url", "outlet")

    _one.__name__ = f"origin_{_name}"
    query(OBS + f" SELECT day, url, outlet FROM obs WHERE {_where.format(c=TARGET)}")(_one)

for _name, _where in {"broad": "TRUE", "both": "list_contains(countries, '{c}')", "only_pair": "list_contains(countries, '{c}') AND len(countries) = 2"}.items():
    def _one(spark: SparkSession, d: str, name: str = _name) -> DataFrame:
        return browse.select(_obs(spark, d), TARGET, name, "gdelt", place=True).select("day", "url", "outlet")

    _one.__name__ = f"mode_{_name}"
    query(OBS + f" SELECT day, url, outlet FROM obs WHERE estimated_country = '{TARGET}' AND {_where.format(c=TARGET)} AND list_contains(specific_location_countries, '{TARGET}')")(_one)

_BASE = OBS + f", b AS (SELECT * FROM obs WHERE estimated_country = '{TARGET}'), bd AS (SELECT * FROM b WHERE {RANGE})"


def _base(spark: SparkSession, d: str) -> DataFrame:
    return browse.select(_obs(spark, d), TARGET)


@query(_BASE + " SELECT outlet, count(DISTINCT url) AS count FROM bd GROUP BY outlet")
def browse_outlets(spark: SparkSession, d: str) -> DataFrame:
    """URLs of each outlet within the dates (A3 L3)."""
    return browse.outlets(_base(spark, d), START, END)


@query(_BASE + " SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT url) AS count FROM b GROUP BY 1")
def browse_timeline(spark: SparkSession, d: str) -> DataFrame:
    """URLs of each month, whatever the dates (A4)."""
    return browse.timeline(_base(spark, d))


@query(_BASE + " SELECT 'outlet' AS kind, outlet, count(DISTINCT url) AS count, CAST(NULL AS DATE) AS bucket FROM bd GROUP BY outlet UNION ALL SELECT 'timeline', NULL, count(DISTINCT url), CAST(date_trunc('month', day) AS DATE) FROM b GROUP BY 4")
def browse_overview(spark: SparkSession, d: str) -> DataFrame:
    """Outlets and months in one result."""
    return browse.overview(_base(spark, d), START, END)


@query(_BASE + " SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS count, count(*) AS websites FROM (SELECT outlet, count(DISTINCT url) AS n FROM bd GROUP BY outlet)")
def browse_totals_api(spark: SparkSession, d: str) -> DataFrame:
    """Totals as sums over outlets (A5)."""
    return browse.totals(_base(spark, d), START, END)


_LATEST = _BASE + """, lu AS (SELECT * EXCLUDE (rn) FROM (SELECT *, min(day) OVER (PARTITION BY url) AS first_observed, day AS last_observed, row_number() OVER (PARTITION BY url ORDER BY day DESC, coalesce(outlet, '')) AS rn FROM bd) WHERE rn = 1)"""


@query(_LATEST + " SELECT count(*) AS count, count(DISTINCT outlet) AS websites FROM lu")
def browse_totals_cache(spark: SparkSession, d: str) -> DataFrame:
    """Totals over URLs."""
    return browse.totals_by_url(_base(spark, d), START, END)


@query(_LATEST + " SELECT url, outlet, first_observed, last_observed, array_to_string(countries, ';') AS countries FROM lu")
def stories_by_url(spark: SparkSession, d: str) -> DataFrame:
    """First, last and latest evidence of each URL."""
    return browse.latest(_base(spark, d), START, END).select("url", "outlet", "first_observed", "last_observed", _text("countries"))


@query(_BASE + """ SELECT outlet, url, min(day) AS first_observed, max(day) AS last_observed, array_to_string(arg_max(countries, day), ';') AS countries, arg_max(domain_country, day) AS domain_country FROM bd GROUP BY outlet, url ORDER BY last_observed DESC, url, outlet LIMIT 20 OFFSET 20""")
def stories_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of stories."""
    return browse.stories(_base(spark, d), START, END, page=1).select("outlet", "url", "first_observed", "last_observed", _text("countries"), "domain_country")


@query(OBS + f""" SELECT url, day, array_to_string(list_sort(list_distinct(list_transform(list_filter(flatten(list_transform(raw_locations, lambda r: list_transform(string_split(r, ';'), lambda l: string_split(l, '#')))), lambda p: len(p) > 2 AND p[3] = '{TARGET}' AND p[1] IN ('2','3','4','5')), lambda p: p[2]))), ';') AS places FROM obs WHERE estimated_country = '{TARGET}'""")
def article_places(spark: SparkSession, d: str) -> DataFrame:
    """Places that each article names."""
    return _base(spark, d).select("url", "day", F.array_join(classify.places(F.col("raw_locations"), F.lit(TARGET)), ";").alias("places"))


_FILTERS = f"{{'broad': TRUE, 'both': list_contains(countries, '{TARGET}'), 'only_pair': list_contains(countries, '{TARGET}') AND len(countries) = 2, 'only_pair_specific': list_contains(countries, '{TARGET}') AND len(countries) = 2 AND list_contains(specific_location_countries, '{TARGET}'), 'specific': list_contains(specific_location_countries, '{TARGET}')}}"


@query(OBS + f""", m AS (SELECT outlet_group, url, outlet, unnest(map_entries(map(['broad','both','only_pair','only_pair_specific','specific'], [TRUE, list_contains(countries, '{TARGET}'), list_contains(countries, '{TARGET}') AND len(countries) = 2, list_contains(countries, '{TARGET}') AND len(countries) = 2 AND list_contains(specific_location_countries, '{TARGET}'), list_contains(specific_location_countries, '{TARGET}')]))) AS f FROM facts)
SELECT outlet_group, f.key AS filter, count(*) FILTER (f.value) AS daily_observations, count(DISTINCT url) FILTER (f.value) AS unique_urls, count(DISTINCT outlet) FILTER (f.value) AS websites FROM m GROUP BY 1, 2""")
def pilot_filter_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Groups by filters, as URLs and as daily observations."""
    return classify.filter_matrix(_obs(spark, d), TARGET)


@query(OBS + f" SELECT day, url, outlet FROM obs WHERE contains(lower(coalesce(outlet, '')), 's1') OR contains(lower(coalesce(CASE estimated_country WHEN '{PIVOT}' THEN 'Pivotland' ELSE estimated_country END, '')), 's1') OR contains(lower(coalesce(estimated_country, '')), 's1')")
def search_rows(spark: SparkSession, d: str) -> DataFrame:
    """Substring search over columns and labels."""
    return browse.search(_obs(spark, d), "S1", ["outlet", "estimated_country"], {PIVOT: "Pivotland"}).select("day", "url", "outlet")


@query(OBS + " SELECT outlet, first_observed, last_observed, url FROM (SELECT url, outlet, min(day) AS first_observed, max(day) AS last_observed FROM obs GROUP BY url, outlet)")
def input_rollup(spark: SparkSession, d: str) -> DataFrame:
    """First and last day of each input."""
    return collection.input_rollup(_obs(spark, d))


@query(OBS + """, i AS (SELECT url, outlet, min(day) AS f FROM obs GROUP BY url, outlet), t AS (SELECT outlet FROM i WHERE outlet IS NOT NULL GROUP BY outlet ORDER BY count(*) DESC, outlet LIMIT 12),
x AS (SELECT i.*, row_number() OVER (PARTITION BY outlet ORDER BY f, url) AS a, row_number() OVER (PARTITION BY outlet ORDER BY f DESC, url DESC) AS b FROM i JOIN t USING (outlet))
SELECT DISTINCT outlet, url, f AS first_observed FROM x WHERE a = 1 OR b = 1""")
def pilot_sample(spark: SparkSession, d: str) -> DataFrame:
    """First and last URL of the twelve largest outlets."""
    return collection.pilot_sample(collection.input_rollup(_obs(spark, d)))


@query(OBS + f" SELECT count(*) AS rows, count(DISTINCT url) AS unique_urls, count(DISTINCT outlet) AS websites, count(*) FILTER (estimated_country = '{TARGET}') AS gdelt_rows, count(DISTINCT url) FILTER (estimated_country = '{TARGET}') AS gdelt_unique_urls FROM obs")
def cache_stats(spark: SparkSession, d: str) -> DataFrame:
    """Figures of an export."""
    return export.stats(_obs(spark, d), TARGET)


# -- collection results -----------------------------------------------------------------

@query(EV + " SELECT run_id, article_id, outlet, updated_at, status, seq FROM latest")
def latest_results(spark: SparkSession, d: str) -> DataFrame:
    """The newest event of each article."""
    return _latest(spark, d).select("run_id", "article_id", "outlet", "updated_at", "status", "seq")


@query(EV + " SELECT outlet, status, count(*) AS articles FROM latest WHERE status NOT IN ('deferred', 'retrying', 'queued') GROUP BY ALL")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Final results by outlet and status."""
    return collection.status_counts(_latest(spark, d))


@query(EV + " SELECT run_id, count(*) AS completed, CAST(sum(list_sum(http_counts)) AS BIGINT) AS attempts, CAST(sum(list_sum(list_transform(http_counts, lambda x: greatest(0, x - 1)))) AS BIGINT) AS retries, CAST(sum(response_bytes) AS BIGINT) AS response_bytes FROM latest WHERE status <> 'deferred' GROUP BY 1")
def attempt_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Attempts, retries and bytes."""
    return collection.metrics(_latest(spark, d))


@query(EV + " SELECT CAST(CAST(('0x' || substr(article_id, 1, 8)) AS BIGINT) % 32 AS INT) AS shard, count(*) AS total, count(*) FILTER (status <> 'deferred') AS processed, CAST(sum(CASE WHEN status <> 'deferred' THEN list_sum(http_counts) ELSE 0 END) AS BIGINT) AS attempts, CAST(sum(CASE WHEN status <> 'deferred' THEN response_bytes ELSE 0 END) AS BIGINT) AS response_bytes FROM latest GROUP BY 1")
def shard_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters by shard."""
    return collection.shard_counters(_latest(spark, d))


_PROGRESS = EV + """, lv AS (SELECT outlet, count(*) AS live FROM latest WHERE seq % 7 = 0 GROUP BY 1),
p AS (SELECT l.outlet, count(*) AS total, count(*) FILTER (status <> 'deferred') AS processed, count(*) FILTER (status = 'saved') AS saved, count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'exhausted') AS exhausted, count(*) FILTER (status = 'failed') AS failed FROM latest l GROUP BY 1),
q AS (SELECT p.*, greatest(0, total - processed) AS remaining, least(greatest(0, total - processed), coalesce(live, 0)) AS active FROM p LEFT JOIN lv USING (outlet))"""


def _progress(spark: SparkSession, d: str) -> DataFrame:
    newest = _latest(spark, d)
    return collection.progress(newest, newest.where("seq % 7 = 0").groupBy("outlet").agg(F.count(F.lit(1)).alias("live")))


@query(_PROGRESS + " SELECT outlet, total, processed, saved, partial, exhausted, failed, remaining, active, remaining - active AS pending FROM q")
def progress_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Finished, active and pending articles by outlet."""
    return _progress(spark, d)


@query(_PROGRESS + " SELECT CAST(sum(total) AS BIGINT) AS total, CAST(sum(saved + partial + exhausted + failed) AS BIGINT) AS finished, round(100 * sum(saved + partial + exhausted + failed) / sum(total), 4) AS percent FROM q")
def public_status(spark: SparkSession, d: str) -> DataFrame:
    """Totals as the public sees them."""
    return collection.public_status(_progress(spark, d))


_MANIFEST = EV + ", manifest AS (SELECT DISTINCT run_id, article_id, outlet FROM ev)"


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("run_id", "article_id", "outlet").distinct()


@query(_MANIFEST + " SELECT m.* FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.run_id = m.run_id AND l.article_id = m.article_id AND status <> 'deferred')")
def pending_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the manifest without a final result."""
    return collection.pending(_manifest(spark, d), _latest(spark, d))


@query(_MANIFEST + ", a AS (SELECT outlet, count(*) AS n FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.run_id = m.run_id AND l.article_id = m.article_id AND status <> 'deferred') GROUP BY 1), b AS (SELECT outlet, count(*) AS n FROM latest WHERE status <> 'deferred' GROUP BY 1) SELECT coalesce(a.outlet, b.outlet) AS outlet, coalesce(a.n, 0) AS pending, coalesce(b.n, 0) AS done FROM a FULL JOIN b ON a.outlet = b.outlet")
def pending_by_outlet(spark: SparkSession, d: str) -> DataFrame:
    """Pending and finished by outlet."""
    return collection.pending_by_outlet(_manifest(spark, d), _latest(spark, d))


@query(EV + " SELECT seq, run_id, article_id FROM ev WHERE outlet IN ('o3', 'o4')")
def outside_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Events that are no row of the manifest."""
    return collection.outside_manifest(_events(spark, d), _manifest(spark, d).where("outlet not in ('o3', 'o4')")).select("seq", "run_id", "article_id")


_DOWN = _LATEST + ", dl AS (SELECT 'https://www.s' || (user_id % 100) || '.n7/o' || (event_id % 400) AS url, CASE WHEN event_type IN ('view') THEN 'saved' WHEN event_type = 'click' THEN 'partial' ELSE 'failed' END AS status FROM events), ok AS (SELECT url, max(status) AS download_status FROM dl WHERE status IN ('saved', 'partial') GROUP BY url)"


def _downloads(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "view", "saved").when(F.col("event_type") == "click", "partial").otherwise("failed")
    return e.select(F.concat(F.lit("https://www.s"), (F.col("user_id") % 100).cast("string"), F.lit(".n7/o"), (F.col("event_id") % 400).cast("string")).alias("url"), status.alias("status"))


@query(_DOWN + " SELECT lu.url, outlet, last_observed, download_status FROM lu JOIN ok USING (url)")
def downloaded_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Stories that have been downloaded."""
    return browse.latest(_base(spark, d), START, END, _downloads(spark, d), True).select("url", "outlet", "last_observed", "download_status")


@query(_DOWN + " SELECT lu.url, outlet, last_observed, download_status FROM lu LEFT JOIN ok USING (url)")
def download_status_join(spark: SparkSession, d: str) -> DataFrame:
    """Stories with what is known of their download."""
    return browse.latest(_base(spark, d), START, END, _downloads(spark, d)).select("url", "outlet", "last_observed", "download_status")


_QUEUE = EV + ", q AS (SELECT article_id, outlet, run_id, updated_at AS due_at FROM latest), fl AS (SELECT outlet, count(*) % 3 AS inflight FROM latest GROUP BY 1)"


def _queue(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    newest = _latest(spark, d)
    q = newest.select("article_id", "outlet", F.col("updated_at").alias("due_at"), F.lit("ready").alias("state"))
    return q, newest.groupBy("outlet").agg((F.count(F.lit(1)) % 3).alias("inflight"))


@query(_QUEUE + f", r AS (SELECT *, row_number() OVER (PARTITION BY outlet ORDER BY due_at, article_id) AS nth FROM q WHERE due_at <= TIMESTAMP '{CLAIMED}' AND outlet <> 'o9') SELECT article_id, r.outlet, due_at FROM r LEFT JOIN fl USING (outlet) WHERE nth <= 4 - coalesce(inflight, 0) ORDER BY due_at, article_id LIMIT 16")
def claim_selection(spark: SparkSession, d: str) -> DataFrame:
    """The next work under capacities."""
    q, inflight = _queue(spark, d)
    return collection.claimable(q, CLAIMED, 16, 4, inflight, ("o9",))


@query(_QUEUE + " SELECT article_id, due_at FROM (SELECT *, row_number() OVER (ORDER BY due_at, article_id) AS n FROM q) WHERE n BETWEEN 11 AND 20")
def due_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of due work after a cursor."""
    q, _ = _queue(spark, d)
    far = datetime(2100, 1, 1)
    last = collection.due_page(q, far, 10).orderBy(F.desc("due_at"), F.desc("article_id")).first()
    return collection.due_page(q, far, 10, (last["due_at"], last["article_id"])).select("article_id", "due_at")


@query(EV + """, b AS (SELECT outlet, count(*) AS waiting, count(*) % 3 AS inflight FROM latest GROUP BY 1), s AS (SELECT outlet, unnest(generate_series(0, least(waiting, 6 - inflight) - 1)) AS j, waiting, inflight FROM b)
SELECT outlet, j, round((waiting - j) / (inflight + j + 1), 9) AS priority FROM s ORDER BY (waiting - j) / (inflight + j + 1) DESC, outlet DESC, j LIMIT 20""")
def backlog_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Largest backlog first."""
    backlog = _latest(spark, d).groupBy("outlet").agg(F.count(F.lit(1)).alias("waiting")).withColumn("inflight", F.col("waiting") % 3)
    return collection.schedule(backlog, 20, 6).withColumn("priority", F.round("priority", 9))


@query(EV + """, m AS (SELECT seq, outlet, updated_at, CAST(status IN ('failed', 'exhausted') AS INT) AS hit FROM ev), i AS (SELECT *, sum(1 - hit) OVER (PARTITION BY outlet ORDER BY updated_at, seq) AS g FROM m)
SELECT seq, outlet, CAST(sum(hit) OVER (PARTITION BY outlet, g ORDER BY updated_at, seq) AS BIGINT) AS streak FROM i""")
def block_streaks(spark: SparkSession, d: str) -> DataFrame:
    """Runs of failures."""
    return collection.streaks(_events(spark, d), "outlet", F.col("status").isin("failed", "exhausted"), ["updated_at", "seq"]).select("seq", "outlet", "streak")


@query(EV + " SELECT seq, outlet, array_to_string(list(status) OVER (PARTITION BY outlet ORDER BY updated_at, seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ';') AS last FROM ev")
def rolling_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The last five outcomes of an outlet."""
    return collection.rolling(_events(spark, d), "outlet", "status", 5, ["updated_at", "seq"]).select("seq", "outlet", _text("last"))


@query(EV + """, g AS (SELECT *, coalesce(sum(CAST(status = 'exhausted' AS INT)) OVER (PARTITION BY outlet ORDER BY updated_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM ev)
SELECT seq, outlet, array_to_string(list(status) OVER (PARTITION BY outlet, g ORDER BY updated_at, seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ';') AS last FROM g""")
def rolling_outcomes_reset(spark: SparkSession, d: str) -> DataFrame:
    """The last five outcomes of an outlet since the last one that changed its pace."""
    return collection.rolling(_events(spark, d), "outlet", "status", 5, ["updated_at", "seq"], reset=F.col("status") == "exhausted").select("seq", "outlet", _text("last"))


@query(EV + """, h AS (SELECT outlet, date_trunc('hour', updated_at) AS t, count(*) AS n FROM ev GROUP BY 1, 2), c AS (SELECT outlet, t, sum(n) OVER (PARTITION BY outlet ORDER BY t) AS saved FROM h)
SELECT outlet, t, CAST(saved AS BIGINT) AS saved, round((saved - lag(saved) OVER w) / (epoch_us(t) - epoch_us(lag(t) OVER w)) * 3.6e9, 6) AS per_hour FROM c WINDOW w AS (PARTITION BY outlet ORDER BY t)""")
def snapshot_rates(spark: SparkSession, d: str) -> DataFrame:
    """Results an hour between snapshots."""
    h = _events(spark, d).groupBy("outlet", F.date_trunc("hour", "updated_at").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    c = h.withColumn("saved", F.sum("n").over(Window.partitionBy("outlet").orderBy("t"))).drop("n")
    return collection.rate(c, "outlet", "saved", "t").withColumn("per_hour", F.round("per_hour", 6))


_BEATS = """WITH beats AS (SELECT CAST(user_id % 14 AS VARCHAR) AS task_index, user_id % 4 AS task_attempt, ts AS updated_at, CASE event_type WHEN 'view' THEN 'completed' WHEN 'click' THEN 'continuing' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'paused_limit' ELSE 'completed' END AS state, event_id FROM events),
lw AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY task_index ORDER BY task_attempt DESC, updated_at DESC) AS rn FROM beats WHERE CAST(task_index AS INT) < 12) WHERE rn = 1)"""


def _beats(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.col("event_type") == "view", "completed").when(F.col("event_type") == "click", "continuing").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "paused_limit").otherwise("completed")
    return table(spark, d, "events").select((F.col("user_id") % 14).cast("string").alias("task_index"), (F.col("user_id") % 4).alias("task_attempt"), F.col("ts").alias("updated_at"), state.alias("state"), "event_id", F.col("ts").alias("expires_at"), (F.col("event_id") % 5).alias("in_flight"), F.col("event_id").alias("requests"))


@query(_BEATS + " SELECT task_index, task_attempt, updated_at, state FROM lw")
def latest_workers(spark: SparkSession, d: str) -> DataFrame:
    """Each task's last record."""
    return collection.latest_workers(_beats(spark, d), 12).select("task_index", "task_attempt", "updated_at", "state")


@query(_BEATS + " SELECT CASE WHEN count(*) < 12 THEN 'running' WHEN bool_or(state = 'failed') THEN 'failed' WHEN bool_or(state = 'paused_limit') THEN 'paused_limit' ELSE 'continuing' END AS state FROM lw")
def cohort_state(spark: SparkSession, d: str) -> DataFrame:
    """The state of a cohort."""
    return collection.cohort_state(collection.latest_workers(_beats(spark, d), 12), 12, 5, 10)


@query(_BEATS + ", w AS (SELECT *, event_id % 5 AS in_flight FROM lw) SELECT CAST(coalesce(sum(in_flight) FILTER (updated_at > TIMESTAMP '2024-01-20'), 0) AS BIGINT) AS in_flight, CAST(sum(event_id) AS BIGINT) AS requests FROM w")
def network_counters(spark: SparkSession, d: str) -> DataFrame:
    """Gauges of live workers, counters of all."""
    return collection.network(collection.latest_workers(_beats(spark, d), 12), NOW)


@query("""WITH l AS (SELECT DISTINCT 'r' || (user_id % 3) AS run_id, sha256('u' || user_id) AS article_id, 'o' || (user_id % 10) AS outlet FROM events)
SELECT run_id, sha256(string_agg(article_id || chr(0) || outlet || chr(10), '' ORDER BY article_id, outlet)) AS fingerprint, count(*) AS articles FROM l GROUP BY 1""")
def manifest_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """One digest of a run's manifest."""
    return collection.fingerprint(_manifest(spark, d))


@query("WITH e AS (SELECT 'u' || user_id || '-' || strftime(ts, '%Y%m%d') AS article_id, list(DISTINCT event_type) AS s FROM events GROUP BY 1), m AS (SELECT article_id, list_sort(list_filter(['view', 'click', 'error'], lambda x: NOT list_contains(s, x))) AS m FROM e) SELECT article_id, array_to_string(m, ';') AS missing FROM m WHERE len(m) > 0")
def stage_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Articles, one for each user and day, that lack a stage."""
    e = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("article_id"), F.col("event_type").alias("stage"))
    return collection.stage_coverage(e, ["view", "click", "error"]).select("article_id", _text("missing"))


@query(EV + ", p AS (SELECT *, row_number() OVER (PARTITION BY run_id, article_id ORDER BY updated_at, seq) AS pass FROM ev), q AS (SELECT article_id, arg_max(status, pass) AS status, max(pass) AS passes, CAST(sum(list_sum(http_counts)) AS BIGINT) AS attempts, CAST(sum(response_bytes) AS BIGINT) AS response_bytes FROM p WHERE pass <= 2 GROUP BY 1) SELECT article_id, CASE WHEN passes >= 2 AND status = 'deferred' THEN 'failed' ELSE status END AS status, passes, attempts, response_bytes FROM q")
def retry_passes(spark: SparkSession, d: str) -> DataFrame:
    """Results over two passes."""
    nth = F.row_number().over(Window.partitionBy("run_id", "article_id").orderBy("updated_at", "seq"))
    passes = _events(spark, d).withColumn("pass", nth.cast("long")).where("pass <= 2").withColumn("attempts", collection.attempts(F.col("http_counts")))
    return collection.final_passes(passes)


@query(EV + ", c AS (SELECT run_id, count(*) AS completed, CAST(sum(list_sum(http_counts)) AS BIGINT) AS attempts, CAST(sum(response_bytes) AS BIGINT) AS response_bytes FROM latest WHERE status <> 'deferred' GROUP BY 1) SELECT run_id, CASE WHEN response_bytes >= 200000 OR attempts >= 100000 THEN 'paused_limit' ELSE 'running' END AS state FROM c")
def budget_stops(spark: SparkSession, d: str) -> DataFrame:
    """Runs that have used up a budget."""
    return collection.stop_reason(collection.metrics(_latest(spark, d)), 200_000, 100_000).select("run_id", "state")


@query(EV + ", w AS (SELECT article_id, 'u' AS url, CASE WHEN min(seq) % 2 = 0 THEN max(updated_at) END AS updated_at FROM ev GROUP BY 1), j AS (SELECT w.article_id, count(*) FILTER (w.updated_at IS NULL OR w.updated_at = ev.updated_at) AS n FROM w JOIN ev USING (article_id) GROUP BY 1) SELECT article_id, CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'accepted' END AS verdict FROM j")
def accepted_versions(spark: SparkSession, d: str) -> DataFrame:
    """The one event that a wanted result means."""
    e = _events(spark, d).withColumn("url", F.lit("u")).withColumn("text_uri", F.col("article_id"))
    wanted = e.groupBy("article_id").agg(F.lit("u").alias("url"), F.when(F.min("seq") % 2 == 0, F.max("updated_at")).alias("updated_at"))
    return collection.accepted(e, wanted).select("article_id", "verdict")


@query(EV + " SELECT article_id AS url, arg_max(status, (updated_at, seq)) AS status FROM ev GROUP BY 1 HAVING arg_max(status, (updated_at, seq)) IN ('saved', 'partial')")
def download_index(spark: SparkSession, d: str) -> DataFrame:
    """The download index after the last day's changes (T3). Before them stands an index of all
    events up to the start of that day; what changed since its watermark less two minutes is
    merged, and the count of saved and partial results says whether that was all."""
    e = _events(spark, d)
    newest = e.groupBy(F.col("article_id").alias("url")).agg(F.max_by(F.struct("status", "updated_at"), F.struct("updated_at", "seq")).alias("x"))
    state = F.when(F.col("status") == "deferred", "ready").otherwise("done")
    rows = cut(newest.select("url", "x.*").withColumn("state", state).withColumn("result_uri", F.lit("gs://x")))
    watermark = e.agg(F.date_trunc("day", F.max("updated_at"))).first()[0]
    if watermark is None:
        return rows.select("url", "status")
    earlier = e.where(F.col("updated_at") < F.lit(watermark)).groupBy(F.col("article_id").alias("url")).agg(F.max_by("status", F.struct("updated_at", "seq")).alias("status"))
    expected = rows.where("status in ('saved', 'partial')").count()
    return collection.refresh_index(earlier.where("status in ('saved', 'partial')"), rows, watermark, expected)


@query(EV + " SELECT outlet, status, count(*) AS articles FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY updated_at DESC, seq) AS rn FROM ev) WHERE rn = 1) WHERE status <> 'deferred' GROUP BY ALL")
def latest_state_stream(spark: SparkSession, d: str) -> DataFrame:
    """Final results from a stream with state that retracts what it replaces."""
    return stateful.stream_latest(spark, _events(spark, d))


@query(EV + " SELECT article_id AS url, arg_max(status, (updated_at, seq)) AS status FROM ev GROUP BY 1 HAVING arg_max(status, (updated_at, seq)) IN ('saved', 'partial')")
def download_index_stream(spark: SparkSession, d: str) -> DataFrame:
    """The download index as a stream of events keeps it, one version a batch."""
    state = F.when(F.col("status") == "deferred", "ready").otherwise("done")
    changes = _events(spark, d).select(F.col("article_id").alias("url"), snapshots.status(state, F.col("status"), F.lit("gs://x")).alias("status"), "updated_at", "seq")
    stream, base = stateful.replayed(spark, changes.repartition(6, "seq"), files=2)
    index = snapshots.Snapshot(spark, f"{base}/index")
    snapshots.keep_up(stream, index, f"{base}/log")
    return index.index()


@query(EV + """, c AS (SELECT article_id, 'gs://b/' || seq AS result_uri, CASE WHEN seq % 4 > 0 THEN 't' || (seq % 3) END AS claim_token, status, updated_at FROM ev WHERE status <> 'deferred')
SELECT article_id, arg_max(status, (updated_at, result_uri, claim_token)) AS status, arg_max(result_uri, (updated_at, result_uri, claim_token)) AS result_uri, count(*) AS loaded, count(*) AS acknowledged FROM c GROUP BY 1""")
def outbox_export(spark: SparkSession, d: str) -> DataFrame:
    """Final results loaded from a stream in acknowledged batches, and the view over them."""
    seq = F.col("seq")
    token = F.when(seq % 4 > 0, F.concat(F.lit("t"), (seq % 3).cast("string")))
    done = _events(spark, d).where("status <> 'deferred'").select("article_id", F.concat(F.lit("gs://b/"), seq.cast("string")).alias("result_uri"), token.alias("claim_token"), "status", "updated_at")
    stream, base = stateful.replayed(spark, done.repartition(6, "result_uri"), files=2)
    box = outbox.Outbox(spark, f"{base}/box", "article_id string, result_uri string, claim_token string, status string, updated_at timestamp")
    outbox.deliver(stream, box, f"{base}/log")
    counts = box.events().groupBy("article_id").agg(F.count(F.lit(1)).alias("loaded"))
    acks = box.acks().groupBy("article_id").agg(F.count(F.lit(1)).alias("acknowledged"))
    return box.view().select("article_id", "status", "result_uri").join(counts, "article_id").join(acks, "article_id", "left")


# -- text and URLs ----------------------------------------------------------------------

@query("""SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, regexp_extract(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '([^.]+\\.[^.]+)$', 1) AS domain FROM pages""")
def registrable_domain(spark: SparkSession, d: str) -> DataFrame:
    """Hosts and registrable domains; no host of the table is below a two-label suffix."""
    return table(spark, d, "pages").select("page_id", urls.host(F.col("url")).alias("host"), classify.registrable_domain(F.col("url")).alias("domain"))


#: Rules of one, two and three labels, wildcards and exceptions.
RULES = ["// a list", "com", "uk", "co.uk", "us", "ma.us", "k12.ma.us", "*.ck", "!www.ck", "jp", "*.kawasaki.jp", "!city.kawasaki.jp", "kobe.jp // more"]
_ENDS = ["com", "co.uk", "pvt.k12.ma.us", "k12.ma.us", "ck", "www.ck", "kawasaki.jp", "city.kawasaki.jp", "x.kobe.jp", "unlisted", "uk"]


@query(f"""WITH h AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN '' WHEN o_custkey % 5 = 1 THEN 'Www.c' || o_custkey || '.' ELSE 'c' || o_custkey || '.' END || ({_ENDS!r})[1 + o_orderkey % {len(_ENDS)}] AS raw FROM orders),
d AS (SELECT DISTINCT lower(raw) AS host FROM h),
r(rule) AS (VALUES {", ".join(f"('{x.split()[0]}')" for x in RULES[1:])}),
m AS (SELECT host, rule, len(string_split(rule, '.')) AS n FROM d, r WHERE CASE WHEN starts_with(rule, '!') THEN host = rule[2:] OR ends_with(host, '.' || rule[2:])
  WHEN starts_with(rule, '*.') THEN regexp_matches(host, '(^|\\.)[^.]+\\.' || replace(rule[3:], '.', '\\.') || '$') ELSE host = rule OR ends_with(host, '.' || rule) END),
w AS (SELECT host, arg_max(CASE WHEN starts_with(rule, '!') THEN n - 1 ELSE n END, CASE WHEN starts_with(rule, '!') THEN 100 ELSE n END) AS n FROM m GROUP BY host),
x AS (SELECT d.host, string_split(d.host, '.') AS l, coalesce(n, 1) AS n FROM d LEFT JOIN w USING (host))
SELECT o_orderkey, CASE WHEN len(l) > n THEN array_to_string(l[len(l) - n:], '.') END AS domain FROM h JOIN x ON x.host = lower(raw)""")
def suffix_domains(spark: SparkSession, d: str) -> DataFrame:
    """Registrable domains under plain, wildcard and exception rules, the longest first."""
    c = F.col("o_custkey")
    start = F.when(c % 5 == 0, "").when(c % 5 == 1, F.concat(F.lit("Www.c"), c.cast("string"), F.lit("."))).otherwise(F.concat(F.lit("c"), c.cast("string"), F.lit(".")))
    end = F.element_at(F.array(*map(F.lit, _ENDS)), (1 + F.col("o_orderkey") % len(_ENDS)).cast("int"))
    rows = table(spark, d, "orders").select("o_orderkey", domains.host(F.concat(F.lit("https://"), start, end, F.lit("/story"))).alias("host"))
    rules = domains.rules(spark.createDataFrame([(x,) for x in RULES], "line string"))
    named = cut(domains.registrable(rows, rules))
    return rows.join(domains.small(named), "host").select("o_orderkey", "domain")


@query("""WITH u AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://web.archive.org/web/20200101' || CASE WHEN page_id % 2 = 0 THEN 'id_' ELSE '' END || '/' || url WHEN page_id % 3 = 1 THEN 'ftp://x.y/z' ELSE url END AS u, url FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 1 THEN NULL ELSE lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) END AS publisher FROM u""")
def publisher_host(spark: SparkSession, d: str) -> DataFrame:
    """Publishers behind replay URLs."""
    p = F.col("page_id")
    replay = F.concat(F.lit("https://web.archive.org/web/20200101"), F.when(p % 2 == 0, "id_").otherwise(""), F.lit("/"), F.col("url"))
    u = F.when(p % 3 == 0, replay).when(p % 3 == 1, "ftp://x.y/z").otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", urls.publisher_host(u).alias("publisher"))


@query("""WITH s AS (SELECT page_id, regexp_extract(rtrim(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/'), '([^/]*)$', 1) AS s FROM pages), t AS (SELECT page_id, trim(regexp_replace(regexp_replace(s, '\\.(html?|aspx?|php)$', '', 'i'), '[-_]+', ' ', 'g')) AS t FROM s)
SELECT page_id, CASE WHEN length(t) > 12 THEN t ELSE 'Open article on here' END AS label FROM t""")
def url_label(spark: SparkSession, d: str) -> DataFrame:
    """Names of stories from their URLs."""
    return table(spark, d, "pages").select("page_id", urls.label(F.col("url"), F.lit("here")).alias("label"))


@query("""SELECT c_custkey, '"' || CASE WHEN c_custkey % 5 = 0 THEN '''=' ELSE '' END || c_name || '","' || c_custkey || '","' || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE replace(c_mktsegment || ' "q"', '"', '""') END || '"' AS line FROM customer""")
def csv_escape(spark: SparkSession, d: str) -> DataFrame:
    """CSV lines that start no formula."""
    key = F.col("c_custkey")
    rows = table(spark, d, "customer").select(key, F.concat(F.when(key % 5 == 0, "=").otherwise(""), F.col("c_name")).alias("name"), F.when(key % 7 != 0, F.concat(F.col("c_mktsegment"), F.lit(' "q"'))).alias("segment"))
    return rows.select("c_custkey", F.concat_ws(",", export.csv_field(F.col("name")), export.csv_field(key, False), export.csv_field(F.col("segment"))).alias("line"))


@query(OBS + " SELECT url, day, array_to_string(countries, '; ') AS countries FROM obs")
def joined_export(spark: SparkSession, d: str) -> DataFrame:
    """Lists joined for a flat file."""
    return export.joined(_obs(spark, d).select("url", "day", "countries"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def squeezed_text(spark: SparkSession, d: str) -> DataFrame:
    """Single spaces."""
    return table(spark, d, "documents").select("doc_id", texts.squeeze(F.col("text")).alias("text"))


@query("""WITH v AS (SELECT event_id, CAST(2020 + user_id % 6 AS VARCHAR) || '-' || CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 14 AS VARCHAR) ELSE lpad(CAST(event_id % 14 AS VARCHAR), 2, '0') END || '-' || lpad(CAST(user_id % 32 AS VARCHAR), 2, '0') AS s FROM events)
SELECT event_id, s, regexp_full_match(s, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(s, '%Y-%m-%d') IS NOT NULL AS valid FROM v""")
def valid_days(spark: SparkSession, d: str) -> DataFrame:
    """Days that exist, among days made of events' numbers."""
    month, two = (F.col("event_id") % 14).cast("string"), lambda c: F.lpad(c, 2, "0")
    day = F.concat_ws("-", (2020 + F.col("user_id") % 6).cast("string"), F.when(F.col("event_id") % 7 == 0, month).otherwise(two(month)), two((F.col("user_id") % 32).cast("string")))
    return table(spark, d, "events").select("event_id", day.alias("s")).withColumn("valid", texts.valid_day(F.col("s")))


@query("""WITH p AS (SELECT page_id, url, CAST(page_id % 6 AS INT) AS k, html FROM pages),
b AS (SELECT *, CASE k WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 404 WHEN 3 THEN 503 WHEN 4 THEN 200 ELSE 302 END AS code, page_id % 4 = 3 AS large, CASE WHEN page_id % 5 = 4 THEN 'application/pdf' ELSE 'text/HTML; charset=utf-8' END AS kind,
  CASE WHEN page_id % 18 = 0 THEN 'Just a moment...' WHEN page_id % 18 = 6 THEN '404 Not Found' ELSE regexp_extract(html, '(?is)<title>(.*?)</title>', 1) END AS title, page_id % 4 = 0 AS home FROM p)
SELECT page_id, CASE WHEN large THEN 'needs_inspection' WHEN code = 403 THEN 'blocked' WHEN code = 404 THEN 'unavailable' WHEN code = 503 THEN 'temporary_error' WHEN code = 302 OR kind = 'application/pdf' THEN 'needs_inspection'
  WHEN regexp_matches(lower(title), 'just a moment|access denied|attention required|verify you are human|captcha') THEN 'blocked' WHEN regexp_matches(lower(title), 'page not found|404 not found|page cannot be found') THEN 'needs_inspection' WHEN home THEN 'needs_inspection' ELSE 'retrieved' END AS outcome FROM b""")
def http_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What responses mean, for the pages with codes and types by their number."""
    p = F.col("page_id")
    code = F.element_at(F.array(*map(F.lit, (200, 403, 404, 503, 200, 302))), (p % 6 + 1).cast("int"))
    title = F.when(p % 18 == 0, "Just a moment...").when(p % 18 == 6, "404 Not Found").otherwise(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1))
    kind = F.when(p % 5 == 4, "application/pdf").otherwise("text/HTML; charset=utf-8")
    final = F.when(p % 4 == 0, F.concat(F.lit("https://"), urls.host(F.col("url")), F.lit("/"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", texts.http_outcome(code, p % 4 == 3, kind, title, F.col("url"), final).alias("outcome"))


@query("""WITH p AS (SELECT page_id, CAST(page_id AS BIGINT) AS id, url, event_id FROM pages JOIN events ON event_id = page_id)
SELECT page_id, CASE WHEN event_id % 9 = 0 THEN 'skipped' WHEN event_id % 5 = 0 THEN 'not_needed' WHEN event_id % 4 = 1 OR event_id % 11 = 0 THEN 'not_applicable: restricted' WHEN event_id % 3 = 1 THEN 'not_applicable: no document' WHEN event_id % 13 = 0 THEN 'not_applicable: homepage' WHEN event_id % 300 > 240 THEN 'deferred' WHEN event_id % 2 = 0 THEN 'handoff' ELSE 'render' END AS gate FROM p""")
def browser_gates(spark: SparkSession, d: str) -> DataFrame:
    """Whether a browser may be tried for each page."""
    rows = table(spark, d, "pages").join(table(spark, d, "events").select("event_id"), F.col("page_id") == F.col("event_id"))
    e = F.col("event_id")
    phase = F.when(e % 9 == 0, "archive").when(e % 2 == 0, "publisher").otherwise("all")
    gate = collection.browser_gate(F.when(e % 5 == 0, "candidate"), F.when(e % 4 == 1, "blocked").otherwise("retrieved"), F.when(e % 3 == 1, 500).otherwise(200), e % 11 == 0, e % 13 == 0, e % 300, phase)
    return rows.select("page_id", gate.alias("gate"))


@query("""WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, regexp_extract(html, '(?i)<a href="([^"]*)"', 1) AS link FROM pages),
f AS (SELECT page_id, CASE WHEN link = '' THEN url ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || link END AS target, url FROM p)
SELECT page_id, CASE WHEN target <> url AND length(regexp_extract(target, '^https?://[^/?#]+([^?#]*)', 1)) > 5 THEN target END AS page FROM f""")
def linked_pages(spark: SparkSession, d: str) -> DataFrame:
    """The page of the same host that each page's first link names."""
    link = F.regexp_extract("html", '(?i)<a href="([^"]*)"', 1)
    return table(spark, d, "pages").select("page_id", urls.other_page(F.col("url"), link).alias("page"))


@query("""WITH b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '') AS w FROM benchmark), o AS (SELECT item_id, array_to_string(w[1:12], ' ') AS o FROM b WHERE len(w) >= 12),
d AS (SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> ''), ' ') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, item_id FROM d JOIN o ON contains(t, o)""")
def article_identity(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold the opening of a benchmark passage.

    The opening twelve words are looked up by equality among the documents' runs of twelve
    words: an equi-join, where a containment test would compare all pairs."""
    return browse.opened_by(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))


@query("""WITH h AS (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1) AS heading FROM pages),
w AS (SELECT page_id, list_distinct(list_filter(regexp_split_to_array(lower(string_split(string_split(title, ' | ')[1], ' - ')[1]), '[^\\p{L}\\p{N}_]+'), lambda x: x <> '')) AS a, list_distinct(list_filter(regexp_split_to_array(lower(string_split(string_split(heading, ' | ')[1], ' - ')[1]), '[^\\p{L}\\p{N}_]+'), lambda x: x <> '')) AS b FROM h),
n AS (SELECT page_id, len(a) AS na, len(b) AS nb, len(list_intersect(a, b)) AS nc FROM w)
SELECT page_id, CASE WHEN least(na, nb) >= 5 AND 2 * nc >= 0.8 * (na + nb) THEN 'headline' END AS verdict FROM n""")
def same_story(spark: SparkSession, d: str) -> DataFrame:
    """Whether a page's title and its heading are the same story's, by their words."""
    title, heading = F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1), F.regexp_extract("html", "(?is)<h1>(.*?)</h1>", 1)
    return table(spark, d, "pages").select("page_id", texts.same_story(title, F.lit("none"), heading, F.lit("other")).alias("verdict"))


@query("""WITH d AS (SELECT doc_id, text, array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> ''), ' ') AS t FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, t, list_transform(string_split(text, chr(10) || chr(10)), lambda p: list_filter(regexp_split_to_array(lower(p), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '')) AS p FROM d)
SELECT doc_id, CASE WHEN len(list_filter(p, lambda w: len(w) >= 12 AND contains(t, array_to_string(w[1:12], ' ')))) > 0 THEN 'opening_text' END AS verdict FROM p""")
def opening_text(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose paragraphs open a story that they themselves tell."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", texts.same_story(F.lit("a"), F.col("text"), F.lit("b"), F.col("text")).alias("verdict"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events FROM events GROUP BY ALL")
def tumbling_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events in hours."""
    return stateful.late_windows(table(spark, d, "events"), size="1 hour")


# -- extraction and pacing ------------------------------------------------------------------

@query(page_functions.oracle_sql())
def extract_pages(spark: SparkSession, d: str) -> DataFrame:
    """Article text of pages."""
    return page_functions.extract_pages(table(spark, d, "pages"))


@query()
def extract_articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles by balanced elements and a choice among candidates (E1c-E1f E2); tests hold them
    against a tree that is built page by page."""
    return extraction.extract(table(spark, d, "pages")).withColumn("links", F.array_join("links", " "))


_JSON = """CASE page_id % 4 WHEN 0 THEN '{"@graph":[{"@type":"WebPage"},{"@type":"NewsArticle","articleBody":"b' || page_id || '","isAccessibleForFree":"False"}]}'
  WHEN 1 THEN '[{"@type":["Thing","BlogPosting"],"isAccessibleForFree":false,"x":[[{"@type":"Article","articleBody":"n' || page_id || '"}]]}]' WHEN 2 THEN '{"@type":"Person"}' ELSE '{broken' END"""


@query(f"""WITH p AS (SELECT page_id, {_JSON} AS j FROM pages), t AS (SELECT page_id, x.value AS v FROM p, LATERAL (SELECT value FROM json_tree(CASE WHEN json_valid(j) THEN j ELSE '0' END) WHERE type = 'OBJECT') x)
SELECT page_id, json_extract_string(v, '$.articleBody') AS body, coalesce(lower(json_extract_string(v, '$.isAccessibleForFree')) = 'false', FALSE) AS closed FROM t WHERE regexp_matches(CAST(json_extract(v, '$."@type"') AS VARCHAR), 'Article|BlogPosting')""")
def structured_articles(spark: SparkSession, d: str) -> DataFrame:
    """What pages' structured data says of articles, at whatever depth."""
    script = F.concat(F.lit('<script type="application/ld+json">'), F.expr(_JSON), F.lit("</script>"))
    pages = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("k"), F.concat(F.coalesce("html", F.lit("")), script).alias("html"))
    return extraction.structured(pages).select(F.col("k").cast("long").alias("page_id"), "body", "closed")


_MORE = """CASE page_id % 5 WHEN 0 THEN '<div><p><a class="x" href="/more/' || page_id || '">Read <b>more</b></a></p></div></article>' WHEN 1 THEN '<aside><div><a href="/no">read more</a></div></aside></article>'
  WHEN 2 THEN '</article><a href="/out">read more</a>' WHEN 3 THEN '<a href="next">Continue reading ...</a><a href="https://else.example/full">read the full story</a><a href="/third">read more</a></article>' ELSE '</article>' END"""


@query(f"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, regexp_extract(url, '^(https?://[^?#]*/)', 1) AS folder FROM pages WHERE len(regexp_extract_all(html, '<article')) = 1)
SELECT page_id, CASE page_id % 5 WHEN 0 THEN root || '/more/' || page_id ELSE folder || 'next https://else.example/full' END AS links FROM p WHERE page_id % 5 IN (0, 3)""")
def continuation_links(spark: SparkSession, d: str) -> DataFrame:
    """Where a page's article says that it goes on."""
    pages = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("k"), "url", F.replace("html", F.lit("</article>"), F.expr(_MORE)).alias("html"))
    rows = cut(extraction.events(pages))
    links = extraction.onward(rows, cut(extraction.elements(rows)), pages)
    return links.select(F.col("k").cast("long").alias("page_id"), F.array_join("links", " ").alias("links"))


_MICROS = "epoch_us(ts)"


def _log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumns({"host": F.concat(F.lit("h"), F.col("user_id").cast("string")), "t": F.unix_micros(F.col("ts").cast("timestamp"))})


@query(f"""WITH RECURSIVE e AS (SELECT 'h' || user_id AS host, event_id, {_MICROS} AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT host, event_id, n, t, t AS start FROM e WHERE n = 1 UNION ALL SELECT e.host, e.event_id, e.n, e.t, greatest(e.t, r.start + 3600000000) FROM e JOIN r ON e.host = r.host AND e.n = r.n + 1)
SELECT host, event_id, start, start - t AS wait FROM r""")
def host_pacing_fold(spark: SparkSession, d: str) -> DataFrame:
    """When hosts' requests may start that are an hour apart."""
    return pacing.permits(_log(spark, d).select("host", "event_id", "t"), "host", F.col("t"), ["t", "event_id"], 3_600_000_000).select("host", "event_id", "start", "wait")


@query(f"""WITH RECURSIVE e AS (SELECT 'h' || (user_id % 7) AS host, event_id, {_MICROS} AS t, row_number() OVER (PARTITION BY user_id % 7 ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT host, event_id, n, t, [t, NULL, NULL] AS s FROM e WHERE n = 1 UNION ALL
  SELECT e.host, e.event_id, e.n, e.t, [greatest(e.t, r.s[1] + 120000000, coalesce(r.s[3] + 5400000000, 0)), r.s[1], r.s[2]] FROM e JOIN r ON e.host = r.host AND e.n = r.n + 1)
SELECT host, event_id, s[1] AS start, s[1] - t AS wait FROM r""")
def host_permits(spark: SparkSession, d: str) -> DataFrame:
    """When few hosts' many requests may start: two minutes apart, three permits of an hour and a
    half at once (T8)."""
    log = _log(spark, d).select(F.concat(F.lit("h"), (F.col("user_id") % 7).cast("string")).alias("host"), "event_id", "t")
    return pacing.permits(log, "host", F.col("t"), ["t", "event_id"], 120_000_000, 5_400_000_000, 3).select("host", "event_id", "start", "wait")


@query("""WITH e AS (SELECT 'h' || user_id AS host, event_id, ts, CAST(event_type IN ('error', 'purchase') AS INT) AS hit FROM events), i AS (SELECT *, sum(1 - hit) OVER (PARTITION BY host ORDER BY ts, event_id) AS g FROM e),
f AS (SELECT host, event_id, CAST(sum(hit) OVER (PARTITION BY host, g ORDER BY ts, event_id) AS BIGINT) AS failures FROM i) SELECT host, event_id, failures, CAST(least(300, 5 * pow(2, failures)) AS DOUBLE) AS delay FROM f""")
def adaptive_rate_fold(spark: SparkSession, d: str) -> DataFrame:
    """Delays that hosts' failures lead to."""
    rows = pacing.delays(_log(spark, d), "host", F.col("event_type").isin("error", "purchase"), ["ts", "event_id"], 5, 300)
    return rows.select("host", "event_id", "failures", "delay")


@query(f"""WITH e AS (SELECT user_id AS article, event_id, {_MICROS} AS t, CASE event_type WHEN 'view' THEN 'claim' WHEN 'click' THEN 'renew' WHEN 'error' THEN 'release' ELSE 'complete' END AS kind, 'w' || (event_id % 3) AS owner FROM events),
m AS (SELECT * FROM e WHERE kind IN ('claim', 'release')),
j AS (SELECT e.*, arg_max(m.kind, (m.t, m.event_id)) AS lk, arg_max(m.owner, (m.t, m.event_id)) AS lo, max(m.t) AS lt FROM e LEFT JOIN m ON m.article = e.article AND (m.t, m.event_id) < (e.t, e.event_id) GROUP BY ALL),
h AS (SELECT *, CASE WHEN lk = 'claim' AND t - lt < 172800000000 THEN lo END AS holder FROM j)
SELECT article, event_id, holder, CASE WHEN kind = 'claim' THEN holder IS NULL OR holder = owner ELSE coalesce(holder = owner, FALSE) END AS ok FROM h""")
def lease_fold(spark: SparkSession, d: str) -> DataFrame:
    """Who holds an article at each event, and whether the event is allowed (T4)."""
    kind = F.when(F.col("event_type") == "view", "claim").when(F.col("event_type") == "click", "renew").when(F.col("event_type") == "error", "release").otherwise("complete")
    rows = _log(spark, d).withColumns({"kind": kind, "owner": F.concat(F.lit("w"), (F.col("event_id") % 3).cast("string")), "article": F.col("user_id")})
    return pacing.leases(rows, "article", F.col("t"), ["t", "event_id"], 172_800_000_000).select("article", "event_id", "holder", "ok")


@query("SELECT doc_id, doc_id // 10000 AS file, row_number() OVER (PARTITION BY doc_id // 10000 ORDER BY doc_id) - 1 AS n, lang, strlen(text) AS bytes, sha256(text) AS digest FROM documents")
def manifest_objects(spark: SparkSession, d: str) -> DataFrame:
    """All documents as JSON arrays of 10,000 ids a file, read back object by object."""
    folder = f"{shared_dir(spark)}/manifests-{uuid.uuid4().hex}"
    rows = table(spark, d, "documents").select("doc_id", "lang", "text")
    arrays.write_manifests(rows, folder, F.floor(F.col("doc_id") / 10_000), ["doc_id"])
    found = arrays.manifests(spark, folder).withColumn("x", F.from_json("item", rows.schema))
    return found.select(
        "x.doc_id", F.regexp_extract("path", r"/file=(\d+)/", 1).cast("long").alias("file"), "n", "x.lang",
        F.octet_length("x.text").cast("long").alias("bytes"), F.sha2("x.text", 256).alias("digest"))


_FIELDS = ["day", "url", "outlet", "estimated_country", "domain_country", "countries", "specific_location_countries"]
_QUOTED = " || ',' || ".join(f"coalesce('\"' || {c} || '\"', 'null')" for c in ("strftime(day, '%Y-%m-%d')", "url", "outlet", "estimated_country", "domain_country"))


@query(OBS.replace("WITH ", "WITH RECURSIVE ", 1) + f""", l AS (SELECT source_country, day, url, '[' || {_QUOTED} || ',' || CAST(to_json(countries) AS VARCHAR) || ',' || CAST(to_json(specific_location_countries) AS VARCHAR) || ']' AS line
  FROM (SELECT *, unnest(list_distinct([estimated_country, domain_country])) AS source_country FROM obs) WHERE source_country IS NOT NULL),
r AS MATERIALIZED (SELECT *, row_number() OVER w - 1 AS n, sum(strlen(line) + 1) OVER w AS e FROM l WINDOW w AS (PARTITION BY source_country ORDER BY day, url, line)),
p(source_country, part, s, base) AS (SELECT DISTINCT source_country, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS HUGEINT) FROM r
  UNION ALL SELECT p.source_country, p.part + 1, max(r.n) + 1, max(r.e) FROM p JOIN r ON r.source_country = p.source_country AND r.n >= p.s AND r.n < p.s + 500 AND (r.n = p.s OR r.e <= p.base + 65536) GROUP BY p.source_country, p.part),
x AS (SELECT p.source_country, part, '{{"source_country":"' || p.source_country || '","fields":["{'","'.join(_FIELDS)}"],"rows":[' || string_agg(line, ',' ORDER BY n) || ']}}' AS body, count(*) AS rows
  FROM (SELECT *, lead(s, 1, 1000000000) OVER (PARTITION BY source_country ORDER BY part) AS t FROM p) p JOIN r ON r.source_country = p.source_country AND r.n >= p.s AND r.n < p.t GROUP BY p.source_country, part)
SELECT source_country, part, 'articles-' || substr(sha256(body), 1, 12) || '.json' AS json, rows, sha256(body) AS sha256, strlen(body) AS json_bytes FROM x""")
def packed_export(spark: SparkSession, d: str) -> DataFrame:
    """Bounded, content-addressed parts of every country's ordered export."""
    rows = classify.by_source_country(_obs(spark, d)).select("source_country", *_FIELDS)
    parts = packing.packed(rows, "source_country", ["day", "url"], 500, 65536)
    return export.manifest(parts, "source_country").drop("gzip")


_LASTS, _DELAY = 86_400_000_000, 3_600_000_000


def _liveness_sql(until: str) -> str:
    return f"""WITH b AS (SELECT CAST(user_id AS VARCHAR) AS worker, {_MICROS} AS "at" FROM events), w AS (SELECT {until} AS w FROM b),
g AS (SELECT *, lag("at") OVER o AS before, lead("at") OVER o AS after FROM b, w WHERE "at" <= w WINDOW o AS (PARTITION BY worker ORDER BY "at"))
SELECT worker, "at", 'up' AS change FROM g WHERE before IS NULL OR "at" - before >= {_LASTS} UNION ALL SELECT worker, "at" + {_LASTS}, 'down' FROM g WHERE (after IS NULL OR after - "at" >= {_LASTS}) AND "at" + {_LASTS} <= w"""


@query(_liveness_sql(str(2**62)))
def worker_liveness(spark: SparkSession, d: str) -> DataFrame:
    """When workers come up and fall silent."""
    return expiry.liveness(table(spark, d, "events"), "user_id", F.unix_micros(F.col("ts").cast("timestamp")), _LASTS)


@query(_liveness_sql(f'max("at") // 1000 * 1000 - {_DELAY}'))
def worker_liveness_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream's timers, up to its watermark."""
    spark = stateful.own_session(spark)
    ts = F.col("ts").cast("timestamp")
    stream, base = stateful.replayed(spark, table(spark, d, "events").select(F.col("user_id").cast("string").alias("worker"), ts.alias("ts"), F.unix_micros(ts).alias("at")), files=100_000)
    out = stateful.run_to_table(expiry.timed(stream, "worker", expiry.Liveness(_LASTS), ["at"], "1 hour", 512), "liveness", base, "append")
    return spark.read.schema("worker string, at long, change string").parquet(out).select("worker", "at", "change")


@query(f"""WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS article, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, {_MICROS} AS "at", CASE event_type WHEN 'view' THEN 'claim' WHEN 'click' THEN 'renew' WHEN 'error' THEN 'release' WHEN 'signup' THEN 'claim' ELSE 'complete' END AS kind, 'w' || (event_id % 2) AS owner, 't' || (event_id % 3) AS token FROM events),
s AS (SELECT article, n, "at", CASE WHEN kind = 'complete' AND n % 5 > 0 THEN 'renew' ELSE kind END AS kind, owner, token, owner || '/' || token AS me FROM e),
r AS (SELECT article, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS "at", '' AS kind, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS token, CAST(NULL AS VARCHAR) AS h, CAST(0 AS BIGINT) AS u, FALSE AS done, FALSE AS granted, CAST(NULL AS VARCHAR) AS gone, CAST(0 AS BIGINT) AS gone_at FROM (SELECT DISTINCT article FROM s)
  UNION ALL SELECT article, n, "at", kind, owner, token, CASE WHEN granted AND kind IN ('claim', 'renew') THEN me WHEN granted THEN NULL ELSE live END, CASE WHEN granted AND kind IN ('claim', 'renew') THEN "at" + {2 * _LASTS} ELSE u END, done OR (granted AND kind = 'complete'), granted, CASE WHEN live IS NULL THEN h END, u
  FROM (SELECT *, NOT done AND (coalesce(live = me, FALSE) OR (kind = 'claim' AND live IS NULL)) AS granted FROM (SELECT s.*, r.h, r.u, r.done, CASE WHEN r.u > s."at" THEN r.h END AS live FROM r JOIN s ON s.article = r.article AND s.n = r.n + 1))),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY article ORDER BY n DESC) = 1)
SELECT article, "at", kind, owner, token, granted FROM r WHERE n > 0 UNION ALL SELECT article, gone_at, 'expire', string_split(gone, '/')[1], string_split(gone, '/')[2], TRUE FROM r WHERE gone IS NOT NULL
UNION ALL SELECT article, u, 'expire', string_split(h, '/')[1], string_split(h, '/')[2], TRUE FROM l WHERE h IS NOT NULL AND u <= (SELECT max("at") FROM s)""")
def lease_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests by owners with tokens, what is granted, and leases that run out (T4)."""
    e = F.col("event_type")
    kind = F.when(e.isin("view", "signup"), "claim").when(e == "click", "renew").when(e == "error", "release").otherwise("complete")
    log = _log(spark, d).withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")))
    kind = F.when((kind == "complete") & (F.col("n") % 5 > 0), "renew").otherwise(kind)
    rows = log.select("user_id", F.col("t").alias("at"), kind.alias("kind"), F.concat(F.lit("w"), (F.col("event_id") % 2).cast("string")).alias("owner"), F.concat(F.lit("t"), (F.col("event_id") % 3).cast("string")).alias("token"))
    until = rows.agg(F.max("at")).first()[0] or 0
    return expiry.leases(rows, "user_id", 2 * _LASTS, until)


# -- more of collection and evidence ------------------------------------------------------

@query(EV + " SELECT run_id, arg_max(status, (updated_at, -seq)) AS state, max(updated_at) AS updated_at FROM ev GROUP BY 1")
def latest_runs(spark: SparkSession, d: str) -> DataFrame:
    """The newest event of each run."""
    rows = collection.latest(_events(spark, d), ["run_id"])
    return rows.select("run_id", F.col("status").alias("state"), "updated_at")


@query(_BEATS + " SELECT count(*) = 12 AND bool_or(state = 'failed') AND bool_and(state IN ('failed', 'completed', 'continuing')) AND count(*) FILTER (state = 'failed' AND event_id % 2 = 1) = 0 AS recoverable FROM lw")
def recoverable_cohort(spark: SparkSession, d: str) -> DataFrame:
    """May a failed cohort be restarted."""
    workers = collection.latest_workers(_beats(spark, d), 12).withColumn("infrastructure_recoverable", F.col("event_id") % 2 == 0)
    return collection.recoverable(workers, "failed", 12)


@query("""WITH c AS (SELECT event_id, user_id, event_type AS to_phase, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_phase FROM events),
m AS (SELECT to_phase AS phase, 1 AS d FROM c UNION ALL SELECT from_phase, -1 FROM c WHERE from_phase IS NOT NULL) SELECT phase, CAST(sum(d) AS BIGINT) AS articles FROM m GROUP BY 1""")
def phase_counts(spark: SparkSession, d: str) -> DataFrame:
    """Articles in each phase as sums of changes."""
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    changes = table(spark, d, "events").select(F.col("user_id").alias("article_id"), F.col("event_id").alias("seq"), before.alias("from_phase"), F.col("event_type").alias("to_phase"))
    return collection.phase_counts(changes)


_QUALITY = "CASE event_type WHEN 'view' THEN 'candidate' WHEN 'click' THEN 'partial' ELSE 'missing' END"


@query(f"""WITH r AS (SELECT user_id AS article_id, event_id AS stage_no, event_id % 4 AS raw_uri, {_QUALITY} AS quality, repeat('x', CAST(event_id % 50 AS INT)) AS text FROM events),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id, raw_uri ORDER BY stage_no DESC) AS rn FROM r) WHERE rn = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY CASE quality WHEN 'candidate' THEN 2 WHEN 'partial' THEN 1 ELSE 0 END DESC, length(text) DESC, stage_no) AS k FROM n)
SELECT article_id, raw_uri, quality, length(text) AS characters, CASE WHEN quality = 'candidate' THEN 'saved' WHEN article_id % 5 = 0 THEN 'deferred' WHEN quality = 'partial' THEN 'partial' ELSE 'exhausted' END AS status FROM b WHERE k = 1""")
def best_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The best text over stages and what it makes of the article."""
    quality = F.when(F.col("event_type") == "view", "candidate").when(F.col("event_type") == "click", "partial").otherwise("missing")
    rows = table(spark, d, "events").select(F.col("user_id").alias("article_id"), F.col("event_id").alias("stage_no"), (F.col("event_id") % 4).alias("raw_uri"), quality.alias("quality"), F.repeat(F.lit("x"), (F.col("event_id") % 50).cast("int")).alias("text"))
    best = collection.best_candidate(rows)
    return best.select("article_id", "raw_uri", "quality", F.length("text").cast("long").alias("characters"), collection.final_status(F.col("quality"), F.col("article_id") % 5 == 0).alias("status"))


@query("SELECT user_id AS article_id, event_id % 6 AS raw_uri, max(CAST(event_type = 'view' AS INT)) AS is_best FROM events WHERE event_id % 3 < 2 AND event_type <> 'error' GROUP BY 1, 2")
def reanalysis(spark: SparkSession, d: str) -> DataFrame:
    """Stored bodies that an older extractor read, each once."""
    e = table(spark, d, "events").select(F.col("user_id").alias("article_id"), F.when(F.col("event_type") != "error", F.col("event_id") % 6).alias("raw_uri"), (F.col("event_id") % 3).alias("extractor_version"), (F.col("event_type") == "view").alias("is_best"))
    return collection.to_reanalyse(e, 2)


@query("""WITH a AS (SELECT user_id, list({'stage': CASE WHEN event_type = 'view' THEN 'http' ELSE 'extract:' || event_type END, 'title': CASE WHEN event_id % 3 > 0 THEN 't' || event_id END, 'raw_uri': 'r' || (event_id % 2)} ORDER BY event_id) AS a FROM events GROUP BY 1),
f AS (SELECT user_id, list_filter(a, lambda x: starts_with(x.stage, 'extract:') AND x.title IS NOT NULL AND x.raw_uri = 'r' || (user_id % 2)) AS f FROM a) SELECT user_id, f[-1].title AS title FROM f""")
def evidence_titles(spark: SparkSession, d: str) -> DataFrame:
    """The title that belongs to the accepted body."""
    e = table(spark, d, "events")
    one = F.struct("event_id", F.when(F.col("event_type") == "view", "http").otherwise(F.concat(F.lit("extract:"), F.col("event_type"))).alias("stage"), F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("t"), F.col("event_id").cast("string"))).alias("title"), F.concat(F.lit("r"), (F.col("event_id") % 2).cast("string")).alias("raw_uri"))
    attempts = e.groupBy("user_id").agg(F.array_sort(F.collect_list(one)).alias("a"))
    return attempts.select("user_id", collection.evidence_title(F.col("a"), F.concat(F.lit("r"), (F.col("user_id") % 2).cast("string"))).alias("title"))


@query(EV + """, m AS (SELECT seq, outlet, updated_at, CAST(status = 'failed' AS INT) AS hit FROM ev), i AS (SELECT *, sum(1 - hit) OVER (PARTITION BY outlet ORDER BY updated_at, seq) AS g FROM m)
SELECT DISTINCT outlet FROM (SELECT outlet, sum(hit) OVER (PARTITION BY outlet, g ORDER BY updated_at, seq) AS streak FROM i) WHERE streak >= 2""")
def paused_outlets(spark: SparkSession, d: str) -> DataFrame:
    """Outlets that two blocks running pause."""
    status = F.when(F.col("status") == "failed", "blocked").otherwise(F.col("status"))
    return collection.paused_outlets(_events(spark, d).withColumn("status", status), ["updated_at", "seq"])


@query("SELECT doc_id, text = '' OR text IS NULL AS blank, CAST(strlen(coalesce(text, '')) * 1.8e-5 * 2 + strlen(coalesce(text, '')) * 2e-6 * 4 AS DOUBLE) AS cost, sha256(coalesce(text, '')) AS address FROM documents")
def stored_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Content addresses and what their seconds would cost."""
    data = F.coalesce(F.col("text"), F.lit(""))
    return table(spark, d, "documents").select("doc_id", (data == "").alias("blank"), texts.cost(F.octet_length(data).cast("double"), 2, 4).alias("cost"), F.sha2(data, 256).alias("address"))
