"""Relations of the news corpus, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.sources.tables import table

#: The pair that the audit is about: the pivot country and the target country.
PIVOT, TARGET = "N09", "N07"
CODE = "^N[0-9]{2}$"


def _code(column) -> F.Column:
    return F.concat(F.lit("N"), F.lpad(column.cast("string"), 2, "0"))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, url, outlet, estimated_country, domain_country, v2locations) for each line item."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    supp, nation = F.col("l_suppkey"), F.col("s_nationkey")
    domain = F.when(supp % 4 == 0, None).when(supp % 7 == 0, _code((nation + 1) % 25)).otherwise(_code(nation))
    locations = F.concat((1 + F.col("l_linenumber") % 5).cast("string"), F.lit("#Place "), F.col("l_linenumber").cast("string"), F.lit("#"), _code(F.col("c_nationkey")), F.lit("#x;1#Country#"), _code(nation), F.lit("#y"))
    return rows.select(
        F.add_months(F.to_date("l_shipdate"), 240).alias("day"),
        F.concat(F.lit("https://www.s"), supp.cast("string"), F.lit(".n"), nation.cast("string"), F.lit("/o"), (F.col("l_orderkey") % 400).cast("string")).alias("url"),
        F.when(supp % 11 != 0, F.concat(F.lit("s"), supp.cast("string"), F.lit(".n"), nation.cast("string"))).alias("outlet"),
        F.when(supp % 5 != 0, _code(nation)).alias("estimated_country"),
        domain.alias("domain_country"),
        locations.alias("v2locations"),
    )


def result_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only collection events: (seq, run_id, article_id, outlet, updated_at, status,
    response_bytes, http_counts)."""
    status = F.create_map(*[F.lit(x) for pair in {"view": "saved", "click": "partial", "purchase": "exhausted", "signup": "failed", "error": "deferred"}.items() for x in pair])
    k = F.coalesce(F.get_json_object("props", "$.k").cast("int"), F.lit(0))
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("r"), (user % 3).cast("string")).alias("run_id"),
        F.sha2(F.concat(F.lit("u"), user.cast("string")), 256).alias("article_id"),
        F.concat(F.lit("o"), (user % 10).cast("string")).alias("outlet"),
        F.col("ts").alias("updated_at"),
        status[F.col("event_type")].alias("status"),
        F.floor(F.col("value") * 100).cast("long").alias("response_bytes"),
        F.transform(F.sequence(F.lit(1), 1 + k % 4), lambda i: (i % 3).cast("int")).alias("http_counts"),
    )


#: The same relations for the oracle, as the head of a WITH clause.
RAW_SQL = """raw_documents AS (
  SELECT CAST(CAST(l_shipdate AS DATE) + INTERVAL 20 YEAR AS DATE) AS day,
    'https://www.s' || l_suppkey || '.n' || s_nationkey || '/o' || (l_orderkey % 400) AS url,
    CASE WHEN l_suppkey % 11 <> 0 THEN 's' || l_suppkey || '.n' || s_nationkey END AS outlet,
    CASE WHEN l_suppkey % 5 <> 0 THEN 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS estimated_country,
    CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN 'N' || lpad(CAST((s_nationkey + 1) % 25 AS VARCHAR), 2, '0') ELSE 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS domain_country,
    (1 + l_linenumber % 5) || '#Place ' || l_linenumber || '#N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '#x;1#Country#N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '#y' AS v2locations
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

_PLACES = "list_transform(flatten(list_transform(raw_locations, lambda r: string_split(r, ';'))), lambda l: string_split(l, '#'))"

OBS_SQL = RAW_SQL + f""", grouped AS (
  SELECT day, url, outlet, estimated_country, domain_country, list_sort(list_distinct(list(v2locations))) AS raw_locations, count(*) AS source_records
  FROM raw_documents GROUP BY ALL),
obs AS (
  SELECT *,
    list_sort(list_distinct(list_filter(list_transform({_PLACES}, lambda p: p[3]), lambda c: c IS NOT NULL AND regexp_matches(c, '{CODE}')))) AS countries,
    list_sort(list_distinct(list_transform(list_filter({_PLACES}, lambda p: p[1] IN ('2','3','4','5')), lambda p: p[3]))) AS specific_location_countries,
    CASE WHEN estimated_country IS NOT NULL AND domain_country IS NOT NULL AND estimated_country <> domain_country THEN NULL ELSE coalesce(estimated_country, domain_country) END AS outlet_country,
    CASE WHEN estimated_country <> domain_country THEN 'conflict' WHEN estimated_country = domain_country THEN 'estimate_domain_agree'
         WHEN estimated_country IS NOT NULL THEN 'estimate_only' WHEN domain_country IS NOT NULL THEN 'domain_only' ELSE 'unknown' END AS classification_basis,
  FROM grouped),
facts AS (
  SELECT *, CASE WHEN outlet_country = '{PIVOT}' THEN 'Chinese' WHEN outlet_country = '{TARGET}' THEN 'Local' WHEN outlet_country IS NULL THEN 'Unknown or uncertain' ELSE 'Third country' END AS outlet_group FROM obs)"""

EVENTS_SQL = """ev AS (
  SELECT event_id AS seq, 'r' || (user_id % 3) AS run_id, sha256('u' || user_id) AS article_id, 'o' || (user_id % 10) AS outlet, ts AS updated_at,
    CASE event_type WHEN 'view' THEN 'saved' WHEN 'click' THEN 'partial' WHEN 'purchase' THEN 'exhausted' WHEN 'signup' THEN 'failed' ELSE 'deferred' END AS status,
    CAST(floor(value * 100) AS BIGINT) AS response_bytes,
    list_transform(generate_series(1, 1 + coalesce(CAST(json_extract_string(props, '$.k') AS INT), 0) % 4), lambda i: i % 3) AS http_counts
  FROM events),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY run_id, article_id ORDER BY updated_at DESC, seq) AS rn FROM ev) WHERE rn = 1)"""
