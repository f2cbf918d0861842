"""Mixing sources to target weights by Poisson replication.

The mean repetition rate of a source is (its share of the mixture * rows wanted) / its
rows. Each document draws u from a hash of (seed, doc_id) and takes the count at which
the Poisson distribution of its source's rate reaches u (inversion of the distribution
function), is repeated so often, and every copy goes to a place that a hash of
(seed, doc_id, copy) gives: a global shuffle in one exchange.

The table of rates has one row for each source. It is written, counted, and broadcast
only up to MAX_BROADCAST rows; beyond that the join shuffles, and adaptive execution
splits the partitions of a hot source.

Defined cases: a null source is a source of its own; a null doc_id draws as the id
"null"; repeated rows draw alike; sources without a weight in a given table get none and
leave; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

#: Rows up to which the table of rates is broadcast.
MAX_BROADCAST = 20_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of the parts joined by colons."""
    digits = F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def distributions(rated: DataFrame) -> DataFrame:
    """rated(source_key, rate) with `at`, the Poisson distribution function at 0, 1, ... until what is
    left is below 2**-52: running sums over a row a step, so a large rate costs its length once."""
    rate, k = F.col("rate"), F.col("k")
    top = F.when(rate > 0, F.ceil(rate + 12 * F.sqrt(rate) + 20)).otherwise(0).cast("int")
    order = Window.partitionBy("source_key").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    steps = rated.select("source_key", "rate", F.explode(F.sequence(F.lit(0), top)).alias("k"))
    logs = steps.withColumn("lp", F.sum(F.when(k > 0, F.log(rate) - F.log(k.cast("double"))).otherwise(-rate)).over(order))
    sums = logs.withColumn("p", F.sum(F.exp("lp")).over(order))
    return sums.groupBy("source_key", "rate").agg(F.array_sort(F.collect_list("p")).alias("at"))


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), source.cast("string")))


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5, rows: float | None = None) -> DataFrame:
    """(source_key, rate, at): at is the distribution function of the source's counts.

    weights: shares of the mixture by source, in any unit; without them a source's share
    is its rows to the power temperature. rows: expected rows of the mixture, by default
    as many as docs has."""
    spark = docs.sparkSession
    counted = docs.groupBy(source_key(F.col("source")).alias("source_key")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
        counted = cut(counted.withColumn("share", share))
    else:
        given = spark.createDataFrame([("v" + str(k), float(v)) for k, v in weights.items()] or [("", 0.0)], "source_key string, share double")
        counted = cut(counted.join(given, "source_key", "left").fillna(0.0, ["share"]))
    n, total = counted.agg(F.sum("n"), F.sum("share")).first()
    wanted = float(rows if rows is not None else n or 0)
    rate = F.col("share") / F.lit(float(total or 1.0)) * F.lit(wanted) / F.col("n")
    return distributions(counted.select("source_key", rate.alias("rate")))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5, rows: float | None = None, seed: int = 20240501, detail: bool = False) -> DataFrame:
    """The mixture: each row of docs as often as its draw says, in an order that a hash
    gives over all partitions. detail adds copy (from 1), rate and place."""
    table = cut(rates(docs, weights, temperature, rows))
    few = table.count() <= MAX_BROADCAST
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), source_key(F.col("source")).alias("source_key"))
    drawn = packed.join(F.broadcast(table) if few else table, "source_key").withColumn("u", uniform(F.lit(seed), F.col("id")))
    counted = drawn.withColumn("times", F.size(F.filter("at", lambda at: F.col("u") >= at))).where("times > 0")
    copies = counted.select("row", "id", "rate", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    placed = copies.withColumn("place", F.md5(F.concat_ws(":", F.lit(f"place{seed}"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("copy"))))
    mixed = placed.repartition("place").sortWithinPartitions("place")
    return mixed.select("row.*", "copy", F.round("rate", 6).alias("rate"), "place") if detail else mixed.select("row.*")


ORACLE_SQL = r"""
WITH counted AS (SELECT source, count(*) AS n, sqrt(count(*)) AS share FROM documents GROUP BY source),
rated AS (SELECT source, share / (SELECT sum(share) FROM counted) * (SELECT sum(n) FROM counted) / n AS rate FROM counted),
terms AS (
  SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
  FROM rated, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS INT))) AS k)
), dist AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
cdfs AS (SELECT source, rate, list(cdf ORDER BY k) AS at FROM dist GROUP BY source, rate),
drawn AS (
  SELECT d.*, c.rate,
         len(list_filter(c.at, lambda x: CAST(('0x' || substr(md5('20240501:' || d.doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0 >= x)) AS times
  FROM documents d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INT) AS copy, round(rate, 6) AS rate,
       md5('place20240501:' || doc_id || ':' || copy) AS place
FROM drawn, LATERAL (SELECT unnest(generate_series(1, times)) AS copy)
"""
