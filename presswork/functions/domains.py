"""Registrable domains by a public suffix list.

A list's rules are plain (`co.uk`), wildcards (`*.ck`: any one label there) or exceptions
(`!www.ck`). Of the rules that a host ends with an exception wins, else the one with the most
labels; a host that none fits has a suffix of one label. The registrable domain is the suffix and
the label before it; an exception's suffix is its rule without the first label. A host that is a
suffix itself has none.

Each distinct host is spread over its ends once, and ends meet the rules by equality; a rule's key
is what it fixes (`ck` of `*.ck`), so wildcards need no pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

#: Rows of a table of rules or of hosts that is broadcast.
BROADCAST = 1_000_000


def rules(lines: DataFrame) -> DataFrame:
    """(key, rank, labels) of a public suffix list's lines (one string column): the end of a host that
    a rule fixes, 1 for an exception and else 0, the labels of the suffix. Comments, blank lines
    and what follows the first white space are ignored."""
    rule = F.lower(F.regexp_extract(F.col(lines.columns[0]), r"^\s*(\S*)", 1))
    given = lines.select(rule.alias("r")).where((F.col("r") != "") & ~F.col("r").startswith("//"))
    key = F.regexp_replace("r", r"^(!|\*\.)", "")
    n = F.size(F.split(key, r"\."))
    rank = F.when(F.col("r").startswith("!"), 1).otherwise(0)
    labels = F.when(rank == 1, n - 1).when(F.col("r").startswith("*."), n + 1).otherwise(n)
    return given.select(key.alias("key"), rank.alias("rank"), labels.alias("labels")).distinct()


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return rules(spark.read.text(path))


def host(url: Column) -> Column:
    """The host of an absolute URL in lower case, without a last dot; null without one."""
    return F.nullif(F.rtrim(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(".")), F.lit(""))


def small(side: DataFrame) -> DataFrame:
    """side, to be broadcast if it has BROADCAST rows at most."""
    return F.broadcast(side) if side.limit(BROADCAST + 1).count() <= BROADCAST else side


def registrable(hosts: DataFrame, table: DataFrame) -> DataFrame:
    """(host, domain) for the distinct hosts(host) under the rules of ``rules``; domain is null for
    hosts that are suffixes, that have empty labels or that are addresses."""
    known = hosts.where("host is not null").select("host").distinct().withColumn("l", F.split("host", r"\."))
    fine = ~F.exists("l", lambda x: x == "") & ~F.col("host").rlike(r"^[0-9.]+$|[:\[\]]")
    ends = known.where(fine).select("host", "l", F.explode(F.sequence(F.lit(1), F.size("l"))).alias("n"))
    ends = ends.withColumn("key", F.array_join(F.slice("l", F.size("l") - F.col("n") + 1, F.col("n")), "."))
    met = ends.join(small(cut(table)), "key").where(F.col("labels") <= F.size("l"))
    best = met.groupBy("host").agg(F.max(F.struct("rank", "labels")).alias("b")).select(F.col("host").alias("_host"), F.col("b.labels").alias("labels"))
    suffix = F.coalesce("labels", F.lit(1))
    domain = F.when(fine & (F.size("l") > suffix), F.array_join(F.slice("l", F.size("l") - suffix, suffix + 1), "."))
    return known.join(best, F.col("host") == F.col("_host"), "left").select("host", domain.alias("domain"))
