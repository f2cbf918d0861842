"""The coverage audit: grouping sets, their summary, the calendar and its assessment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.operators.classify import GROUPS

#: Intervals and how a day falls into one; weeks start on Monday.
BUCKETS = {"day": None, "week": "week", "month": "MM", "year": "YEAR"}
FIRST, LAST = date(2015, 1, 1), date(2025, 12, 31)


def bucket(day: Column, interval: str) -> Column:
    return F.trunc(day, BUCKETS[interval]) if BUCKETS[interval] else day


def validate(country: str, start: date, end: date, interval: str, pivot: str = "CH") -> None:
    """Raise ValueError for a selection that the audit does not take."""
    if country == pivot or not (len(country) == 2 and country.isascii() and country.isalpha() and country.isupper()):
        raise ValueError("choose a target country other than the pivot")
    if not FIRST <= start <= end <= LAST:
        raise ValueError("choose ordered dates within 2015-2025")
    if interval not in BUCKETS:
        raise ValueError("choose day, week, month or year")


def daily(obs: DataFrame) -> DataFrame:
    """The audit's fact: URLs a day for each outlet and classification, of observations, which are a
    row for each URL of a day and classification."""
    return obs.groupBy("day", "outlet_group", "outlet", "outlet_country", "estimated_country", "domain_country", "classification_basis").agg(F.count("url").alias("article_count"))


def audit(facts: DataFrame, start: date, end: date, interval: str) -> DataFrame:
    """Timeline, summary and outlet rows in one result, end included.

    Distinct outlets and days are the only aggregates that grouping sets would expand for
    every input row, so facts are first folded to one row for each (day, outlet, ...)."""
    keys = ["outlet_group", "outlet", "outlet_country", "estimated_country", "domain_country", "classification_basis"]
    chosen = facts.where(F.col("day").between(F.lit(start), F.lit(end))).groupBy("day", *keys).agg(F.sum("article_count").alias("n"))
    chosen = chosen.withColumn("bucket", bucket(F.col("day"), interval))
    columns = [F.col(c) for c in ["bucket", *keys]]
    sets = [[F.col("bucket"), F.col("outlet_group")], [F.col("outlet_group")], [F.col(c) for c in keys]]
    rows = chosen.groupingSets(sets, *columns).agg(
        F.when(F.grouping("bucket") == 0, "timeline").when(F.grouping("outlet") == 0, "outlet").otherwise("summary").alias("kind"),
        F.sum("n").alias("articles"), F.count_distinct("outlet").alias("active_outlets"), F.count_distinct("day").alias("active_days"),
    )
    return rows.select("kind", "bucket", *keys, "articles", "active_outlets", "active_days")


def summary(rows: DataFrame) -> DataFrame:
    """A row for each group, zeros where it has none: totals, the largest known outlet and
    the articles without one."""
    spark = rows.sparkSession
    groups = spark.createDataFrame([(g,) for g in GROUPS], "outlet_group string")
    totals = rows.where("kind = 'summary'").select("outlet_group", "articles", "active_outlets", "active_days")
    known = F.coalesce(F.col("outlet"), F.lit("")) != ""
    outlets = rows.where("kind = 'outlet'").groupBy("outlet_group").agg(
        F.min(F.when(known, F.struct((-F.col("articles")).alias("less"), "outlet"))).alias("top"),
        F.sum(F.when(~known, F.col("articles")).otherwise(0)).alias("missing"),
    )
    joined = groups.join(totals, "outlet_group", "left").join(outlets, "outlet_group", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return joined.select(
        "outlet_group", zero(F.col("articles")).alias("articles"), zero(F.col("active_outlets")).alias("active_outlets"), zero(F.col("active_days")).alias("active_days"),
        F.col("top.outlet").alias("largest_outlet"), zero(-F.col("top.less")).alias("largest_outlet_articles"), zero(F.col("missing")).alias("missing_domain_articles"),
    )


def calendar(spark, start: date, end: date) -> DataFrame:
    """One row a day, end included, leap days too."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("day"))


def periods(timeline: DataFrame, start: date, end: date, interval: str, missing: list[date]) -> DataFrame:
    """Every period of the calendar with its expected and available days, and for each group
    its articles and outlets, zeros where timeline(bucket, outlet_group, ...) has no row."""
    spark = timeline.sparkSession
    gone = F.col("day").isin(*[F.lit(d) for d in missing]) if missing else F.lit(False)
    spine = calendar(spark, start, end).groupBy(bucket(F.col("day"), interval).alias("period")).agg(F.count(F.lit(1)).alias("expected_days"), F.sum(F.when(gone, 0).otherwise(1)).alias("available_days"))
    every = spine.withColumn("outlet_group", F.explode(F.array(*map(F.lit, GROUPS))))
    found = timeline.select(F.col("bucket").alias("period"), "outlet_group", "articles", "active_outlets")
    return every.join(found, ["period", "outlet_group"], "left").fillna(0, ["articles", "active_outlets"])


def assess(series: DataFrame, min_outlets: int, min_articles: int, required: float) -> DataFrame:
    """Whether enough complete periods reach both minimums for the pivot's and the target's
    outlets: complete, excluded, passing, percent (null without complete ones), meets."""
    good = (F.col("active_outlets") >= min_outlets) & (F.col("articles") >= min_articles)
    both = F.col("outlet_group").isin("Chinese", "Local")
    each = series.groupBy("period").agg(F.first(F.col("available_days") == F.col("expected_days")).alias("whole"), F.every(good | ~both).alias("good"))
    counts = each.agg(
        F.count_if("whole").alias("complete"), F.count_if(~F.col("whole")).alias("excluded"), F.count_if(F.col("whole") & F.col("good")).alias("passing")
    )
    percent = 100 * F.col("passing") / F.nullif(F.col("complete"), F.lit(0))
    return counts.withColumn("percent", percent).withColumn("meets", F.coalesce(F.col("percent") >= required, F.lit(False)))


def histogram(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """How many of rows(days array) fall on each day of spine(day), each once a day."""
    counted = rows.select(F.explode(F.array_distinct("days")).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("count"))
    return spine.join(counted, "day", "left").fillna(0, ["count"])
