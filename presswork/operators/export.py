"""Leaving the engine: CSV that spreadsheets can't execute, ordered exports, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.plans.lineage import cut
from presswork.sources.sinks import ContentFiles


def csv_field(value: Column, is_text: bool = True) -> Column:
    """A quoted field; text that would start a formula gets an apostrophe first."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    if is_text:
        text = F.when(text.rlike(r"^[=+@\-\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_lines(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One line for each row."""
    kinds = dict(rows.dtypes)
    return rows.select(F.concat_ws(",", *[csv_field(F.col(c), kinds[c] == "string") for c in columns]).alias("line"))


def csv_header(columns: list[str]) -> str:
    return ",".join('"' + ("'" + c if c[:1] in "=+@-\t\r" and c else c).replace('"', '""') + '"' for c in columns)


def joined(rows: DataFrame, separator: str = "; ") -> DataFrame:
    """rows with arrays of text as one text."""
    return rows.select(*[F.array_join(c, separator).alias(c) if kind == "array<string>" else F.col(c) for c, kind in rows.dtypes])


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that an export may hold once but that occur more often."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def jsonl(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def manifest(parts: DataFrame, key: str) -> DataFrame:
    """A row for each part of ``packing.packed``: its place, its files' names and what they hold."""
    name = F.concat(F.lit("articles-"), F.substring("sha256", 1, 12), F.lit(".json"))
    return parts.select(key, "part", name.alias("json"), F.concat(name, F.lit(".gz")).alias("gzip"), "rows", "sha256", F.col("bytes").alias("json_bytes"))


def write_parts(parts: DataFrame, key: str, folder: str) -> DataFrame:
    """Write each part's body as it is and compressed under its content's name in a folder for its
    key, and the manifest as JSON lines beside them. Returns the manifest, read back. Bodies
    that exist are left alone, so a task or a job that runs again changes nothing."""
    spark = parts.sparkSession
    spark.dataSource.register(ContentFiles)
    held = cut(parts)
    place = F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("none")), F.concat(F.lit("articles-"), F.substring("sha256", 1, 12), F.lit(".json")))
    held.select(place.alias("name"), "body").write.format("content_files").mode("append").option("folder", folder).save()
    rows = manifest(held, key)
    rows.orderBy(key, "part").write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.schema(rows.schema).json(f"{folder}/manifest")


def within_budget(df: DataFrame, limit: int) -> int:
    """The optimizer's size of a plan in bytes; ValueError beyond the limit."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > limit:
        raise ValueError(f"the plan reads about {size} bytes; the limit is {limit}")
    return size


def stats(obs: DataFrame, country: str) -> DataFrame:
    """Rows, URLs and outlets of an export, and how many the estimate gives: one row."""
    mine = F.col("estimated_country") == country
    return obs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("url").alias("unique_urls"), F.count_distinct("outlet").alias("websites"), F.count_if(mine).alias("gdelt_rows"), F.count_distinct(F.when(mine, F.col("url"))).alias("gdelt_unique_urls"))



def increasing(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows that do not follow the one before them strictly: none in a proper export."""
    key = F.struct(*order)
    window = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("_before", F.lag(key).over(window)).where(F.col("_before").isNotNull() & (F.col("_before") >= key)).drop("_before")
