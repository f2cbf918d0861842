"""Loading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; any path that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_by_day(df: DataFrame, path: str, time: str, cluster: list[str], files: int = 1, mode: str = "append") -> None:
    """df as Parquet in a folder for each day of `time`, rows of like `cluster` together, so
    that readers skip days by folder and files by their statistics. `files` is how many a
    day gets."""
    day = df.withColumn("day", F.to_date(time))
    dealt = day.repartition("day", *([F.pmod(F.xxhash64(*cluster), F.lit(files))] if files > 1 else []))
    dealt.sortWithinPartitions("day", *cluster).write.mode(mode).partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str, start, end) -> DataFrame:
    """The rows of the days from start to end; other days' folders are not opened."""
    return spark.read.parquet(path).where(F.col("day").between(F.lit(start), F.lit(end)))


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """df as a table whose rows lie in buckets by the hash of keys, sorted by them: windows, groups
    and joins on these keys read it without a shuffle. path: where, if not in the warehouse."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
