"""The subpackage's queries and their SQL, as __spark_entry__ registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import bpe, exact_dedup, decontamination, licenses, mih, mixing, ngram_join, periodic, quality, sharding, suffix_tree, toxicity, whitening
from presswork.sources.tables import table

#: Sixteen shards of equal weight.
SHARDS = [1.0] * 16


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.links(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), detail=True)


def op4_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts of a tenth of the ids, by CRC-32, repeat a stretch up to their end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, found).alias("w")).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    repeated = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def _line(r: Column) -> Column:
    return F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(_with_repeats(table(spark, sf_dir, "documents")))
    # by exponent, compared without division; runs come by start, then period
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.array_join(F.transform("runs", _line), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "b.*", F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
        "op3_mixing": op3_mixing,
        "op4_suffix_tree_scores": op4_suffix_tree_scores,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_bpe_round_trip": op7_bpe_round_trip,
        "op8_rendezvous_shards": op8_rendezvous_shards,
        "op9_toxicity": op9_toxicity,
        "op10_multi_index_hashing": op10_multi_index_hashing,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_benchmark_decontamination": op13_benchmark_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": licenses.oracle_sql(),
        "op2_ngram_jaccard_join": ngram_join.ORACLE_SQL,
        "op3_mixing": mixing.ORACLE_SQL,
        "op5_exact_dedup": exact_dedup.ORACLE_SQL,
        "op13_benchmark_decontamination": decontamination.ORACLE_SQL,
    }
