"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes.

Texts are equal when identical after each run of [\\x20\\x09-\\x0D] becomes one space;
a null text counts as empty. One pass groups (hash, text): partial aggregation folds the
copies of a text to one row for each map task before anything moves, so a text that a
third of all rows share costs no more than any other. Grouping by the bytes beside the
hash is the comparison that excludes collisions; a hash that stands for more than one
text is regrouped by the text itself.

Defined cases: null doc_id loses against any other; of rows that tie on text and doc_id
exactly one stays; an empty table gives an empty result; other columns are ignored by
``groups`` and returned untouched by ``keep_one``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.base import repeated
from presswork.plans.lineage import cut

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def content_hash(norm: Column, bits: int = 128) -> Column:
    """Hex digits of the text's MD5; fewer bits only to provoke collisions in tests."""
    return F.substring(F.md5(norm), 1, bits // 4)


def classes(rows: DataFrame, bits: int = 128) -> DataFrame:
    """(hash, norm, keep_id, group_size, sha, texts) for each distinct text of
    rows(id, norm); texts: how many texts the hash stands for. The text itself is null
    unless its hash is shared."""
    by_text = (
        rows.groupBy(content_hash(F.col("norm"), bits).alias("hash"), "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumn("sha", F.sha2("norm", 256))
    )
    by_hash = by_text.groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.min("sha").alias("sha")
    )
    return by_hash


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), normalised(F.col("text")).alias("norm"))


def groups(docs: DataFrame, bits: int = 128) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256. Rows that repeat
    an id with its text are one row with a count while they meet their group."""
    rows = _source(docs)
    found = cut(classes(rows, bits))
    hashed = rows.select("id", content_hash(F.col("norm"), bits).alias("hash"), F.sha2("norm", 256).alias("sha"))
    member = cut(hashed.groupBy("id", "hash", "sha").agg(F.count(F.lit(1)).alias("nth")))
    out = member.join(found.where("texts = 1").drop("sha", "texts"), "hash").select("id", "sha", "nth", "keep_id", "group_size")
    shared = found.where("texts > 1").select("hash")
    if not shared.isEmpty():
        # the hash collided: group these rows by their bytes alone
        clash = rows.withColumn("hash", content_hash(F.col("norm"), bits)).join(shared, "hash", "left_semi")
        exact = clash.groupBy("norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        each = clash.groupBy("norm", "id").agg(F.count(F.lit(1)).alias("nth"))
        out = out.unionByName(each.join(exact, "norm").withColumn("sha", F.sha2("norm", 256)).select(out.columns))
    every = repeated(out, "nth", ["id", "sha"], member)
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return every.select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame, bits: int = 128) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Whole rows meet their group on (text hash, doc_id), so the copies of a hot text
    spread over the partitions by doc_id and drop out where they land."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), normalised(F.col("text")).alias("norm"))
    found = cut(classes(packed.select("id", "norm"), bits))
    keyed = packed.withColumn("hash", content_hash(F.col("norm"), bits))
    number = F.coalesce(F.col("id"), F.lit(0))
    missing = F.col("id").isNull()
    best = found.where("texts = 1").select("hash", F.coalesce("keep_id", F.lit(0)).alias("key"), F.col("keep_id").isNull().alias("no_id"))
    kept = keyed.withColumn("key", number).withColumn("no_id", missing).join(best, ["hash", "key", "no_id"]).dropDuplicates(["hash", "key", "no_id"]).select("row")
    shared = found.where("texts > 1").select("hash")
    if not shared.isEmpty():
        clash = keyed.join(shared, "hash", "left_semi")
        exact = clash.groupBy(F.col("norm").alias("kept_norm")).agg(F.min("id").alias("keep_id"))
        first = (F.col("norm") == F.col("kept_norm")) & F.col("id").eqNullSafe(F.col("keep_id"))
        again = clash.join(exact, first).dropDuplicates(["norm"]).select("row")
        kept = kept.union(again)
    return kept.select("row.*")


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept,
       sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
