"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Copies of a row that one task repeats.
COPIES = 4096


def repeated(rows: DataFrame, copies: str, key: list[str], counts: DataFrame) -> DataFrame:
    """rows, each as often as its column `copies` says, which then numbers them from 1. Rows of more
    than COPIES are dealt out again first, so no task repeats one more often. counts: a table that
    is quick to read and has the same column, to see whether there are such rows."""
    hot = not counts.where(F.col(copies) > COPIES).isEmpty()
    numbered = lambda df, before: df.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).withColumn(copies, F.col(copies) + before)
    if not hot:
        return numbered(rows, F.lit(0))
    few = numbered(rows.where(F.col(copies) <= COPIES), F.lit(0))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / COPIES))
    many = rows.where(F.col(copies) > COPIES).withColumn("_piece", F.explode(pieces)).repartition(*key, "_piece")
    many = many.withColumn(copies, F.least(F.lit(COPIES).cast("long"), F.col(copies) - F.col("_piece") * COPIES))
    return few.unionByName(numbered(many, F.col("_piece") * COPIES).drop("_piece"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def parts(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about limit bytes of text (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(sizes):
            end, total = at, 0
            while end < len(sizes) and (end == at or total + sizes[end] <= limit):
                total += int(sizes[end])
                end += 1
            yield batch.slice(at, end - at)
            at = end


def small_batches(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The same parts, and their texts; null texts as empty ones."""
    for part in parts(batches, text, limit):
        yield part, [x or "" for x in part.column(part.schema.get_field_index(text)).to_pylist()]


def sample(docs: DataFrame, labels: DataFrame, column: str, modulus: int = 3, held: int = 1, per_class: int = 1500) -> DataFrame:
    """(id, text, label): the labelled rows that a classifier may learn from, of each class the
    per_class with the smallest hash of id; those with remainder `held` are left out."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(column).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(remainder(F.col("id"), modulus) != held).groupBy("id").agg(F.min("label").alias("label"))
    order = F.xxhash64("id", F.lit(column))
    parts = [known.where(F.col("label") == v).orderBy(order, "id").limit(per_class) for v in (0, 1)]
    few = parts[0].union(parts[1])  # at most 2 * per_class rows
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(few), "id")
