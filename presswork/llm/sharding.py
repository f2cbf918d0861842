"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard j draws, for a key, u_j in (0,1) from a hash of (key, j) and bids
-w_j / ln(u_j); the highest bid takes the record. A bid depends on its own shard alone,
so a new shard takes records only into itself and moves 1/(n+1) of them. Law: key.

Slots number a shard's records from 0 without gaps. No task holds a whole shard: records
are numbered within (shard, piece), and the pieces' counts, at most shards * PIECES rows
and therefore broadcast, give each piece its first slot.

Defined cases: a null key bids as the key "null"; null text has size 1 and the CRC of no
bytes; repeated rows get slots of their own; an empty table gives an empty result; other
columns are ignored by ``assign`` and kept by ``shards``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces in which a shard's slots are numbered.
PIECES = 1024


def bids(key: Column, weights: Sequence[float]) -> list[Column]:
    text = F.coalesce(key.cast("string"), F.lit("null"))
    out = []
    for j, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(j)), 11).cast("double") + 0.5) * (2.0**-53)
        out.append(-w / F.log(u))
    return out


def winner(found: Sequence[Column]) -> Column:
    """The shard with the highest bid; the smaller shard of equal bids."""
    best = F.greatest(*found) if len(found) > 1 else found[0]
    out = F.lit(len(found) - 1)
    for j in range(len(found) - 2, -1, -1):
        out = F.when(found[j] == best, F.lit(j)).otherwise(out)
    return out.cast("int")


def shards(docs: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """docs with the shard of each record in a new last column."""
    offers = bids(F.col(key), weights)
    picked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.array(*offers).alias("bids"))
    return picked.select("row.*", winner([F.col("bids")[j] for j in range(len(weights))]).alias(name))


def assign(docs: DataFrame, weights: Sequence[float], pieces: int = PIECES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs;
    grown_shard: with one more shard of the mean weight."""
    grown = [*weights, sum(weights) / len(weights)]
    data = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(F.encode(data, "UTF-8")).cast("long").alias("text_crc32"))
    bid = rows.withColumn("bids", F.array(*bids(F.col("doc_id"), grown)))
    every = [F.col("bids")[j] for j in range(len(grown))]
    placed = bid.select(
        "doc_id", "size", "text_crc32", winner(every[:-1]).alias("shard"), winner(every).alias("grown_shard"),
        F.pmod(F.xxhash64(F.col("doc_id"), F.col("text_crc32"), F.lit("piece")), F.lit(pieces)).cast("int").alias("piece"),
    )
    first = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n")).select("shard", "piece", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "size"))
    numbered = placed.withColumn("nth", nth).join(F.broadcast(starts), ["shard", "piece"])  # at most len(weights) * pieces rows
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"), "grown_shard")
