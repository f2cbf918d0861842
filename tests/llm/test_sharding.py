import math
import struct
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from presswork.llm import sharding


def test_law(make, odd):
    pairs = odd + [(i, f"t{i % 50}") for i in range(1000, 4000)]
    rows = sharding.assign(make(pairs), [1.0] * 16, pieces=8).collect()
    assert len(rows) == len(pairs)
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in pairs)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 16)
    assert set(by) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    moved = sum(r["grown_shard"] == 16 for r in rows) / len(rows)
    assert abs(moved - 1 / 17) < 0.03
    places = {}
    for r in rows:
        assert places.setdefault(r["doc_id"], r["shard"]) == r["shard"]


def test_winner_equals_brute_force(make, odd):
    def bid(key, j):
        first = xxhash.xxh64_intdigest(key.encode(), 42)
        u = ((xxhash.xxh64_intdigest(struct.pack("<i", j), first) >> 11) + 0.5) / 2**53
        return -1 / math.log(u)

    for r in sharding.assign(make(odd + [(i, "t") for i in range(500)]), [1.0] * 16).collect():
        key = "null" if r["doc_id"] is None else str(r["doc_id"])
        bids = [bid(key, j) for j in range(17)]
        assert r["shard"] == max(range(16), key=bids.__getitem__) and r["grown_shard"] == max(range(17), key=bids.__getitem__)


def test_weights_and_growth(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("bids"), F.lit(2).alias("shard_"))
    four = sharding.shards(df, "k", [1, 1, 2, 4])
    got = Counter(r["shard"] for r in four.collect())
    assert abs(got[3] / 20_000 - 0.5) < 0.02 and abs(got[2] / 20_000 - 0.25) < 0.02
    five = sharding.shards(df, "k", [1, 1, 2, 4, 2]).select("k", F.col("shard").alias("b"))
    assert four.join(five, "k").where("shard <> b and b <> 4").count() == 0


def test_empty(make):
    assert sharding.assign(make([]), [1.0] * 16).count() == 0
