import hashlib
import math
from collections import Counter

from presswork.llm import mixing


def brute(pairs, source_of, seed=20240501):
    n = Counter(source_of(i) for i, _ in pairs)
    share = {s: math.sqrt(c) for s, c in n.items()}
    out = Counter()
    for i, t in pairs:
        s = source_of(i)
        rate = share[s] / sum(share.values()) * len(pairs) / n[s]
        u = int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
        k, p, total = 0, math.exp(-rate), math.exp(-rate)
        while u >= total and k < 200:
            k += 1
            p *= rate / k
            total += p
        out[(i, t)] += k
    return +out


def test_counts(make, odd):
    pairs = odd + [(i, f"t{i}") for i in range(100, 400)]
    docs = make(pairs)
    source = lambda i: f"s{(i or 0) % 3}" if i is None or i % 5 else None
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == brute(pairs, source)


def test_weights(make):
    pairs = [(i, f"t{i}") for i in range(1, 3000) if i % 5]
    docs = make(pairs)
    got = Counter(r["source"] for r in mixing.mix(docs, weights={"s0": 1, "s1": 3}, rows=4000).collect())
    assert set(got) == {"s0", "s1"} and abs(got["s0"] - 1000) < 150 and abs(got["s1"] - 3000) < 250


def test_large_rate(spark):
    rows = {r["source_key"]: r["at"] for r in mixing.distributions(spark.createDataFrame([("a", 900.0), ("b", 0.0), ("c", 50_000.0)], "source_key string, rate double")).collect()}
    assert abs(rows["a"][-1] - 1) < 1e-9 and rows["b"] == [1.0] and abs(rows["c"][-1] - 1) < 1e-6
    assert abs(rows["c"][50_000] - 0.5) < 0.01


def test_empty(make):
    assert mixing.mix(make([])).count() == 0
