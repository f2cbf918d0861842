"""Parts equal those of a greedy packer that reads each key from end to end."""

import gzip
import hashlib
import json
import random
from pathlib import Path

import numpy as np
import pytest

from presswork.operators import export, packing
from presswork.sources import files

SCHEMA = "key string, day int, url string, tags array<string>"


def greedy(rows, max_rows, max_bytes):
    """Bodies by (key, part)."""
    by_key = {}
    for key, *values in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        by_key.setdefault(key, []).append(json.dumps(values, ensure_ascii=False, separators=(",", ":")))
    out = {}
    for key, lines in by_key.items():
        parts, held, size = [], [], 0
        for one in lines:
            n = len(one.encode()) + 1
            if held and (len(held) >= (max_rows or 10**9) or size + n > max_bytes):
                parts.append(held)
                held, size = [], 0
            held.append(one)
            size += n
        parts.append(held)
        for k, part in enumerate(parts):
            out[key, k] = '{"key":' + json.dumps(key, ensure_ascii=False) + ',"fields":["day","url","tags"],"rows":[' + ",".join(part) + "]}"
    return out


def table(seed, n, share=0.6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < share else rng.choice(["a", "b", None, "ü"])
        long = rng.choice([1, 5, 20, 60, 300 if rng.random() < 0.1 else 10])
        rows.append((key, i // 7, f"u{i:05d}/" + "é" * (long % 7) + "x" * long, None if i % 11 == 0 else ["p", 'q"\\'][: i % 3]))
    return rows


def found(df):
    return {(r["key"], r["part"]): r["body"] for r in df.collect()}


@pytest.mark.parametrize(("pieces", "max_rows", "max_bytes"), [(1, 40, 2000), (9, 7, 100000), (9, None, 900), (24, 40, 2000), (24, 3, 150), (16, None, 10**9), (40, 1, 10), (5, 1000, 120)])
def test_equals_greedy(spark, pieces, max_rows, max_bytes):
    rows = table(pieces, 700)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(packing.packed(df, "key", ["day", "url"], max_rows, max_bytes, pieces)) == greedy(rows, max_rows, max_bytes)


def test_one_key_in_many_pieces_smaller_than_a_part(spark):
    rows = [("k", i, f"u{i:04d}", ["t"]) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(packing.packed(df, "key", ["day"], 90, 10**6, 30)) == greedy(rows, 90, 10**6)
    assert found(packing.packed(df, "key", ["day"], None, 2500, 30)) == greedy(rows, None, 2500)


def test_empty_and_single(spark):
    assert packing.packed(spark.createDataFrame([], SCHEMA), "key", ["day"], 5, 100).count() == 0
    one = [(None, 1, "u", None)]
    assert found(packing.packed(spark.createDataFrame(one, SCHEMA), "key", ["day"], 5, 1)) == greedy(one, 5, 1)


def test_rows_that_repeat(spark):
    rows = [("k", 1, "same", ["t"])] * 50
    assert found(packing.packed(spark.createDataFrame(rows, SCHEMA), "key", ["day"], 8, 10**6, 6)) == greedy(rows, 8, 10**6)


def test_jumps():
    size = np.array([5, 5, 50, 1, 1, 1])
    assert packing.jumps(np.cumsum(size) - size, size, 3, 10).tolist() == [2, 2, 3, 6, 6, 6]


def test_a_hot_key_is_spread(spark):
    rows = [("k", i, f"u{i:05d}", ["t"]) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    by = packing.numbered_parts(df.selectExpr("key as k", "key", "url as line", "10L as size", "day").repartitionByRange(12, "k", "day").sortWithinPartitions("day").select("k", "key", "line", "size"), 50, 10**6)
    each = by.groupBy("piece").count().collect()
    assert len(each) >= 10 and max(r["count"] for r in each) < 1000
    assert by.groupBy("part").count().where("count <> 50").count() == 0


def test_files_round_trip(spark, tmp_path):
    rows = [(k, d, u, t or ["z"]) for k, d, u, t in table(3, 300) if k in ("hot", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = packing.packed(df, "key", ["day", "url"], 40, 3000, 8)
    folder = str(tmp_path / "out")
    names = export.write_parts(parts, "key", folder).collect()
    want = greedy(rows, 40, 3000)
    assert {(r["key"], r["part"]): r["sha256"] for r in names} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}
    stamps = {}
    for r in names:
        plain, packed = Path(folder, r["key"], r["json"]), Path(folder, r["key"], r["gzip"])
        assert plain.read_text() == gzip.decompress(packed.read_bytes()).decode() == want[r["key"], r["part"]]
        assert len(plain.read_bytes()) == r["json_bytes"]
        stamps[plain] = plain.stat().st_mtime_ns
    assert not list(Path(folder).rglob("*.part"))
    export.write_parts(parts, "key", f"file://{folder}")  # again: nothing is written anew
    assert {p: p.stat().st_mtime_ns for p in stamps} == stamps
    back = files.json_cache(spark, f"{folder}/*/articles-*.json", arrays=("tags",), expected=len(rows), rows_of={r["json"]: r["rows"] for r in names})
    assert sorted((r["day"], r["url"], r["tags"]) for r in back.collect()) == sorted((str(d), u, t) for _, d, u, t in rows)
