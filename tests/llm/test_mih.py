import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.llm import mih

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, top=20):
    good = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = np.array(sorted(good))
    data = np.stack([good[i] for i in ids])
    out = {}
    for i in ids[ids % 20 == 0]:
        score = data @ good[i]
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != i][:top]
        out[int(i)] = [(int(ids[k]), score[k]) for k in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_recall(spark, spread):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((1500, 24))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    data *= 1 + spread * rng.random((1500, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(i, rows[40][1]) for i in range(2000, 2400)]  # a very common vector
    rows += [(9000, None), (9020, [0.0] * 24), (9040, [float("nan")] * 24), (9060, [None] * 24), (9080, []), (9100, [float("inf")] * 24), (None, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = found(mih.nearest(df, lambda c: c % 20 == 0, block=512, wanted=96))
    want = brute(rows)
    assert set(got) == set(want)
    hits = total = 0
    for q, best in want.items():
        assert len(got[q]) == 20 and q not in [i for i, _ in got[q]]
        hits += len({i for i, _ in best} & {i for i, _ in got[q]})
        total += 20
        assert np.allclose([s for _, s in got[q]], sorted((s for _, s in got[q]), reverse=True))
    assert hits / total >= 0.9
    assert [i for i, _ in got[2000]] == [i for i, _ in want[2000]]


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 256, (40, 32), dtype=np.uint8)
    noise = (1 << rng.integers(0, 8, (n, 32))).astype(np.uint8) * (rng.random((n, 32)) < 0.2)
    return base[rng.integers(0, 40, n)] ^ noise.astype(np.uint8)


def test_probing_retrieves_every_code_of_the_radius():
    rng = np.random.default_rng(3)
    for rows in (clustered(4000), rng.integers(0, 256, (3000, 32), dtype=np.uint8), np.repeat(clustered(5), 300, axis=0)):
        index = mih.Index(rows)
        for k in (0, 10, 300, 1499):
            far = np.bitwise_count(rows ^ rows[k]).sum(axis=1)
            for wanted in (1, 7, 60, 400, len(rows), None):
                edge = np.sort(far)[min(wanted or len(rows), len(rows)) - 1]
                assert set(index.nearest(rows[k], wanted)) == set(np.flatnonzero(far <= edge))


def test_probes_read_few_rows_where_codes_have_clusters():
    rows = clustered(20_000)
    index = mih.Index(rows)
    for k in range(50):
        index.nearest(rows[k], 40)
    assert index.read < 0.2 * 50 * len(rows)


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(8 if i % 3 else 5)]) for i in range(300)] + [(1000, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = found(mih.nearest(df, lambda c: c % 20 == 0))
    for q, best in got.items():
        own = dict(rows)[q]
        data = {i: np.dot(np.float32(v).astype(float), np.float32(own).astype(float)) for i, v in rows if len(v) == len(own) and i != q}
        assert [i for i, _ in best] == sorted(data, key=lambda i: (-data[i], i))[:20]
    assert set(got) == {i for i, _ in rows if i % 20 == 0} - {1000}


def test_repeated_ids_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumns({c: F.lit(3) for c in ("id", "vec", "n", "block", "kind", "rep", "score", "model")})
    got = mih.nearest(df, lambda c: c % 20 == 0).collect()
    assert all(r["vec_id"] != 0 for r in got) and {r["vec_id"] for r in got} == {1, 2}


@pytest.mark.parametrize("wanted", [mih.WANTED, None])
def test_recall_on_the_embeddings(spark, wanted):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, got = brute(rows), found(mih.nearest(df, lambda c: c % 20 == 0, wanted=wanted))
    assert set(got) == set(want)
    recall = [len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / len(want[q]) for q in want]
    assert np.mean(recall) >= (0.99 if wanted else 1.0) and min(recall) >= (0.85 if wanted else 1.0)


def test_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)], SCHEMA)
    assert found(mih.nearest(df, lambda c: c % 20 == 0)) == {0: [(1, 0.5), (2, 0.5)]}
    assert mih.nearest(df.where("vec_id < 0"), lambda c: c % 20 == 0).count() == 0
    assert mih.nearest(df.where(F.col("vec_id") == 0), lambda c: c % 20 == 0).count() == 0
