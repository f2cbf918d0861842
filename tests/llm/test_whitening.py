import math
from fractions import Fraction

import numpy as np
import pytest

from presswork.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, length int"


@pytest.fixture(scope="module")
def build(spark):
    return lambda pairs, schema=SCHEMA: spark.createDataFrame([(i, v, 1, "x", 3) for i, v in pairs], schema)


def brute(pairs, components=4):
    """The contract with fractions; numpy only for the eigenvectors."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in pairs if v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for d in {len(x) for _, x in kept}:
        fit = sorted({tuple(x) for _, x in kept if len(x) == d})
        n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        cov = [[Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n**3) for b in range(d)] for a in range(d)]
        value, vector = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
        trace = float(sum(cov[a][a] for a in range(d)))
        for i, x in kept:
            if len(x) == d:
                z = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s, strict=True)])
                dev = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
                out.setdefault(i, []).append([(k + 1, n, dev, z @ vector[:, d - 1 - k] / math.sqrt(value[d - 1 - k]) if value[d - 1 - k] > 1e-13 * trace else None, value[d - 1 - k] / trace if trace else 0.0) for k in range(min(components, d))])
    return out


def check(df, pairs):
    want = brute(pairs)
    found = {}
    for r in df.collect():
        found.setdefault(r["vec_id"], []).append(r)
    assert found.keys() == want.keys()
    flips = {}
    for i, copies in want.items():
        got = sorted(found[i], key=lambda r: (r["component"], r["deviation_exact"]))
        expect = sorted((x for c in copies for x in c), key=lambda x: (x[0], str(x[2])))
        assert len(got) == len(expect)
        for r, (k, n, dev, w, e) in zip(got, expect, strict=True):
            assert (r["component"], r["n"], r["deviation_exact"]) == (k, n, str(dev))
            assert r["deviation"] == (dev if dev < 2**63 else None)
            assert r["explained"] == pytest.approx(max(e, 0.0), rel=1e-6, abs=1e-12)
            assert (r["whitened"] is None) == (w is None)
            if w is not None:
                assert abs(abs(r["whitened"]) - abs(w)) < 1e-6
                if abs(w) > 1e-6:  # one sign for all rows
                    assert flips.setdefault((n, k), np.sign(w * r["whitened"])) == np.sign(w * r["whitened"])
                assert r["identity_error"] < 1e-6
    return found


def test_equals_fractions(build):
    rng = np.random.default_rng(1)
    basis = np.diag([3.0, 1.5, 0.7, 0.5, 0.1, 0.02]) @ np.linalg.qr(rng.normal(size=(6, 6)))[0]
    pairs = [(i, [float(np.float32(c)) for c in rng.normal(size=6) @ basis + 2]) for i in range(300)]
    check(whitening.whiten(build(pairs + pairs[:40])), pairs + pairs[:40])


def test_odd_rows(build):
    rng = np.random.default_rng(2)
    some = [(i, [float(np.float32(c)) for c in rng.normal(size=5)]) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [1.0, math.nan, 1.0, 1.0, 1.0]), (104, [math.inf] + [1.0] * 4), (None, [0.5] * 5), (105, [-0.0, -0.001, 0.0, 1.0, 2.0]), (105, [0.25] * 5)]
    lone = [(200, [1.0, 2.0]), (201, [3.0]), (202, [4.0]), (203, [5.0]), (204, [5.0]), (205, [2.0, 1.0])]
    found = check(whitening.whiten(build(some + odd + lone)), some + odd + lone)
    assert len(found[200]) == 2 and len(found[203]) == 1
    alike = whitening.whiten(build([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(alike) == 4 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, 0.0, None) for r in alike)
    assert whitening.whiten(build([])).count() == 0
    assert whitening.whiten(build([(1, None)])).count() == 0


def test_numbers_of_any_size(build):
    rng = np.random.default_rng(4)
    wide = "vec_id long, embedding array<double>, label int, x string, length int"
    pairs = [(i, (rng.normal(size=4) * 10.0 ** rng.integers(0, 13, size=4)).tolist()) for i in range(60)]
    check(whitening.whiten(build(pairs, wide)), pairs)
    far = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])]
    got = {r["vec_id"]: int(r["deviation_exact"]) for r in whitening.whiten(build(far, wide)).collect()}
    x = {1: (2**63 - 1, 0), 2: (-(2**63), 256), 3: (0, 1280)}
    s = [sum(v[k] for v in x.values()) for k in range(2)]
    assert got == {i: sum((3 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in x.items()}


def test_cross_products_are_exact():
    rng = np.random.default_rng(6)
    y = np.concatenate([rng.integers(-(2**k), 2**k, size=(50, 7)) for k in (3, 20, 23, 30, 61)])
    wide = y.astype(object)
    assert (whitening.cross_products(y) == wide.T @ wide).all()
    most = np.full((700, 2), 2**24 - 1)
    assert whitening.cross_products(most)[0, 1] == 700 * (2**24 - 1) ** 2
    for v in (0, 1, -1, 2**29, -(2**30), 3**100, -(3**140)):
        assert whitening.from_limbs(whitening.limbs(v)) == v


def test_vectors_keep_their_bytes():
    x = np.array([[1, -128], [127, 128], [-32768, 5], [2**31 - 1, 0], [2**31, -(2**63)], [2**63 - 1, 1]])
    data = whitening.packed(x)
    assert [d[0] for d in data] == [1, 2, 2, 4, 8, 8]
    assert (whitening.unpacked(data) == x).all()


def test_lengths_in_passes(build, monkeypatch):
    monkeypatch.setattr(whitening, "PER_PASS", 1)
    rng = np.random.default_rng(8)
    pairs = [(i, [float(np.float32(c)) for c in rng.normal(size=2 + i % 3)]) for i in range(60)]
    check(whitening.whiten(build(pairs)), pairs)


def test_query_on_the_embeddings(spark, small):
    found = queries.op12_embedding_whitening(spark, small)
    pairs = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check(found, pairs)
