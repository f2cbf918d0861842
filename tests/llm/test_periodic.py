import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from presswork.llm import periodic, queries
from presswork.sources.tables import table


def brute(w, least=24, exponent=3):
    """Runs by extending matches at each lag and looking for a smaller period."""
    found = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if n >= max(least, exponent * q) and not any(all(w[j] == w[j + d] for j in range(s, s + n - d)) for d in range(1, q)):
                found.append((s, n, q))
    return sorted(found)


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(lines), digest(collapse(w, runs)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def cases():
    random.seed(5)
    some = [["a"] * 23, ["a"] * 24, ["a"] * 400, list("ab") * 12, list("abc") * 8, (list("abcd") * 6)[:-1], list("ab") * 30 + list("abc") * 30, list("aab") * 40 + list("aaab") * 40]
    for _ in range(60):
        w = []
        while len(w) < random.randint(10, 160):
            unit = random.choices("abcd"[: random.randint(1, 4)], k=random.randint(1, 9))
            w += unit * random.randint(1, 9) + random.choices("abcdef", k=random.randint(0, 5))
        some.append(w)
    fib = ["a", "ab"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    return [*some, list(fib[-1])]


def test_runs_equal_brute_force(make):
    texts = [" ".join(w) for w in cases()]
    found = {r["doc_id"]: r for r in periodic.find(make(list(enumerate(texts)))).collect()}
    for i, w in enumerate(cases()):
        runs = [tuple(x) for x in found[i]["runs"]]
        assert runs == brute(w), w
        assert found[i]["collapsed"] == collapse(w, runs) and found[i]["n_words"] == len(w)


@pytest.mark.parametrize(("least", "exponent"), [(4, 2), (9, 4)])
def test_other_parameters(make, least, exponent):
    texts = [" ".join(w) for w in cases()[:30]]
    for r in periodic.find(make(list(enumerate(texts))), least, exponent).collect():
        assert [tuple(x) for x in r["runs"]] == brute(texts[r["doc_id"]].split(), least, exponent)


def test_one_period_is_refused(make):
    with pytest.raises(ValueError, match="twice"):
        periodic.find(make([(1, "a")]), exponent=1)


def test_transforms_and_differences_count_alike(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = [700, 0, 3, 5000, 1]
    code = np.concatenate([rng.zipf(1.3, n).clip(max=300) for n in lengths]).astype(np.int32)
    begin = np.concatenate(([0], np.cumsum(lengths)))
    used = []
    real = np.fft.rfft
    monkeypatch.setattr(np.fft, "rfft", lambda x: used.append(len(x)) or real(x))
    both = periodic.matches(code, begin)
    assert 16384 in used  # the text of 5,000 words has frequent ones
    monkeypatch.setattr(periodic, "_cost", lambda n: np.full(len(n), np.inf))
    monkeypatch.setattr(periodic, "HELD", 1000)
    assert (periodic.matches(code, begin) == both).all()
    monkeypatch.setattr(periodic, "_cost", lambda n: np.zeros(len(n)))
    assert (periodic.matches(code, begin) == both).all()
    mine = code[begin[3] : begin[4]]
    assert all(both[begin[3] + q] == (mine[:-q] == mine[q:]).sum() for q in range(1, 5000 // 3 + 1))


def test_a_repeated_word_is_scanned_once(monkeypatch):
    scans = []
    real = np.diff
    monkeypatch.setattr(periodic.np, "diff", lambda x, *a: scans.append(len(x)) or real(x, *a))
    code = np.zeros(3000, np.int32)
    count = np.concatenate(([0], 3000 - np.arange(1, 1001)))
    assert periodic.runs_of(code, count) == [(0, 3000, 1)]
    assert len(scans) == 1


def test_words_are_cut_at_six_bytes():
    flat, begin = periodic.words(pa.array(["  a\tb\x0bc\x1cd\r\ne ", "", "x y\x85 z", " \n"], pa.large_string()))
    assert flat.to_pylist() == ["a", "b", "c\x1cd", "e", "x y\x85", "z"] and begin.tolist() == [0, 4, 4, 6, 6]


def test_query_equals_brute_force_on_the_documents(spark):
    folder = "/root/testdata/sf0.001"
    pairs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    short = {i for i, t in pairs if len((t or "").split()) <= 900}
    found = [r for r in rows(queries.op11_periodic_runs(spark, folder)) if r[0] in short]
    assert found == sorted((expected(i, t) for i, t in pairs if i in short), key=repr)
    assert len(short) > 100 and sum(r[1] > 0 for r in found) > 10


def test_odd_rows(spark, make, odd, tmp_path):
    make(odd).write.parquet(f"{tmp_path}/documents.parquet")
    found = rows(queries.op11_periodic_runs(spark, str(tmp_path)))
    assert len(found) == len(odd)
    small = [x for x in odd if not x[1] or len(x[1]) < 60_000]
    assert [r for r in found if r[0] not in (6, 7)] == sorted((expected(*x) for x in small), key=repr)
    make(odd[:0]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op11_periodic_runs(spark, f"{tmp_path}/none").count() == 0


def brute_by_lag(w):
    """Runs of a long text: islands of every lag, and a smaller period looked for among divisors."""
    code = np.unique(w, return_inverse=True)[1]
    found = []
    for q in range(1, len(w) // 3 + 1):
        edge = np.diff(np.concatenate(([0], (code[:-q] == code[q:]).astype(np.int8), [0])))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            n = e - s + q
            if n >= max(24, 3 * q) and not any(q % d == 0 and (code[s : s + n - d] == code[s + d : s + n]).all() for d in range(1, q)):
                found.append((s, n, q))
    return sorted(found)


def test_long_documents_equal_islands_of_every_lag(spark):
    folder = "/root/testdata/sf0.01"
    pairs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect() if len((r["text"] or "").split()) > 900]
    found = {r[0]: r for r in rows(queries.op11_periodic_runs(spark, folder))}
    some = 0
    for i, t in pairs:
        w = planted(i, t)
        runs = brute_by_lag(w)
        some += bool(runs)
        assert found[i][1] == len(runs) and found[i][7] == digest(collapse(w, runs))
        assert found[i][6] == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
    assert len(pairs) > 50 and some > 5
