import hashlib
import re

import pytest
from oracle import connect, same

from presswork.llm import decontamination as d
from presswork.llm import base, queries

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BENCH = "item_id long, text string, w string, h long"


def cut(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(text, n=10):
    w = cut(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(docs, bench, n=10):
    out = []
    for i, text in docs:
        w, hit, items = cut(text), set(), set()
        for item, body in bench:
            for g in windows(body, n):
                for at in range(len(w) - len(g) + 1):
                    if tuple(w[at : at + len(g)]) == g:
                        hit |= set(range(at, at + len(g)))
                        items.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (10, "one TWO three, four five six seven eight nine ten!"), (2, "short item"), (3, None), (4, " .,; "), (None, "x1 é Ü"), (5, "a b a b a b a b a b a b a"), (5, "single")]
DOCS = [
    (1, "zero one two three four five six seven eight nine ten eleven twelve"), (2, "One, two; three four five six seven eight nine"), (3, "a SHORT item; and a short - item"), (4, None), (5, ""), (6, "..."),
    (7, "a b a b a b a b a b a b a b a b"), (8, "X1 é Ü x1 É Ü x1 é ü"), (9, "singles single"), (9, "singles single"), (9, "another text"), (None, "short item"), (None, None), (11, "one two three four five six seven eight nine ten"), (12, "item"),
]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(i, t, "w", 0) for i, t in ITEMS], BENCH)


def test_equals_brute_force(make, bench):
    assert rows(d.report(make(DOCS), bench)) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("n", [2, 3, 13])
def test_other_sizes(make, bench, n):
    assert rows(d.report(make(DOCS), bench, n)) == brute(DOCS, ITEMS, n)


def test_passes_and_joins_give_the_same(make, bench, monkeypatch):
    monkeypatch.setattr(d, "PER_PASS", 2)
    monkeypatch.setattr(d, "BROADCAST", 0)
    monkeypatch.setattr(base, "COPIES", 3)
    docs = DOCS + [(20, "short item")] * 10
    assert rows(d.report(make(docs), bench)) == brute(docs, ITEMS)


def test_hashes_are_verified(make, bench, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(d, "_hashes", lambda w: F.transform(w, lambda x: F.lit(1).cast("long")))
    monkeypatch.setattr(d, "_gram_hash", lambda size: F.when(F.col("size") == size, F.xxhash64(*[F.lit(1).cast("long")] * size)))
    assert rows(d.report(make(DOCS), bench)) == brute(DOCS, ITEMS)


def test_odd_rows_and_empty_tables(spark, make, odd, bench):
    assert rows(d.report(make(odd), bench)) == brute([x if not x[1] or len(x[1]) < 60_000 else (x[0], x[1]) for x in odd], ITEMS)
    assert rows(d.report(make(odd[:0]), bench)) == []
    none = spark.createDataFrame([], BENCH)
    assert rows(d.report(make(DOCS), none)) == brute(DOCS, [])
    assert d.remove(make(DOCS), none).count() == len(DOCS)


def test_many_items_share_a_window(spark, make):
    items = [(i, f"alpha beta gamma delta epsilon zeta eta theta iota kappa {'lambda' if i % 2 else 'mu'}") for i in range(300)]
    docs = [(i, f"x{i} alpha beta gamma delta epsilon zeta eta theta iota kappa lambda") for i in range(40)]
    assert rows(d.report(make(docs), spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_removal(make, bench):
    spans = {(r["doc_id"], r["text"]) for r in d.remove(make(DOCS), bench).collect()}
    assert (1, "zero twelve") in spans and (3, "a; and a") in spans and (9, "singles") in spans and (9, "another text") in spans
    assert (7, "") in spans and (4, None) in spans and (2, DOCS[1][1]) in spans and (8, " x1 É Ü x1 é ü") in spans
    whole = d.remove(make(DOCS), bench, whole=True)
    dirty = {(i, t) for i, t in DOCS if brute([(i, t)], ITEMS)[0][5]}
    assert sorted(((r["doc_id"], r["text"]) for r in whole.collect()), key=repr) == sorted((x for x in DOCS if x not in dirty), key=repr)
    assert whole.columns == make(DOCS).columns == d.remove(make(DOCS), bench).columns


def test_query_equals_sql(spark, small):
    found = queries.op13_benchmark_decontamination(spark, small)
    same(connect(small), found, d.ORACLE_SQL)
    assert found.where("contaminated").count() > 0


def test_no_python_in_the_plan(spark, small, bench, make):
    plan = d.remove(make(DOCS), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
