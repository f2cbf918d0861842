import hashlib
from collections import Counter

from presswork.llm import queries
from presswork.plans.lineage import cut


def test_stages(spark, small):
    import public_tokenizers
    import tiktoken

    import corpus_pipeline
    from presswork.llm import bpe, quality
    from test_mixing import brute as mixed
    from test_ngram_join import brute as linked

    tables = {n: spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels")}
    docs = tables["documents"]
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(cut(stage(spark, seen[-1], small)))
        assert name == "encode" or seen[-1].columns == columns
    rows = [[tuple(r) for r in s.select(*(["doc_id", "text", "source"] if i < 5 else s.columns)).collect()] for i, s in enumerate(seen)]
    kept = {r["doc_id"] for r in quality.score(docs, quality.train(docs, tables["labels"])).where("predicted = 1").collect()}
    assert {r[0] for r in rows[1]} == kept
    first = {}
    for i, t, _ in sorted(rows[1]):
        first.setdefault(" ".join((t or "").split()), i)
    assert sorted(r[0] for r in rows[2]) == sorted(first.values())
    assert {r[0] for r in rows[3]} == {c for _, c, _ in linked([(r[0], r[1]) for r in rows[2]])}
    source = {r[0]: r[2] for r in rows[3]}
    assert Counter((i, t) for i, t, _ in rows[4]) == mixed([(r[0], r[1]) for r in rows[3]], source.get)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))}, special_tokens={})
    ids = lambda t: coder.encode_ordinary(t or "")
    want = Counter((i, len(ids(t)), hashlib.sha256(",".join(map(str, ids(t))).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows[4])
    assert Counter(rows[5]) == want


def test_queries_equal_sql(spark, small):
    from oracle import connect, same

    con = connect(small)
    for name, sql in queries.oracle_sql().items():
        same(con, queries.queries()[name](spark, small), sql)


def test_queries_are_whole(spark, small):
    found = queries.queries()
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    for name in ("op4_suffix_tree_scores", "op6_quality_classifier", "op7_bpe_round_trip", "op8_rendezvous_shards", "op9_toxicity"):
        assert found[name](spark, small).count() == n


def test_stages_on_odd_and_empty_tables(make, odd, spark, small):
    import corpus_pipeline

    for docs in (make(odd), make([])):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = cut(stage(spark, docs, small))
            assert name == "encode" or docs.columns == columns
            ids = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
            if name in ("exact", "near"):
                assert max(ids.values(), default=1) == 1
                assert sum(ids.values()) <= n
        assert (n == 0) == (sum(ids.values()) == 0)


def test_stages_on_ids_that_repeat_with_other_texts(make, spark, small):
    import corpus_pipeline
    from test_ngram_join import repeated_ids, survivors

    pairs = repeated_ids(seed=12) + [(3, "one  two three four five six"), (2, "one two three four five six"), (2, "other words of the same id here")]
    docs = make(pairs)
    rows = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    stages = dict(corpus_pipeline.STAGES)
    first = {}
    for i, t in sorted(pairs):
        first.setdefault(" ".join(t.split()), (i, t))
    exact = cut(stages["exact"](spark, docs, small))
    assert [(i, " ".join(t.split())) for i, t in rows(exact)] == sorted(((i, k) for k, (i, _) in first.items()), key=repr)
    near = cut(stages["near"](spark, exact, small))
    assert rows(near) == survivors(rows(exact))
    accepted = rows(stages["quality"](spark, docs, small))
    from presswork.llm import quality
    from presswork.sources.tables import table

    fitted = quality.train(docs, table(spark, small, "labels"))
    assert Counter(accepted) == Counter(x for x in rows(docs) if quality.vote(fitted, quality.terms([x[1]]))[0] >= 0.5)
    mixed = Counter(rows(stages["mix"](spark, near, small)))
    assert set(mixed) <= set(rows(near))
    assert stages["encode"](spark, near, small).count() == near.count()
