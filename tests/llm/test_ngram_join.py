import random

from presswork.llm import ngram_join


def brute(pairs):
    def sets(t):
        w = (t or "").lower().encode().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    rows = [(i, sets(t)) for i, t in pairs if i is not None]
    links = {k: [] for k in range(len(rows))}
    for x in range(len(rows)):
        for y in range(x):
            a, b = rows[x][1], rows[y][1]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[x].append(y)
                links[y].append(x)
    out = []
    for x in range(len(rows)):
        seen, todo = {x}, [x]
        while todo:
            for y in links[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        out.append((rows[x][0], min(rows[y][0] for y in seen), len(links[x])))
    return sorted(out) + [(None, None, 0)] * sum(i is None for i, _ in pairs)


def near_copies(n, groups, seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    out, base = [], [[rng.choice(vocab) for _ in range(rng.randint(30, 200))] for _ in range(groups)]
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append((i, " ".join(words)))
    return out


def found(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect()), key=lambda x: (x[0] is None, x))


def test_links(make, odd):
    pairs = [(1000 + i, t) for i, t in near_copies(150, 12)] + odd
    assert found(ngram_join.links(make(pairs), recall=0.999999)) == brute(pairs)


def test_large_group_in_chunks(make):
    pairs = near_copies(120, 2, seed=9)
    assert found(ngram_join.links(make(pairs), recall=0.999999, chunk=16)) == brute(pairs)


def test_keep_one(make, odd):
    pairs = [(1000 + i, t) for i, t in near_copies(60, 5)] + [x for x in odd if x[0] is not None]
    docs = make(pairs)
    kept = ngram_join.keep_one(docs, recall=0.999999)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c, _ in brute(pairs)}


def test_empty(make):
    assert ngram_join.links(make([])).count() == 0


def test_depth_reaches_the_recall():
    d = ngram_join.depth()
    reach = lambda d, trees=ngram_join.TREES: 1 - (1 - 0.8**d) ** trees
    assert reach(d) >= ngram_join.RECALL > reach(d + 1)
    for d in (6, 12, 18):
        n = ngram_join.trees(d)
        assert reach(d, n) >= ngram_join.RECALL > reach(d, n - 1)


def boilerplate(n, seed=2):
    """Texts that share two thirds of their words, some of them near copies of another."""
    rng = random.Random(seed)
    shared = " ".join(f"s{i}" for i in range(160))
    own = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(80)) for _ in range(n)]
    out = [(i, f"{shared} {t}") for i, t in enumerate(own)]
    return out + [(n + i, f"{shared} {own[i]} more{i}") for i in range(0, n, 3)]


def test_crowded_neighbourhoods_take_longer_prefixes(make, spark):
    pairs = boilerplate(60)
    docs = make(pairs)
    assert found(ngram_join.links(docs, recall=0.999999, chunk=8)) == brute(pairs)
    d = ngram_join.depth(recall=0.99)
    classes = spark.createDataFrame([(i, i, ngram_join.xxhash.xxh3_128_digest(s.tobytes()), ngram_join.nodes(s, d).tobytes()) for i, t in pairs for s in [ngram_join.shingles(t)]], "c long, id long, key binary, nodes binary")
    short = ngram_join._near(classes, ngram_join.TREES).groupBy("group").count().agg({"count": "max"}).first()[0]
    deep = ngram_join._grouped(docs, classes, d, 0.8, 0.99, 8).groupBy("group").count().agg({"count": "max"}).first()[0]
    assert deep < short / 2


def test_default_recall(make):
    pairs = near_copies(400, 40, seed=5)
    want, got = brute(pairs), found(ngram_join.links(make(pairs)))
    assert sum(n for *_, n in got) >= 0.998 * sum(n for *_, n in want)


def survivors(pairs):
    """(doc_id, text) that stay: of each group the least by id and MD5 of the text, once."""
    import hashlib

    rows = [(i, t) for i, t in pairs if i is not None and (t or "").split()]
    sets = [{tuple(w[k : k + 5]) for w in [t.lower().encode().split()] for k in range(max(1, len(w) - 4))} for _, t in rows]
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) - 1e-9 and group[x] != group[y]:
                old = group[x]
                group = [group[y] if g == old else g for g in group]
    order = lambda k: (rows[k][0], hashlib.md5(rows[k][1].encode()).hexdigest())
    best = [rows[min((k for k in range(len(rows)) if group[k] == g), key=order)] for g in set(group)]
    return sorted(best + [(i, t) for i, t in pairs if i is None or not (t or "").split()], key=repr)


def repeated_ids(seed=11):
    """Near copies whose ids repeat with other texts."""
    rng = random.Random(seed)
    pairs = [(rng.randrange(40), t) for _, t in near_copies(90, 14, seed)]
    return pairs + pairs[:7]


def test_ids_that_repeat_with_other_texts(make, odd):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    four = [(1, a), (5, a + " end"), (5, b), (9, b + " end")]
    kept = lambda pairs: sorted(((r["doc_id"], r["text"]) for r in ngram_join.keep_one(make(pairs), recall=0.999999).collect()), key=repr)
    assert kept(four) == [(1, a), (5, b)]
    pairs = repeated_ids() + odd
    assert kept(pairs) == survivors(pairs)
    assert found(ngram_join.links(make(pairs), recall=0.999999)) == brute(pairs)
