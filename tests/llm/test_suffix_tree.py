import math
import zlib
from collections import Counter

import numpy as np
import pytest

from presswork.llm import suffix_tree

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(t):
    return (t or "").encode().translate(LOWER).split()


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def state(followers, times, least, discount, prior, lower):
    """The shares and what is left of a context, by the definition; None if it is no state."""
    seen = {y: n for y, n in followers.items() if n >= least}
    if times < 2 * least or sum(n / times * math.log(n / times / lower(y)) for y, n in seen.items()) < suffix_tree.DIVERGENCE:
        return None
    share = {y: max(n - discount, 0) / (times + prior) for y, n in seen.items()}
    return share, min(1.0, max(1e-9, 1 - sum(share.values())))


class Chain:
    """A tree by the definition, one context at a time."""

    def __init__(self, sequences, depth, discount, prior, root, total):
        self.depth, self.discount, self.prior, self.root = depth, discount, prior, root
        self.least, self.after, self.states = suffix_tree.least(total), {}, {}
        for s, n in sequences:
            for at in range(1, len(s)):
                for d in range(1, min(depth, at) + 1):
                    self.after.setdefault(tuple(s[at - d : at]), Counter())[s[at]] += n

    def p(self, context, x):
        if not context:
            return self.root(x)
        lower = lambda y: self.p(context[1:], y)
        if context not in self.states:
            followers = self.after.get(context, Counter())
            self.states[context] = state(followers, sum(followers.values()), self.least, self.discount, self.prior, lower)
        if self.states[context] is None:
            return lower(x)
        share, left = self.states[context]
        return share.get(x, 0) + left * lower(x)

    def log(self, s, start):
        return sum(math.log10(self.p(tuple(s[max(0, at - self.depth) : at]), s[at])) for at in range(start, len(s)))


def chains(train):
    """The tree of words and that of bytes over lists of words."""
    counts = Counter(x for t in train for x in [*t, b""])
    n, d = sum(counts.values()), suffix_tree.DEPTH
    pad = b"\n" * d
    single = Counter()
    for w, times in counts.items():
        for x in w + b"\n":
            single[x] += times
    total = sum(single.values())
    # contexts of a word's first bytes hold the newlines before it
    letters = Chain([], d, suffix_tree.DISCOUNT, suffix_tree.PRIOR, lambda x: (single[x] + 0.01) / (total + 2.56), total)
    for w, times in counts.items():
        s = pad + w + b"\n"
        for at in range(d, len(s)):
            for k in range(1, d + 1):
                letters.after.setdefault(tuple(s[at - k : at]), Counter())[s[at]] += times
    spell = lambda w: letters.log(pad + w + b"\n", d)
    root = lambda w: suffix_tree.ROOT * counts[w] / max(1, n) + (1 - suffix_tree.ROOT) * 10 ** spell(w)
    words = Chain([((None, *t, b""), 1) for t in train], suffix_tree.CONTEXTS, suffix_tree.WORD_DISCOUNT, suffix_tree.WORD_PRIOR, root, n)
    return counts, words


def test_hashes_are_sparks(spark):
    some = [b"", b"a", "gr\u00fc\u00dfe".encode(), b"x" * 100]
    got = [r["h"] for r in spark.createDataFrame([(bytearray(w),) for w in some], "w binary").selectExpr("xxhash64(w) AS h").collect()]
    assert got == [int(np.uint64(suffix_tree._hashes[w]).view(np.int64)) for w in some]


@pytest.mark.parametrize("keep", [suffix_tree.KEEP, 0.03])
def test_scores(make, odd, monkeypatch, keep):
    monkeypatch.setattr(suffix_tree, "KEEP", keep)
    odd = [x for x in odd if x[0] not in (6, 7, 9)]
    pairs = odd + [(i, f"the cat {i % 7} sat on the mat {'again ' * (i % 3)}word{i} The End") for i in range(20, 80)]
    rows = suffix_tree.scores(make(pairs)).collect()
    assert len(rows) == len(pairs)
    counts, tree = chains([words(t) for i, t in pairs if not held(i)])
    n, v = sum(counts.values()), len(counts)
    assert (suffix_tree.least(n) > 2) == (keep == 0.03)
    want = []
    for i, t in pairs:
        own = [*words(t), b""]
        base = [(counts[x] + 0.1) / (n + 0.1 * (v + 1)) for x in own]
        want.append((i, held(i), len(own), sum(counts[x] > 0 for x in own), n, sum(map(math.log10, base)), tree.log([None, *own], 1)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for got, expected in zip(sorted((tuple(r) for r in rows), key=key), sorted(want, key=key), strict=True):
        assert got[:5] == expected[:5]
        assert np.allclose(got[5:], expected[5:], rtol=1e-9)


def test_distributions_sum_to_one(make):
    docs = make([(i, f"abc abd abe {i % 4} xyz") for i in range(50)]).select("text")
    model = suffix_tree.train(docs)
    tree = model["spelling"]
    for g in suffix_tree._spelt(words("abc abq zzz"))[0]:
        every = (int(g) & suffix_tree._mask(suffix_tree.DEPTH)) | (np.arange(256) << 8 * suffix_tree.DEPTH)
        assert abs(suffix_tree.probabilities(tree, every).sum() - 1) < 1e-9
    for level in model["levels"]:
        context = level["edges"] >> 32
        assert len(context) and np.allclose((np.bincount(context, level["share"], len(level["left"])) + level["left"])[np.unique(context)], 1)


def test_a_long_new_word_has_its_own_price(make):
    rows = {r["doc_id"]: r["score"] for r in suffix_tree.scores(make([(i, "a b c") for i in range(20) if not held(i)] + [(i, "q" * i) for i in range(500, 700) if held(i)])).collect()}
    new = [rows[i] for i in sorted(rows) if i >= 500]
    assert new == sorted(new, reverse=True) and new[0] < -500


def test_words_after_words_score_better(make):
    """Held-out texts in the order of the training texts against the same words in another."""
    ids = [i for i in range(1, 400)]
    rows = {r["doc_id"]: r for r in suffix_tree.scores(make([(i, "one two three four five six") if not held(i) or i % 2 else (i, "six three one five two four") for i in ids])).collect()}
    right, wrong = ([rows[i]["score"] for i in ids if held(i) and i % 2 == k] for k in (1, 0))
    assert min(right) > max(wrong) + 5


def test_long_and_tail(make, odd, monkeypatch):
    monkeypatch.setattr(suffix_tree, "KEEP", 0.05)
    rows = {r["doc_id"]: r for r in suffix_tree.scores(make(odd)).collect()}
    assert rows[6]["n_tokens"] == 60_001 and rows[7]["n_tokens"] == 60_002
    assert rows[6]["n_known"] == 60_001 or held(6)


def test_empty(make):
    assert suffix_tree.scores(make([])).count() == 0
    assert suffix_tree.scores(make([(i, "a b") for i in range(200) if held(i)])).where("train_tokens = 0 and n_known = 0 and base_score = 0").count() > 0
