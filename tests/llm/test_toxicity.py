import math
import zlib
from collections import Counter

import numpy as np
import pytest

from presswork.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def many(n=9600):
    """More than 3,000 rows of each class that may teach; some words are odd: l337, s p e l t, doubled."""
    rows, labels = [], []
    for i in range(n):
        toxic = i % 2
        word = ["idiot", "1d10t", "i d i o t", "idiott"][i // 2 % 4] if toxic and i % 3 else "market"
        rows.append((i, f"the story{i % 89} of {word} and zebra{i % 7}" + (" idiot" if i % 97 == 0 else "")))
        labels.append((i, 1, toxic))
    return rows, labels


def test_all_labelled_rows_teach(make, spark):
    rows, labels = many()
    docs, known = make(rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.train(docs, known)
    learnt = [(t, i % 2) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = sum(y for _, y in learnt)
    assert min(toxic, len(learnt) - toxic) > 3000
    chars = toxicity.CharModel(dict(toxicity.grams([t for t, _ in learnt])))
    assert model["grams"] == chars.three
    seen = Counter(), Counter()
    for text, y in learnt:
        every = text.lower().split()
        words = toxicity.spelled_words(every, chars).union(*(toxicity.readings(t, chars) for t in every))
        seen[y].update({p for w in words for p in toxicity.parts(w)})
    strong = [(p, a, seen[0][p]) for p, a in seen[1].items() if (a + 0.5) / (toxic + 1) > 2 * (seen[0][p] + 0.5) / (len(learnt) - toxic + 1)]
    want = toxicity.ratios(strong, toxic, len(learnt) - toxic)
    assert "idiot$" in want and model["ratio"] == pytest.approx(want)
    # at the weights that were fitted the penalised likelihood of all rows has no slope
    scorer = toxicity.Scorer(model)
    x, y = np.array([[1.0, *scorer.evidence(t)] for t, _ in learnt]), np.array([float(y) for _, y in learnt])
    slope = x.T @ (y - 1 / (1 + np.exp(-np.clip(x @ model["weights"], -30, 30)))) - np.array([1e-3, 1, 1, 1, 1]) * model["weights"]
    assert np.abs(slope).max() < 1e-4


def test_scores_in_one_pass_are_those_of_the_model(make, spark):
    rows, labels = many(400)
    rows += [(None, "idiot"), (7, "zzz idiot"), (7, "aaa"), (9, None), (500, "")]
    docs, known = make(rows), spark.createDataFrame([*labels, (8, 1, None)], LABELS)
    some = lambda df: sorted(((r["doc_id"] or -1, r["held_out"], r["predicted"], r["score"]) for r in df.collect()))
    got, want = some(toxicity.scores(docs, known)), some(toxicity.score(docs, toxicity.train(docs, known)))
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])
    assert len(got) == len(rows) and not math.isnan(got[0][3])


def test_parts_are_counted_once_a_text():
    rows, _ = many(300)
    texts = [t for _, t in rows] + ["idiot idiott idiotic, idiot! i d i o t", "", "aa aa a a a", "Straße ßß ǅǆ 日本 日日本"]
    chars = toxicity.CharModel(dict(toxicity.grams(texts)))
    held, sums = toxicity.Parts(chars), np.zeros((2, 0), np.int64)
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        sums = held.add(some, [i % 2 for i in range(len(some))], sums)
    want = Counter(), Counter()
    for at, text in enumerate(texts):
        every = text.lower().split()
        words = toxicity.spelled_words(every, chars).union(*(toxicity.readings(t, chars) for t in every))
        want[at % 50 % 2].update({p for w in words for p in toxicity.parts(w)})
    for y in (0, 1):
        assert {p: n for p, n in zip(held.numbers, sums[y].tolist(), strict=True) if n} == want[y]


def test_letters_alone_need_no_lattice():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aabcdeß"), rng.integers(1, 12))) for _ in range(3000)]
    chars = toxicity.CharModel(dict(toxicity.grams([" ".join(words[:300]), "aabb abba baab"])))
    assert [chars.undoubled(w) for w in words] == [chars.lattice(w, True) for w in words]


def test_trigrams_of_words():
    texts = ["ab, ab abc. 日本 🎉 x1 ß", "ab!", "", "$$ ^^ a$b"]
    want: Counter = Counter()
    for text in texts:
        for token in set(text.lower().split()):
            word = toxicity._EDGE.sub("", token)
            if word.isalpha():
                framed = "^^" + word + "$"
                want.update(framed[i : i + 3] for i in range(len(framed) - 2))
    assert toxicity.grams(texts) == want and toxicity.grams([]) == Counter()
