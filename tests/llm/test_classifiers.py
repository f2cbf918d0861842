import zlib

import numpy as np
import pytest

from presswork.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def good(i):
    return " ".join(f"the {w} of story{i * k % 97} was told" for k, w in enumerate("river mountain village market teacher harvest".split()))


def pairs():
    out = []
    for i in range(300):
        text, q, t = good(i), 1, 0
        if i % 4 == 1:
            text, q = " ".join(w.upper() + "%%%" for w in good(i).split()), 0
        if i % 5 == 2:
            text, t = text + " idiot moron", 1
        out.append((i, text, q, t))
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, q, t) for i, _, q, t in pairs()] + [(999, None, None), (None, 1, 1), (0, 1, 0)]
    return spark.createDataFrame(rows, LABELS)


def test_quality(make, odd, labelled):
    docs = make([(i, t) for i, t, _, _ in pairs()] + [(None if i is None else i + 1000, t) for i, t in odd])
    model = quality.train(docs, labelled)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 300 + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    truth = {i: q for i, _, q, _ in pairs()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_vote_is_exact(make):
    rng = np.random.default_rng(0)
    rows, labels = rng.random((80, quality.DIMS + quality.SHAPES), dtype=np.float32), rng.integers(0, 2, 80).astype(np.float32)
    model = quality.fit(rows, labels)
    some = rng.random((30, rows.shape[1]), dtype=np.float32)
    for got, x in zip(quality.vote(model, some, block=7), some, strict=True):
        z = x @ model["basis"]
        c = model["known"] @ (z / np.linalg.norm(z))
        near = np.argsort(-c)[: quality.NEIGHBOURS]
        w = np.maximum(c[near], 0).astype(float) ** quality.POWER
        assert abs(got - (w * labels[near]).sum() / w.sum()) < 1e-4


def test_toxicity(make, odd, labelled):
    docs = make([(i, t) for i, t, _, _ in pairs()] + [(None if i is None else i + 1000, t) for i, t in odd] + [(5000, good(1) + " 1d10t m0r0n"), (5001, good(2) + " i.d.i.o.t m o r o n"), (5002, good(3) + " idiiiiot moooron")])
    rows = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.train(docs, labelled)).collect()}
    truth = {i: t for i, _, _, t in pairs()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    assert np.mean([rows[i]["predicted"] == t for i, t in truth.items() if rows[i]["held_out"]]) > 0.97
    assert all(rows[i]["predicted"] for i in (5000, 5001, 5002))


def test_decoding_finds_the_best_path():
    model = toxicity.CharModel(dict(toxicity.grams(["idiot moron stupid clown loser trash story market"] * 3)))
    for rough, word in {"1d10t": "idiot", "m0r0n": "moron", "stuuupid": "stupid", "c-l-o-w-n": "clown", "l0$er": "loser", "tra5h": "trash", "story": "story", "market!!": "market"}.items():
        assert toxicity.restore(rough, model) == word

    def every(token):
        """All readings with their log probability."""
        from itertools import groupby

        found = [("", 0.0)]
        for sign, run in ((k, len(list(g))) for k, g in groupby(token)):
            options = []
            for letter, price in [(x, 0.0) for x in sign if x.isalpha()] + [(x, toxicity.SWAP) for x in toxicity.LEET.get(sign, "")]:
                options.append((letter, price + (toxicity.REPEAT if run > 1 else 0)))
                if run > 1:
                    options.append((letter * 2, 2 * price + (toxicity.REPEAT if run > 2 else 0)))
            if sign in toxicity.BETWEEN or not options:
                options.append(("", toxicity.SKIP))
            found = [(a + b, p + q) for a, p in found for b, q in options]
        total = lambda w: sum(model.logp(*("^^" + w + "$")[i : i + 3]) for i in range(len(w) + 1))
        return max(p + total(w) for w, p in found), found, total

    for rough in ("1d10t", "st*pid", "m00r0n", "l0$e-r", "tra5hh"):
        best, found, total = every(rough)
        read = model.decode(rough)
        assert max(p + total(w) for w, p in found if w == read) == pytest.approx(best)


def test_every_obfuscated_token_is_decoded():
    model = toxicity.CharModel(dict(toxicity.grams(["idiot moron stupid slut asshole ass hole story market"] * 30)))
    for rough, word in {"@$$hole": "asshole", "a$$": "ass", "@$$": "ass", "4$$": "ass", "$lut$": "slut", "$+upid": "stupid", "iddiott": "idiot", "stuupid": "stupid"}.items():
        assert word in toxicity.readings(rough, model), rough
        assert toxicity.Scorer({"grams": model.three, "ratio": {word + "$": 2.0}}).word(rough) == 2.0
    assert "stupid" in toxicity.readings("stupi" + "d" * 100, model) and "idiot" in toxicity.readings("i" * 100 + "d1ot", model)
    assert toxicity.restore("2024", model) == "2024" and toxicity.restore("$100", model) == "100"
    assert toxicity.restore("market!!", model) == "market" and "ass" in toxicity.readings("ass", model)
    assert len(toxicity.restore("a1b2" * 5000, model)) == 20_000


def test_spaces_are_part_of_the_lattice():
    model = toxicity.CharModel(dict(toxicity.grams(["you are a stupid idiot moron market story"] * 100)))
    scorer = toxicity.Scorer({"grams": model.three, "ratio": {"stupid$": 2.0, "idiot$": 3.0}})
    for rough, want in {"y o u a r e s t u p i d": 2, "a i d i o t": 3, "s t u p ! d": 2, "$ t u p 1 d": 2, "s\tt\nu\tp\ni\td": 2, "stu pid": 2, "st u p 1d market": 2, "s t u p i d i d i o t": 5, "you id market": 0, "s - t - u - p - i - d": 2}.items():
        assert scorer.evidence(rough)[0] == want, (rough, model.spaced(rough.split()))
    assert model.spaced("y o u a r e s t u p i d".split())[-1] == "stupid"


def test_nothing_to_learn(make, spark):
    none = spark.createDataFrame([], LABELS)
    docs = make([(1, "a b"), (2, None)])
    assert [r["score"] for r in quality.score(docs, quality.train(docs, none)).collect()] == [0.5, 0.5]
    assert [r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()] == [0.0, 0.0]
    assert quality.score(make([]), quality.train(make([]), none)).count() == 0


def planted(n=240):
    """Toxic texts teach plain words; those that are held out hold the words obfuscated."""
    rough = ["1d10t", "i d i o t", "i.d.i.0.t", "iidiiott", "id iot", "$tupid", "s t u p ! d", "stu p1d", "stuuupid", "m0r0n", "m o r o n", "mo ron"]
    rows, labels = [], []
    for i in range(n):
        held = zlib.crc32(str(i).encode()) % 3 == 1
        toxic = i % 2
        word = rough[i // 2 % len(rough)] if held else ["idiot", "stupid", "moron"][i // 2 % 3]
        rows.append((i, good(i) + (f" you {word} there" if toxic else f" you {2000 + i} there $15 or 3d")))
        labels.append((i, 1, toxic))
    return rows, labels


def test_decoding_is_what_finds_obfuscated_words(make, spark, monkeypatch):
    rows, labels = planted()
    docs, known = make(rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.train(docs, known)
    toxic = {i for i, _, t in labels if t}
    held = [r for r in toxicity.score(docs, model).collect() if r["held_out"]]
    assert np.mean([r["predicted"] for r in held if r["doc_id"] in toxic]) > 0.95
    assert not any(r["predicted"] for r in held if r["doc_id"] not in toxic)
    scorer = toxicity.Scorer(model)
    texts = dict(rows)
    monkeypatch.setattr(toxicity, "readings", lambda token, model: {token})
    monkeypatch.setattr(toxicity.CharModel, "spaced", lambda self, signs, spelled=True: signs)
    plain = [scorer.score([texts[r["doc_id"]]])[0] >= 0.7 for r in held if r["doc_id"] in toxic]
    assert np.mean(plain) < 0.1  # without the lattice they are missed


def test_scores_equal_brute_force(make, spark):
    """Every token decoded, every run of neighbouring tokens tried, evidence and logistic
    function computed anew."""
    rows, labels = planted(60)
    docs = make(rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    chars, ratio = toxicity.CharModel(model["grams"]), model["ratio"]
    bare = lambda t: toxicity._EDGE.sub("", t) or t

    def best(word):
        return max((ratio[p] for p in toxicity.parts(word) if p in ratio), default=0.0)

    def evidence(text):
        every = text.lower().split()
        found = [max((best(w) for w in toxicity.readings(t, chars)), default=0.0) for t in set(every)]
        more = {w for run in toxicity.spelled(every, {t for t in every if toxicity.one_sign(t)}) for w in chars.spaced(run)}
        for i in range(len(every)):
            for j in range(i + 2, min(len(every), i + 9) + 1):
                if toxicity.form(bare(every[i])) and toxicity.form(bare(every[j - 1])):
                    run = [bare(t) for t in every[i:j]]
                    whole = "".join(chars.spaced(run, False))
                    if whole + "$" in ratio and " ".join(chars.spaced(run, False)) == whole:
                        more.add(whole)
        found += [best(w) for w in more - set(every)]
        found = sorted((x for x in found if x), reverse=True)
        return [sum(found[:5]), (found + [0])[0], (found + [0, 0])[1], np.log1p(len(set(every)))]

    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for i, text in rows:
        x = np.array([1.0, *evidence(text)])
        assert got[i] == pytest.approx(1 / (1 + np.exp(-x @ model["weights"])), abs=1e-9), text


def test_pruning_changes_no_token(spark, small):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(60).collect()]
    model = toxicity.CharModel(dict(toxicity.grams(texts + ["idiot moron stupid asshole"] * 30)))
    scorer = toxicity.Scorer({"grams": model.three, "ratio": {"idiot$": 3.0, "idio": 2.0, "moron$": 2.5, "asshole$": 2.0, "assh": 1.5, "the$": 1.2, "1488$": 2.0, "licen": 1.5}})
    rough = "1d10t id*ot *diot idio* $!diot!$ @$$h0le a$$hole m.o.r.o.n moooron 1488 $1488 t#h#e th3 1icense |icen$e i*d idiots!! ***idiot***".split()
    for token in {t for text in texts for t in text.lower().split()} | set(rough):
        want = max((scorer.ratio[p] for w in toxicity.readings(token, model) for p in toxicity.parts(w) if p in scorer.ratio), default=0.0)
        assert scorer.word(token) == want, token


def test_no_length_is_too_long():
    word = "pneumono" * 6  # 48 letters
    model = toxicity.CharModel(dict(toxicity.grams([f"{word} idiot"] * 30)))
    assert model.three["pne"] == 180 and model.three[word[-2:] + "$"] == 30
    assert toxicity.restore("1d10t" * 40, model) == "idiot" * 40
    scorer = toxicity.Scorer({"grams": model.three, "ratio": {word + "$": 2.0}})
    assert scorer.word(word.replace("o", "0")) == 2.0 and scorer.evidence(" ".join(word))[0] == 2.0


def test_toxicity_of_odd_tables(make, spark):
    rows, labels = planted(60)
    known = spark.createDataFrame(labels, LABELS)
    assert toxicity.score(make([]), toxicity.train(make([]), known)).count() == 0
    twice = make(rows + [(i, "zzz " + t) for i, t in rows])
    one, other = toxicity.train(twice, known), toxicity.train(twice.repartition(7, "text"), known)
    assert one["ratio"] == other["ratio"] and np.allclose(one["weights"], other["weights"])


def test_quality_equals_brute_force(make, spark):
    """Terms, decomposition and votes computed anew, term by term."""
    rng = np.random.default_rng(8)
    marks = ["", "", "", ",", ".", "!!", "%%", "$4", "?"]
    rows, label = [], {}
    for i in range(260):
        words = ["".join(rng.choice(list("abcdeilnorst"), rng.integers(2, 9))) + marks[rng.integers(len(marks))] for _ in range(rng.integers(30, 200))]
        label[i] = int(rng.random() < 0.6)
        rows.append((i, " ".join(w.upper() if not label[i] and rng.random() < 0.3 else w for w in words)))
    docs = make(rows)
    got = {(r["doc_id"], r["score"]) for r in quality.score(docs, quality.train(docs, spark.createDataFrame([(i, q, 0) for i, q in label.items()], LABELS))).collect()}

    def row(text):
        data, a, b = text.encode(), np.zeros(quality.DIMS), np.zeros(quality.SHAPES)
        for i in range(max(1, len(data) - 2)):
            x, y, z = (data + b"\0\0")[i : i + 3]
            a[((x * 0x9E3779B1 + y * 0x85EBCA77 + z * 0xC2B2AE3D) % 2**32) >> 22] += 1
        words, lines = text.split(), [x for x in text.split("\n") if x]
        found = [quality.shape(w) for w in words] + [quality.shape(v) + " " + quality.shape(w) for v, w in zip(words, words[1:])]
        found += ["same token "] * sum(v == w for v, w in zip(words, words[1:])) + ["same line "] * (len(lines) - len(set(lines)))
        for x in found:
            b[zlib.crc32(x.encode()) % quality.SHAPES] += 1
        a, b = np.log1p(a), np.log1p(b)
        return np.concatenate([a / np.linalg.norm(a) * quality.TRIGRAMS, b / np.linalg.norm(b)])

    learnt = [(t, label[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    data, y = np.stack([row(t) for t, _ in learnt]), np.array([q for _, q in learnt])
    idf = np.log((1 + len(data)) / (1 + (data > 0).sum(axis=0))) + 0.1
    basis = np.linalg.svd(data * idf)[2][: quality.LATENT].T
    known = (data * idf) @ basis
    known /= np.linalg.norm(known, axis=1, keepdims=True)
    off = 0
    for i, t in rows:
        z = (row(t) * idf) @ basis
        c = known @ z / np.linalg.norm(z)
        near = np.argsort(-c)[: quality.NEIGHBOURS]
        w = np.maximum(c[near], 0) ** quality.POWER
        want = (w * y[near]).sum() / w.sum()
        off += min(abs(s - want) for j, s in got if j == i) > 0.02
    assert off <= 0.02 * len(rows)  # neighbours that tie but for rounding


def test_words_of_many_doubled_letters(monkeypatch):
    import time

    from presswork.llm import toxicity

    words = ["bookkeeper", "aabbccddeeffgghhiijjkkllmmnnooppqqrr", "ballooned", "mississippi", "aardvark", "glass"]
    model = {"grams": toxicity.grams([" ".join(words)]), "ratio": {w + "$": 3.0 for w in words}}
    began = time.time()
    few = toxicity.Scorer(model)
    assert time.time() - began < 2
    assert few.long
    monkeypatch.setattr(toxicity, "DOUBLED", 0)
    none = toxicity.Scorer(model)
    assert len(none.long) > len(few.long)
    short = {k: v for k, v in model["ratio"].items() if len(k) < 20}
    for spelled in ("book keeper", "bo okke eper", "b o o k keeper", "bal looned", "ballo oned", "mis sis sippi", "miss iss ippi", "aa rdvark", "a ardvark", "glas s", "gla ss", "glass", "bokeeper", "book ke e per", "gl as sx"):
        tokens = spelled.split()
        forms = [toxicity.form(t) for t in tokens]
        monkeypatch.setattr(toxicity, "DOUBLED", 99)
        every = toxicity.Scorer(model | {"ratio": short})
        stream = "".join(forms)
        assert sorted(set(every.spelled_out(stream))) == sorted({x for x in none.spelled_out(stream) if x[1] > 1})
        assert every.fragments(tokens, forms) == none.fragments(tokens, forms) == few.fragments(tokens, forms)
