import random
from importlib.metadata import distribution
from pathlib import Path

import pytest

from presswork.llm import licenses


def test_finds(make, odd):
    filler = " ".join(f"filler{i}" for i in range(50))
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    notice = licenses.TEMPLATES["MIT-permission"]
    pairs = odd + [(20, f"{filler} {mit}. {filler}"), (21, mit), (22, f"{filler} {gpl.upper()}"), (23, f"{filler}\n{notice.replace('free of charge', 'free of  charge')}"), (24, "released under the license of mit"), (25, f"{filler} {mit}, {filler} {gpl}"), (26, " ".join(notice.split()[:-1]))]
    rows = {(r["doc_id"], r["license"]): r for r in licenses.scan(make(pairs)).collect()}
    assert set(rows) == {(20, "MIT"), (21, "MIT"), (22, "GPL-3.0"), (23, "MIT-permission"), (25, "MIT"), (25, "GPL-3.0"), (26, "MIT-permission")}
    assert rows[(20, "MIT")]["first_word"] in (49, 50) and rows[(20, "MIT")]["containment"] == 1.0
    assert 0.8 <= rows[(26, "MIT-permission")]["containment"] < 1


def test_other_windows(make):
    filler = " ".join(f"filler{i}" for i in range(30))
    texts = {k: v for k, v in licenses.TEMPLATES.items() if not k.endswith("-text")}
    rows = licenses.scan_notices(make([(i, f"{filler} {t} {filler}") for i, t in enumerate(texts.values())]), {k: licenses._template_words(v) for k, v in texts.items()}, width=3, bands=24).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(texts)))


def edited(text, share, seed):
    """text with that share of its words replaced, in bursts of four."""
    rng, w = random.Random(seed), text.split()
    for i in rng.sample(range(0, len(w) - 4, 4), int(share * len(w) / 4)):
        w[i : i + 4] = [f"e{rng.randrange(10**6)}" for _ in range(4)]
    return " ".join(w)


def shares(templates, text):
    """Exact containment of each template of LONG shingles or more in text, and where the
    first shingle stands."""
    cut = lambda t: [tuple(w[i : i + 5]) for w in [licenses._template_words(t)] for i in range(len(w) - 4)]
    held = cut(text)
    out = {}
    for name, t in templates.items():
        own = set(cut(t))
        if len(cut(t)) >= licenses.LONG and len(own & set(held)) >= 0.8 * len(own):
            out[name] = (round(len(own & set(held)) / len(own), 6), next(i for i, s in enumerate(held) if s in own))
    return out


def apache():
    for file in distribution("pyarrow").files or []:
        if file.name == "LICENSE.txt":
            text = Path(file.locate()).read_text(errors="replace")
            return text[text.index("TERMS AND CONDITIONS FOR USE") : text.index("END OF TERMS AND CONDITIONS")]
    return None


def test_full_texts_with_edits(make):
    templates = dict(licenses.TEMPLATES)
    if full := apache():
        templates["Apache-2.0-text"] = full
    filler = " ".join(f"filler{i}" for i in range(700))
    pairs = []
    for k, name in enumerate(t for t in templates if t.endswith("-text")):
        for j, share in enumerate((0, 0.02, 0.05, 0.08, 0.2)):
            pairs.append((100 * k + j, f"{filler} {edited(templates[name], share, j)} {filler}" if j % 2 else edited(templates[name], share, j)))
    want = {(i, name): x for i, t in pairs for name, x in shares(templates, t).items()}
    got = {(r["doc_id"], r["license"]): (r["containment"], r["first_word"]) for r in licenses.scan(make(pairs), templates).collect() if r["license"].endswith("-text")}
    assert got == want and len(want) >= 12


def test_collision_probability():
    """Windows that share two thirds with a template's are found as surely as stated."""
    windows = (licenses.LONG - licenses.TEXT_WIDTH) // licenses.TEXT_STRIDE + 1
    one = 1 - (1 - (2 / 3) ** licenses.TEXT_ROWS) ** licenses.TEXT_BANDS
    assert one > 0.9 and 1 - (1 - one) ** windows > 0.99
    assert 1 - (1 - 1 / licenses.WIDTH) ** licenses.BANDS > 0.999


def test_many_templates_take_more_passes(make):
    rng = random.Random(1)
    texts = {f"T{i}": " ".join(f"w{rng.randrange(5000)}" for _ in range(1500)) for i in range(20)}  # 30,000 words
    texts |= {f"N{i}": " ".join(f"n{rng.randrange(5000)}" for _ in range(12)) for i in range(20)}
    docs = make([(i, f"some words {texts[k]} and more words") for i, k in enumerate(texts)])
    old = dict(licenses.PER_PASS)
    licenses.PER_PASS.update(notices=50, texts=20_000)
    try:
        got = {(r["doc_id"], r["license"]) for r in licenses.scan(docs, texts).collect()}
    finally:
        licenses.PER_PASS.update(old)
    assert got == set(enumerate(texts))


def test_odd_templates(make):
    assert licenses.scan(make([(1, "a b c d e f")]), {}).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(make([(1, "a b c d e f")]), {"short": "one two"})


def test_empty(make):
    assert licenses.scan(make([])).count() == 0


def test_a_template_that_repeats_a_passage(make):
    passage = " ".join(f"clause{i}" for i in range(60))
    templates = {"twice": f"{passage} {passage}", "word": "again " * 70}
    rows = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(make([(1, passage), (2, f"x y z {passage} {passage}"), (3, "again again again again again"), (4, "too short")]), templates).collect()}
    assert rows[(2, "twice")] == 1.0 and rows[(3, "word")] == 1.0
    assert rows[(1, "twice")] == round(56 / 60, 6)
