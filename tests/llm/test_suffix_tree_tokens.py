from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from presswork.llm import suffix_tree

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Each ASCII character alone, between, before and behind letters; blanks of other scripts, which divide nothing.
TEXTS = [None, "", " ", "\t\n\v\f\r ", *(t for c in map(chr, range(128)) for t in (c, f"Ab{c}Cd", f"{c}x{c}{c}Y{c}")), "a\x85b\xa0c d　e", "ÄÖ İ ß 日本 🎉", "A" * 70 + " b\n"]


def plain(text):
    return [*(text or "").encode().translate(LOWER).split(), b""]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_tokens_of_whole_batches(kind):
    split = suffix_tree.tokens(pa.array(["cut off", *TEXTS], kind)[1:])
    assert [[w.encode() for w in words] for words in split.to_pylist()] == [plain(t) for t in TEXTS]


def test_each_different_word_of_a_batch_is_hashed_once(monkeypatch):
    digest, seen = suffix_tree.xxhash.xxh64_intdigest, []
    monkeypatch.setattr(suffix_tree.xxhash, "xxh64_intdigest", lambda word, seed: seen.append(word) or digest(word, seed))
    texts = [*TEXTS, "x " * 100 + "w" * 100, "y " + "w" * 100]
    every = [w for t in texts for w in plain(t)]
    known = np.sort(np.array([digest(w, 42) for w in {b"", b"x", b"y"}], np.uint64).view(np.int64))
    ids, first, sizes, words, hashes, which = suffix_tree.token_ids({"keys": known}, pa.array(texts))
    assert sorted(seen) == sorted(set(every))
    assert [words[i] for i in which] == every and sizes.tolist() == [len(plain(t)) for t in texts]
    assert hashes.view(np.uint64).tolist() == [digest(w, 42) for w in words]
    assert [i >= 0 for i in ids] == [w in (b"", b"x", b"y") for w in every] and all(known[i] == hashes[j] for i, j in zip(ids, which) if i >= 0)
    assert np.flatnonzero(first).tolist() == [0, *np.cumsum(sizes)[:-1].tolist()]


@pytest.mark.parametrize("tallied", [8, 1 << 21])
def test_keys_without_counts_are_sorted_as_numbers(monkeypatch, tallied):
    monkeypatch.setattr(suffix_tree, "TALLIED", tallied)
    rng = np.random.default_rng(3)
    keys = [rng.integers(0, 1 << 52, n) // (1 << 44) for n in (0, 5, 40, 1, 300)]
    alone = []
    monkeypatch.setattr(suffix_tree.np, "argsort", lambda x, kind=None, order=np.argsort: alone.append(kind) or order(x, kind=kind))
    tally = suffix_tree.Tally()
    found = [b for k in keys for b in tally.add(k)] + list(tally.out())
    got = Counter()
    for b in found:
        edges = b.column(0).to_pylist()
        assert edges == sorted(set(edges))
        got.update(dict(zip(edges, b.column(1).to_pylist())))
    assert got == Counter(np.concatenate(keys).tolist())
    assert set(alone) <= {"stable"} and (tallied == 8 or not alone)


def test_places_by_rank():
    rng = np.random.default_rng(4)
    before, word = rng.integers(0, 50, 400), rng.integers(0, 9, 400)
    keys = np.unique((before << 32 | word)[:200])
    place = {k: i for i, k in enumerate(keys.tolist())}
    want = [place.get(k, -1) for k in (before << 32 | word).tolist()]
    for rank in (None, before * 9 + word, (before * 9 + word) << 53):
        assert suffix_tree._places(keys, before << 32 | word, rank).tolist() == want
