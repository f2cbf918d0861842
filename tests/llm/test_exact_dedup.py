import hashlib
import re

import pytest

from presswork.llm import exact_dedup


def brute(pairs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs]
    out = []
    for (i, _), n in zip(pairs, norm, strict=True):
        ids = [j for (j, _), m in zip(pairs, norm, strict=True) if m == n]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [128, 8, 4])
def test_groups(make, odd, bits):
    pairs = odd + [(100 + i, f"text {i % 9}") for i in range(40)]
    found = exact_dedup.groups(make(pairs), bits).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == sorted(brute(pairs), key=repr)
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in found})
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


@pytest.mark.parametrize("bits", [128, 4])
def test_keep_one(make, odd, bits):
    pairs = odd + [(100 + i, f"text {i % 9}") for i in range(40)]
    docs = make(pairs)
    kept = exact_dedup.keep_one(docs, bits)
    assert kept.columns == docs.columns
    want = {(r["keep_id"], r["text_sha256"]) for r in exact_dedup.groups(docs).collect()}
    got = [(r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest()) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_rows_that_repeat_often(make, monkeypatch):
    from presswork.llm import base

    monkeypatch.setattr(base, "COPIES", 4)
    pairs = [(None, "same")] * 23 + [(7, "same")] * 9 + [(3, "one"), (None, "alone")] + [(None, "null")] * 6
    found = exact_dedup.groups(make(pairs)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == sorted(brute(pairs), key=repr)
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert len(kept) == len(set(kept)) == 4


def test_empty(make):
    assert exact_dedup.groups(make([])).count() == 0
    assert exact_dedup.keep_one(make([])).count() == 0
