import base64
import hashlib

import pytest

from presswork.llm import bpe

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["  \n\n a  b'll   x\x85y\x1c\x1d z \t\t\r\n", "<|endoftext|> 日本語 🎉🎉👩‍👩‍👧 ½ ² Ⅷ", "a" * 300_000, " " * 1000 + "x", "don't I'LL 's's", ("word " * 50 + "\n") * 3000]


def test_round_trip(make, odd, reference):
    pairs = odd + [(200 + i, t) for i, t in enumerate(ODD)]
    rows = bpe.round_trip(make(pairs), PATH, public.PATTERN).collect()

    def want(i, t):
        ids = reference.encode_ordinary(t or "")
        return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())

    assert sorted(map(tuple, rows), key=repr) == sorted((want(*x) for x in pairs), key=repr)


def test_offsets(make, reference):
    text = "héllo wörld 🎉🎉 日本"
    row = bpe.encode(make([(1, text), (2, None)]), PATH, public.PATTERN).orderBy("doc_id").collect()
    assert row[0]["ids"] == reference.encode_ordinary(text) and row[1]["ids"] == []
    tokens = bpe.read_ranks(PATH)
    data, at = text.encode(), 0
    for i, start, char in zip(row[0]["ids"], row[0]["starts"], row[0]["char_starts"], strict=True):
        assert start == at and len(data[: at + 1].decode("utf-8", "ignore")) in (char, char + 1)
        at += len(tokens[i])


def test_decode_split_characters(reference):
    tokens = bpe.read_ranks(PATH)
    text = "🎉 naïve 日本語 👩‍👧"
    ids = reference.encode_ordinary(text)
    out, rest = "", b""
    for i in ids:
        some, rest = bpe.decode(tokens, [i], rest)
        out += some
    assert out == text and rest == b""
    assert bpe.decode(tokens, [tokens.index(b"\xf0")]) == ("", b"\xf0")


def test_pieces_keep_text():
    text = "ab  cd\n" * 5000 + "x" * 9000
    parts = list(bpe.pieces(text, 100))
    assert "".join(parts) == text and len(parts) > 50


def test_empty(make):
    assert bpe.round_trip(make([]), PATH, public.PATTERN).count() == 0
