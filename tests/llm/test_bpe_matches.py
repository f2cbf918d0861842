import base64

import pytest

from presswork.llm import bpe

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    tokens = bpe.read_ranks(PATH)
    return bpe.Coder(tokens, bpe.model(tokens, public.PATTERN))


def test_matches_are_the_librarys_at_every_character():
    """Each character between a letter and a digit, after a space and after another sign."""
    from tokenizers import Regex, pre_tokenizers

    library, split = pre_tokenizers.Split(Regex(public.PATTERN), "isolated"), bpe.splitter(public.PATTERN)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and bpe._assigned(chr(c))]
    for at in range(0, len(every), 1 << 15):
        text = "".join(f"a{c}1 {c}'{c}" for c in every[at : at + (1 << 15)])
        assert split(text) == [x for x, _ in library.pre_tokenize_str(text)]


def test_characters_that_are_not_assigned_are_left_to_the_library(coder):
    new = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not bpe._assigned(chr(c))]
    for at in range(0, len(new), 1 << 15):
        text = "".join(f"a{c}1 {c}'{c}" for c in new[at : at + (1 << 15)])
        ids = [i for _, some in coder.encode([text]) for i in some]
        assert ",".join(x for _, x, _ in coder.written(text)) == ",".join(map(str, ids))


def test_patterns_that_may_differ_are_left_to_the_library():
    assert bpe.splitter(r"\w+|\s+") is None and bpe.splitter(r"(?i:'s)|\p{L}+") is None and bpe.splitter(public.PATTERN)


def test_a_match_is_encoded_once(coder, monkeypatch):
    """Ids, their number and bytes as tiktoken's, with few matches kept; the library sees a match once."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["don't  I'LL\x85 x\x1c\x1d y\n\n z", "zebra " * 40_000, "x" * 70_000 + " y", "", "日本語 🎉👩‍👧 ½²Ⅷ <|endoftext|>", "ünï\u00a0cödé\u2003 a\u200bb"] * 2
    seen = []
    encode = coder.matches.encode_batch_fast

    class Spy:
        def encode_batch_fast(self, some, **more):
            seen.extend(some)
            return encode(some, **more)

    monkeypatch.setattr(coder, "matches", Spy())
    for kept in (400_000, 5):
        monkeypatch.setattr(bpe, "REMEMBERED", kept)
        for text in texts:
            ids = reference.encode_ordinary(text)
            found = list(coder.written(text))
            assert (sum(n for n, _, _ in found), ",".join(x for _, x, _ in found), b"".join(x for _, _, x in found)) == (len(ids), ",".join(map(str, ids)), text.encode())
        if kept > 5:
            assert all(seen.count(x) == 1 for x in seen if len(x) <= bpe.LONGEST)
