"""Byte-level BPE with the tokenizers library over Arrow batches, and back.

A rank file (base64 token, rank) becomes a tokenizers model: every byte is written as
the printable character of the byte-level alphabet, a token's merge is the pair that
merging its own bytes by lower ranks leaves, and a piece that is itself a token is taken
whole. Each match of the pattern is encoded separately, no special tokens.

A round trip splits texts by the pattern itself and has the library encode each different match
once: matches are encoded separately, so what a match gives, and what that decodes to, is kept for
its next occurrence (REMEMBERED matches a worker, then it begins anew).

Decoding looks ids up in a table of byte strings (the alphabet reversed). Tokens may cut
a character; bytes are joined before they are read as UTF-8, and ``decode`` carries the
bytes of an unfinished character from one piece to the next.

Long texts are cut where a space or newline follows a character that is none, which no
match of the pattern crosses, so memory is bounded by a piece; a text without such places is
one piece.

Defined cases: null and empty texts have no tokens; repeated rows are encoded alike; an
empty table gives an empty result; other columns are ignored. The model goes to the
executors as a broadcast of fixed size (the vocabulary file's).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from presswork.llm.base import small_batches

#: Characters in a piece of a long text, and bytes of text encoded at once.
PIECE, AT_ONCE = 1 << 16, 1 << 19
#: Matches whose ids a worker keeps, and the longest that is kept.
REMEMBERED, LONGEST = 400_000, 64

_BREAK = re.compile("[^\\s\x1c-\x1f\x85](?=[ \n])")


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    found = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [found[i] for i in range(len(found))]


def alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others
    from U+0100 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that merging the token's bytes by ranks below its own ends in."""
    parts, top = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        least, at = min(((ranks.get(a + b, top), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(top, -1))
        if least >= top:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def splitter(pattern: str) -> Callable[[str], list[str]] | None:
    """The matches of a pattern in a text, if the regex module reads it as the library does: its classes
    are general categories and white space, which is Unicode's here and Python's there."""
    if set(regex.findall(r"\\.|\(\?.", pattern)) <= {r"\p", r"\s", r"\S", "(?!"}:
        return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    return None


def _assigned(text: str) -> bool:
    """Has text only characters of which every version of Unicode in use says the same? Those that
    Python does not know may be letters to one library and not to another."""
    return text.isascii() or all(unicodedata.category(c) != "Cn" for c in set(text))


def model(tokens: list[bytes], pattern: str) -> str:
    """The tokenizers library's JSON for these ranks."""
    ranks, signs = {t: i for i, t in enumerate(tokens)}, alphabet()
    text = lambda b: "".join(signs[x] for x in b)
    merges = [[text(m[0]), text(m[1])] for t in tokens if len(t) > 1 and (m := merge_of(t, ranks))]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "post_processor": None, "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True, "vocab": {text(t): i for i, t in enumerate(tokens)}, "merges": merges},
    })


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """text, cut about every size characters at places that no match crosses."""
    at = 0
    while len(text) - at > size:
        found = _BREAK.search(text, at + size - 1)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def decode(tokens: list[bytes], ids: Iterable[int], rest: bytes = b"") -> tuple[str, bytes]:
    """The text of ids after the bytes in rest, and the bytes of a character that ids
    leave unfinished; bytes that can't be UTF-8 become U+FFFD."""
    data = rest + b"".join([tokens[i] for i in ids])
    cut = len(data)
    for back in range(1, min(3, len(data)) + 1):
        lead = data[-back]
        if lead >= 0xC0:
            if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                cut = len(data) - back
            break
        if lead < 0x80:
            break
    return data[:cut].decode("utf-8", "replace"), data[cut:]


class Coder:
    """A loaded model: ids of texts, and bytes of ids."""

    def __init__(self, tokens: list[bytes], built: str):
        from tokenizers import Tokenizer

        self.tokens = tokens
        *_, split = (x for x in json.loads(built)["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.split = splitter(split["pattern"]["Regex"])
        whole = json.loads(built)
        whole["pre_tokenizer"] = whole["pre_tokenizer"]["pretokenizers"][-1]
        self.matches = Tokenizer.from_str(json.dumps(whole))  # takes a text as one match
        self.matches.encode_special_tokens = True
        self.ids: dict[str, str] = {}
        self.bodies: dict[str, bytes] = {}
        self.coder = Tokenizer.from_str(built)
        self.coder.encode_special_tokens = True
        self.names = [str(i) for i in range(len(tokens))]

    def encode(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(position in texts, ids of a piece), in order; none for empty texts."""
        queue: list[tuple[int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for piece in pieces(text) if text else ():
                queue.append((k, piece))
                size += len(piece)
                if size >= AT_ONCE:
                    yield from self._drain(queue)
                    queue, size = [], 0
        yield from self._drain(queue)

    def written(self, text: str) -> Iterator[tuple[int, str, bytes]]:
        """For each piece of text: how many ids, the ids in decimal joined by commas, and the bytes that
        they decode to."""
        for piece in pieces(text) if text else ():
            found = self.split(piece) if self.split else []
            if sum(map(len, found)) != len(piece):  # not read by this pattern as a whole
                ids = [i for _, some in self.encode([piece]) for i in some]
                yield len(ids), *self._spelt(ids)
                continue
            if len(self.ids) > REMEMBERED:
                self.ids.clear()
                self.bodies.clear()
            every = set(found)
            new = list(every.difference(self.ids))
            if not _assigned("".join(new)):
                ids = [i for _, some in self.encode([piece]) for i in some]
                yield len(ids), *self._spelt(ids)
                continue
            if new:
                for match, one in zip(new, self.matches.encode_batch_fast(new, add_special_tokens=False), strict=True):
                    self.ids[match], self.bodies[match] = self._spelt(one.ids)
            ids, body = ",".join(map(self.ids.__getitem__, found)), b"".join(map(self.bodies.__getitem__, found))
            for match in new:
                if len(match) > LONGEST:
                    del self.ids[match], self.bodies[match]
            yield ids.count(",") + 1, ids, body

    def _spelt(self, ids: list[int]) -> tuple[str, bytes]:
        return ",".join([self.names[i] for i in ids]), b"".join([self.tokens[i] for i in ids])

    def _drain(self, queue: list[tuple[int, str]]) -> Iterator[tuple[int, list[int]]]:
        for (k, _), found in zip(queue, self.coder.encode_batch_fast([x for _, x in queue], add_special_tokens=False) if queue else [], strict=True):
            yield k, found.ids


def _coder(shared) -> Coder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
    tokens, built, digest = shared.value
    cached = globals().get("_loaded")
    if not cached or cached[0] != digest:
        cached = globals()["_loaded"] = (digest, Coder(tokens, built))
    return cached[1]


def shared_model(spark: SparkSession, path: str, pattern: str):
    tokens = read_ranks(path)
    built = model(tokens, pattern)
    return spark.sparkContext.broadcast((tokens, built, hashlib.sha256(built.encode()).hexdigest()))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, starts (the first byte of each token in the text's UTF-8) and
    char_starts (the character that byte belongs to) for each row of docs."""
    shared = shared_model(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        sizes = np.array([len(t) for t in coder.tokens], dtype=np.int64)
        for part, texts in small_batches(batches, limit=AT_ONCE):
            ids: list[list[int]] = [[] for _ in texts]
            for k, some in coder.encode(texts):
                ids[k] += some
            starts, chars = [], []
            for text, one in zip(texts, ids, strict=True):
                at = np.concatenate([[0], np.cumsum(sizes[one])])[:-1] if one else np.zeros(0, np.int64)
                leads = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
                starts.append(at)
                chars.append(np.cumsum(leads)[at] - 1 if one else at)
            yield pa.record_batch([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64())), pa.array(chars, pa.list_(pa.int64()))], names=["doc_id", "ids", "starts", "char_starts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<bigint>, char_starts array<bigint>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the ids of each text and what they
    decode to, as digests taken where they are made."""
    shared = shared_model(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for part, texts in small_batches(batches):
            counts, ids, bodies = [0] * len(texts), [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
            for k, text in enumerate(texts):
                for n, some, body in coder.written(text):
                    ids[k].update(("," * bool(counts[k]) + some).encode())
                    bodies[k].update(body)
                    counts[k] += n
            yield pa.record_batch([part.column(0), pa.array(counts, pa.int64()), pa.array([x.hexdigest() for x in ids]), pa.array([x.hexdigest() for x in bodies])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
