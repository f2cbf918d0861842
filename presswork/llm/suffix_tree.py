"""Language-model scores from a probabilistic suffix tree.

Tokens are words between runs of [\\x20\\x09-\\x0D] (A-Z lower-cased) and one end for each
text. They are the tree's symbols, and a context is the start of a text or a word, and the
token after it, CONTEXTS symbols at most. A token's own distribution is that of the empty context:
ROOT parts of its share of all training tokens, and the rest that of its spelling, which
a second tree of the same kind gives: its symbols are a word's bytes and a newline, its
contexts the 1 to DEPTH bytes before the next one (newlines before the first).

Training counts every context with its next symbol over all texts that are not held out.
A context is a state if it occurs twice as often as `least` asks for, and its next-symbol
distribution diverges from its longest shorter state's by DIVERGENCE nats or more. A
state's distribution gives each next symbol seen `least` times its count less
DISCOUNT, over the state's count and PRIOR, and spreads what is left as the shorter state
does, down to the empty context. A symbol is scored by the longest suffix of what precedes it
that is a state. All are distributions over tokens.

`least` is KEEP times the symbols of the corpus to the power 2/3, and 2 at least: states are
at most the cube root of the symbols over KEEP for each depth, so that they grow with the corpus
but stay small enough for the driver and a broadcast (at 100 TB, 5 * 10**8 were every
one of them as rare as that allows). No context is counted but those that the depth before
has shown to be frequent enough, which leaves out nothing that could become a state.

Words that occur `least` times are broadcast with their counts. The other tokens' hashes leave
the scoring pass beside the score of their spelling and are joined with the table of all
words' counts, which has no bound and grows with the corpus.

Defined cases: null and empty texts are one end; repeated rows are scored (and counted)
each; null ids count as the empty text for the held-out rule; without training texts all
single bytes are equally likely; an empty table gives an empty result; other columns
are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.base import parts, remainder
from presswork.plans.lineage import cut

DEPTH, DIVERGENCE, DISCOUNT, PRIOR = 6, 0.001, 1.0, 10.0
#: Words of a context, and what is taken off counts of words and added to their contexts'.
CONTEXTS, WORD_DISCOUNT, WORD_PRIOR = 2, 0.75, 4.0
#: See `least`.
KEEP = 5e-5
#: The part of word frequencies in a token's own probability.
ROOT = 0.3
#: Bytes handled at once, and keys that a partition's counts hold before they are merged.
AT_ONCE, TALLIED = 1 << 20, 1 << 21
#: Bytes of text whose tokens are looked up at once, and bytes of tokens that are counted at once.
TEXT, READ = 4 << 20, 24 << 20


class _Hashes(dict):
    """Spark's xxhash64 of words."""

    def __missing__(self, word: bytes) -> int:
        return int(self.of([word])[0])

    @staticmethod
    def of(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))


_hashes = _Hashes()


def tokens(texts: pa.Array) -> pa.ListArray:
    """The tokens of each text, the end as the empty word."""
    none, blank = pa.scalar("", texts.type), pa.scalar(" ", texts.type)
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, none)))
    # the end is what follows the last blank, or an empty text itself
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(texts, none, blank)))


def _bytes(words: pa.Array) -> list[bytes]:
    return words.cast(pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()).to_numpy(zero_copy_only=False).tolist()


def least(symbols: float) -> float:
    """How often a symbol must follow a context in a corpus of so many."""
    return max(2.0, math.ceil(KEEP * symbols ** (2 / 3)))


def grams(stream: bytes, at: int = 0, n: int | None = None) -> np.ndarray:
    """Each symbol from `at` on and the DEPTH before it, nearest first, as the bytes of a
    number: the key of a shorter context is the number shifted right, which keeps the order."""
    total = len(stream) - DEPTH
    n = total - at if n is None else min(n, total - at)
    data = np.frombuffer(stream, np.uint8)[at : at + n + DEPTH].astype(np.int64)
    out = np.zeros(n, np.int64)
    for j in range(DEPTH, -1, -1):
        out = (out << 8) | data[j : j + n]
    return out


def _mask(symbols_: int) -> int:
    return (1 << (8 * symbols_)) - 1


class Tally:
    """Counts of keys within a partition: sorted runs that are merged when they hold
    TALLIED keys, and handed on when merging no longer helps. Keys come all with counts or all without."""

    def __init__(self):
        self.raw, self.waiting, self.runs, self.held = [], 0, [], 0

    def add(self, keys: np.ndarray, n: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self.raw.append((keys, n))
        self.waiting += len(keys)
        if self.waiting >= (2 * TALLIED if n is None else AT_ONCE):
            self._sort()
            if self.held >= TALLIED:
                self._merge()
                if self.held >= TALLIED // 2:
                    yield from self.out()

    def _sort(self) -> None:
        if self.waiting:
            self.runs.append(self._counted([keys for keys, _ in self.raw]) if self.raw[0][1] is None else self._summed(self.raw))
            self.raw, self.waiting, self.held = [], 0, self.held + len(self.runs[-1][0])

    def _merge(self) -> None:
        if len(self.runs) > 1:
            self.runs = [self._summed(self.runs, "stable")]  # which merges what is in order
            self.held = len(self.runs[0][0])

    @staticmethod
    def _counted(raw: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        # numbers are sorted much quicker than their places
        keys = np.sort(np.concatenate(raw))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.diff(first, append=len(keys))

    @staticmethod
    def _summed(runs: list[tuple[np.ndarray, np.ndarray]], kind: str = "quicksort") -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
        order = np.argsort(keys, kind=kind)  # sums of equal keys need no order
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(n, first)

    def out(self) -> Iterator[pa.RecordBatch]:
        self._sort()
        if not self.held:
            return
        self._merge()
        (keys, n), self.runs, self.held = self.runs[0], [], 0
        for at in range(0, len(keys), 1 << 18):
            yield pa.record_batch([pa.array(keys[at : at + (1 << 18)]), pa.array(n[at : at + (1 << 18)])], names=["edge", "n"])


def _summed(tallied: DataFrame) -> DataFrame:
    # tallies have merged what a task holds: dealt out first, keys are not hashed again before they move
    return tallied.repartition("edge").groupBy("edge").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, word, n): the tokens of docs(text), the end as the empty word."""

    def out(held: list[pa.Array]) -> pa.RecordBatch:
        found = pc.value_counts(pa.chunked_array(held))
        return pa.record_batch([found.field("values").cast(pa.binary()), found.field("counts")], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts(batches, limit=TEXT):
            held.append(tokens(part.column(0)).flatten())
            size += held[-1].nbytes
            if size >= READ:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    keyed = docs.select("text").mapInArrow(run, "word binary, n long").select(F.xxhash64("word").alias("key"), "word", "n")
    return keyed.repartition("key").groupBy("key", "word").agg(F.sum("n").alias("n"))


def _spelt(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all symbols of words, one after the other, and how many each word has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    pad = b"\n" * DEPTH
    keys = grams(pad + (b"\n" + pad).join(words) + b"\n")
    return keys[np.arange(lengths.sum()) + np.repeat(DEPTH * np.arange(len(words)), lengths)], lengths


def _few(words: list[bytes]) -> Iterator[slice]:
    """Parts of about AT_ONCE bytes."""
    at, size = 0, 0
    for i, w in enumerate(words):
        size += len(w) + DEPTH + 1
        if size >= AT_ONCE:
            yield slice(at, i + 1)
            at, size = i + 1, 0
    if at < len(words):
        yield slice(at, len(words))


def spelling(tree: dict, words: list[bytes]) -> np.ndarray:
    """The log10 probability of each word's bytes."""
    found = [np.zeros(0)]
    for part in _few(words):
        keys, lengths = _spelt(words[part])
        found.append(np.add.reduceat(np.log10(probabilities(tree, keys)), np.concatenate([[0], np.cumsum(lengths)[:-1]])))
    return np.concatenate(found)


def byte_counts(words: DataFrame) -> DataFrame:
    """(edge, n): bytes with those before them, over words(word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            every, n = _bytes(batch.column(0)), batch.column(1).to_numpy()
            for part in _few(every):
                keys, lengths = _spelt(every[part])
                yield from tally.add(keys, np.repeat(n[part], lengths))
        yield from tally.out()

    return _summed(words.select("word", "n").mapInArrow(run, "edge long, n long"))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.searchsorted(keys, wanted)
    at[at >= len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], default)


def probabilities(model: dict, found: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The probability of each key's symbol after its longest state; keys of that depth."""
    edge, back = np.unique(found, return_inverse=True)
    return _in_order(model, edge, depth)[back]


def _in_order(model: dict, edge: np.ndarray, depth: int) -> np.ndarray:
    """The same for sorted keys: those of each shorter depth are sorted too."""
    if not depth or not len(edge):
        return model["single"][edge]
    short = edge >> 8
    first = np.concatenate([[True], short[1:] != short[:-1]])
    lower = _in_order(model, short[first], depth - 1)[np.cumsum(first) - 1]
    states, left, edges, share = model["levels"][depth - 1]
    return _look(edges, share, edge, 0.0) + _look(states, left, edge & _mask(depth), 1.0) * lower


def grow(single: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray]]) -> dict:
    """The tree from the counts of single symbols and, for each depth, of the (symbol,
    context) keys that are frequent enough and of the contexts; contexts sorted."""
    n = single.sum()
    model: dict = {"single": (single + 0.01) / (n + 2.56), "levels": []}
    for depth, ((edge, count), (context, total)) in enumerate(zip(edges, contexts, strict=True), 1):
        order = np.argsort(edge & _mask(depth), kind="stable")
        edge, count = edge[order], count[order]
        of = _look(context, total.astype(float), edge & _mask(depth), 0.0)
        edge, count, of = edge[of > 0], count[of > 0], of[of > 0]
        after = edge & _mask(depth)
        share = np.maximum(count - DISCOUNT, 0) / (of + PRIOR)
        start, stop = np.searchsorted(after, context), np.searchsorted(after, context, side="right")
        ratio = count / of
        gain = ratio * np.log(ratio / probabilities(model, edge >> 8, depth - 1))
        sums = np.concatenate([[0.0], np.cumsum(gain)])
        mass = np.concatenate([[0.0], np.cumsum(share)])
        keep = (sums[stop] - sums[start] >= DIVERGENCE) & (stop > start)
        left = np.clip(1 - (mass[stop] - mass[start]), 1e-9, 1.0)[keep]
        states = context[keep]
        mine = _look(states, np.ones(len(states)), after, 0.0) > 0
        edge, share = edge[mine], share[mine]
        order = np.argsort(edge)
        model["levels"].append((states, left, edge[order], share[order]))
    return model


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    found = df.toArrow()
    return [found.column(x).to_numpy() for x in names]


def byte_tree(words: DataFrame) -> dict:
    """The tree of the bytes of words(word, n)."""
    # each depth's counts are the next deeper one's, folded over its farthest symbol
    levels = {DEPTH: cut(byte_counts(words))}
    for d in range(DEPTH - 1, -1, -1):
        levels[d] = cut(levels[d + 1].groupBy(F.shiftright("edge", 8).alias("edge")).agg(F.sum("n").alias("n")))
    single = np.zeros(256)
    for r in levels[0].collect():  # 256 rows at most
        single[r["edge"]] = r["n"]
    enough = least(float(single.sum()))
    edges, contexts = [], []
    before = (np.flatnonzero(single), single[single > 0])
    for d in range(1, DEPTH + 1):
        # a context's key is that of its last symbol after the others: what was counted one
        # depth before, but for the ends of words, and the start of a word
        key, count = before
        some = (count >= 2 * enough) & (key >> (8 * (d - 1)) != 10)
        start = sum(10 << (8 * i) for i in range(d))
        begun = [single[10]] if single[10] >= 2 * enough else []
        key, count = np.concatenate([key[some], np.full(len(begun), start, np.int64)]), np.concatenate([count[some], begun]).astype(np.int64)
        order = np.argsort(key)
        contexts.append((key[order], count[order]))
        before = _columns(levels[d].where(F.col("n") >= enough), "edge", "n")
        edges.append(tuple(before))
    return grow(single, edges, contexts)


def token_ids(model: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """The tokens of texts, one after the other: numbers (-1 for words that are not broadcast),
    whether they begin a text, how many each text has; the different words, their hashes, and which
    of them each token is."""
    split = tokens(texts)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words, which = _bytes(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
    hashes = _hashes.of(words).view(np.int64)
    ids = _places(model["keys"], hashes)[which]
    first = np.zeros(len(ids), bool)
    first[np.cumsum(sizes) - sizes] = True
    return ids, first, sizes, words, hashes, which


def _order(rank: np.ndarray) -> np.ndarray:
    """The places of rank in order; behind the ranks themselves where a number holds both, which is sorted quicker."""
    bits = len(rank).bit_length()
    if len(rank) and rank.min() >= 0 and rank.max() >> (62 - bits) == 0:
        return np.sort(rank << bits | np.arange(len(rank))) & ((1 << bits) - 1)
    return np.argsort(rank)


def _places(keys: np.ndarray, wanted: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """Where each of wanted stands in the sorted keys; -1 if it does not. In order, so that
    neighbouring searches meet the same memory. rank: smaller numbers that sort as wanted do."""
    if not len(keys):
        return np.full(len(wanted), -1)
    order = _order(wanted if rank is None else rank)
    ordered = wanted[order]
    at = np.searchsorted(keys, ordered)
    at[at >= len(keys)] = 0
    found = np.empty(len(wanted), np.int64)
    found[order] = np.where(keys[at] == ordered, at, -1)
    return found


def edges_of(model: dict, ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each depth, each token's context and its edge there (-1 for none). A context is a
    number of the depth before: a word's, or that of the start, and then an edge's."""
    begin = len(model["keys"])
    context = np.concatenate([[-1], ids[:-1]])
    context[first] = begin
    for level in model["levels"]:
        edge = np.full(len(ids), -1)
        good = np.flatnonzero((context >= 0) & (ids >= 0))
        before, word = context[good], ids[good]
        edge[good] = _places(level["edges"], before << 32 | word, before * begin + word)
        yield context, edge
        context = np.concatenate([[-1], edge[:-1]])
        context[first] = -1


def next_counts(docs: DataFrame, model: dict) -> DataFrame:
    """(edge, n): the tokens that follow the contexts of the depth that the model lacks."""
    shared = docs.sparkSession.sparkContext.broadcast({"keys": model["keys"], "frequent": model["frequent"], "levels": [{"edges": level["edges"]} for level in model["levels"]]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, grown = Tally(), shared.value
        for part in parts(batches, limit=TEXT):
            ids, first, *_ = token_ids(grown, part.column(0))
            context, edge = np.concatenate([[-1], ids[:-1]]), ids
            context[first] = len(grown["keys"])
            for _, edge in edges_of(grown, ids, first):
                context = np.concatenate([[-1], edge[:-1]])
                context[first] = -1
            # a token that is too rare after the shorter context is so after this one
            some = (context >= 0) & (edge >= 0)
            context, ids = context[some], ids[some]
            often = grown["frequent"][context]
            yield from tally.add(context[often] << 32 | ids[often])
        yield from tally.out()

    return _summed(docs.select("text").mapInArrow(run, "edge long, n long"))


def train(docs: DataFrame) -> dict:
    """The model of docs(text): the tree of bytes, that of words, counts of all words as a
    written table, and their totals."""
    words = cut(word_counts(docs))
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    spelt, enough = byte_tree(words), least(float(n or 0))
    tree = docs.sparkSession.sparkContext.broadcast(spelt)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(spelling(tree.value, _bytes(batch.column(1))))], names=["key", "n", "log"])

    often = words.where(F.col("n") >= enough).mapInArrow(spell, "key long, n long, log double")
    key, count, log = _columns(often.groupBy("key").agg(F.sum("n").alias("n"), F.max("log").alias("log")), "key", "n", "log")
    order = np.argsort(key)
    key, count, log = key[order], count[order], log[order]
    root = ROOT * count / max(1, n) + (1 - ROOT) * 10.0**log
    model: dict = {"spelling": spelt, "words": words, "n": int(n), "v": int(v), "keys": key, "counts": count, "root": root, "levels": []}
    # how often each context of the next depth occurs, and the context that is one word shorter
    begun = _places(key, _hashes.of([b""]).view(np.int64))[0]
    occurs, shorter = np.concatenate([count, [count[begun] if begun >= 0 else 0]]), None
    if begun >= 0:
        occurs[begun] = 0  # nothing follows an end
    for _ in range(CONTEXTS):
        model["frequent"] = occurs >= 2 * enough
        edge, count = _columns(next_counts(docs, model).where(F.col("n") >= enough), "edge", "n")
        order = np.argsort(edge)
        edge, count = edge[order], count[order].astype(float)
        context, word = edge >> 32, edge & ((1 << 32) - 1)
        if shorter is None:
            lower, below = word, root[word]
        else:
            lower = _places(model["levels"][-1]["edges"], shorter[context] << 32 | word)
            below = model["levels"][-1]["of_edge"][lower]
        share = np.maximum(count - WORD_DISCOUNT, 0) / (occurs[context] + WORD_PRIOR)
        ratio = count / np.maximum(occurs[context], 1)
        size = len(occurs)
        kept = np.bincount(context, ratio * np.log(ratio / below), size) >= DIVERGENCE
        left = np.where(kept, np.clip(1 - np.bincount(context, share, size), 1e-9, 1.0), 1.0)
        share = np.where(kept[context], share, 0.0)
        model["levels"].append({"edges": edge, "share": share, "left": left, "of_edge": share + left[context] * below})
        # an edge is the next depth's context; one word shorter it is this depth's, and without its first word the lower edge
        occurs, shorter = np.where(word == begun, 0, count), lower
    del model["frequent"]
    return model


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of
    docs."""
    levels = [{x: level[x] for x in ("edges", "share", "left")} for level in model["levels"]]
    shared = docs.sparkSession.sparkContext.broadcast({**{x: model[x] for x in ("spelling", "keys", "counts", "root")}, "levels": levels})
    below = model["n"] + 0.1 * (model["v"] + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in parts(batches, limit=TEXT):
            ids, first, sizes, words, hashes, which = token_ids(m, part.column(1))
            ends = np.cumsum(sizes)
            known = ids >= 0
            p, base = np.ones(len(ids)), np.zeros(len(ids))
            p[known], base[known] = m["root"][ids[known]], np.log10((m["counts"][ids[known]] + 0.1) / below)
            for level, (context, edge) in zip(m["levels"], edges_of(m, ids, first), strict=True):
                after, seen = context >= 0, edge >= 0
                p[after] *= level["left"][context[after]]
                p[seen] += level["share"][edge[seen]]
            by_row = lambda x: np.add.reduceat(x, ends - sizes)  # noqa: B023, E731
            rest = which[~known]
            new, spelt = np.unique(rest), np.zeros(len(words))
            spelt[new] = spelling(m["spelling"], [words[i] for i in new.tolist()])
            bounds = np.concatenate([[0], np.cumsum(by_row((~known).astype(np.int64)))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (hashes[rest], spelt[rest])]
            yield pa.record_batch([part.column(0), part.column(2), pa.array(sizes), pa.array(by_row(known.astype(np.int64))), pa.array(by_row(base)), pa.array(by_row(np.log10(p))), *lists], names=["doc_id", "held_out", "n_tokens", "known", "base", "total", "keys", "logs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (remainder(F.col("doc_id"), 10) == 0).alias("held_out"))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, total double, keys array<long>, logs array<double>"
    scored = cut(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))
    tail = scored.select("row", F.explode(F.arrays_zip("keys", "logs")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.logs").alias("log"))
    plain = (F.coalesce("n", F.lit(0)) + 0.1) / F.lit(float(below))
    # long words' probabilities are below what a double holds: unseen ones stay logarithms
    mixed = F.when(F.col("n") > 0, F.log10(F.lit(ROOT / max(1, model["n"])) * F.col("n") + F.lit(1 - ROOT) * F.pow(F.lit(10.0), F.col("log")))).otherwise(F.lit(math.log10(1 - ROOT)) + F.col("log"))
    counts = model["words"].groupBy("key").agg(F.sum("n").alias("n"))
    counted = tail.join(counts, "key", "left").groupBy("row").agg(F.count("n").alias("more"), F.sum(F.log10(plain)).alias("added"), F.sum(mixed).alias("mixed"))
    full = scored.drop("keys", "logs").join(counted, "row", "left")
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(model["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("added", F.lit(0.0))).alias("base_score"), (F.col("total") + F.coalesce("mixed", F.lit(0.0))).alias("score"),
    )


def scores(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score all."""
    learnt = docs.where(remainder(F.col("doc_id"), 10) != 0).select(F.col("text").cast("string").alias("text"))
    return score(docs, train(learnt))
