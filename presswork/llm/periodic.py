"""Periodic runs: heavy/light lag counting, then island scans of the lags that can hold one.

A run of a text's words is a stretch with smallest period q (words q apart are identical) that
no neighbouring word extends, of `least` words and `exponent` periods or more. At lag q a run
is an island of consecutive matches w[i] = w[i + q], max(least - q, (exponent - 1) * q) of them
or more, so only lags with as many matches in the whole text are scanned. Matches are counted
exactly for all lags at once:

* a rare word's occurrences are paired, and each pair's difference is a match at that lag;
* a frequent word, whose pairs would cost more than a transform, adds the power spectrum of its
  indicator vector, and one inverse transform of their sum gives the counts. They are integers
  below 2**53 with errors far under a half, so rounding makes them exact.

Lags are scanned in ascending order. A run with period d also matches at every multiple of d,
where it is nothing new as long as q + d words of it are left (two periods of a stretch that
long share their greatest common divisor); those matches are taken off the count of lag q
first, so that a text of one repeated word is scanned once and not at each lag.

What is left of a text when each run keeps its first period is `collapsed`: the kept words
joined by one space.

Texts are worked on in parts of half a MB (one text at least), row by row: nothing is shuffled.
Pairs and transforms take about n * sqrt(n log n) steps for n words; scanned lags take n each,
which a long text of two or three different words can bring to n * n / 4.

Defined cases: null, empty and blank texts have no words and no runs, and collapse to the empty
text; a null doc_id is returned as it is; repeated rows are rows of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.base import small_batches

#: The fewest words and the fewest periods of a run.
LEAST, EXPONENT = 24, 3
#: Bytes of text worked on at once, and differences that are held at a time: a word takes some
#: twenty numbers, and workers share the executor's memory with each other and the JVM.
AT_ONCE, HELD = 1 << 19, 1_000_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words [^\\x20\\x09-\\x0D]+ of all texts, one after the other, and where each text's begin
    (one more entry than texts)."""
    parts = pc.split_pattern_regex(texts, r"[\x20\x09-\x0D]+")
    flat, ends = parts.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))))
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # texts that begin or end with spaces have empty parts
    return flat.filter(pa.array(full)), np.concatenate(([0], np.cumsum(full)))[ends.astype(np.int64)]


def _cost(n: np.ndarray) -> np.ndarray:
    """Steps of a transform that holds n words without wrapping around."""
    size = np.exp2(np.ceil(np.log2(np.maximum(2 * n, 2))))
    return size * np.log2(size)


def matches(code: np.ndarray, begin: np.ndarray, exponent: int = EXPONENT) -> np.ndarray:
    """At begin[t] + q the number of positions of text t whose word is that q words on, for
    lags q up to the text's length / exponent; code: the words' numbers."""
    total, length = int(begin[-1]), np.diff(begin)
    found = np.zeros(total + 1, dtype=np.int64)
    text = np.repeat(np.arange(len(length)), length)
    order = np.argsort(code, kind="stable")  # a word's places in order, so text by text
    first = np.ones(total, dtype=bool)
    first[1:] = (code[order[1:]] != code[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    at = np.flatnonzero(first)
    often = np.diff(np.append(at, total))
    heavy = often.astype(float) ** 2 > _cost(length)[text[order[at]]]

    # rare words: differences to the next place, the one after it, and so on
    end = np.repeat(at + often, often)
    most = (length // exponent)[text[order]]
    here, step, waiting, held = np.flatnonzero(np.repeat(~heavy, often)), 1, [], 0
    while len(here):
        here = here[here + step < end[here]]
        lag = order[here + step] - order[here]
        near = lag <= most[here]  # further places are only further away
        here, lag = here[near], lag[near]
        waiting.append(begin[text[order[here]]] + lag)
        held += len(lag)
        step += 1
        if held > HELD or not len(here):
            found += np.bincount(np.concatenate(waiting), minlength=total + 1)
            waiting, held = [], 0

    # frequent words: spectra by text
    groups = np.flatnonzero(heavy)
    for t in np.unique(text[order[at[groups]]]):
        n = int(length[t])
        size = 1 << (2 * n - 1).bit_length()
        power = np.zeros(size // 2 + 1)
        for g in groups[text[order[at[groups]]] == t]:
            one = np.zeros(size)
            one[order[at[g] : at[g] + often[g]] - begin[t]] = 1.0
            spectrum = np.fft.rfft(one)
            power += spectrum.real**2 + spectrum.imag**2
        lags = np.arange(1, n // exponent + 1)
        found[begin[t] + lags] += np.rint(np.fft.irfft(power, size)[lags]).astype(np.int64)
    return found


def runs_of(code: np.ndarray, count: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, by start, then period; count[q]: matches
    at lag q."""
    lag = np.arange(len(count))
    need = np.maximum(np.maximum(least - lag, (exponent - 1) * lag), 1)
    known: dict[tuple[int, int], int] = {}
    explained = np.zeros(len(count), dtype=np.int64)
    for q in np.flatnonzero((count >= need) & (lag > 0)).tolist():
        if count[q] - explained[q] < need[q]:
            continue
        same = np.zeros(len(code) - q + 2, dtype=np.int8)
        same[1:-1] = code[:-q] == code[q:]
        edge = np.diff(same)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for s, m in zip(start.tolist(), (end - start).tolist(), strict=True):
            if m >= need[q] and (s, m + q) not in known:  # a stretch that is known has a smaller period
                known[s, m + q] = q
                multiples = np.arange(2 * q, min(m, len(count) - 1) + 1, q)  # q + lag words at least are left
                explained[multiples] += m + q - multiples
    return sorted((s, n, q) for (s, n), q in known.items())


def annotated(batches: Iterator[pa.RecordBatch], least: int = LEAST, exponent: int = EXPONENT) -> Iterator[pa.RecordBatch]:
    """The columns of find() for batches of (doc_id, text)."""
    for part, texts in small_batches(batches, limit=AT_ONCE):
        flat, begin = words(pa.array(texts, pa.large_string()))
        code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int32)
        count = matches(code, begin, exponent)
        kept, found, ends = np.ones(len(code), dtype=bool), [], [0]
        lag = np.arange(len(code)) - np.repeat(begin[:-1], np.diff(begin))
        some = np.maximum(np.maximum(least - lag, (exponent - 1) * lag), 1) <= count[:-1]
        some &= lag > 0
        worth = set(np.flatnonzero(np.add.reduceat(some, begin[:-1][np.diff(begin) > 0])).tolist()) if len(code) else set()
        nth = -1
        for t in range(len(texts)):
            s, e = int(begin[t]), int(begin[t + 1])
            nth += e > s
            mine = runs_of(code[s:e], count[s : s + (e - s) // exponent + 1], least, exponent) if e > s and nth in worth else []
            for start, length, period in mine:
                kept[s + start + period : s + start + length] = False
            found += mine
            ends.append(len(found))
        sizes = np.concatenate(([0], np.cumsum(kept)))[begin]
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat.filter(pa.array(kept))), pa.scalar(" ", pa.large_string()))
        table = np.array(found, dtype=np.int64).reshape(-1, 3)
        items = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)], fields=list(RUN))
        runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(begin), pa.int64()), runs, collapsed.cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def find(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period) and
    collapsed, for each row of docs."""
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return annotated(batches, least, exponent)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
