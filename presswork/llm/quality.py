"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms of a text are its byte trigrams (hashed to DIMS of them) and its token shapes (hashed
to SHAPES): a shape writes each run of small letters as a, of capitals as A, of digits as 9
and keeps every other sign; terms are the shapes of tokens and of neighbouring tokens, a
token like the one before, and a line like an earlier one. Each half is log(1 + count),
scaled to unit length, trigrams times TRIGRAMS. Weighted by idf, they are projected on the
LATENT leading right singular vectors of the labelled sample. The labelled vectors, at most
2 * PER_CLASS, are broadcast; every document's cosine with each is computed in blocks, and
its NEIGHBOURS nearest vote with weight cosine**POWER.

The classifier is fitted on the PER_CLASS labelled rows of each class with the smallest
hash of doc_id (all, if fewer), which bounds the driver's work and the broadcast whatever
the size of the corpus; everything else reads whole texts of all rows.

Defined cases: null and empty texts have no terms and score the prior, as does everything
when there are no labels (0.5 then); null labels teach nothing; a document labelled twice
counts with its smallest label; repeated rows score alike; an empty table gives an empty
result; other columns are ignored. A null doc_id is not held out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.base import remainder, sample, small_batches

PER_CLASS, DIMS, SHAPES, LATENT, NEIGHBOURS, POWER = 1500, 1024, 512, 48, 15, 4.0
TRIGRAMS = 0.5

_SMALL, _CAPITALS, _DIGITS = re.compile(r"[^\W\d_A-ZÀ-Þ]+"), re.compile(r"[A-ZÀ-Þ]+"), re.compile(r"\d+")


def shape(token: str) -> str:
    return _DIGITS.sub("9", _CAPITALS.sub("A", _SMALL.sub("a", token)))


class _Shapes(dict):
    def __missing__(self, token: str) -> str:
        if len(self) > 200_000:
            self.clear()
        found = self[token] = shape(token)
        return found


class _Slots(dict):
    def __missing__(self, term) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[term] = zlib.crc32(" ".join(term).encode("utf-8", "surrogatepass")) % SHAPES
        return found


_shapes, _slots = _Shapes(), _Slots()


def shape_terms(text: str) -> Counter:
    """How often each shape term occurs."""
    words = text.split()
    found = list(map(_shapes.__getitem__, words))
    out: Counter = Counter(zip(found))
    out.update(zip(found, found[1:]))
    lines = [x for x in text.split("\n") if x]
    again = {("same", "token", ""): sum(map(str.__eq__, words, words[1:])), ("same", "line", ""): len(lines) - len(set(lines))}
    out.update({k: n for k, n in again.items() if n})
    return out


def terms(texts: list[str]) -> np.ndarray:
    """A row of term weights before idf for each text."""
    out = np.zeros((len(texts), DIMS + SHAPES), dtype=np.float32)
    for row, text in zip(out, texts, strict=True):
        if not text:
            continue
        data = text.encode()
        counts = np.zeros(DIMS)
        for at in range(0, len(data), 1 << 22):
            raw = np.frombuffer(data[at : at + (1 << 22) + 2], np.uint8).astype(np.uint32)
            if len(raw) < 3:
                raw = np.concatenate([raw, np.zeros(3 - len(raw), np.uint32)])
            code = (raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA77) + raw[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(22)
            counts += np.bincount(code, minlength=DIMS)
        row[:DIMS] = np.log1p(counts)
        row[:DIMS] *= TRIGRAMS / np.sqrt((row[:DIMS] ** 2).sum())
        if found := shape_terms(text):
            at = np.fromiter(map(_slots.__getitem__, found), np.int64, len(found))
            seen = np.log1p(np.bincount(at, np.fromiter(found.values(), np.float64, len(found)), minlength=SHAPES))
            row[DIMS:] = seen / np.sqrt((seen**2).sum())
    return out


def fit(rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """idf, projection, unit vectors of the labelled rows, labels and prior."""
    if not len(rows):
        return {"prior": np.float64(0.5), "labels": labels}
    present = (rows > 0).sum(axis=0)
    idf = np.log((1 + len(rows)) / (1 + present)).astype(np.float32) + 0.1
    weighted = rows * idf
    _, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    basis = (vectors[:, ::-1][:, :LATENT].astype(np.float32)) * idf[:, None]
    return {"basis": basis, "known": unit(rows @ basis), "labels": labels.astype(np.float32), "prior": np.float64(labels.mean())}


def unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def vote(model: dict[str, np.ndarray], rows: np.ndarray, block: int = 256) -> np.ndarray:
    """The weighted share of label 1 among the nearest labelled vectors of each row."""
    out = np.full(len(rows), float(model["prior"]))
    if "basis" not in model:
        return out
    k = min(NEIGHBOURS, len(model["labels"]))
    for at in range(0, len(rows), block):
        placed = unit(rows[at : at + block] @ model["basis"])
        cosine = placed @ model["known"].T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER
        total = weight.sum(axis=1)
        some = (total > 0) & (rows[at : at + block].any(axis=1))
        ones = (weight * model["labels"][near]).sum(axis=1)
        out[at : at + block][some] = ones[some] / total[some]
    return np.clip(out, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = PER_CLASS) -> dict[str, np.ndarray]:
    """The fitted model; terms are counted on the executors, at most 2 * per_class rows of
    them reach the driver (more only if doc_ids repeat: the first of each counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_batches(batches):
            yield pa.record_batch([part.column(0), pa.array([x.tobytes() for x in terms(texts)]), part.column(2)], names=["id", "row", "label"])

    found = sample(docs, labels, column, per_class=per_class).select("id", "text", "label").mapInArrow(run, f"id {docs.schema['doc_id'].dataType.simpleString()}, row binary, label int")
    rows = found.groupBy("id").agg(F.min(F.struct("row", "label")).alias("x")).select("x.row", "x.label", "id").orderBy("id").collect()
    data = np.stack([np.frombuffer(r["row"], np.float32) for r in rows]) if rows else np.zeros((0, DIMS + SHAPES), np.float32)
    return fit(data, np.array([r["label"] for r in rows], dtype=np.float32))


def score(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_batches(batches):
            found = vote(shared.value, terms(texts))
            yield pa.record_batch([part.column(0), part.column(2), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (remainder(F.col("doc_id"), 3) == 1).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the classifier accepts, all their columns untouched."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    own = "text_to_score"
    while own in names:
        own += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_batches(batches, own):
            accepted = vote(shared.value, terms(texts)) >= threshold
            yield part.select(list(range(len(names)))).filter(pa.array(accepted))

    return docs.withColumn(own, F.col("text").cast("string")).mapInArrow(run, docs.schema)
