"""Approximate nearest neighbours by multi-index hashing.

Vectors are learned binary codes: TABLES rotations, fitted on a bounded sample by
alternating sign codes and the orthogonal map that suits them, give one bit a dimension
each. A code is cut into m substrings of SUB bits, and each substring is an index from its
value to the rows that hold it. Two codes that differ in fewer than m * (s + 1) bits agree
within s bits on some substring (pigeonhole), so probing every substring's values within
s flips retrieves every code within that radius. A query widens s until the radius holds
`wanted` codes. Where the next probes would read more rows than there are, all codes are
compared instead, which retrieves the same. So a query has exactly the rows whose codes are
among its `wanted` nearest (ties included), and these are reranked by the inner product of
the original vectors in double precision. With wanted=None all rows are: exact search.

Rows are dealt once into blocks of BLOCK vectors (fewer, if they are long), each with its own
index, and every block gets the queries one after another, so a task holds one block and
one batch of queries whatever the size of the table. Each block reports its TOP best and a
query keeps the best of all blocks. What moves is the table once and the queries once a
block. Vectors of each length are an index of their own.

Inner products are searched as angles: vectors get one more coordinate,
sqrt(longest**2 - length**2), which queries lack. Of equal vectors only the TOP + 1
smallest ids can be among any query's nearest, and the others leave the index, which
bounds what a vector that a third of all rows share costs; equal queries search once.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, neither as queries nor as candidates; vectors are compared with those of
their own length; a null id takes no part; rows that repeat an id with an equal vector count
once, with another vector they are rows of their own, and no row finds its own id; fewer
candidates than asked for give all; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

TABLES, SAMPLE, ROUNDS, SUB = 8, 4000, 12, 16
BLOCK, BYTES, TOP, WANTED = 16_384, 64 << 20, 20, 400

#: The masks that flip s of SUB bits, for each s.
_FLIPS = [np.flatnonzero(np.bitwise_count(np.arange(1 << SUB, dtype=np.uint32)) == s).astype(np.uint16) for s in range(SUB + 1)]


def learn(sample: np.ndarray, longest: float, tables: int = TABLES, rounds: int = ROUNDS, seed: int = 7) -> dict[str, np.ndarray]:
    """Mean, rotations (dimensions x bits) and the length to lift to for these vectors;
    0 where lengths differ by too little to matter."""
    rest = np.sqrt(np.maximum(longest**2 - (sample**2).sum(axis=1), 0))
    lift = longest if rest.max(initial=0) > 0.01 * longest else 0.0
    wide = -(-(sample.shape[1] + bool(lift)) // 8) * 8
    data = lifted(sample, lift, wide)
    mean = data.mean(axis=0)
    centred = data - mean
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(tables):
        turn = np.linalg.qr(rng.standard_normal((wide, wide)))[0]
        for _ in range(rounds):
            signs = np.where(centred @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(centred.T @ signs)
            turn = u @ v
        found.append(turn)
    return {"mean": mean, "turn": np.concatenate(found, axis=1), "lift": np.float64(lift)}


def lifted(vectors: np.ndarray, lift: float, wide: int) -> np.ndarray:
    """vectors in wide dimensions, with the coordinate that makes them lift long."""
    full = np.pad(vectors, ((0, 0), (0, wide - vectors.shape[1])))
    if lift:
        full[:, vectors.shape[1]] = np.sqrt(np.maximum(lift**2 - (vectors**2).sum(axis=1), 0))
    return full


def codes(vectors: np.ndarray, model: dict[str, np.ndarray], query: bool = False) -> np.ndarray:
    """Code bytes, a row for each vector; queries are not lifted."""
    full = lifted(vectors, 0.0 if query else float(model["lift"]), len(model["mean"]))
    return np.packbits((full - model["mean"]) @ model["turn"] >= 0, axis=1)


class Index:
    """The substring indexes of a block's codes."""

    def __init__(self, rows: np.ndarray):
        self.words = np.ascontiguousarray(rows).view(np.uint64)
        parts = np.ascontiguousarray(rows).view(np.uint16)
        self.m = parts.shape[1]
        self.order = np.argsort(parts, axis=0, kind="stable").T.astype(np.int32)
        self.start = np.zeros((self.m, (1 << SUB) + 1), np.int32)
        for j in range(self.m):
            self.start[j, 1:] = np.cumsum(np.bincount(parts[:, j], minlength=1 << SUB))
        self.read = 0  # rows that probes and comparisons have looked at

    def far(self, word: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        some = self.words if rows is None else self.words[rows]
        self.read += len(some)
        return np.bitwise_count(some ^ word).sum(axis=1, dtype=np.int64)

    def nearest(self, code: np.ndarray, wanted: int | None) -> np.ndarray:
        """The rows whose codes are as near as the wanted-th nearest one."""
        n = len(self.words)
        if wanted is None or wanted >= n:
            return np.arange(n)
        word, part = code.view(np.uint64), code.view(np.uint16)
        every = np.arange(self.m)[:, None]
        rows, far, looked = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for s, flips in enumerate(_FLIPS):
            looked += self.m * len(flips)
            if looked >= n:
                break
            values = part[:, None] ^ flips[None, :]
            lo, hi = self.start[every, values], self.start[every, values.astype(np.int64) + 1]
            size = (hi - lo).sum()
            looked += int(size)
            if looked >= n:
                break
            if size:
                j, k = np.nonzero(hi > lo)
                new = np.concatenate([self.order[x, a:b] for x, a, b in zip(j, lo[j, k], hi[j, k], strict=True)])
                new = np.setdiff1d(new, rows)
                rows, far = np.concatenate([rows, new]), np.concatenate([far, self.far(word, new)])
            inside = far < self.m * (s + 1)  # of these none is missing
            if inside.sum() >= wanted:
                return np.sort(rows[inside][far[inside] <= np.partition(far[inside], wanted - 1)[wanted - 1]])
        far = self.far(word)
        return np.flatnonzero(far <= np.partition(far, wanted - 1)[wanted - 1])


def _valid(vectors: DataFrame) -> DataFrame:
    v = F.col("vec").cast("array<double>")
    good = F.col("id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.coalesce(good, F.lit(False))).withColumn("vec", v)


def _packed(model: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def _searched(tasks: DataFrame, top: int, wanted: int | None) -> DataFrame:
    """(rep, vec_id, score) from rows (n, block, kind, id, vec, model): of each (n, block) one
    with the model, then the block's vectors, then the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, model, ids, data, index = None, None, [], [], None
        for batch in batches:
            n, block, kind = (batch.column(x).to_numpy() for x in ("n", "block", "kind"))
            first = np.flatnonzero(np.concatenate([[True], (n[1:] != n[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])])) if len(n) else []
            for lo, hi in zip(first, [*first[1:], len(n)], strict=True):
                part = batch.slice(lo, hi - lo)
                if (n[lo], block[lo]) != now:
                    now, model, ids, data, index = (n[lo], block[lo]), None, [], [], None
                if kind[lo] == 0:
                    model = dict(np.load(io.BytesIO(part.column("model")[0].as_py())))
                elif kind[lo] == 1:
                    ids.append(part.column("id").to_numpy())
                    data.append(_matrix(part.column("vec")))
                elif data:
                    if index is None:
                        ids, data = [np.concatenate(ids)], [np.concatenate(data)]
                        index = Index(codes(data[0], model))
                    reps, ask = part.column("id").to_numpy(), _matrix(part.column("vec"))
                    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                    for rep, q, code in zip(reps, ask, codes(ask, model, query=True), strict=True):
                        found = index.nearest(code, wanted)
                        score = data[0][found] @ q
                        best = np.lexsort((ids[0][found], -score))[: top + 1]
                        out.append((np.full(len(best), rep), ids[0][found][best], score[best]))
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["rep", "vec_id", "score"])

    return tasks.mapInArrow(run, "rep long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, top: int = TOP, block: int = BLOCK, wanted: int | None = WANTED) -> DataFrame:
    """query_id, rank, vec_id, score: the top best found for each row where the condition
    is_query(id column) holds, among all rows but the query's own."""
    spark = vectors.sparkSession
    rows = _valid(vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vec")))
    # of equal vectors the smallest ids; Spark drops the rest before it shuffles
    order = Window.partitionBy("vec").orderBy("id")
    kept = cut(rows.dropDuplicates(["id", "vec"]).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top + 1).select("id", "vec", F.size("vec").alias("n")))
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    sizes = kept.groupBy("n").agg(F.count(F.lit(1)).alias("rows"), F.max(norm).alias("longest")).collect()  # a row for each length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    by_length = lambda f: F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["n"], f(r))]), F.col("n"))
    blocks = {r["n"]: -(-r["rows"] // max(1, min(block, BYTES // (8 * r["n"])))) for r in sizes}

    # about SAMPLE vectors of each length by the hash of id, however many there are
    share = by_length(lambda r: 1.25 * SAMPLE / r["rows"])
    drawn = kept.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 40)) < share * float(1 << 40))
    longest = {r["n"]: float(np.sqrt(r["longest"])) for r in sizes}

    def fit(key, found: pd.DataFrame) -> pd.DataFrame:
        some = found.sort_values("id")["vec"].to_numpy()[:SAMPLE]
        return pd.DataFrame({"n": [key[0]], "model": [_packed(learn(np.stack(some), longest[key[0]]))]})

    models = cut(drawn.groupBy("n").applyInPandas(fit, "n int, model binary"))

    asked = rows.where(is_query(F.col("id"))).select("id", "vec")
    group = cut(asked.groupBy("vec").agg(F.min("id").alias("rep")))
    every = F.explode(F.sequence(F.lit(0), by_length(lambda r: blocks[r["n"]] - 1))).alias("block")
    empty, none = F.lit(None).cast("array<double>"), F.lit(None).cast("binary")
    tasks = models.select("n", every, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("id"), empty.alias("vec"), "model")
    tasks = tasks.unionByName(kept.select("n", F.pmod(F.xxhash64("id"), by_length(lambda r: blocks[r["n"]])).cast("int").alias("block"), F.lit(1).alias("kind"), "id", "vec", none.alias("model")))
    tasks = tasks.unionByName(group.withColumn("n", F.size("vec")).select("n", every, F.lit(2).alias("kind"), F.col("rep").alias("id"), "vec", none.alias("model")))
    tasks = tasks.repartition(min(sum(blocks.values()), 4000), "n", "block").sortWithinPartitions("n", "block", "kind")
    one = _searched(tasks, top, wanted)
    ranked = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    best = one.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= top + 1).select("rep", "vec_id", "score")
    # every query takes its vector's list, without itself
    member = asked.join(group, "vec").select(F.col("id").alias("query_id"), "rep").distinct()
    lists = best.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id", "score"))).alias("found"))  # top + 1 at most
    own = member.join(lists, "rep").withColumn("found", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, top))
    flat = own.select("query_id", F.posexplode("found").alias("pos", "x"))
    return flat.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
