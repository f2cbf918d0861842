"""Embedding whitening: exact integer scatter, converted to floats once, decomposed by eigh.

Entries become integers x = floor(SCALE * c). Each distinct x vector counts once. Tasks subtract a
shift (a vector of the table), so that the numbers are small, and add up the rest and its
cross-products as Python integers of any size: blocks of rows are multiplied as float64 where
every sum stays below 2**53 and so is exact, rows with larger numbers as integers. Tasks' sums
leave them as limbs of 30 bits, which Spark adds up by (length, i, j). The scatter n * X'X - S S'
is then formed in integers; the shift cancels in it. Only then are its entries, divided by n * n
with one rounding each, decomposed by numpy's eigh.

A fit is one for each length of vectors: what one length holds does not depend on the others.
Fits go to the tasks in passes of PER_PASS numbers. Nothing else passes the driver, and only
the distinct vectors are shuffled, in the fewest bytes an entry that hold them.

Defined cases: vectors that are null, empty or hold null or non-finite entries have no rows; entries
beyond a long are the nearest long; repeated rows and ids give rows each; a null vec_id is
returned as it is; a component whose variance is nothing but rounding (RANK of the trace, or
all vectors alike) has a null whitened value and no part in identity_error, which is null where
no component is left; deviation is null where it exceeds a long, deviation_exact holds its
digits always; vectors shorter than COMPONENTS have as many components as entries; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

SCALE, COMPONENTS = 256.0, 4
#: Variance of a component, as a share of the trace, that counts as rounding.
RANK = 1e-13
#: Numbers in the fits that one pass sends to the tasks; a single length may exceed it.
PER_PASS = 4_000_000
LIMB, LIMBS = 30, 8
LEAST, MOST = -(2**63), 2**63 - 1
WIDTHS = {1: "<i1", 2: "<i2", 4: "<i4", 8: "<i8"}


class Fit(NamedTuple):
    """What one length's distinct vectors say: sums after the shift, eigenvectors as columns."""

    n: int
    shift: np.ndarray
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def used(self) -> np.ndarray:
        return self.values > RANK * self.trace


# -- vectors ----------------------------------------------------------------------------

def integers(c: np.ndarray, scale: float = SCALE) -> np.ndarray:
    with np.errstate(over="ignore"):
        v = np.floor(c * scale)
    inside = np.clip(v, float(LEAST), 2.0**63 - 1024).astype(np.int64)
    return np.where(v >= 2.0**63, MOST, inside)


def vectors(column: pa.ListArray, scale: float = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x vectors) of each length among an Arrow column of lists of doubles; without vectors that
    are null, empty or hold anything that is no finite number."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    end = np.cumsum(size)
    wrong = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    fits = (size > 0) & (wrong[end] == wrong[end - size])
    for length in np.unique(size[fits]).tolist():
        rows = np.flatnonzero(fits & (size == length))
        yield rows, integers(flat[(end[rows] - length)[:, None] + np.arange(length)], scale)


def packed(x: np.ndarray) -> list[bytes]:
    """Each vector as the width of its numbers and their bytes, the width the least that holds them."""
    out: list[bytes] = [b""] * len(x)
    low, high, left = x.min(1), x.max(1), np.ones(len(x), dtype=bool)
    for width, kind in WIDTHS.items():
        info = np.iinfo(kind)
        rows = np.flatnonzero(left & (low >= info.min) & (high <= info.max))
        left[rows] = False
        data = x[rows].astype(kind).tobytes()
        step = width * x.shape[1]
        for k, row in enumerate(rows.tolist()):
            out[row] = bytes([width]) + data[k * step : (k + 1) * step]
    return out


def unpacked(data: list[bytes]) -> np.ndarray:
    """The vectors, all of one length."""
    x = np.empty((len(data), (len(data[0]) - 1) // data[0][0]), dtype=np.int64)
    width = np.array([d[0] for d in data])
    for w, kind in WIDTHS.items():
        rows = np.flatnonzero(width == w)
        if len(rows):
            x[rows] = np.frombuffer(b"".join(data[k][1:] for k in rows.tolist()), dtype=kind).reshape(len(rows), -1)
    return x


def shifted(x: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """x - shift, as Python integers if a long might not hold it."""
    near = len(x) == 0 or max(int(x.max()), -int(x.min()), int(shift.max()), -int(shift.min())) < 2**62
    return x - shift if near else x.astype(object) - shift.astype(object)


# -- the scatter ------------------------------------------------------------------------

def cross_products(y: np.ndarray) -> np.ndarray:
    """y'y exactly, as Python integers."""
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if not len(y):
        return out
    most = np.maximum(np.abs(y).max(1), 1) if y.dtype == object else np.maximum(y.max(1), -y.min(1)).clip(1)
    small = (most < 2**24).astype(bool)
    some = y[small].astype(float)
    if len(some):
        step = max(1, 2**53 // int(most[small].max()) ** 2 - 1)
        for at in range(0, len(some), step):
            block = some[at : at + step]
            out += (block.T @ block).astype(np.int64).astype(object)
    large = y[~small].astype(object)
    return out + large.T @ large if len(large) else out


def limbs(value: int) -> list[int]:
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    for _ in range(LIMBS):
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return out


def from_limbs(parts) -> int:
    return sum(int(p) << (LIMB * k) for k, p in enumerate(parts))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, x vectors) of a batch whose last columns are length and x."""
    length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
    data = batch.column(batch.schema.get_field_index("x"))
    for one in np.unique(length).tolist():
        rows = np.flatnonzero(length == one)
        yield one, rows, unpacked(data.take(pa.array(rows)).to_pylist())


def _fit(found: pd.DataFrame, shift: np.ndarray, components: int) -> Fit:
    """The fit of a length's sums (i, j and limbs; i = -1 holds the sums, i = j = -1 the count)."""
    d = len(shift)
    sums, products, n = np.zeros(d, dtype=object), np.zeros((d, d), dtype=object), 0
    names = [f"l{k}" for k in range(LIMBS)]
    for i, j, *parts in found[["i", "j", *names]].itertuples(index=False):
        value = from_limbs(parts)
        if j < 0:
            n = value
        elif i < 0:
            sums[j] = value
        else:
            products[i, j] = products[j, i] = value
    scatter = n * products - np.outer(sums, sums)
    covariance = np.array([[v / (n * n) for v in row] for row in scatter.tolist()], dtype=float)
    trace = sum(scatter.diagonal().tolist()) / (n * n)
    value, vector = np.linalg.eigh(covariance)
    most = slice(None, -components - 1, -1)
    return Fit(n, shift, sums, vector[:, most], np.maximum(value[most], 0.0), trace)


def _sums(distinct: DataFrame, shifts: dict[int, np.ndarray]) -> DataFrame:
    """(length, i, j, l0 ...): count, sums and cross-products of the shifted vectors, in limbs."""
    names = [f"l{k}" for k in range(LIMBS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for length, _, x in _by_length(batch):
                y = shifted(x, shifts[length])
                now = held.setdefault(length, [0, np.zeros(length, dtype=object), np.zeros((length, length), dtype=object)])
                now[0] += len(x)
                now[1] = now[1] + y.astype(object).sum(0)
                now[2] = now[2] + cross_products(y)
        for length, (n, sums, products) in held.items():
            rows = [(-1, -1, n)] + [(-1, j, v) for j, v in enumerate(sums)] + [(i, j, products[i, j]) for i in range(length) for j in range(i, length) if products[i, j]]
            parts = np.array([limbs(v) for *_, v in rows], dtype=np.int64)
            columns = [pa.array([length] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), *[pa.array(parts[:, k]) for k in range(LIMBS)]]
            yield pa.RecordBatch.from_arrays(columns, ["length", "i", "j", *names])

    parts = distinct.mapInArrow(run, ", ".join(["length int, i int, j int", *[f"{c} long" for c in names]]))
    return parts.groupBy("length", "i", "j").agg(*[F.sum(c).alias(c) for c in names])


def _packed_rows(embeddings: DataFrame, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in vectors(batch.column(1), scale):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([x.shape[1]] * len(rows), pa.int32()), pa.array(packed(x), pa.binary())], ["vec_id", "length", "x"])

    kind = embeddings.schema["vec_id"].dataType.simpleString()
    return embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).mapInArrow(run, f"vec_id {kind}, length int, x binary")


def fits(distinct: DataFrame, lengths: list[int], components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each of the lengths, from distinct(length, x)."""
    mine = distinct.where(F.col("length").isin(lengths))
    shifts = {r["length"]: unpacked([bytes(r["s"])])[0] for r in mine.groupBy("length").agg(F.min("x").alias("s")).collect()}
    sums = _sums(mine, shifts)

    def solve(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        fit = _fit(found, shifts[int(key[0])], components)
        return pd.DataFrame({"length": [key[0]], "n": [fit.n], "sums": [[str(v) for v in fit.sums]], "vectors": [fit.vectors.ravel().tolist()], "values": [fit.values.tolist()], "trace": [fit.trace]})

    solved = sums.groupBy("length").applyInPandas(solve, "length int, n long, sums array<string>, vectors array<double>, values array<double>, trace double")
    out = {}
    for r in solved.collect():  # a row a length
        d = r["length"]
        out[d] = Fit(r["n"], shifts[d], np.array([int(v) for v in r["sums"]], dtype=object), np.array(r["vectors"]).reshape(d, -1), np.array(r["values"]), r["trace"])
    return out


def deviations(x: np.ndarray, fit: Fit) -> tuple[np.ndarray, list[int]]:
    """(n * x - S) / n as floats, and the sum of squares of n * x - S."""
    y = shifted(x, fit.shift)
    near = y.dtype != object and (int(np.abs(y).max()) * fit.n + max(map(abs, fit.sums.tolist()))) ** 2 * y.shape[1] < 2**63
    z = y * fit.n - fit.sums.astype(np.int64) if near else y.astype(object) * fit.n - fit.sums
    return z.astype(float) / fit.n, (z * z).sum(1).tolist()


def whitened(centred: np.ndarray, fit: Fit) -> np.ndarray:
    """Values of the components that have a variance."""
    use = fit.used()
    return centred @ fit.vectors[:, use] / np.sqrt(fit.values[use])


def _identity_errors(distinct: DataFrame, found: dict[int, Fit]) -> dict[int, float]:
    """By length, the largest absolute entry of the covariance of the whitened distinct vectors less
    the identity. Tasks hand on counts, means and centred products, which merge stably."""

    def merged(a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        n, step = a[0] + b[0], b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for length, _, x in _by_length(batch):
                w = whitened(deviations(x, found[length])[0], found[length])
                mean = w.mean(0)
                held[length] = merged(held.get(length), (len(w), mean, (w - mean).T @ (w - mean)))
        for length, (n, mean, products) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([n]), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))], ["length", "n", "mean", "products"])

    def total(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        now = None
        for p in parts.sort_values(["n", "mean"], key=lambda c: c.map(str)).itertuples():
            k = len(p.mean)
            now = merged(now, (p.n, np.array(p.mean), np.array(p.products).reshape(k, k)))
        error = np.abs(now[2] / now[0] - np.eye(len(now[1]))).max() if len(now[1]) else None
        return pd.DataFrame({"length": [key[0]], "error": [error]})

    parts = distinct.where(F.col("length").isin(list(found))).mapInArrow(run, "length int, n long, mean array<double>, products array<double>")
    return {r["length"]: r["error"] for r in parts.groupBy("length").applyInPandas(total, "length int, error double").collect()}


def _lengths(distinct: DataFrame) -> Iterator[list[int]]:
    """The lengths of one pass after the other."""
    waiting, size = [], 0
    for r in distinct.select("length").distinct().orderBy("length").toLocalIterator():
        if waiting and size + (COMPONENTS + 2) * r["length"] > PER_PASS:
            yield waiting
            waiting, size = [], 0
        waiting.append(r["length"])
        size += (COMPONENTS + 2) * r["length"]
    yield waiting


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """vec_id, component (from 1, by falling variance), n (vectors of the fit), deviation, whitened,
    explained (the component's share of the variance), identity_error and deviation_exact, for
    each row of embeddings(vec_id, embedding) and component."""
    rows = _packed_rows(embeddings, scale)
    distinct = cut(rows.select("length", "x").distinct())
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    out = None
    for lengths in _lengths(distinct):
        found = fits(distinct, lengths, components)
        errors = _identity_errors(distinct, found)

        def run(batches: Iterator[pa.RecordBatch], found=found, errors=errors) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for length, at, x in _by_length(batch):
                    fit = found[length]
                    centred, squares = deviations(x, fit)
                    k, use = len(fit.values), np.flatnonzero(fit.used())
                    w = np.full((len(x), k), np.nan)
                    w[:, use] = whitened(centred, fit)
                    again = lambda v: np.repeat(np.array(v, dtype=object), k)
                    m = len(x) * k
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(np.repeat(at, k))),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                            pa.array(np.full(m, fit.n)),
                            pa.array([v if v <= MOST else None for v in again(squares)], pa.int64()),
                            pa.array(w.ravel(), from_pandas=True),
                            pa.array(np.tile(fit.values / fit.trace if fit.trace else np.zeros(k), len(x))),
                            pa.array([errors[length]] * m, pa.float64()),
                            pa.array([str(v) for v in again(squares)]),
                        ],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                    )

        part = rows.where(F.col("length").isin(lengths)).mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string")
        out = part if out is None else out.unionByName(part)
    return out
