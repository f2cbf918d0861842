"""Pacing of hosts and leases of articles over logs of events, as window functions.

Each rule has a closed form over the ordered events of a key, so nothing is replayed row by
row. All times are microseconds as longs. Requests whose grants depend on earlier grants, and
leases that run out without an event, are in ``expiry``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.operators.collection import streaks
from presswork.plans.lineage import cut

#: Earlier than any time, and still so with any spacing added.
NEVER = -(2**62)


def starts(requests: DataFrame, key: str, time: Column, order: list[str], spacing: int) -> DataFrame:
    """requests with start and wait: a host's requests begin in order, each when it comes or
    `spacing` after the start before it. The n-th start is the largest of t_j + (n - j) *
    spacing over the requests j up to it: a running maximum (T8)."""
    by_key = Window.partitionBy(key).orderBy(*order)
    rows = requests.withColumn("_t", time).withColumn("_n", F.row_number().over(by_key).cast("long"))
    ahead = F.max(F.col("_t") - F.col("_n") * spacing).over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("start", ahead + F.col("_n") * spacing)
    return rows.withColumn("wait", F.col("start") - F.col("_t")).drop("_t", "_n")


def _after(rows: list[np.ndarray], t: int, spacing: int, hold: int) -> np.ndarray:
    """The row of the next start from those of the last starts, newest first, and the constant's."""
    *starts, fixed = rows
    return np.maximum(np.maximum(starts[0] + spacing, starts[-1] + hold), fixed + t)


def permits(requests: DataFrame, key: str, time: Column, order: list[str], spacing: int, hold: int = 0, capacity: int = 1, piece: Column | None = None) -> DataFrame:
    """requests with start and wait: a host's requests begin in order, each when it comes, when
    `spacing` has passed since the start before it and when fewer than `capacity` of the
    permits that last for `hold` from their start are out (T8).

    A start is the largest of sums, so what a request does to the last `capacity` starts is a matrix
    of the max-plus algebra, and what a piece of a host's requests does is the product of theirs. Pieces
    (the days of `time`, if not given) are multiplied out by themselves, a host's products are taken in
    order, a row a piece, and each piece then works out its starts from those it begins with."""
    rows = requests.withColumn("_t", time)
    rows = rows.withColumn("_piece", F.floor(F.col("_t") / 86_400_000_000) if piece is None else piece)
    c = capacity

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for batch in batches:
            done = []
            for *own, t in zip(batch["k"], batch["p"], batch["_t"].tolist(), strict=True):
                if own != now:
                    if now is not None:
                        done.append((*now, np.concatenate(held).tolist()))
                    now, held = own, [np.where(np.arange(c + 1) == i, 0, NEVER) for i in range(c + 1)]
                held = [np.maximum(_after(held, t, spacing, hold), NEVER), *held[: c - 1], held[c]]
            yield pd.DataFrame(done, columns=["k", "p", "m"])
        if now is not None:
            yield pd.DataFrame([(*now, np.concatenate(held).tolist())], columns=["k", "p", "m"])

    def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = [], None
        for batch in batches:
            out = []
            for k, m in zip(batch["k"], batch["m"], strict=True):
                if [k] != now:
                    now, state = [k], np.array([NEVER] * c + [0])
                out.append(state[:c].tolist())
                state = np.maximum((np.array(m).reshape(c + 1, c + 1) + state).max(axis=1), NEVER)
            yield batch[["k", "p"]].assign(v=out)

    def started(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for batch in batches:
            out = []
            for *own, t, v in zip(batch["_k"], batch["_piece"], batch["_t"].tolist(), batch["_v"], strict=True):
                if own != now:
                    now, held = own, list(v)
                held = [max(t, held[0] + spacing, held[-1] + hold), *held[: c - 1]]
                out.append(held[0])
            yield batch[names].assign(start=out)

    def sorted_by(df: DataFrame, *keys: str) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, *[x for x in order if x in df.columns])

    narrow = rows.select(F.col(key).alias("k"), F.col("_piece").alias("p"), "_t", *[x for x in order if x not in ("k", "p", "_t")])
    kinds = ", ".join(f"{n} {t}" for n, t in narrow.dtypes[:2])
    products = sorted_by(narrow, "k", "p").mapInPandas(product, f"{kinds}, m array<long>")
    begin = cut(products.repartition("k").sortWithinPartitions("k", "p").mapInPandas(entered, f"{kinds}, v array<long>")).toDF("_k", "_p", "_v")
    names = [n for n in rows.columns if n != "_piece"]
    met = rows.join(begin, F.col(key).eqNullSafe(F.col("_k")) & F.col("_piece").eqNullSafe(F.col("_p")), "left").drop("_p")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "_piece")
    out = sorted_by(met, "_k", "_piece").mapInPandas(started, f"{schema}, start long")
    return out.withColumn("wait", F.col("start") - F.col("_t")).drop("_t")


def delays(responses: DataFrame, key: str, failed: Column, order: list[str], base: int, most: int) -> DataFrame:
    """responses with failures (how many failed in a row up to this one) and the delay that
    follows: base, doubled for each of them, `most` at most (T9)."""
    rows = streaks(responses, key, failed, order).withColumnRenamed("streak", "failures")
    return rows.withColumn("delay", F.least(F.lit(float(most)), base * F.pow(F.lit(2.0), F.least(F.col("failures"), F.lit(60)))))


def leases(events: DataFrame, key: str, time: Column, order: list[str], lasts: int) -> DataFrame:
    """A log of granted events(kind, owner) with holder and ok: an audit of leases (T4). An
    article is held by the owner of its last claim or release if that was a claim that came
    less than `lasts` before. ok tells what the rule allows: a claim where nobody else holds
    the article, any other event where its owner does."""
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    mark = F.when(F.col("kind").isin("claim", "release"), F.struct("kind", "owner", time.alias("t")))
    last = F.last(mark, ignorenulls=True).over(before)
    rows = events.withColumn("_last", last)
    live = (F.col("_last.kind") == "claim") & (time - F.col("_last.t") < lasts)
    rows = rows.withColumn("holder", F.when(live, F.col("_last.owner")))
    ok = F.when(F.col("kind") == "claim", F.col("holder").isNull() | (F.col("holder") == F.col("owner"))).otherwise(F.coalesce(F.col("holder") == F.col("owner"), F.lit(False)))
    return rows.withColumn("ok", ok).drop("_last")
