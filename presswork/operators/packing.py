"""Greedy packing of ordered rows into bounded, content-addressed parts, a hot key in pieces.

A part takes the rows of its key in order until it has max_rows or the next row would exceed
max_bytes; a row that exceeds them alone is a part. Where a part begins depends on all parts
before it, yet no task reads a key from end to end:

* rows are dealt by ranges of (key, order), sorted and numbered; a key's share of a range is a
  piece. Sizes alone, without the rows, are looked at from here on;
* for each row at which a part may first begin in a piece (within max_rows and max_bytes of its
  start), the piece says where the last part that begins inside it does, and the first part
  after that begins in a later piece: pointers from entry to entry;
* pointers are doubled, which marks the entries that lead on from each key's first row in as
  many rounds as the logarithm of its pieces;
* with its entry each piece cuts its own rows, and rows meet in their part.

What depends on the number of pieces alone (at most two rows a range, for keys in several) is
collected and broadcast; nothing that grows with the rows is.

Defined cases: a null key is a key; rows that tie on the order are ordered by their text; an
empty table has no parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

#: Rows of a piece that share one list of the parts that begin among them.
BLOCK = 512
#: Rows of a part where only its bytes are bounded.
NO_ROWS = 2**40


def value(c: Column) -> Column:
    """A column as a JSON value."""
    text = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(6), F.length(text) - 6)


def line(columns: list[str]) -> Column:
    """A row as a JSON array of its values."""
    return F.concat(F.lit("["), F.concat_ws(",", *[value(F.col(c)) for c in columns]), F.lit("]"))


def jumps(before: np.ndarray, size: np.ndarray, max_rows: int, max_bytes: int) -> np.ndarray:
    """For each row the one at which the next part begins if a part begins at it; len(size) where
    that is beyond them. before: bytes of the rows before each."""
    at = np.arange(len(size))
    over = np.searchsorted(before + size, before + max_bytes, side="right")
    return np.maximum(at + 1, np.minimum(over, at + max_rows))


def _numbered(lines: DataFrame) -> DataFrame:
    """lines(k, key, line, size), sorted, with piece, i (the row in the piece) and before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last, rows, held = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            k, size, at = batch.column("k"), batch.column("size").to_numpy(), np.arange(m)
            first = np.concatenate(([k[0].as_py() != last], pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)))
            begin = np.maximum.accumulate(np.where(first, at, -1))
            sums = np.cumsum(size) - size
            i = np.where(begin < 0, rows + at, at - begin)
            before = np.where(begin < 0, held + sums, sums - sums[np.maximum(begin, 0)])
            last, rows, held = k[m - 1].as_py(), int(i[-1]) + 1, int(before[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(m, piece, np.int32)), pa.array(i), pa.array(before)], [*batch.schema.names, "piece", "i", "before"])

    return lines.mapInArrow(run, f"{', '.join(f'{c} {t}' for c, t in lines.dtypes)}, piece int, i long, before long")


def _entries(placed: DataFrame, several: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """(k, piece, g, end, s, parts, to, at, lim, cap) for each row g of a key at which a part may
    first begin in a piece: the last part in the piece begins at s, after `parts` of them; the
    next one at `to`, or where it is left open, in the piece `at` at the first row whose end is
    beyond lim bytes, at row cap at the latest. Rows and bytes are counted from the key's start."""
    known: dict[str, list] = {}
    for r in several.orderBy("k", "piece").collect():  # at most two rows a range
        known.setdefault(r["k"], []).append((r["piece"], r["row_start"], r["byte_start"] + r["bytes"], r["rows"]))
    shared = placed.sparkSession.sparkContext.broadcast({k: [np.array(x) for x in zip(*v, strict=True)] for k, v in known.items()})

    def run(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("i")
        pieces, row_start, byte_end, rows = shared.value[key[0]]
        own = int(np.flatnonzero(pieces == key[1])[0])
        total = int(row_start[-1] + rows[-1])
        start, at_byte = int(row_start[own]), int(byte_end[own] - found["size"].sum())
        before, size = found["before"].to_numpy(), found["size"].to_numpy()
        m = len(size)
        following = jumps(before, size, max_rows, max_bytes).tolist()
        last, parts = list(range(m)), [1] * m
        for i in range(m - 1, -1, -1):
            if following[i] < m:
                last[i], parts[i] = last[following[i]], parts[following[i]] + 1
        out = []
        for i in range(1 if own == 0 else min(m, max_rows)):
            if before[i] > max_bytes:
                break
            s = last[i]
            lim, cap = at_byte + int(before[s]) + max_bytes, start + s + max_rows
            full, capped = int(np.searchsorted(byte_end, lim, side="right")), int(np.searchsorted(row_start, cap, side="right")) - 1 if cap < total else len(pieces)
            if full <= own:  # the row alone is too large
                to, at = start + s + 1, None
            elif capped < full:
                to, at = cap, None
            elif full == len(pieces):
                to, at = total, None
            else:
                to, at = None, int(pieces[full])
            out.append((key[0], key[1], start + i, at_byte + int(before[i] + size[i]), start + s, parts[i], None if to is None or to >= total else to, at, lim, cap))
        frame = pd.DataFrame(out, columns=["k", "piece", "g", "end", "s", "parts", "to", "at", "lim", "cap"])
        return frame.astype({"to": "Int64", "at": "Int32"})

    narrow = placed.select("k", "piece", "i", "before", "size").join(F.broadcast(several.select("k").distinct()), "k", "left_semi")
    return narrow.groupBy("k", "piece").applyInPandas(run, "k string, piece int, g long, end long, s long, parts long, to long, at int, lim long, cap long")


def _resolved(entries: DataFrame) -> DataFrame:
    """(k, g, to) of all entries that lead on."""
    asked = entries.where("at is not null").select("k", "at", F.lit(None).cast("long").alias("g"), F.lit(None).cast("long").alias("end"), "s", "lim", "cap").distinct()
    none = F.lit(None).cast("long")
    region = entries.select("k", F.col("piece").alias("at"), "g", "end", none.alias("s"), none.alias("lim"), none.alias("cap"))

    def run(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        rows, asks = found[found["s"].isna()].sort_values("g"), found[found["s"].notna()]
        g, end = rows["g"].to_numpy(np.int64), rows["end"].to_numpy(np.int64)
        s, lim, cap = (asks[c].to_numpy(np.int64) for c in ("s", "lim", "cap"))
        place = np.searchsorted(end, lim, side="right")
        over = np.where(place < len(g), g[np.minimum(place, len(g) - 1)], cap) if len(g) else cap
        return pd.DataFrame({"k": key[0], "s": s, "found": np.minimum(np.maximum(over, s + 1), cap)})

    found = region.unionByName(asked).groupBy("k", "at").applyInPandas(run, "k string, s long, found long")
    return entries.join(found, ["k", "s"], "left").select("k", "g", F.coalesce("to", F.when(F.col("at").isNotNull(), F.col("found"))).alias("to")).where("to is not null")


def _visited(entries: DataFrame, several: DataFrame) -> DataFrame:
    """(k, g) of the entries that lead on from each key's first row."""
    most = several.groupBy("k").count().agg(F.max("count")).first()[0] or 1
    pointer = cut(_resolved(entries))
    reached = several.select("k").distinct().withColumn("g", F.lit(0).cast("long"))
    for _ in range(math.ceil(math.log2(most))):
        reached = cut(reached.unionByName(reached.join(pointer, ["k", "g"]).select("k", F.col("to").alias("g"))).distinct())
        onward = pointer.select("k", F.col("g").alias("to"), F.col("to").alias("then"))
        pointer = cut(pointer.join(onward, ["k", "to"]).select("k", "g", F.col("then").alias("to")))
    return reached


def _blocks(placed: DataFrame, entered: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """(k, piece, block, starts, carry) for each BLOCK rows of a piece: the rows among them at which
    parts begin, and the number of the part that goes on at their first row."""

    def run(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("i")
        following = jumps(found["before"].to_numpy(), found["size"].to_numpy(), max_rows, max_bytes).tolist()
        entry, carry = found["entry"].iloc[0], int(found["passed"].iloc[0]) - 1
        m, starts = len(following), []
        i = m if pd.isna(entry) else int(entry)
        while i < m:
            starts.append(i)
            i = following[i]
        blocks = [[] for _ in range(-(-m // BLOCK))]
        for i in starts:
            blocks[i // BLOCK].append(i)
        carries = carry + np.cumsum([0, *map(len, blocks)])[:-1]
        return pd.DataFrame({"k": key[0], "piece": key[1], "block": range(len(blocks)), "starts": blocks, "carry": carries})

    rows = placed.select("k", "piece", "i", "before", "size").join(entered, ["k", "piece"])
    return rows.groupBy("k", "piece").applyInPandas(run, "k string, piece int, block long, starts array<long>, carry long")


def numbered_parts(lines: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """lines(k, key, line, size), sorted within ranges of the whole order, with piece, i and part."""
    placed = cut(_numbered(lines))
    totals = cut(placed.groupBy("k", "piece").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")))
    by_key = totals.groupBy("k").agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1").select("k")
    some = totals.join(by_key, "k")
    order = Window.partitionBy("k").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    several = cut(some.withColumns({"row_start": F.coalesce(F.sum("rows").over(order), F.lit(0)), "byte_start": F.coalesce(F.sum("bytes").over(order), F.lit(0))}))
    alone = totals.join(by_key, "k", "left_anti").select("k", "piece", F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("passed"))
    if several.isEmpty():
        entered = alone
    else:
        entries = cut(_entries(placed, several, max_rows, max_bytes))
        visited = _visited(entries, several).join(entries, ["k", "g"]).select("k", "piece", "g", "parts")
        each = several.join(visited, ["k", "piece"], "left")
        passed = F.coalesce(F.sum(F.coalesce("parts", F.lit(0))).over(order), F.lit(0))
        entered = alone.unionByName(each.select("k", "piece", (F.col("g") - F.col("row_start")).alias("entry"), passed.alias("passed")))
    blocks = cut(_blocks(placed, entered, max_rows, max_bytes))
    rows = placed.withColumn("block", F.floor(F.col("i") / BLOCK)).join(blocks, ["k", "piece", "block"])
    begun = F.size(F.filter("starts", lambda x: x <= F.col("i")))
    return rows.select("k", "key", "piece", "i", "line", (F.col("carry") + begun).alias("part"))


def packed(rows: DataFrame, key: str, order: list[str], max_rows: int | None, max_bytes: int, pieces: int | None = None) -> DataFrame:
    """(key, part, rows, bytes, sha256, body) of the ordered rows of each key: JSON objects of the
    key, the other columns' names (`fields`) and `rows` of their values. max_bytes bounds the
    rows' text with a comma each; bytes is the whole body's. pieces: how many ranges the rows
    are dealt into, by default as many as the session shuffles into."""
    fields = [c for c in rows.columns if c != key]
    kept = rows.select(F.to_json(F.struct(F.col(key).alias("k"))).alias("k"), F.col(key).alias("key"), *[F.col(c).alias(f"o{n}") for n, c in enumerate(order)], line(fields).alias("line"))
    by = ["k", *[f"o{n}" for n in range(len(order))], "line"]
    dealt = kept.repartitionByRange(pieces, *by) if pieces else kept.repartitionByRange(*by)
    lines = dealt.sortWithinPartitions(*by).select("k", "key", "line", (F.octet_length("line") + 1).cast("long").alias("size"))
    parts = numbered_parts(lines, max_rows or NO_ROWS, max_bytes)
    each = parts.groupBy("k", "part").agg(F.first("key").alias("key"), F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list(F.struct("piece", "i", "line"))).alias("x"))
    head = F.concat(F.lit(f'{{"{key}":'), value(F.col("key")), F.lit(',"fields":["' + '","'.join(fields) + '"],"rows":['))
    body = F.concat(head, F.array_join(F.transform("x", lambda x: x["line"]), ","), F.lit("]}"))
    made = each.select("key", "part", "rows", F.explode(F.array(body)).alias("body"))
    return made.select(F.col("key").alias(key), F.col("part").cast("long").alias("part"), "rows", F.octet_length("body").cast("long").alias("bytes"), F.sha2("body", 256).alias("sha256"), "body")
