"""Running values over ordered events whose keys may be hot.

A window by key alone puts a key's events in one task. Here a key's order is cut into pieces
(the days of its time, or what else is given), each piece is worked on by itself, and what
the pieces before it hand on is a window over one row a piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(events: DataFrame, key: str, order: list[str], piece: Column, handed: dict[str, Column]) -> DataFrame:
    """events with _piece, _n (the position in the piece), _before (the rows of the key's
    pieces before) and, for each of `handed`, which is an aggregate of a piece's _n, its
    maximum over the pieces before as a position in the whole key."""
    inside = Window.partitionBy(key, "_piece").orderBy(*order)
    rows = events.withColumn("_piece", piece).withColumn("_n", F.row_number().over(inside).cast("long"))
    each = rows.groupBy(F.col(key).alias("_key"), F.col("_piece").alias("_own")).agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(name) for name, c in handed.items()])
    before = Window.partitionBy("_key").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    each = each.withColumns({name: F.max(F.col(name) + F.col("_before")).over(before) for name in handed}).drop("_rows")
    return rows.join(each, F.col(key).eqNullSafe(F.col("_key")) & F.col("_piece").eqNullSafe(F.col("_own")), "left").drop("_key", "_own")
