"""Sources of the news corpus: positional JSON caches, checkpoints, bounded gzip. Manifests are in
``arrays``."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXTS = T.ArrayType(T.StringType())


def json_cache(spark: SparkSession, path: str, arrays: tuple[str, ...] = ("countries", "specific_location_countries", "places"), expected: int | None = None, rows_of: dict[str, int] | None = None) -> DataFrame:
    """Rows of cache parts {country, fields, rows}: columns by the header, arrays of text
    where told. Parts that disagree on their fields, a total other than expected, or a part
    that has not the rows that rows_of (by file name) gives for it, are refused."""
    # a row's values are texts or arrays: both are kept as JSON and read by column
    parts = spark.read.option("wholetext", True).text(path)
    heads = parts.select(F.from_json("value", "country string, fields array<string>").alias("h")).select("h.*").distinct().limit(3).collect()
    if len({tuple(h["fields"]) for h in heads}) != 1:
        raise ValueError("cache parts have different fields")
    fields = heads[0]["fields"]
    body = parts.select(F.from_json("value", "country string, rows array<array<string>>").alias("p")).select("p.country", F.explode("p.rows").alias("r"))
    out = body.select("country", *[F.from_json(F.get("r", F.lit(i)), TEXTS).alias(f) if f in arrays else F.get("r", F.lit(i)).alias(f) for i, f in enumerate(fields)])
    if expected is not None and (n := out.count()) != expected:
        raise ValueError(f"the cache has {n} rows, its manifest {expected}")
    if rows_of is not None:
        sizes = parts.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.size(F.from_json("value", "rows array<string>")["rows"]).alias("n"))
        found = {r["file"]: r["n"] for r in sizes.collect()}  # a row for each part of the manifest
        if wrong := sorted(f for f in rows_of.keys() | found.keys() if rows_of.get(f) != found.get(f)):
            raise ValueError(f"parts with other rows than the manifest's: {wrong[:5]}")
    return out


def append_checkpoints(rows: DataFrame, path: str) -> None:
    """Add rows to the JSON lines at path."""
    rows.write.mode("append").json(path)


def checkpoints(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, compressed or not; unknown fields and blank lines are ignored."""
    return spark.read.schema(schema).json(path)


def bounded_texts(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """(path, text, error) of files whose contents are limit bytes at most. Gzip files may have
    several members and zero bytes after each; one that ends early or is broken is an error, and
    files without gzip's first bytes are read as they are. Larger ones are reported, and not unpacked beyond the
    limit."""

    def unpacked(content: bytes) -> bytes:
        if content[:2] != b"\x1f\x8b":
            return content[: limit + 1]
        parts, size, rest = [], 0, content
        while rest and size <= limit:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(rest, limit + 1 - size))
            size += len(parts[-1])
            if size <= limit and not member.eof:
                raise ValueError("the file ends within a member")
            rest = member.unused_data.lstrip(b"\0")  # files may be padded
        return b"".join(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    data = unpacked(bytes(content))
                    rows.append((p, None, "larger than the limit") if len(data) > limit else (p, data.decode("utf-8", "replace"), None))
                except (zlib.error, ValueError) as e:
                    rows.append((p, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string, error string")
