"""Manifests: files that each hold one JSON array of objects, of any size.

No task holds a file. Spark reads it as text that ends at each `}`, so that a file is split where its
bytes are and a fragment is at most what lies between two closing braces. Whether a fragment begins
within a string, and how deep, are running sums of its quotes and braces: within each piece of a
file (its share of bytes) for both answers, then over one row a piece. Fragments up to the return
to depth 0 are an object, and only those meet in one group.

Nothing is believed because of how it was split: each object is parsed strictly, what lies between
objects must be a comma, and the bytes of all fragments must be those of the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.functions.domains import small
from presswork.plans.lineage import cut

PIECE = ["path", "block"]
#: White space between the tokens of JSON.
SPACE = r"[ \t\r\n]*"


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, at, size, value, quotes, even, odd): the text up to each `}`, which is left out, where it
    is, its quotes that no backslash precedes, and the `{` outside strings if it begins outside
    one or within."""
    read = spark.read.option("lineSep", "}").text(path)
    place = [F.input_file_name().alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size")]
    rows = read.select(*place, F.monotonically_increasing_id().alias("at"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    outside = lambda text: _count(F.regexp_replace(text, '"[^"]*"?', ""), "{")
    return rows.select("*", _count(plain, '"').alias("quotes"), outside(plain).alias("even"), outside(F.concat(F.lit('"'), plain)).alias("odd"))


def numbered(rows: DataFrame) -> DataFrame:
    """(path, block, at, n): the object that each fragment belongs to, from 0 in its file."""
    own = Window.partitionBy(*PIECE).orderBy("at")
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    pieces = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    even = lambda c: c % 2 == 0

    def change(first: int) -> Column:
        begins = F.col("quotes_before") + first
        return F.when(even(begins), F.col("even")).otherwise(F.col("odd")) - even(begins + F.col("quotes")).cast("int")

    local = rows.select(*PIECE, "at", "quotes", "even", "odd").withColumn("quotes_before", before("quotes", earlier))
    local = local.withColumns({"if_even": change(0), "if_odd": change(1)})
    each = local.groupBy(*PIECE).agg(*[F.sum(c).alias(c) for c in ("quotes", "if_even", "if_odd")])
    each = each.withColumn("outside", even(before("quotes", pieces))).withColumn("change", F.when(F.col("outside"), F.col("if_even")).otherwise(F.col("if_odd")))
    each = each.select(*PIECE, "outside", before("change", pieces).alias("depth"))
    met = local.join(each, PIECE)
    depth = F.col("depth") + F.sum(F.when(F.col("outside"), F.col("if_even")).otherwise(F.col("if_odd"))).over(own)
    closed = met.select(*PIECE, "at", (depth <= 0).cast("int").alias("closed")).withColumn("n", before("closed", earlier))
    ends = closed.groupBy(*PIECE).agg(F.sum("closed").alias("ends")).select(*PIECE, before("ends", pieces).alias("ends"))
    return closed.join(ends, PIECE).select(*PIECE, "at", (F.col("n") + F.col("ends")).alias("n"))


def is_object(text: Column) -> Column:
    """Whether text, which begins with `{`, is one JSON object in UTF-8 by the letter: double quotes, no
    comments, no trailing commas."""
    strict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false"}
    return F.is_valid_utf8(text) & F.from_json(text, "bad string", strict)["bad"].isNull()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, item, error): each object of JSON-array files as its own text and its number in the
    array. A file that is broken anywhere (cut short, empty, other elements than objects, a trailing
    comma, more data, a byte order mark, compressed) gives one row with its error and no items. A task's memory is
    bounded by the largest object."""
    # a scan skips empty files; their names are in the listing, which the driver holds for any scan
    names = spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "path string")
    return objects(cut(fragments(spark, path)), names)


def objects(rows: DataFrame, names: DataFrame) -> DataFrame:
    """What ``manifests`` says of the fragments of the files names(path)."""
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    whole = rows.join(numbered(rows), [*PIECE, "at"]).groupBy("path", "n").agg(
        F.array_join(F.transform(pieces, lambda x: x["value"]), "}").alias("text"), F.sum(F.octet_length("value") + F.lit(1)).alias("bytes"), F.max("size").alias("size"))
    opens = F.instr("text", "{")
    item = F.when(opens > 0, F.concat(F.expr("substring(text, instr(text, '{'))"), F.lit("}")))
    between = F.when(opens > 0, F.substring_index("text", "{", 1)).otherwise(F.col("text"))
    first, close = F.col("n") == 0, F.when(F.col("item").isNull(), r"\]" + SPACE).otherwise("")
    wanted = F.concat(F.lit("^" + SPACE), F.when(first, r"\[" + SPACE).otherwise(F.when(F.col("item").isNull(), "").otherwise("," + SPACE)), close, F.lit(r"\z"))
    held = whole.select("path", "n", "bytes", "size", item.alias("item"), between.alias("between"))
    held = cut(held.withColumn("fine", F.regexp_like("between", wanted) & (F.col("item").isNull() | is_object(F.col("item")))).drop("between"))

    each = held.groupBy(F.col("path").alias("_path")).agg(
        F.min(F.when(~F.col("fine"), F.col("n"))).alias("bad"), F.max("n").alias("last"), F.max(F.when(F.col("item").isNull(), F.col("n"))).alias("tail"),
        (F.sum("bytes") - 1 != F.max("size")).alias("more"))
    error = (
        F.when(F.col("last").isNull(), "the file is empty").when(F.col("bad").isNotNull(), F.concat(F.lit("no array of objects, from element "), F.col("bad").cast("string")))
        .when(F.col("tail").isNull() | (F.col("tail") < F.col("last")), "the file ends within the array").when(F.col("more"), "data outside the array, or compressed"))
    broken = cut(names.join(each, F.col("path") == F.col("_path"), "left").select("path", error.alias("error")).where("error is not null"))
    items = held.where("item is not null").join(small(broken.select("path")), "path", "left_anti")
    return items.select("path", "n", "item", F.lit(None).cast("string").alias("error")).unionByName(broken.select("path", F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("item"), "error"))


def write_manifests(rows: DataFrame, folder: str, file: Column, order: list[str]) -> None:
    """Write rows as JSON arrays of objects, one for each value of `file`, in the given order: files
    below folder/file=<value>. Fields that are null are left out."""
    held = rows.select(file.cast("string").alias("file"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.to_json(F.struct(*rows.columns)).alias("value"))
    keys = [f"_o{i}" for i in range(len(order))]
    own = Window.partitionBy("file").orderBy(*keys)
    held = held.withColumns({"_n": F.row_number().over(own), "_next": F.lead(F.lit(1)).over(own)})
    text = F.concat(F.when(F.col("_n") == 1, "[").otherwise(","), F.col("value"), F.when(F.col("_next").isNull(), "]").otherwise(""))
    held.select("file", "_n", text.alias("value")).sortWithinPartitions("file", "_n").select("file", "value").write.mode("overwrite").partitionBy("file").text(folder)
