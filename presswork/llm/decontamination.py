"""Benchmark decontamination: a broadcast hash set of the benchmark's normalised n-grams, the
documents' token windows looked up in it, hits verified, spans or documents removed.

A-Z is lower-cased and words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ (digits, a-z and all that is not
ASCII). An item's windows are its runs of N words; an item of fewer words, but not none, is one
window. A document's word is hit if any occurrence of a window holds it.

One scan of the documents hashes each word once and each window from its words' hashes, and
keeps the windows whose hash is in the broadcast set, so that nothing but hits and one row a
document leaves it. Hits meet the windows again by hash and words, which excludes
collisions. Windows are folded before hits are joined: those that the same items share stand for
one class of items, and a document meets each class once, so a passage that many items and many
documents share costs no product of the two. The set is broadcast in passes of PER_PASS hashes,
which bounds it; more windows take more scans.

Rows with one doc_id and one text are one row with a count until the end; where the count is large
they are dealt out again before they are repeated.

Defined cases: null, empty and wordless texts hit nothing, and null, empty and wordless items have
no windows; an item_id that repeats is one item with the windows of all its texts; a null item_id
counts as the empty text; a null doc_id is an id like any other; rows that repeat give a row
each; an empty table of documents gives an empty result and an empty benchmark no hits; other
columns are ignored by ``report`` and returned untouched by ``remove``, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.base import repeated
from presswork.plans.lineage import cut

N = 10
#: Hashes of windows that one scan looks for.
PER_PASS = 2_000_000
#: Windows, counted with each of their items, up to which they are broadcast to verify hits.
BROADCAST = 200_000
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word with what stands before it, or the end of a text, before lower-casing.
PIECES = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    # lower() gives the same as translate() where all is ASCII, in less time
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), GAPS), "")


def _hashes(w: str) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _window(hashes: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + k) for k in range(size)])


def windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(h, size, gram, class) for each distinct window, and by class the items that have it:
    (class, item)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text").cast("string")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
    each = items.select("item", "w", F.explode(starts).alias("p")).select("item", F.slice("w", F.col("p") + 1, n).alias("g")).where(F.size("g") > 0)
    grams = each.select("item", F.size("g").alias("size"), F.array_join("g", " ").alias("gram")).distinct()
    by_gram = grams.groupBy("size", "gram").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return by_gram.withColumn("class", F.sha2(F.to_json("items"), 256))


def _gram_hash(size: int) -> Column:
    return F.when(F.col("size") == size, F.xxhash64(*[F.xxhash64(F.get(F.split("gram", " "), F.lit(k))) for k in range(size)]))


def _scan(docs: DataFrame, grams: DataFrame, sizes: list[int], lone: bool) -> DataFrame:
    """(id, text_key, n_words, p, size, h, gram) for windows whose hash is among grams(h) and, if
    lone, a row with p = -1 for each document."""
    text = F.col("text").cast("string")
    cut_up = docs.select(F.col("doc_id").alias("id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_key"), words(text).alias("w"))
    hashed = cut_up.select("id", "text_key", "w", _hashes("w").alias("x"))
    least = F.lit(-1 if lone else 0)
    at = hashed.select("id", "text_key", "w", "x", F.explode(F.sequence(least, F.greatest(F.size("x") - min(sizes, default=N), least))).alias("p"))
    # a window past the end of the text has the hash of a shorter one, but not its size
    p, values = F.col("p"), [F.struct(F.lit(s).alias("size"), _window("x", F.col("p"), s).alias("h")) for s in sizes]
    alone = F.struct(F.lit(0).alias("size"), F.lit(0).cast("long").alias("h"))
    if len(values) == 1:
        one = at.select("id", "text_key", "w", "x", "p", *[F.when(p < 0, alone[c]).otherwise(values[0][c]).alias(c) for c in ("size", "h")])
    else:
        each = F.explode(F.when(p < 0, F.array(alone)).otherwise(F.array(*values or [alone]))).alias("v")
        one = at.select("id", "text_key", "w", "x", "p", each).select("id", "text_key", "w", "x", "p", "v.size", "v.h")
    met = one.join(F.broadcast(grams.select("h").distinct()), "h", "left_semi")
    gram = F.when(F.col("p") >= 0, F.array_join(F.slice("w", F.col("p") + 1, F.col("size")), " "))
    return met.select("id", "text_key", F.size("w").cast("long").alias("n_words"), "p", "size", "h", gram.alias("gram"))


def _spans(at: str) -> Column:
    """The stretches (start, end) of the numbers in the array `at`."""
    after = F.transform(at, lambda x: x + 1)
    return F.arrays_zip(F.array_sort(F.array_except(at, after)).alias("start"), F.array_sort(F.array_except(after, at)).alias("end"))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N) -> tuple[DataFrame, DataFrame]:
    """Two tables by (id, text_key), the text's SHA-256: a row for each text of an id with its copies,
    n_words and spans (the hit words as (start, end) without overlaps); and a row for each item
    that it holds a window of."""
    spark = docs.sparkSession
    sized = cut(windows(benchmark, n))
    sizes = sorted(r["size"] for r in sized.select("size").distinct().collect())  # n values at most
    sized = sized.withColumn("h", F.coalesce(*[_gram_hash(s) for s in sizes]) if sizes else F.lit(0).cast("long"))
    total = sized.agg(F.sum(F.size("items"))).first()[0] or 0  # windows with each of their items
    passes = max(1, -(-sized.count() // PER_PASS))
    lone = spark.createDataFrame([(0,)], "h long")
    found = []
    for k in range(passes):
        mine = sized.where(F.pmod("h", F.lit(passes)) == k).select("h") if passes > 1 else sized.select("h")
        found.append(_scan(docs, mine.union(lone) if k == 0 else mine, sizes, k == 0))
    met = cut(reduce(DataFrame.unionByName, found))
    known = sized.select("h", "size", "gram", "class")
    known = F.broadcast(known) if total <= BROADCAST else known
    hits = met.where("p >= 0").join(known, ["h", "size", "gram"]).select("id", "text_key", "n_words", "p", "size", "class")
    rows = met.where("p < 0").select("id", "text_key", "n_words", "p", "size", F.lit(None).cast("string").alias("class")).unionByName(hits)
    span = F.when(F.col("p") >= 0, F.struct("p", "size"))
    each = rows.groupBy("id", "text_key").agg(F.max("n_words").alias("n_words"), F.count_if(F.col("p") < 0).alias("copies"), F.collect_set(span).alias("s"), F.collect_set("class").alias("classes"))
    each = each.withColumn("at", F.array_distinct(F.flatten(F.transform("s", lambda x: F.sequence(x["p"], x["p"] + x["size"] - 1)))))
    each = cut(each.select("id", "text_key", "n_words", "copies", _spans("at").alias("spans"), "classes"))
    classes = sized.select("class", "items").dropDuplicates(["class"])
    classes = F.broadcast(classes) if total <= BROADCAST else classes
    items = each.select("id", "text_key", F.explode("classes").alias("class")).join(classes, "class").select("id", "text_key", F.explode("items").alias("item")).distinct()
    return each.drop("classes"), items


def report(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256 (of the items' ids,
    sorted as texts and joined by commas) and contaminated."""
    each, items = contaminated(docs, benchmark, n)
    ids = items.groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_text")).agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("ids"))
    joined = each.join(ids, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text")), "left")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    out = joined.select("id", "text_key", "copies", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"))
    return repeated(out, "copies", ["id", "text_key"], each.select("copies")).select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, whole: bool = False, n: int = N) -> DataFrame:
    """docs without what the benchmark contaminates, all columns as they were: whole documents, or the
    hit words with what stands before each of them."""
    text = F.col("d.text").cast("string")
    each, _ = contaminated(docs, benchmark, n)
    bad = each.where(F.size("spans") > 0).select("id", "text_key", "spans")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("d")).withColumn("k", F.sha2(F.coalesce(text, F.lit("")), 256))
    same = F.col("d.doc_id").eqNullSafe(F.col("id")) & (F.col("k") == F.col("text_key"))
    if whole:
        return packed.join(bad, same, "left_anti").select("d.*")
    pieces = F.when(F.col("text_key").isNotNull(), F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)))
    joined = packed.join(bad, same, "left").withColumn("pieces", pieces)
    # what lies between the spans: a piece for each word, and perhaps one for the end of the text
    begin, end = F.concat(F.array(F.lit(0)), F.col("spans.end")), F.concat(F.col("spans.start"), F.array(F.size("pieces")))
    between = F.zip_with(begin, end, lambda b, e: F.array_join(F.slice("pieces", b + 1, e - b), ""))
    kept = F.when(F.col("pieces").isNull(), text).otherwise(F.array_join(between, ""))
    return joined.select(*[(kept.cast(f.dataType) if f.name == "text" else F.col("d").getField(f.name)).alias(f.name) for f in docs.schema])


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda x: x <> '') AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), {N}) AS size, array_to_string(w[i:i+{N - 1}], ' ') AS gram FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - {N - 1}, 1))) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT size FROM g),
p AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d CROSS JOIN s WHERE len(w) >= size)),
h AS (SELECT r, i, size, item FROM p JOIN g USING (size, gram)),
n AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS x FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
