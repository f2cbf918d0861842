"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

A text is the set of its SHINGLE-word shingles (lower case, words between runs of
[\\x20\\x09-\\x0D]; a text of fewer words is one shingle). Rows with equal sets are a
class and are handled once. In each trie of the forest a class has a label, its MinHash
values under that trie's functions, and classes whose labels share a prefix are a node.

How long a prefix two classes must share adapts to the neighbourhood. The shortest one is the
greatest depth at which TREES tries let two sets of similarity `threshold` meet with
probability `recall` (1 - (1 - threshold**d)**TREES); pairs that are more alike meet more
surely. Where classes that meet there hang together in a group of more than `chunk`, which
passages that many texts share bring about, its classes are placed anew by prefixes DEEPER
times as long, in as many more tries as the same recall takes, and only those that meet
there stay candidates. Longer prefixes hold few classes that are not alike; recall stays
what it was, and sparse neighbourhoods never pay for the long labels.

Candidates are not spelled out as pairs: each is tied to its node's first class, the ties'
components are found, and a component's shingle sets (made once, 64-bit hashes) meet in one
task, or in a task for each pair of its chunks if it has more than `chunk` classes or
CHUNK_BYTES of sets. There every pair that shares a node is verified by its exact Jaccard
similarity. Tasks report how many links each class has and a spanning forest of them, so a
group of n near copies yields n rows for each of its chunks, not n * n, and no link is lost.
A task holds two chunks: at most 2 * CHUNK_BYTES of sets, or one text's that is longer.

Defined cases: null and empty texts have no shingles and link to nothing, as do rows with
a null doc_id (class null); rows that repeat are copies of one class; ties need no order:
a class's and a group's id is its smallest doc_id; an empty table gives an empty result;
other columns are ignored by ``links`` and returned untouched by ``keep_one``. Shingles
are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.base import small_batches
from presswork.plans.components import components
from presswork.plans.lineage import cut

SHINGLE, THRESHOLD, TREES, DEEPEST, RECALL, CHUNK = 5, 0.8, 24, 8, 0.999, 1024
#: How much longer the prefixes of crowded neighbourhoods are, and bytes of sets in a chunk.
DEEPER, CHUNK_BYTES = 2, 64 << 20

_PLACES = np.random.default_rng(3).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)


@lru_cache(4)
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """What n hash functions flip and multiply by."""
    seeds = np.random.default_rng(20240607).integers(1, 2**32, size=(n, 2), dtype=np.uint64).astype(np.uint32)
    return seeds[:, :1], seeds[:, 1:] | np.uint32(1)


def depth(threshold: float = THRESHOLD, trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL) -> int:
    """The longest common prefix at which pairs at the threshold are met with the recall."""
    d = deepest
    while d > 1 and 1 - (1 - threshold**d) ** trees < recall:
        d -= 1
    return d


def trees(d: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """How many tries prefixes of length d take for the recall of pairs at the threshold."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**d)) if threshold < 1 else 1


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    total = np.zeros(n, np.uint64)
    for j in range(min(width, len(h))):
        total += h[j : j + n] * _PLACES[j]
    return np.unique(_mixed(total))


def nodes(sets: np.ndarray, d: int, count: int = TREES) -> np.ndarray:
    """The node of a set in each of count tries at depth d."""
    folded = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    flip, times = _functions(count * d)
    least = np.full(len(flip), 0xFFFFFFFF, np.uint32)
    step = max(64, (2048 * 144) // len(flip))
    for at in range(0, len(folded), step):
        v = (folded[None, at : at + step] ^ flip) * times
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        np.minimum(least, v.min(axis=1), out=least)
    label = least.reshape(count, d).astype(np.uint64)
    value = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d)
    for j in range(d):
        value = _mixed(value ^ (label[:, j] * _PLACES[8 + j % 32]))
    return value


def _described(docs: DataFrame, d: int) -> DataFrame:
    """(id, mark, key, nodes, n) for each row that has an id; mark: a column of docs that is
    carried along; key: a 128-bit hash of the set, null without shingles; n: its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_batches(batches):
            keys, found, sizes = [], [], []
            last: tuple[bytes, bytes] | None = None
            for text in texts:
                s = shingles(text)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None)
                    found.append(None)
                    continue
                key = xxhash.xxh3_128_digest(s.tobytes())
                if not last or last[0] != key:
                    last = (key, nodes(s, d).tobytes())
                keys.append(key)
                found.append(last[1])
            yield pa.record_batch([part.column(0), part.column(2), pa.array(keys, pa.binary()), pa.array(found, pa.binary()), pa.array(sizes, pa.int64())], names=["id", "mark", "key", "nodes", "n"])

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), "mark")
    return rows.mapInArrow(run, "id long, mark string, key binary, nodes binary, n long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))


def _sets(rows: DataFrame, d: int | None = None, count: int = 0) -> DataFrame:
    """(c, set) of rows (c, key, text) whose text is the class's own, or (c, nodes) at depth
    d of count tries; an id that repeats with another text is not this class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_batches(batches):
            classes, found = [], []
            for c, key, text in zip(part.column("c").to_pylist(), part.column("key").to_pylist(), texts, strict=True):
                s = shingles(text)
                if xxhash.xxh3_128_digest(s.tobytes()) == key:
                    classes.append(c)
                    found.append((nodes(s, d, count) if d else s).tobytes())
            yield pa.record_batch([pa.array(classes, pa.int64()), pa.array(found, pa.binary())], names=["c", "nodes" if d else "set"])

    return rows.select("c", "key", "text").mapInArrow(run, f"c long, {'nodes' if d else 'set'} binary").dropDuplicates(["c"])


def _near(classes: DataFrame, count: int) -> DataFrame:
    """(c, group) for the classes (c, nodes) that share a node of count tries with others."""
    at = F.expr(f"transform(sequence(0, {count - 1}), t -> substring(nodes, t * 8 + 1, 8))")
    spread = classes.select("c", F.explode(at).alias("node")).repartition("node")
    shared = spread.groupBy("node").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("node", "lo")
    ties = spread.join(shared, "node").where("c <> lo").select(F.col("lo").alias("a"), F.col("c").alias("b")).distinct()
    return components(ties).select(F.col("node").alias("c"), F.col("component").alias("group"))


def verify(sets: list[np.ndarray], held: np.ndarray, sizes: np.ndarray, cross: int | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For classes with these sets, nodes (a row each) and sizes: the links of each, the rows
    in the classes it links to, and the first class of its tree in a spanning forest.
    cross: only pairs of one class before it and one from it on."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    flat, ids = np.unique(np.concatenate(sets), return_inverse=True) if n else (np.zeros(0), np.zeros(0, int))
    at = np.concatenate([[0], np.cumsum(lengths)])
    mark = np.zeros(len(flat), np.bool_)
    links, rows, parent = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(n if cross is None else cross):
        first = i + 1 if cross is None else cross
        mates = first + np.flatnonzero((held[first:] == held[i]).any(axis=1))
        mates = mates[np.minimum(lengths[mates], lengths[i]) >= threshold * np.maximum(lengths[mates], lengths[i]) - 1e-9]
        if not len(mates):
            continue
        mark[ids[at[i] : at[i + 1]]] = True
        for lo in range(0, len(mates), 256):
            some = mates[lo : lo + 256]
            inside = mark[np.concatenate([ids[at[j] : at[j + 1]] for j in some])]
            common = np.add.reduceat(inside, np.concatenate([[0], np.cumsum(lengths[some])[:-1]]), dtype=np.int64)
            alike = common >= threshold * (lengths[i] + lengths[some] - common) - 1e-9
            linked = some[alike]
            links[i] += len(linked)
            rows[i] += sizes[linked].sum()
            links[linked] += 1
            rows[linked] += sizes[i]
            for j in linked:
                a, b = root(i), root(int(j))
                parent[max(a, b)] = min(a, b)
        mark[ids[at[i] : at[i + 1]]] = False
    return links, rows, np.array([root(i) for i in range(n)])


def _verified(tasks: DataFrame, threshold: float) -> DataFrame:
    """(c, links, rows, first) from tasks (group, i, j, chunk, c, size, nodes, set): rows of a
    (group, i, j) stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c", "size", "chunk", "nodes", "set"]
        pending: dict[str, list] = {x: [] for x in names}
        now = None

        def done() -> pa.RecordBatch | None:
            i, j = now[1], now[2]
            own = sorted(range(len(pending["c"])), key=lambda k: (pending["chunk"][k], pending["c"][k]))
            if len(own) < 2:
                return None
            cross = None if i == j else sum(1 for k in own if pending["chunk"][k] == i)
            c = np.array([pending["c"][k] for k in own])
            held = np.stack([np.frombuffer(pending["nodes"][k], np.uint64) for k in own])
            sets = [np.frombuffer(pending["set"][k], np.uint64) for k in own]
            links, rows, first = verify(sets, held, np.array([pending["size"][k] for k in own]), cross, threshold)
            some = links > 0
            return pa.record_batch([pa.array(c[some]), pa.array(links[some]), pa.array(rows[some]), pa.array(c[first[some]])], names=["c", "links", "rows", "first"])

        for batch in batches:
            columns = {x: batch.column(x).to_pylist() for x in names}
            keys = list(zip(*(batch.column(x).to_pylist() for x in ("group", "i", "j")), strict=True))
            for k, key in enumerate(keys):
                if key != now:
                    if now is not None and (out := done()):
                        yield out
                    now, pending = key, {x: [] for x in names}
                for x in names:
                    pending[x].append(columns[x][k])
        if now is not None and (out := done()):
            yield out

    return tasks.mapInArrow(run, "c long, links long, rows long, first long")


def _grouped(docs: DataFrame, classes: DataFrame, d: int, threshold: float, recall: float, chunk: int) -> DataFrame:
    """(c, group, nodes) for the classes that share a prefix with others, the prefixes as long
    as each neighbourhood needs."""
    near = cut(_near(classes, TREES))
    crowded = cut(near.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk))
    placed = near.join(classes.select("c", "nodes"), "c").select("c", "group", "nodes")
    if crowded.isEmpty():
        return placed
    some = near.join(crowded.select("group"), "group").join(classes.select("c", "id", "key"), "c")
    count = trees(DEEPER * d, threshold, recall)
    deeper = cut(_sets(some.join(_texts(docs), "id"), DEEPER * d, count))
    again = _near(deeper, count).join(deeper, "c").select("c", "group", "nodes")
    # a group keeps its number apart from those of the other depth
    return placed.join(crowded.select("group"), "group", "left_anti").select("c", "group", "nodes").unionByName(again.withColumn("group", -1 - F.col("group")))


def _solved(docs: DataFrame, threshold: float, recall: float, chunk: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (id, mark, c, size), counted links (c, links, rows) and groups (c, component) of
    docs(doc_id, text, mark)."""
    d = depth(threshold, recall=recall)
    described = cut(_described(docs, d))
    keyed = described.where("key is not null")
    classes = keyed.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("nodes").alias("nodes"), F.first("n").alias("n"))
    classes = cut(classes.withColumn("c", F.monotonically_increasing_id()))
    member = keyed.select("id", "mark", "key").join(classes.select("key", "c", "size"), "key").select("id", "mark", "c", "size")

    near = cut(_grouped(docs, classes, d, threshold, recall, chunk).join(classes.select("c", "id", "size", "key", "n"), "c"))
    sizes = near.groupBy("group").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("weight"))
    chunks = F.greatest(F.ceil(F.col("many") / chunk), F.ceil(8 * F.col("weight") / CHUNK_BYTES)).cast("int")
    placed = near.join(sizes, "group").select("c", "group", "size", "nodes", chunks.alias("chunks"), F.pmod(F.xxhash64("c"), chunks.cast("long")).cast("int").alias("chunk"))
    sets = _sets(near.select("c", "id", "key").join(_texts(docs), "id"))
    routed = placed.join(sets, "c").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tasks = routed.select("group", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "c", "size", "nodes", "set")
    tasks = tasks.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    found = cut(_verified(tasks, threshold))
    counted = found.groupBy("c").agg(F.sum("links").alias("links"), F.sum("rows").alias("rows"))
    groups = components(found.select(F.col("c").alias("a"), F.col("first").alias("b"))).select(F.col("node").alias("c"), "component")
    return member, counted, groups


def links(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """doc_id, class_id (the smallest doc_id that links lead to), n_links (other rows that
    are as similar as the threshold or more, copies too) and n_texts (the different texts
    among them) for each row of docs."""
    member, counted, groups = _solved(docs.select("doc_id", "text", F.lit(None).cast("string").alias("mark")), threshold, recall, chunk)
    rows = member.join(groups, "c", "left").join(counted, "c", "left").select("id", F.coalesce("component", "c").alias("component"), (F.coalesce("rows", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_texts"))
    rows = cut(rows)
    # written, so that the join is of two plain exchanges, whose hot partitions Spark can split
    least = cut(rows.groupBy("component").agg(F.min("id").alias("class_id")))
    linked = rows.join(least, "component").select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_texts")
    blank = F.coalesce(F.length(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", "")), F.lit(0)) == 0
    alone = docs.where(F.col("doc_id").isNull() | blank).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("doc_id").cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_texts"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """The rows of docs that stay, all columns untouched: of each group of linked rows the one
    with the smallest (doc_id, MD5 of the text), one of them where rows repeat. Rows are
    told apart by id and text, so an id that repeats with another text loses only the text
    that has a partner."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark"))
    member, _, groups = _solved(packed.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text"), "mark"), threshold, recall, chunk)
    rows = cut(member.join(groups, "c", "left").select("id", "mark", F.coalesce("component", "c").alias("component")))
    # written, so that the join is of two plain exchanges, whose hot partitions Spark can split
    best = cut(rows.groupBy("component").agg(F.min(F.struct("id", "mark")).alias("best")))
    judged = rows.join(best, "component").select("id", "mark", (F.struct("id", "mark") == F.col("best")).alias("stays"))
    judged = judged.groupBy("id", "mark").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    verdict = cut(judged.where("not stays or n > 1").select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "stays"))
    joined = packed.join(verdict, (F.col("id") == F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    out = joined.where("stays is null").select("row.*")
    if verdict.where("stays").isEmpty():
        return out
    return out.union(joined.where("stays").dropDuplicates(["id", "mark"]).select("row.*"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g')) AS t FROM documents),
w AS (SELECT doc_id, string_split(t, ' ') AS w FROM d WHERE t <> ''),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b, common, x.n AS na, y.n AS nb FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE common >= 0.8 * (x.n + y.n - common) - 1e-9),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a),
sets AS (SELECT doc_id, md5(string_agg(s, '|' ORDER BY s)) AS h FROM s GROUP BY doc_id),
t AS (SELECT l.a AS doc_id, count(DISTINCT y.h) AS n_texts FROM l JOIN sets x ON x.doc_id = l.a JOIN sets y ON y.doc_id = l.b WHERE x.h <> y.h GROUP BY l.a),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT r.doc_id, min(seen) AS class_id, CAST(coalesce(min(k.n_links), 0) AS BIGINT) AS n_links, CAST(coalesce(min(t.n_texts), 0) AS BIGINT) AS n_texts
FROM r LEFT JOIN k ON k.doc_id = r.doc_id LEFT JOIN t ON t.doc_id = r.doc_id GROUP BY r.doc_id
"""
