"""A keyed table that a stream of changes keeps up to date, in versions that readers see whole.

The table lies in buckets by the hash of its key. A merge rewrites the buckets that its changes
touch under a new name and then adds one commit, a small file that names each bucket's present
data; the commit with the highest number is the table. A reader sees the commit it opened, a merge
that dies before its commit leaves data that nobody names, and two writers can't both add the
same commit.

Of the versions of a key the one with the greatest (updated_at, seq) stays, so changes may come
late, twice or in any order. Keys that no longer count stay as rows without a status, which keeps
an older change that comes late from bringing them back."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

ROWS = "url string, status string, updated_at timestamp, seq long"
#: Statuses that have text.
TEXT = ("saved", "partial")


class Conflict(RuntimeError):
    """Another writer has added the commit first."""


def status(state: Column, given: Column, result_uri: Column) -> Column:
    """What the index says of a result: its status if it is done, has text and evidence; else null."""
    return F.when((state == "done") & given.isin(*TEXT) & result_uri.isNotNull(), given)


class Snapshot:
    """rows (url, status, updated_at, seq) in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 32):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    # -- commits ------------------------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._path("commits")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def commit(self, version: int | None = None) -> dict:
        """The commit of a version, by default of the last; that of an empty table before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return {"version": 0, "data": {}, "counts": {}, "watermark": None, "signature": None, "batches": {}}
        fs, path = self._path(f"commits/{version:020d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _add(self, body: dict) -> dict:
        fs, path = self._path(f"commits/{body['version']:020d}.json")
        _, draft = self._path(f"commits/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.writeBytes(json.dumps(body))  # ASCII
        out.close()
        if fs.exists(path) or not fs.rename(draft, path):
            fs.delete(draft, False)
            raise Conflict(f"version {body['version']} is there already")
        return body

    # -- reading ------------------------------------------------------------------------

    def rows(self, commit: dict | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """All rows, those without a status too."""
        data = (commit or self.commit())["data"]
        paths = [f"{self.folder}/data/{name}/bucket={b}" for b, name in data.items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(ROWS).parquet(*paths) if paths else self.spark.createDataFrame([], ROWS)

    def index(self, version: int | None = None) -> DataFrame:
        """(url, status) of the results with text, as of a version."""
        return self.rows(self.commit(version)).where("status is not null").select("url", "status")

    # -- writing ------------------------------------------------------------------------

    def _given(self, rows: DataFrame) -> DataFrame:
        return rows.where("url is not null").select("url", "status", F.col("updated_at").cast("timestamp").alias("updated_at"), "seq")

    def _newest(self, rows: DataFrame) -> DataFrame:
        best = F.max_by(F.struct("status", "updated_at", "seq"), F.struct("updated_at", "seq"))
        return rows.groupBy("url").agg(best.alias("x")).select("url", "x.*")

    def _write(self, rows: DataFrame, now: dict, touched: list[int], **more) -> dict:
        name = uuid.uuid4().hex
        placed = rows.withColumn("bucket", self._bucket())
        placed.repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.folder}/data/{name}")
        written = self.spark.read.schema(f"{ROWS}, bucket int").parquet(f"{self.folder}/data/{name}")
        data = {b: v for b, v in now["data"].items() if int(b) not in touched}
        counts = {b: v for b, v in now["counts"].items() if int(b) not in touched}
        for r in written.groupBy("bucket", "status").count().collect():  # at most three rows a bucket
            data[str(r["bucket"])] = name
            if r["status"]:
                counts.setdefault(str(r["bucket"]), {})[r["status"]] = r["count"]
        return self._add(now | {"version": now["version"] + 1, "data": data, "counts": counts} | more)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("url"), F.lit(self.buckets)).cast("int")

    def merge(self, changes: DataFrame, stream: str | None = None, batch: int | None = None) -> dict:
        """Put in changes(url, status, updated_at, seq). A batch of a stream that is in already is
        left out; what was in anyway changes nothing. Returns the commit that holds them."""
        now = self.commit()
        batches = now["batches"]
        if stream is not None and batches.get(stream, -1) >= batch:
            return now
        if stream is not None:
            batches = batches | {stream: batch}
        new = cut(self._newest(self._given(changes)).withColumn("bucket", self._bucket()))
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most self.buckets rows
        if not touched:
            return now
        latest = new.agg(F.max(F.unix_micros("updated_at"))).first()[0]
        merged = self._newest(self.rows(now, touched).unionByName(new.drop("bucket")))
        return self._write(merged, now, touched, batches=batches, signature=None, watermark=max(latest or 0, now["watermark"] or 0))

    def rebuild(self, rows: DataFrame, signature: list | None = None) -> dict:
        """Replace the table by rows."""
        now = self.commit()
        new = cut(self._newest(self._given(rows)))
        latest = new.agg(F.max(F.unix_micros("updated_at"))).first()[0]
        return self._write(new, now | {"data": {}, "counts": {}}, [], signature=signature, watermark=latest)

    def totals(self, commit: dict | None = None) -> dict[str, int]:
        held = (commit or self.commit())["counts"].values()
        return {s: sum(c.get(s, 0) for c in held) for s in TEXT}

    def refresh(self, rows: DataFrame, signature: list, overlap: int = 120, reconcile: bool = False) -> dict:
        """Bring the table up to rows, whose signature [run, saved, partial] a run reports. The same
        signature as at the last refresh, with as many entries, means that nothing is to do. Else
        what changed since `overlap` seconds before the watermark is merged; where the entries are
        then not as many as the signature says, or are to be reconciled, all rows are read."""
        now = self.commit()
        known = lambda c: c["signature"] == signature and list(self.totals(c).values()) == signature[1:]
        if not reconcile and now["version"] and known(now):
            return now
        if now["version"] and not reconcile and now["signature"] and now["signature"][0] == signature[0]:
            since = (now["watermark"] or 0) - overlap * 1_000_000
            merged = self.merge(rows.where(F.unix_micros(F.col("updated_at").cast("timestamp")) >= since))
            if list(self.totals(merged).values()) == signature[1:]:
                return self._add(merged | {"version": merged["version"] + 1, "signature": signature})
        return self.rebuild(rows, signature)

    def vacuum(self, keep: int = 2) -> int:
        """Delete the data that none of the last `keep` commits names, and older commits; returns
        how many folders went. Not to be run beside a merge."""
        versions = self.versions()
        named = {name for v in versions[-keep:] for name in self.commit(v)["data"].values()}
        fs, path = self._path("data")
        gone = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName() not in named] if fs.exists(path) else []
        for p in gone:
            fs.delete(p, True)
        for v in versions[:-keep]:
            _, old = self._path(f"commits/{v:020d}.json")
            fs.delete(old, False)
        return len(gone)


def keep_up(changes: DataFrame, snapshot: Snapshot, checkpoint: str, **trigger) -> None:
    """Merge a stream of changes(url, status, updated_at, seq) into a snapshot, to the stream's
    present end or as the trigger says."""

    def put(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        Snapshot(batch.sparkSession, snapshot.folder, snapshot.buckets).merge(batch, stream, number)

    query = changes.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
    query.awaitTermination()
