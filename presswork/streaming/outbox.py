"""Results on their way out: an outbox, a table that takes them in batches, and acknowledgements.

A result is known by (article_id, result_uri, claim_token). Batches are written whole under their
own name, so a batch that runs again replaces itself. Acknowledged is what a batch holds and the
outbox still has under the same key; a result that was claimed anew meanwhile has another token and
stays pending. A batch that dies between its load and its acknowledgements is acknowledged by
whoever comes next; until then its results may be loaded by another batch too, and the view shows
each article once, by its newest result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.collection import terminal
from presswork.plans.lineage import cut

KEY = ("article_id", "result_uri", "claim_token")


def _same(a: DataFrame, b: DataFrame) -> Column:
    same = F.lit(True)
    for c in KEY:
        same = same & a[c].eqNullSafe(b[f"_{c}"])
    return same


def _keys(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{c}") for c in KEY]).distinct()


class Outbox:
    """Tables `events` (what was loaded) and `acks` below a folder that the executors share."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _batches(self, name: str) -> list[str]:
        """Batches of a table that were written whole."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath() for f in fs.listStatus(path)] if fs.exists(path) else []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in found if fs.exists(done(p, "_SUCCESS")))

    def _read(self, name: str, schema: str, batches: list[str] | None = None) -> DataFrame:
        some = self._batches(name) if batches is None else batches
        paths = [f"{self.folder}/{name}/{b}" for b in some]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("events", self.schema)

    def acks(self) -> DataFrame:
        return self._read("acks", ", ".join(f"{c} string" for c in KEY))

    def pending(self, outbox: DataFrame) -> DataFrame:
        """Rows of the outbox that no batch has been acknowledged for; an error if one is not done."""
        if not outbox.where(~F.coalesce(terminal(F.col("status")), F.lit(False))).isEmpty():
            raise RuntimeError("the outbox holds results that are not final")
        return outbox.join(acked := _keys(self.acks()), _same(outbox, acked), "left_anti")

    def load(self, rows: DataFrame, batch: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/events/{batch}")

    def acknowledge(self, batch: str, outbox: DataFrame) -> None:
        """Acknowledge what the batch loaded and the outbox still holds."""
        loaded = _keys(self._read("events", self.schema, [batch]))
        held = outbox.join(loaded, _same(outbox, loaded), "left_semi").select(*KEY).distinct()
        held.write.mode("overwrite").parquet(f"{self.folder}/acks/{batch}")

    def recover(self, outbox: DataFrame) -> list[str]:
        """Acknowledge batches that were loaded and not acknowledged; returns their names."""
        open_ = sorted(set(self._batches("events")) - set(self._batches("acks")))
        for batch in open_:
            self.acknowledge(batch, outbox)
        return open_

    def export(self, outbox: DataFrame, batch: str) -> None:
        """Load what is pending as one batch and acknowledge it."""
        self.recover(outbox)
        self.load(self.pending(outbox), batch)
        self.acknowledge(batch, outbox)

    def view(self) -> DataFrame:
        """Each article's newest result."""
        e = self.events()
        best = F.max_by(F.struct(*e.columns), F.struct("updated_at", *KEY[1:]))
        return e.groupBy("article_id").agg(best.alias("x")).select("x.*")


def deliver(completions: DataFrame, outbox: Outbox, checkpoint: str, between=None, **trigger) -> None:
    """Load a stream of final results batch by batch, each acknowledged once it is in. A batch that
    fails anywhere is run again by Spark under its number and replaces itself. between(batch) is
    called after a load."""

    def put(batch: DataFrame, number: int) -> None:
        name = f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number:012d}"
        mine = Outbox(batch.sparkSession, outbox.folder, outbox.schema)
        rows = cut(batch)
        mine.load(mine.pending(rows), name)
        if between:
            between(name)
        mine.acknowledge(name, rows)

    query = completions.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
    query.awaitTermination()
