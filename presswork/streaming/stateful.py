"""Structured Streaming over collection events: latest states and counters that retract."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from presswork.operators.collection import PENDING
from presswork.plans.lineage import shared_dir

LATEST = "article_id string, updated_at timestamp, seq long, status string, outlet string, delta_status string, delta int"


class Latest(StatefulProcessor):
    """Keeps each article's newest event. An event that is not strictly newer changes
    nothing; one that is emits +1 for its final status and -1 for the one it replaces."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("latest", "updated_at timestamp, seq long, status string, outlet string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        # within a micro-batch rows have no order of their own
        events = pd.concat(list(rows)).sort_values(["updated_at", "seq"])
        held = self.state.get() if self.state.exists() else None
        before, out = held, []
        for e in events.itertuples():
            if held is None or e.updated_at > pd.Timestamp(held[0]):
                held = (e.updated_at.to_pydatetime(), int(e.seq), e.status, e.outlet)
        if held is not None and held != before:
            self.state.update(held)
            for one, delta in ((before, -1), (held, 1)):
                if one is not None:
                    out.append((key[0], held[0], held[1], held[2], one[3], one[2] if one[2] not in PENDING else None, delta))
        yield pd.DataFrame(out, columns=["article_id", "updated_at", "seq", "status", "outlet", "delta_status", "delta"])

    def close(self) -> None:
        pass


def latest_changes(events: DataFrame) -> DataFrame:
    """The changes of a stream events(article_id, updated_at, seq, status, outlet)."""
    rows = events.select("article_id", "updated_at", "seq", "status", "outlet")
    return rows.groupBy("article_id").transformWithStateInPandas(statefulProcessor=Latest(), outputStructType=LATEST, outputMode="Update", timeMode="None")


def status_totals(changes: DataFrame) -> DataFrame:
    """Final articles by outlet and status, from all changes so far."""
    return changes.where("delta_status is not null").groupBy("outlet", F.col("delta_status").alias("status")).agg(F.sum("delta").alias("articles")).where("articles > 0")


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "update") -> str:
    """Run a stream to its present end into Parquet under the checkpoint; a batch that is
    repeated overwrites its own folder. Returns the folder."""
    folder = f"{checkpoint}/{name}"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    query = stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{checkpoint}/{name}-log").trigger(availableNow=True).start()
    query.awaitTermination()
    return folder


def late_windows(events: DataFrame, delay: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by type in tumbling windows, later ones than the delay dropped."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("events")).select(F.col("window.start").alias("start"), "event_type", "events")


def use_rocksdb(spark) -> None:
    """The state store that transformWithState needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def own_session(spark):
    """A session for a stream that keeps its state in RocksDB. The caller's settings stay as they are,
    and those that a new session would not take over hold in it."""
    other = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        other.conf.set(name, spark.conf.get(name))
    use_rocksdb(other)
    return other


def replayed(spark, rows: DataFrame, files: int = 4) -> tuple[DataFrame, str]:
    """rows written out and read again as a stream of some files a batch, and the folder that the
    stream's own files may go to."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows.write.parquet(f"{base}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in"), base


def stream_latest(spark, events: DataFrame) -> DataFrame:
    """Status totals of events, computed by writing them out and reading them as a stream."""
    spark = spark.newSession()  # the caller's settings stay as they are
    use_rocksdb(spark)
    stream, base = replayed(spark, events)
    folder = run_to_table(latest_changes(stream), "latest", base)
    return status_totals(spark.read.parquet(folder))
