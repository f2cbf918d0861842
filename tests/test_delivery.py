"""Snapshots that streams keep up to date, and outboxes with acknowledgements."""

import random
from datetime import datetime, timedelta

import pytest

from presswork.operators import collection
from presswork.streaming import outbox, snapshots
from presswork.streaming.snapshots import ROWS, Conflict, Snapshot

T0 = datetime(2025, 1, 1)


def changes(seed, n, urls=40):
    rng = random.Random(seed)
    return [(f"u{rng.randrange(urls)}", rng.choice(["saved", "partial", None]), T0 + timedelta(seconds=rng.randrange(5000)), i) for i in range(n)]


def newest(rows):
    best = {}
    for u, s, t, q in rows:
        if u not in best or (t, q) > best[u][0]:
            best[u] = ((t, q), s)
    return {u: s for u, (_, s) in best.items() if s}


def read(df):
    found = [(r["url"], r["status"]) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def test_stream_equals_batch_whatever_comes_late_or_twice(spark, tmp_path):
    rows = changes(1, 300)
    for k in range(6):
        spark.createDataFrame(rows[k * 50 : k * 50 + 50], ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    snap = Snapshot(spark, str(tmp_path / "snap"), buckets=8)
    stream = lambda: spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    snapshots.keep_up(stream(), snap, str(tmp_path / "log"))
    assert read(snap.index()) == newest(rows)
    assert snap.totals() == {s: sum(x == s for x in newest(rows).values()) for s in ("saved", "partial")}
    versions = snap.versions()
    assert len(versions) == 6
    snapshots.keep_up(stream(), snap, str(tmp_path / "log"))  # nothing new
    assert snap.versions() == versions
    snapshots.keep_up(stream(), snap, str(tmp_path / "lost-log"))  # all again, as another stream
    assert read(snap.index()) == newest(rows)
    last = snap.commit()
    (stream_id, batch), *_ = last["batches"].items()
    assert snap.merge(spark.createDataFrame([("new", "saved", T0, 1)], ROWS), stream_id, batch) == last  # a batch that is in
    assert read(snap.index(versions[2])) == read(Snapshot(spark, snap.folder, 8).index(3))


def test_only_touched_buckets_are_written(spark, tmp_path):
    snap = Snapshot(spark, str(tmp_path), buckets=16)
    first = snap.merge(spark.createDataFrame(changes(2, 200), ROWS))
    second = snap.merge(spark.createDataFrame([("u1", "saved", T0 + timedelta(days=9), 999)], ROWS))
    moved = [b for b in second["data"] if second["data"][b] != first["data"][b]]
    assert len(moved) == 1 and len(first["data"]) > 8
    assert snap.merge(spark.createDataFrame([], ROWS))["version"] == second["version"]


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    snap = Snapshot(spark, str(tmp_path), buckets=4)
    rows = changes(3, 60)
    snap.merge(spark.createDataFrame(rows, ROWS))
    before = read(snap.index())
    more = changes(4, 60)
    with monkeypatch.context() as m:
        m.setattr(Snapshot, "_add", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            snap.merge(spark.createDataFrame(more, ROWS))
    assert read(snap.index()) == before == newest(rows)
    snap.merge(spark.createDataFrame(more, ROWS))
    assert read(snap.index()) == newest(rows + more)
    assert snap.vacuum(keep=1) >= 1
    assert read(snap.index()) == newest(rows + more)


def test_two_writers_cannot_add_one_commit(spark, tmp_path):
    snap = Snapshot(spark, str(tmp_path))
    now = snap.merge(spark.createDataFrame([("a", "saved", T0, 1)], ROWS))
    with pytest.raises(Conflict):
        snap._add(now)


def test_refresh_by_signature(spark, tmp_path, monkeypatch):
    snap = Snapshot(spark, str(tmp_path), buckets=4)
    t = lambda s: T0 + timedelta(seconds=s)
    one = [("a", "saved", t(0), 1), ("b", "partial", t(1000), 2), ("c", None, t(1100), 3)]
    frame = lambda rows: spark.createDataFrame(rows, ROWS)
    first = snap.refresh(frame(one), ["r1", 1, 1])
    assert read(snap.index()) == {"a": "saved", "b": "partial"}
    with monkeypatch.context() as m:
        m.setattr(Snapshot, "merge", None)
        m.setattr(Snapshot, "rebuild", None)
        assert snap.refresh(frame(one), ["r1", 1, 1]) == first  # the same signature: no work
    # within the overlap of the watermark: merged alone
    two = [*one, ("c", "saved", t(1150), 4), ("b", None, t(1090), 5)]
    with monkeypatch.context() as m:
        m.setattr(Snapshot, "rebuild", None)
        snap.refresh(frame(two), ["r1", 2, 0])
    assert read(snap.index()) == {"a": "saved", "c": "saved"}
    # a change from before the overlap is missed by the merge, the count tells, and all is read
    three = [*two, ("d", "partial", t(5), 6)]
    snap.refresh(frame(three), ["r1", 2, 1])
    assert read(snap.index()) == {"a": "saved", "c": "saved", "d": "partial"}
    snap.refresh(frame([("x", "saved", t(0), 1)]), ["r2", 1, 0])  # another run
    assert read(snap.index()) == {"x": "saved"}
    snap.refresh(frame([("y", "saved", t(0), 1)]), ["r2", 1, 0], reconcile=True)
    assert read(snap.index()) == {"y": "saved"}


def test_snapshot_equals_the_batch_index(spark, tmp_path):
    rows = changes(7, 200)
    snap = Snapshot(spark, str(tmp_path))
    for k in range(0, 200, 67):
        snap.merge(spark.createDataFrame(rows[k : k + 67], ROWS))
    latest = collection.latest(spark.createDataFrame(rows, ROWS).selectExpr("*", "-seq as s"), ["url"], arrival="s")
    batch = collection.download_index(spark.createDataFrame([], "url string, status string"), latest.selectExpr("url", "'done' as state", "status", "'x' as result_uri"))
    assert read(snap.index()) == read(batch)


BOX = "article_id string, result_uri string, claim_token string, status string, updated_at timestamp"


def results(ids, token="t1", at=0):
    return [(f"a{i}", f"uri{i}-{token}", None if i % 5 == 0 else token, "saved", T0 + timedelta(seconds=at + i)) for i in ids]


def keys(df):
    return sorted((r["article_id"], r["result_uri"]) for r in df.collect())


def test_export_and_acknowledge(spark, tmp_path):
    box = outbox.Outbox(spark, str(tmp_path), BOX)
    frame = lambda rows: spark.createDataFrame(rows, BOX)
    one = frame(results(range(10)))
    box.export(one, "b1")
    assert box.pending(one).count() == 0 and box.acks().count() == box.view().count() == 10
    # claimed anew: another token and evidence, pending again; the view shows the newer
    two = frame(results(range(3, 10)) + results(range(3), "t2", 100))
    assert keys(box.pending(two)) == [(f"a{i}", f"uri{i}-t2") for i in range(3)]
    box.export(two, "b2")
    assert box.view().count() == 10 and box.view().where("result_uri like '%t2'").count() == 3
    with pytest.raises(RuntimeError, match="not final"):
        box.pending(frame([("a", "u", "t", "deferred", T0)]))
    with pytest.raises(RuntimeError, match="not final"):
        box.pending(frame([("a", "u", "t", None, T0)]))


def test_a_batch_that_dies_between_load_and_acknowledgement(spark, tmp_path):
    box = outbox.Outbox(spark, str(tmp_path), BOX)
    rows = spark.createDataFrame(results(range(8)), BOX)
    box.load(box.pending(rows), "b1")  # and the exporter dies
    assert box.acks().count() == 0 and box.pending(rows).count() == 8
    changed = spark.createDataFrame(results(range(2, 8)) + results([0, 1], "t2", 50), BOX)
    assert box.recover(changed) == ["b1"]
    assert keys(box.acks()) == [(f"a{i}", f"uri{i}-t1") for i in range(2, 8)]  # not those that were claimed anew
    box.export(changed, "b2")
    assert box.events().count() == 10 and box.view().count() == 8 and box.pending(changed).count() == 0


def test_a_stream_whose_batch_is_killed(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame(results(range(k * 4, k * 4 + 4)), BOX).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    box = outbox.Outbox(spark, str(tmp_path / "box"), BOX)
    stream = lambda: spark.readStream.schema(BOX).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []

    def kill(name):
        seen.append(name)
        if len(seen) == 2:
            raise RuntimeError("killed between load and acknowledgement")

    with pytest.raises(Exception, match="killed"):
        outbox.deliver(stream(), box, str(tmp_path / "log"), between=kill)
    assert box.events().count() == 8 and box.acks().count() == 4
    outbox.deliver(stream(), box, str(tmp_path / "log"), between=seen.append)
    assert box.events().count() == box.acks().count() == box.view().count() == 12  # each was loaded once
    assert len(seen) == 4 and seen[1] == seen[2]
