"""Timers of a stream: one for each group of keys, whatever the number of its events."""

from types import SimpleNamespace

import duckdb
import pandas as pd
import pytest
from oracle import same
from test_expiry import S, base, beats, brute_leases, brute_liveness, lease_events, session, streamed  # noqa: F401

from presswork import registry
from presswork.streaming import expiry, stateful


class Handle:
    """What a processor of one group asks of Spark."""

    def __init__(self):
        self.timers, self.value, self.rows = set(), None, []

    def getValueState(self, name, schema):
        return SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, update=lambda row: setattr(self, "value", row))

    def getListState(self, name, schema):
        return SimpleNamespace(get=lambda: iter(list(self.rows)), appendValue=self.rows.append, appendList=self.rows.extend, clear=self.rows.clear, put=lambda rows: self.rows.__setitem__(slice(None), rows))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def batches(rule, fields, each, delay):
    """Rows (key, at, ...) of a group in batches: what comes out, the calls of timers by batch, the timers left."""
    one, handle, out, calls, mark = expiry.Timed(rule, fields), Handle(), [], [], 0
    one.init(handle)
    for rows in [*each, None]:  # the last time passes without rows
        if rows:
            frame = pd.DataFrame(rows, columns=["k", *fields])
            list(one.handleInputRows(("g",), iter([frame[:3], frame[3:]] if len(frame) > 3 else [frame]), None))
        fired = sorted(t for t in handle.timers if t <= mark)
        for t in fired:
            time = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
            out += [tuple(r) for frame in one.handleExpiredTimer(("g",), time, None) for r in frame.itertuples(index=False)]
            handle.deleteTimer(t)
        calls.append(len(fired))
        mark = max(mark, max((r[1] for r in rows or []), default=0) // 1000 - delay // 1000)
    return sorted(out), calls, handle.timers


def test_events_of_a_key_share_a_timer():
    rows, lasts = [r for r in beats() if r[0] == "w3"], 120 * S
    found, calls, left = batches(expiry.Liveness(lasts), ["at"], [rows], 300 * S)
    assert calls == [0, 1] and len(left) == 1
    to = (max(at for _, at in rows) // 1000 - 300_000) * 1000
    assert [x[1:] for x in found] == [x[1:] for x in brute_liveness(rows, lasts, to)] and len(found) > 6


@pytest.mark.parametrize("n", [2, 7, 40])
def test_a_group_of_keys(n):
    rows = sorted(beats(), key=lambda r: (r[1] // (200 * S), r[0]))
    each = [rows[i * len(rows) // n : (i + 1) * len(rows) // n] for i in range(n)]
    found, calls, left = batches(expiry.Liveness(120 * S), ["at"], each, 300 * S)
    assert max(calls) == 1 and len(left) <= 1
    assert found == brute_liveness(rows, 120 * S, (max(at for _, at in rows) // 1000 - 300_000) * 1000)


def test_an_earlier_event_moves_the_timer():
    b = base()
    each = [[("a", b + 50 * S)], [("b", b + 20 * S)], [("c", b + 90 * S)], [("c", b + 100 * S)]]
    found, calls, left = batches(expiry.Liveness(15 * S), ["at"], each, 60 * S)
    assert found == [("b", b + 20 * S, "up"), ("b", b + 35 * S, "down")] and calls == [0, 0, 0, 1, 1] and left == {(b + 50 * S) // 1000}


def test_what_is_over_is_not_kept():
    for rule, row in ((expiry.Liveness(5 * S), {"at": base()}), (expiry.Leases(5 * S), {"at": base(), "kind": "claim", "owner": "o", "token": "t"})):
        state = {}
        assert len(list(expiry.advanced(rule, state, [row], base() + 9 * S))) == 2 and not state


def in_buckets(monkeypatch, buckets):
    timed = expiry.timed
    monkeypatch.setattr(expiry, "timed", lambda *a: timed(*a, buckets=buckets))


def test_liveness_in_buckets(session, tmp_path, monkeypatch):  # noqa: F811
    in_buckets(monkeypatch, 2)
    rows, lasts = beats(5), 120 * S
    found, to = streamed(session, tmp_path, rows, "w string, at long", "w", expiry.Liveness(lasts), ["at"], 6)
    assert sorted(tuple(r) for r in found.select("worker", "at", "change").collect()) == brute_liveness(rows, lasts, to)


def test_leases_in_buckets(session, tmp_path, monkeypatch):  # noqa: F811
    in_buckets(monkeypatch, 2)
    rows, lasts = lease_events(7), 200 * S
    schema, columns = "a string, at long, kind string, owner string, token string", ["article", "at", "kind", "owner", "token", "granted"]
    found, to = streamed(session, tmp_path, rows, schema, "a", expiry.Leases(lasts), ["at", "kind", "owner", "token"], 8)
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == brute_leases(rows, lasts, to)


def test_the_stream_takes_over_the_callers_settings(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "shared_dir", lambda _: str(tmp_path))
    caller = spark.newSession()
    caller.conf.set("spark.sql.shuffle.partitions", 3)
    assert registry.queries()["worker_liveness_stream"](caller, small).count() > 0
    assert {p.name for p in tmp_path.glob("stream-*/liveness-log/state/0/*") if p.name.isdigit()} == {"0", "1", "2"}
    assert caller.conf.get("spark.sql.streaming.stateStore.providerClass") == spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_no_worker_and_no_time(spark, tmp_path):
    rows = [(1, "2024-01-01 10:00:00"), (2, "2024-01-09 11:00:00"), (None, "2024-01-03 10:00:00"), (None, "2024-01-04 10:00:00"), (1, None), (3, None)]
    spark.createDataFrame(rows, "user_id long, ts string").selectExpr("user_id", "CAST(ts AS timestamp_ntz) AS ts").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    same(con, registry.queries()["worker_liveness_stream"](spark, str(tmp_path)), registry.oracle_sql()["worker_liveness_stream"])
