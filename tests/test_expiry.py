"""Silent workers and leases that run out: streams equal tables as of the watermark."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from presswork.streaming import expiry, stateful

T0 = datetime(2025, 1, 1, tzinfo=timezone.utc)
S = 1_000_000


def stamp(at):
    return T0 + timedelta(microseconds=at)


def base():
    return int(T0.timestamp()) * S


def beats(seed=1, n=240):
    rng = random.Random(seed)
    return [(f"w{rng.randrange(6)}", base() + rng.randrange(3600 * S)) for _ in range(n)]


def brute_liveness(rows, lasts, to):
    out = []
    for w in {w for w, _ in rows}:
        times = sorted(t for x, t in rows if x == w and t <= to)
        for i, t in enumerate(times):
            if i == 0 or t - times[i - 1] >= lasts:
                out.append((w, t, "up"))
            if (i + 1 == len(times) or times[i + 1] - t >= lasts) and t + lasts <= to:
                out.append((w, t + lasts, "down"))
    return sorted(out)


def lease_events(seed=2, n=300):
    rng = random.Random(seed)
    return [(f"a{rng.randrange(5)}", base() + rng.randrange(3600 * S), "complete" if i % 30 == 7 else rng.choice(["claim"] * 4 + ["renew", "release"] * 2), f"o{rng.randrange(3)}", f"t{rng.randrange(2)}") for i in range(n)]


def brute_leases(rows, lasts, to):
    """By asking at each event who holds the article."""
    out = []
    for a in {r[0] for r in rows}:
        holder, until, done = None, None, False
        for _, at, kind, owner, token in sorted(r for r in rows if r[0] == a and r[1] <= to):
            if holder and until <= at:
                out.append((a, until, "expire", *holder, True))
                holder = None
            ok = not done and (holder == (owner, token) or (kind == "claim" and not holder))
            if ok and kind in ("claim", "renew"):
                holder, until = (owner, token), at + lasts
            elif ok:
                holder, done = None, kind == "complete"
            out.append((a, at, kind, owner, token, ok))
        if holder and until <= to:
            out.append((a, until, "expire", *holder, True))
    return sorted(out)


@pytest.fixture(scope="module")
def session(spark):
    other = spark.newSession()
    stateful.use_rocksdb(other)
    return other


def streamed(session, tmp_path, rows, schema, key, rule, fields, shuffle):
    """Rows in files that come one after the other, not in order within 5 minutes; the changes."""
    rng = random.Random(shuffle)
    rows = sorted(rows, key=lambda r: r[1] + rng.randrange(300 * S))
    for k in range(8):
        part = rows[k * len(rows) // 8 : (k + 1) * len(rows) // 8]
        df = session.createDataFrame([(*r, stamp(r[1] - base())) for r in part], f"{schema}, ts timestamp")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = session.readStream.schema(f"{schema}, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = stateful.run_to_table(expiry.timed(stream, key, rule, fields, "5 minutes"), "out", str(tmp_path / "log"), "append")
    last = max(r[1] for r in rows)
    return session.read.parquet(out), (last // 1000 - 300_000) * 1000


@pytest.mark.parametrize("shuffle", [1, 2])
def test_liveness(session, tmp_path, shuffle):
    rows, lasts = beats(), 120 * S
    found, to = streamed(session, tmp_path, rows, "w string, at long", "w", expiry.Liveness(lasts), ["at"], shuffle)
    want = brute_liveness(rows, lasts, to)
    assert sorted(tuple(r) for r in found.select("worker", "at", "change").collect()) == want and len(want) > 30
    table = session.createDataFrame(rows, "w string, at long")
    assert sorted(tuple(r) for r in expiry.liveness(table, "w", F.col("at"), lasts, F.lit(to)).collect()) == want
    everything = sorted(tuple(r) for r in expiry.liveness(table, "w", F.col("at"), lasts).collect())
    assert everything == brute_liveness(rows, lasts, 10**18)


def test_a_silent_worker_goes_down_when_others_move_time(session, tmp_path):
    rows = [("quiet", base() + 5 * S)] + [("busy", base() + i * 30 * S) for i in range(60)]
    found, _ = streamed(session, tmp_path, rows, "w string, at long", "w", expiry.Liveness(90 * S), ["at"], 3)
    assert [tuple(r) for r in found.where("worker = 'quiet'").orderBy("at").select("at", "change").collect()] == [(base() + 5 * S, "up"), (base() + 95 * S, "down")]


def test_leases(session, tmp_path):
    rows, lasts = lease_events(), 200 * S
    schema = "a string, at long, kind string, owner string, token string"
    found, to = streamed(session, tmp_path, rows, schema, "a", expiry.Leases(lasts), ["at", "kind", "owner", "token"], 4)
    want = brute_leases(rows, lasts, to)
    columns = ["article", "at", "kind", "owner", "token", "granted"]
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == want
    assert {k for _, _, k, *_ in want} == {"claim", "renew", "release", "complete", "expire"} and {True, False} == {r[-1] for r in want}
    table = session.createDataFrame(rows, schema)
    assert sorted(tuple(r) for r in expiry.leases(table, "a", lasts, to).select(*columns).collect()) == want


def test_nothing(session):
    assert expiry.liveness(session.createDataFrame([], "w string, at long"), "w", F.col("at"), 5).count() == 0
    assert list(expiry.advanced(expiry.Leases(5), {}, [], 10**9)) == []
