"""What happens because time passes: workers that fall silent and leases that run out.

A worker is up from a heartbeat until `lasts` after its last one; a lease is held until `lasts`
after it was claimed or renewed. Such ends are no rows of the input. As a stream they are event-time
timers of transformWithState: a key's events wait in its state until the watermark has passed
them, are taken in the order of their time, and what ends before the watermark is given out then,
also where no further row of the key ever comes. So the output up to a watermark depends on the
events before it alone, not on batches or on the order in which rows arrived.

The same rules are asked of a table as of a time: liveness by window functions, leases by the fold
that the stream's state takes its steps with. Times are microseconds as longs."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Microseconds of a timer's unit.
MS = 1000


# -- rules ------------------------------------------------------------------------------

class Liveness:
    """up when a worker's heartbeat comes after none or after it was down, down when it is silent."""

    columns = {"worker": "string", "at": "long", "change": "string"}

    def __init__(self, lasts: int):
        self.lasts = lasts

    def until(self, state: dict) -> int | None:
        """When the state ends by itself."""
        return state["last"] + self.lasts if state.get("up") else None

    def end(self, state: dict) -> dict:
        out = {"at": state["last"] + self.lasts, "change": "down"}
        state.clear()
        return out

    def take(self, state: dict, event: dict) -> Iterator[dict]:
        if not state.get("up"):
            yield {"at": event["at"], "change": "up"}
        state.update(up=True, last=event["at"])


class Leases:
    """claim, renew, release and complete of an article by an owner with a token. A claim is granted
    where nobody holds the article, or its holder by the same token does; anything else is granted
    to the holder by its token alone. A lease that is neither renewed nor ended expires."""

    columns = {"article": "string", "at": "long", "kind": "string", "owner": "string", "token": "string", "granted": "boolean"}

    def __init__(self, lasts: int):
        self.lasts = lasts

    def until(self, state: dict) -> int | None:
        return state["until"] if state.get("owner") is not None else None

    def end(self, state: dict) -> dict:
        out = {"at": state["until"], "kind": "expire", "owner": state["owner"], "token": state["token"], "granted": True}
        state.clear()
        return out

    def take(self, state: dict, event: dict) -> Iterator[dict]:
        held = state.get("owner") is not None
        mine = held and (state["owner"], state["token"]) == (event["owner"], event["token"])
        granted = not state.get("done") and (mine or (event["kind"] == "claim" and not held))
        if granted and event["kind"] in ("claim", "renew"):
            state.update(owner=event["owner"], token=event["token"], until=event["at"] + self.lasts)
        elif granted:
            state.update(owner=None, token=None, done=event["kind"] == "complete")
        yield {k: event[k] for k in ("at", "kind", "owner", "token")} | {"granted": granted}


def advanced(rule, state: dict, events: list[dict], to: int) -> Iterator[dict]:
    """What comes out of a key's ordered events and of time passing, up to `to` and with it. An end
    comes before an event at the same time."""
    for event in [*events, None]:
        at = to if event is None else event["at"]
        if (end := rule.until(state)) is not None and end <= at:
            yield rule.end(state)
        if event is not None:
            yield from rule.take(state, event)


# -- tables -----------------------------------------------------------------------------

def liveness(beats: DataFrame, key: str, time: Column, lasts: int, to: Column | None = None) -> DataFrame:
    """(worker, at, change) of beats up to a time (by default all that is known): a worker goes down
    where its next heartbeat comes `lasts` after the one before or later, or not at all."""
    order = Window.partitionBy("worker").orderBy("at")
    rows = beats.select(F.col(key).cast("string").alias("worker"), time.alias("at"))
    rows = rows if to is None else rows.where(F.col("at") <= to)
    gaps = rows.withColumns({"before": F.lag("at").over(order), "after": F.lead("at").over(order)})
    up = F.when(F.col("before").isNull() | (F.col("at") - F.col("before") >= lasts), F.struct("at", F.lit("up").alias("change")))
    ends = F.col("after").isNull() | (F.col("after") - F.col("at") >= lasts)
    down = F.when(ends, F.struct((F.col("at") + lasts).alias("at"), F.lit("down").alias("change")))
    found = gaps.select("worker", F.explode(F.array_compact(F.array(up, down))).alias("x")).select("worker", "x.*")
    return found if to is None else found.where(F.col("at") <= to)


def leases(events: DataFrame, key: str, lasts: int, to: int) -> DataFrame:
    """What ``Leases`` says of events(key, at, kind, owner, token) up to a time. An article's events
    are a group of their own, worked on in order."""
    rule = Leases(lasts)

    def run(one: tuple, found: pd.DataFrame) -> pd.DataFrame:
        rows = found.sort_values(["at", "kind", "owner", "token"]).to_dict("records")
        return _frame(rule, [(str(one[0]), x) for x in advanced(rule, {}, rows, to)])

    rows = events.select(F.col(key).cast("string").alias("k"), "at", "kind", "owner", "token").where(F.col("at") <= to)
    return rows.groupBy("k").applyInPandas(run, _schema(rule))


def _schema(rule) -> str:
    return ", ".join(f"{c} {t}" for c, t in rule.columns.items())


def _frame(rule, rows: list[tuple[str, dict]]) -> pd.DataFrame:
    first, *rest = rule.columns
    return pd.DataFrame([[key, *[r[c] for c in rest]] for key, r in rows], columns=[first, *rest])


# -- streams ----------------------------------------------------------------------------

class Timed(StatefulProcessor):
    """A rule over a stream, for groups of keys that share a state: {key: state}, what their events wait in,
    and one timer, at the first of those events or the first end of a state. When it fires, all up to the
    watermark is done at once: Python is called once a group and watermark, not once an event."""

    def __init__(self, rule, fields: list[str]):
        self.rule, self.fields = rule, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "body string, timer long")
        self.waiting = handle.getListState("waiting", "body string")  # lists of [key, at, ...]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        first = []
        for frame in rows:
            events = list(zip(*(frame[c].tolist() for c in ["k", *self.fields]), strict=True))
            self.waiting.appendValue((json.dumps(events),))
            first.append(min(e[1] for e in events))
        body, due = self.state.get() or ("[]", None)
        if due is None or _tick(min(first)) < due:
            self._fire(body, due, min(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        to = timerValues.getCurrentWatermarkInMs() * MS
        states, ready, left = dict(json.loads(self.state.get()[0])), defaultdict(list), []
        for (body,) in self.waiting.get():
            for e in json.loads(body):
                if e[1] <= to:
                    ready[e[0]].append(e[1:])
                else:
                    left.append(e)
        out = []
        for k in {k for k, state in states.items() if (end := self.rule.until(state)) is not None and end <= to} | ready.keys():
            events = [dict(zip(self.fields, e, strict=True)) for e in sorted(ready[k])]
            out += [(k, x) for x in advanced(self.rule, states.setdefault(k, {}), events, to)]
        if ready:
            self.waiting.clear()
            if left:
                self.waiting.put([(json.dumps(left),)])
        ends = [end for state in states.values() if (end := self.rule.until(state)) is not None]
        self._fire(json.dumps([x for x in states.items() if x[1]]), None, min([*ends, *(e[1] for e in left)], default=None))
        if out:
            yield _frame(self.rule, out)

    def _fire(self, body: str, due: int | None, at: int | None) -> None:
        """From now on the timer stands at a time, not where it did."""
        if due is not None:
            self.handle.deleteTimer(due)
        if at is not None:
            self.handle.registerTimer(_tick(at))
        self.state.update((body, None if at is None else _tick(at)))

    def close(self) -> None:
        pass


def _tick(at: int) -> int:
    """The first millisecond that is not before a time."""
    return -(-at // MS)


def timed(events: DataFrame, key: str, rule, fields: list[str], delay: str = "10 minutes", buckets: int | None = None) -> DataFrame:
    """A rule over a stream of events(key, ts, at, ...): ts is the time that the watermark follows and
    `at` the same in microseconds; fields: the columns of an event, `at` first, which order events
    at one time; those without a time are none. buckets: how many groups share out the keys, for many keys
    of few events; a group's waiting events are read together. By default each key is a group."""
    group = F.col("k") if buckets is None else F.pmod(F.hash("k"), F.lit(buckets))
    rows = events.where("ts IS NOT NULL").withWatermark("ts", delay).select(F.col(key).cast("string").alias("k"), "ts", *fields).withColumn("g", group)
    return rows.groupBy("g").transformWithStateInPandas(statefulProcessor=Timed(rule, fields), outputStructType=_schema(rule), outputMode="Append", timeMode="EventTime")
