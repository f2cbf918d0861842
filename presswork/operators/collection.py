"""Accounting of collection results: latest states, counters, progress, work selection."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.plans.pieces import numbered

PENDING = ("deferred", "retrying", "queued")
TERMINAL_WORKERS = ("completed", "continuing", "paused_by_operator", "paused_limit", "interrupted", "failed", "recovery_failed")
#: States of a cohort by priority, after `running`.
COHORT = ("failed", "recovery_failed", "paused_by_operator", "paused_limit", "interrupted")
SHARDS = 32


def latest(events: DataFrame, keys: list[str], time: str = "updated_at", arrival: str = "seq") -> DataFrame:
    """The newest event of each key; of equally new ones the first to arrive."""
    order = Window.partitionBy(*keys).orderBy(F.desc(time), F.asc(arrival))
    return events.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def terminal(status: Column) -> Column:
    return ~status.isin(*PENDING)


def attempts(counts: Column) -> Column:
    """HTTP attempts of an event from those of its stages."""
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)


def retries(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + F.greatest(F.lit(0), n - 1))


def status_counts(newest: DataFrame) -> DataFrame:
    """Articles of each outlet and status among the final results."""
    return newest.where(terminal(F.col("status"))).groupBy("outlet", "status").agg(F.count(F.lit(1)).alias("articles"))


def metrics(newest: DataFrame) -> DataFrame:
    """Attempts, retries and bytes of the final results, by run."""
    c = F.col("http_counts")
    done = newest.where(terminal(F.col("status")))
    return done.groupBy("run_id").agg(F.count(F.lit(1)).alias("completed"), F.sum(attempts(c)).alias("attempts"), F.sum(retries(c)).alias("retries"), F.sum("response_bytes").alias("response_bytes"))


def shard(article_id: Column, shards: int = SHARDS) -> Column:
    """The counter shard of an article: its id's first 32 bits."""
    return (F.conv(F.substring(article_id, 1, 8), 16, 10).cast("long") % shards).cast("int")


def shard_counters(newest: DataFrame) -> DataFrame:
    """Partial counters by shard; their sums are the totals."""
    done = terminal(F.col("status"))
    return newest.groupBy(shard(F.col("article_id")).alias("shard")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(done).alias("processed"),
        F.sum(F.when(done, attempts(F.col("http_counts"))).otherwise(0)).alias("attempts"), F.sum(F.when(done, F.col("response_bytes")).otherwise(0)).alias("response_bytes"),
    )


def merged(shards: DataFrame) -> DataFrame:
    names = [c for c in shards.columns if c != "shard"]
    return shards.agg(*[F.sum(c).alias(c) for c in names])


def progress(newest: DataFrame, live: DataFrame) -> DataFrame:
    """For each outlet its finished statuses, what remains, and how much of that is being
    fetched: live(outlet, live) counts leases."""
    done = terminal(F.col("status"))
    counts = newest.groupBy("outlet").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(done).alias("processed"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("saved", "partial", "exhausted", "failed")],
    )
    left = F.greatest(F.lit(0), F.col("total") - F.col("processed"))
    joined = counts.join(live, "outlet", "left").withColumn("remaining", left)
    active = F.least("remaining", F.coalesce("live", F.lit(0)))
    return joined.select("outlet", "total", "processed", "saved", "partial", "exhausted", "failed", "remaining", active.alias("active"), (F.col("remaining") - active).alias("pending"))


def pending(manifest: DataFrame, newest: DataFrame) -> DataFrame:
    """Rows of the manifest without a final result."""
    return manifest.join(newest.where(terminal(F.col("status"))).select("run_id", "article_id"), ["run_id", "article_id"], "left_anti")


def outside_manifest(events: DataFrame, manifest: DataFrame) -> DataFrame:
    """Events whose run, article and outlet are no row of the manifest: must be empty."""
    return events.join(manifest.select("run_id", "article_id", "outlet"), ["run_id", "article_id", "outlet"], "left_anti")


def pending_by_outlet(manifest: DataFrame, newest: DataFrame) -> DataFrame:
    """Pending and finished articles of each outlet."""
    waiting = pending(manifest, newest).groupBy("outlet").agg(F.count(F.lit(1)).alias("pending"))
    done = newest.where(terminal(F.col("status"))).groupBy("outlet").agg(F.count(F.lit(1)).alias("done"))
    return waiting.join(done, "outlet", "full").fillna(0, ["pending", "done"])


def latest_workers(beats: DataFrame, expected: int) -> DataFrame:
    """The record of each task's last attempt and heartbeat; other task indexes go."""
    task = F.try_to_number("task_index", F.lit("999999999")).cast("int")
    rows = beats.withColumn("task", task).where(F.col("task_index").rlike("^[0-9]+$") & (F.col("task") < expected))
    order = Window.partitionBy("task_index").orderBy(F.desc("task_attempt"), F.desc("updated_at"))
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth", "task")


def cohort_state(workers: DataFrame, expected: int, processed: int, total: int) -> DataFrame:
    """The state of a cohort from its tasks' latest records: one row."""
    state = F.coalesce("state", F.lit("starting"))
    facts = workers.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.every(state.isin(*TERMINAL_WORKERS)), F.lit(True)).alias("ended"),
        *[F.count_if(state == s).alias(s) for s in COHORT],
    )
    worst = F.coalesce(*[F.when(F.col(s) > 0, s) for s in COHORT])
    found = F.when((F.col("n") < expected) | ~F.col("ended"), "running").otherwise(F.coalesce(worst, F.lit("completed" if processed >= total else "continuing")))
    return facts.select(found.alias("state"))


def recoverable(workers: DataFrame, state: str, expected: int) -> DataFrame:
    """Whether a failed cohort may be restarted: one row."""
    failed = F.col("state") == "failed"
    return workers.agg(
        (F.lit(state == "failed") & (F.count(F.lit(1)) == expected) & (F.count_if(failed) > 0)
         & F.coalesce(F.every(F.coalesce(F.col("state").isin("failed", "completed", "continuing"), F.lit(False))), F.lit(False))
         & (F.count_if(failed & ~F.coalesce("infrastructure_recoverable", F.lit(False))) == 0)).alias("recoverable")
    )


def live_workers(beats: DataFrame, now) -> DataFrame:
    return beats.where(F.col("expires_at") > F.lit(now))


def network(workers: DataFrame, now) -> DataFrame:
    """Gauges over live workers, cumulative counters over all current ones: one row."""
    live = F.col("expires_at") > F.lit(now)
    return workers.agg(F.coalesce(F.sum(F.when(live, F.col("in_flight"))), F.lit(0)).alias("in_flight"), F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"))


def public_status(done: DataFrame) -> DataFrame:
    """Finished articles and percentage from progress(total, saved, partial, exhausted,
    failed): one row."""
    sums = done.agg(*[F.sum(c).alias(c) for c in ("total", "saved", "partial", "exhausted", "failed")])
    finished = F.col("saved") + F.col("partial") + F.col("failed") + F.col("exhausted")
    return sums.select("total", finished.alias("finished"), F.round(100 * finished / F.nullif("total", F.lit(0)), 4).alias("percent"))


def stop_reason(totals: DataFrame, max_bytes: int, max_attempts: int) -> DataFrame:
    """paused_limit where a budget is used up."""
    over = (F.col("response_bytes") >= max_bytes) | (F.col("attempts") >= max_attempts)
    return totals.withColumn("state", F.when(over, "paused_limit").otherwise("running"))


def phase_counts(changes: DataFrame) -> DataFrame:
    """Articles in each phase from changes(article_id, seq, from_phase, to_phase): sums of +1
    and -1. A negative sum means that the log lacks changes, and is given as it is."""
    moves = changes.select(F.explode(F.array(F.struct(F.col("to_phase").alias("phase"), F.lit(1).alias("d")), F.struct(F.col("from_phase").alias("phase"), F.lit(-1).alias("d")))).alias("m")).select("m.*")
    return moves.where("phase is not null").groupBy("phase").agg(F.sum("d").alias("articles"))


def fingerprint(manifest: DataFrame) -> DataFrame:
    """run_id, fingerprint, articles: one SHA-256 over a run's sorted lines `article_id NUL
    outlet`. A digest is sequential, so a run is read by one task; it reads the sorted lines
    as a stream and holds none of them."""
    lines = manifest.select("run_id", "article_id", "outlet").repartition("run_id").sortWithinPartitions("run_id", "article_id", "outlet")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, n = None, hashlib.sha256(), 0

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([now]), pa.array([digest.hexdigest()]), pa.array([n], pa.int64())], names=["run_id", "fingerprint", "articles"])

        for batch in batches:
            for run_id, article, outlet in zip(*(batch.column(x).to_pylist() for x in ("run_id", "article_id", "outlet")), strict=True):
                if n and run_id != now:
                    yield out()
                    digest, n = hashlib.sha256(), 0
                now, n = run_id, n + 1
                digest.update(f"{article}\0{outlet}\n".encode())
        if n:
            yield out()

    return lines.mapInArrow(run, "run_id string, fingerprint string, articles long")


def stage_coverage(events: DataFrame, required: list[str]) -> DataFrame:
    """Articles that lack a required stage among events(article_id, stage)."""
    seen = events.groupBy("article_id").agg(F.collect_set("stage").alias("stages"))
    lacking = F.array_sort(F.array_except(F.array(*map(F.lit, required)), "stages"))
    return seen.select("article_id", lacking.alias("missing")).where(F.size("missing") > 0)


def input_rollup(obs: DataFrame) -> DataFrame:
    return obs.groupBy("url", "outlet").agg(F.min("day").alias("first_observed"), F.max("day").alias("last_observed"))


def pilot_sample(inputs: DataFrame, outlets: int = 12) -> DataFrame:
    """The first and the last URL of each of the largest outlets."""
    top = inputs.where("outlet is not null").groupBy("outlet").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "outlet").limit(outlets)
    rows = inputs.join(F.broadcast(top.select("outlet")), "outlet")  # at most `outlets` rows
    ends = rows.groupBy("outlet").agg(F.min(F.struct("first_observed", "url")).alias("a"), F.max(F.struct("first_observed", "url")).alias("b"))
    return ends.select("outlet", F.explode(F.array_distinct(F.array("a", "b"))).alias("x")).select("outlet", "x.url", "x.first_observed")


def claimable(queue: DataFrame, now, limit: int, per_outlet: int, inflight: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """The next work: due rows in order of (due_at, article_id), at most per_outlet an outlet
    with what is in flight, at most limit in all. queue(article_id, outlet, due_at, state)."""
    due = queue.where((F.col("state") == "ready") & (F.col("due_at") <= F.lit(now)))
    due = due.where(~F.col("outlet").isin(*excluded)) if excluded else due
    nth = F.row_number().over(Window.partitionBy("outlet").orderBy("due_at", "article_id"))
    free = F.lit(per_outlet) - F.coalesce("inflight", F.lit(0))
    some = due.withColumn("nth", nth).where(F.col("nth") <= per_outlet).join(inflight, "outlet", "left").where(F.col("nth") <= free)
    return some.orderBy("due_at", "article_id").limit(limit).select("article_id", "outlet", "due_at")


def due_page(queue: DataFrame, now, size: int, after: tuple | None = None) -> DataFrame:
    """A page of due work, after a (due_at, article_id) cursor."""
    rows = queue.where(F.col("due_at") <= F.lit(now))
    if after:
        rows = rows.where((F.col("due_at") > F.lit(after[0])) | ((F.col("due_at") == F.lit(after[0])) & (F.col("article_id") > after[1])))
    return rows.orderBy("due_at", "article_id").limit(size)


def schedule(backlog: DataFrame, picks: int, per_outlet: int) -> DataFrame:
    """The order in which a scheduler that always takes from the outlet with the largest
    (waiting / (in flight + 1), name) picks: backlog(outlet, waiting, inflight)."""
    room = F.least(F.col("waiting"), F.lit(per_outlet) - F.col("inflight"))
    each = backlog.withColumn("room", room).where("room > 0").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("room") - 1)))
    priority = (F.col("waiting") - F.col("j")) / (F.col("inflight") + F.col("j") + 1)
    return each.select("outlet", "j", priority.alias("priority")).orderBy(F.desc("priority"), F.desc("outlet"), "j").limit(picks)


def _days(events: DataFrame, time: str) -> Column:
    """The days of a column of times; one piece for a column of another type."""
    return F.to_date(time) if dict(events.dtypes)[time].startswith(("timestamp", "date")) else F.lit(0)


def streaks(events: DataFrame, key: str, hit: Column, order: list[str], piece: Column | None = None) -> DataFrame:
    """events with the length of the run of hits that each ends, 0 where it is none: its
    position less that of the last event that is no hit. Keys are worked on in pieces, the
    days of order[0] where none are given."""
    marked = events.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    rows = numbered(marked, key, order, _days(events, order[0]) if piece is None else piece, {"_missed": F.max(F.when(~F.col("_hit"), F.col("_n")))})
    inside = Window.partitionBy(key, "_piece").orderBy(*order)
    at = F.col("_before") + F.col("_n")
    missed = F.max(F.when(~F.col("_hit"), at)).over(inside)
    return rows.withColumn("streak", at - F.coalesce(missed, "_missed", F.lit(0))).drop("_hit", "_missed", "_before", "_n", "_piece")


def paused_outlets(events: DataFrame, order: list[str]) -> DataFrame:
    """Outlets to pause: two blocks running, or one rate limit or unreadable robots file."""
    runs = streaks(events, "outlet", F.col("status") == "blocked", order)
    return runs.where((F.col("streak") >= 2) | F.col("status").isin("rate_limited", "robots_unavailable")).select("outlet").distinct()


def rolling(events: DataFrame, key: str, value: str, n: int, order: list[str], piece: Column | None = None, reset: Column | None = None) -> DataFrame:
    """events with the last n values of their key, since the last event for which reset holds: that
    one's own window still has what came before it. Keys are worked on in pieces, the days of
    order[0] where none are given; a piece hands on its last n - 1 values and the place of its
    last reset."""
    if reset is not None:
        marked = events.withColumn("_reset", F.coalesce(reset, F.lit(False)))
        placed = numbered(marked, key, order, _days(events, order[0]) if piece is None else piece, {"_was": F.max(F.when(F.col("_reset"), F.col("_n")))})
        at = F.col("_before") + F.col("_n")
        earlier = Window.partitionBy(key, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        inside = F.max(F.when(F.col("_reset"), at)).over(earlier)
        placed = placed.withColumn("_since", (at - F.coalesce(inside, "_was", F.lit(0))).cast("int")).drop("_reset", "_was", "_before", "_n")
        found = rolling(placed, key, value, n, order, F.col("_piece"))
        few = F.least(F.size("last"), F.col("_since"))
        return found.withColumn("last", F.slice("last", F.size("last") - few + 1, few)).drop("_since")
    tail = F.transform(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("_n", value)))), 1, n - 1), lambda x: x[value])
    rows = events.withColumn("_piece", _days(events, order[0]) if piece is None else piece)
    inside = Window.partitionBy(key, "_piece").orderBy(*order)
    rows = rows.withColumn("_n", F.row_number().over(inside))
    back = F.row_number().over(Window.partitionBy(key, "_piece").orderBy(*[F.desc(c) for c in order]))
    ends = rows.withColumn("_back", back).where(F.col("_back") < n)  # n - 1 rows a piece
    each = ends.groupBy(F.col(key).alias("_key"), F.col("_piece").alias("_own")).agg(F.reverse(tail).alias("_tail"))
    # n - 1 pieces before hold n - 1 values at least, if there are so many
    before = Window.partitionBy("_key").orderBy("_own").rowsBetween(-(n - 1), -1)
    each = each.withColumn("_tail", F.flatten(F.collect_list("_tail").over(before)))
    joined = rows.join(each, F.col(key).eqNullSafe(F.col("_key")) & F.col("_piece").eqNullSafe(F.col("_own")), "left")
    here = F.collect_list(value).over(inside.rowsBetween(-(n - 1), 0))
    every = F.concat(F.coalesce("_tail", F.array().cast(f"array<{dict(events.dtypes)[value]}>")), here)
    return joined.withColumn("last", F.slice(every, F.greatest(F.lit(1), F.size(every) - n + 1), n)).drop("_key", "_own", "_tail", "_piece", "_n")


def rate(snapshots: DataFrame, key: str, value: str, time: str) -> DataFrame:
    """Change an hour since the snapshot before."""
    window = Window.partitionBy(key).orderBy(time)
    gap = F.unix_micros(time) - F.unix_micros(F.lag(time).over(window))
    return snapshots.withColumn("per_hour", (F.col(value) - F.lag(value).over(window)) / F.nullif(gap, F.lit(0)) * 3.6e9)


def final_passes(passes: DataFrame, allowed: int = 2) -> DataFrame:
    """An article's result over its passes: attempts and bytes add up, and what is still
    deferred after the allowed passes has failed."""
    done = passes.groupBy("article_id").agg(F.max_by("status", "pass").alias("status"), F.max("pass").alias("passes"), F.sum("attempts").alias("attempts"), F.sum("response_bytes").alias("response_bytes"))
    return done.withColumn("status", F.when((F.col("passes") >= allowed) & (F.col("status") == "deferred"), "failed").otherwise(F.col("status")))


def accepted(events: DataFrame, wanted: DataFrame) -> DataFrame:
    """For wanted(article_id, url, updated_at or null) how many events match and the one that
    does; verdict: accepted, missing, ambiguous or mismatch."""
    e = events.select("article_id", F.col("url").alias("e_url"), F.col("updated_at").alias("e_at"), "text_uri")
    joined = wanted.join(e, "article_id", "left").withColumn("fits", F.col("e_at").isNotNull() & (F.col("updated_at").isNull() | (F.col("e_at") == F.col("updated_at"))))
    found = joined.groupBy("article_id", "url").agg(F.count_if("fits").alias("n"), F.max(F.when(F.col("fits"), F.struct("e_url", "e_at", "text_uri"))).alias("x"))
    verdict = F.when(F.col("n") == 0, "missing").when(F.col("n") > 1, "ambiguous").when(F.col("x.e_url") != F.col("url"), "mismatch").otherwise("accepted")
    return found.select("article_id", "url", verdict.alias("verdict"), F.when(verdict == "accepted", F.col("x.text_uri")).alias("text_uri"))


def evidence_title(attempts_: Column, raw_uri: Column) -> Column:
    """The title of the last extraction that used the accepted body."""
    fits = F.filter(attempts_, lambda a: a["stage"].startswith("extract:") & a["title"].isNotNull() & (a["raw_uri"] == raw_uri))
    return F.when(F.size(fits) > 0, F.element_at(fits, -1)["title"])


def download_index(index: DataFrame, changed: DataFrame) -> DataFrame:
    """The index (url, status) after a batch of changed(url, state, status, result_uri): done
    results with evidence are put in, others taken out."""
    keep = F.coalesce((F.col("state") == "done") & F.col("status").isin("saved", "partial") & F.col("result_uri").isNotNull(), F.lit(False))
    kept = index.join(changed.select("url"), "url", "left_anti")
    return kept.unionByName(changed.where(keep).select("url", "status"))


def refresh_index(index: DataFrame | None, rows: DataFrame, watermark, expected: int, overlap: str = "120 seconds") -> DataFrame:
    """The index (url, status) of rows(url, state, status, result_uri, updated_at) from an
    earlier one: what changed since `overlap` before the watermark is merged. Where the
    result has not the expected number of entries, or there is no index, it is built anew
    from all rows."""
    if index is not None:
        since = F.lit(watermark).cast("timestamp") - F.expr(f"INTERVAL {overlap}")
        merged = download_index(index, rows.where(F.col("updated_at").cast("timestamp") >= since))
        if merged.count() == expected:
            return merged
    return download_index(rows.select("url", "status").limit(0), rows)


def browser_gate(best: Column, first_status: Column, http_status: Column, paywall: Column, homepage: Column, seconds: Column, phase: Column) -> Column:
    """Whether a browser may be tried for an article: the first rule that holds."""
    return (
        F.when(phase == "archive", "skipped").when(best == "candidate", "not_needed")
        .when(first_status.isin("blocked", "robots_denied", "robots_unavailable", "rate_limited") | F.coalesce(paywall, F.lit(False)), "not_applicable: restricted")
        .when(F.coalesce(http_status, F.lit(0)) != 200, "not_applicable: no document").when(homepage, "not_applicable: homepage")
        .when(seconds > 240, "deferred").when(phase == "publisher", "handoff").otherwise("render")
    )


def best_candidate(rows: DataFrame) -> DataFrame:
    """The best text of each article among rows(article_id, stage_no, raw_uri, quality, text):
    the last assessment of a body replaces earlier ones; then quality, then length."""
    newest = rows.groupBy("article_id", "raw_uri").agg(F.max_by(F.struct("quality", "text", "stage_no"), "stage_no").alias("x")).select("article_id", "raw_uri", "x.*")
    rank = F.when(F.col("quality") == "candidate", 2).when(F.col("quality") == "partial", 1).otherwise(0)
    best = F.max_by(F.struct("raw_uri", "quality", "text"), F.struct(rank, F.length("text"), -F.col("stage_no")))
    return newest.groupBy("article_id").agg(best.alias("b")).select("article_id", "b.*")


def final_status(quality: Column, unresolved: Column) -> Column:
    """What an article ends as after all stages."""
    return F.when(quality == "candidate", "saved").when(unresolved, "deferred").when(quality == "partial", "partial").otherwise("exhausted")


def to_reanalyse(events: DataFrame, version: int) -> DataFrame:
    """Stored bodies that an older extractor assessed, each once, the current best first."""
    old = events.where(F.col("raw_uri").isNotNull() & (F.coalesce("extractor_version", F.lit(0)) < version))
    return old.groupBy("article_id", "raw_uri").agg(F.max(F.col("is_best").cast("int")).alias("is_best")).orderBy("article_id", F.desc("is_best"), "raw_uri")
