"""Where an unfinished article's next archive request goes, from its JSON checkpoint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.urls import host

SERVICES = ("archive.org", "web.archive.org", "local")


def _at(document: Column, path: str) -> Column:
    return F.get_json_object(document, path)


def archive_service(checkpoint: Column, first_observed: Column, version: str) -> Column:
    """local, archive.org or web.archive.org; invalid for a hint that names none of them.

    Work that needs no archive is local: a stored body that another extractor version read
    or that goes on elsewhere. Otherwise a hint decides; else the lookups, of the day first
    observed and then of any day: without an answer archive.org has to give one, and a
    snapshot not yet seen is fetched from web.archive.org."""
    state = F.coalesce(checkpoint, F.lit("{}"))
    work = F.coalesce(F.when(_at(state, "$.kind") == "phased-toolbox", _at(state, "$.pipeline")).otherwise(state), F.lit("{}"))
    body = F.coalesce(_at(work, "$.best.raw_uri"), F.lit("")) != ""
    other = ~_at(work, "$.extractor_version").eqNullSafe(F.lit(version))
    goes_on = F.coalesce(F.json_array_length(_at(work, "$.best.continuations")), F.lit(0)) > 0
    hint = _at(work, "$.archive_service")
    lookups = F.from_json(_at(work, "$.archive_lookups"), "map<string,string>")
    seen = F.coalesce(F.from_json(_at(work, "$.archive_seen"), "array<string>"), F.array().cast("array<string>"))

    def answer(stamp: Column, otherwise: Column) -> Column:
        payload = _at(F.try_element_at(lookups, stamp), "$.payload")
        snapshot = F.replace(F.coalesce(_at(payload, "$.archived_snapshots.closest.url"), F.lit("")), F.lit("http://web.archive.org/"), F.lit("https://web.archive.org/"))
        there = F.coalesce(_at(payload, "$.archived_snapshots.closest.available") == "true", F.lit(False))
        return (
            F.when(payload.isNull(), "archive.org").when(~there, otherwise)
            .when(~host(snapshot).eqNullSafe(F.lit("web.archive.org")), "local").when(~F.array_contains(seen, snapshot), "web.archive.org").otherwise(otherwise)
        )

    day = F.replace(F.coalesce(first_observed.cast("string"), F.lit("")), F.lit("-"), F.lit(""))
    found = answer(day, answer(F.lit(""), F.lit("local")))
    return F.when(body & (other | goes_on), "local").when(hint.isNotNull(), F.when(hint.isin(*SERVICES), hint).otherwise("invalid")).otherwise(found)


#: What attempts look like to the retry rule.
ATTEMPTS = "array<struct<stage string, status string, url string, http_attempts array<struct<http_status int>>>>"


def archive_outage(attempts: Column, url: Column) -> Column:
    """Whether attempts (ATTEMPTS) show that the publisher had answered for good when only an
    archive was out: one HTTP stage for the URL that ended with 401, 403, 404 or 410, a
    browser stage that did not apply, no deferred extraction, and an archive that failed."""
    gone = lambda e: F.coalesce(F.element_at(e["http_attempts"], -1)["http_status"].isin(401, 403, 404, 410), F.lit(False))
    stage = lambda *names: F.filter(attempts, lambda e: e["stage"].isin(*names))
    http, browser, other = stage("http"), stage("browser"), stage("publisher_url_discovery")
    answered = (F.size(http) == 1) & F.forall(http, lambda e: (F.size(e["http_attempts"]) > 0) & (e["url"] == url) & e["status"].isin("unavailable", "blocked") & gone(e))
    skipped = (F.size(browser) > 0) & F.forall(browser, lambda e: e["status"] == "not_applicable")
    searched = F.forall(other, lambda e: e["status"].isin("no_candidate", "not_needed") | (e["status"].isin("unavailable", "blocked") & (F.size(e["http_attempts"]) > 0) & gone(e)))
    read = ~F.exists(attempts, lambda e: e["stage"].startswith("extract:") & (e["status"] == "deferred"))
    out = F.exists(attempts, lambda e: (e["stage"].isin("archive", "archive_canonical") & e["status"].isin("temporary_error", "rate_limited", "robots_unavailable")) | ((e["stage"] == "archive_lookup") & (e["status"] == "error")))
    return F.coalesce(answered & skipped & searched & read & out, F.lit(False))
