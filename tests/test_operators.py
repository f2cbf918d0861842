"""Fixtures with expected values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from presswork.functions import pages, text, urls
from presswork.operators import audit, browse, classify, collection, export
from presswork.plans.components import components
from presswork.sources import arrays, files, tables
from presswork.streaming import pacing

OBS = "day date, url string, outlet string, estimated_country string, domain_country string, countries array<string>, specific_location_countries array<string>"


@pytest.fixture(scope="module")
def obs(spark):
    d = date
    return spark.createDataFrame([
        (d(2025, 1, 1), "https://a.ke/1", "a.ke", "KE", "KE", ["CH", "KE"], ["KE"]),
        (d(2025, 1, 2), "https://a.ke/1", "a.ke", "KE", "KE", ["CH", "KE", "US"], []),
        (d(2025, 1, 3), "https://b.com/2", "b.com", "KE", None, ["CH"], []),
        (d(2025, 1, 3), "https://c.ke/3", "c.ke", "US", "KE", ["CH", "KE"], ["KE"]),
    ], OBS)


JAN = (date(2025, 1, 1), date(2025, 1, 31))


def test_browse_counts(obs):
    count = lambda **k: browse.totals_by_url(browse.select(obs, "KE", **k), *JAN).first()["count"]
    assert count() == 2
    assert count(origin_name="cctld") == 2
    assert count(origin_name="both") == 1
    assert count(mode_name="only_pair", place=True) == 1
    pair = browse.latest(browse.select(obs, "KE", "only_pair", place=True), *JAN).first()
    assert pair["last_observed"] == date(2025, 1, 1)
    assert browse.latest(browse.select(obs, "KE"), *JAN).where("outlet = 'a.ke'").first()["last_observed"] == date(2025, 1, 2)
    assert browse.totals_by_url(browse.select(obs, "KE"), date(2025, 2, 1), date(2025, 2, 28)).first()["count"] == 0
    assert [r["count"] for r in browse.timeline(browse.select(obs, "KE")).collect()] == [2]


def test_downloaded(spark, obs):
    got = spark.createDataFrame([("https://a.ke/1", "saved"), ("https://b.com/2", "failed")], "url string, status string")
    rows = browse.latest(browse.select(obs, "KE"), *JAN, got, only_downloaded=True).collect()
    assert [r["url"] for r in rows] == ["https://a.ke/1"]
    assert {r["url"]: r["download_status"] for r in browse.latest(browse.select(obs, "KE"), *JAN, got).collect()} == {"https://a.ke/1": "saved", "https://b.com/2": None}


def test_validation():
    audit.validate("KE", date(2015, 1, 1), date(2025, 12, 31), "week")
    for bad in (("CH", *JAN, "day"), ("ke", *JAN, "day"), ("KE", JAN[1], JAN[0], "day"), ("KE", *JAN, "hour"), ("KE", date(2014, 1, 1), JAN[1], "day")):
        with pytest.raises(ValueError):
            audit.validate(*bad)


def test_weeks_start_on_monday(spark):
    rows = spark.createDataFrame([(date(2025, 1, 5),), (date(2025, 1, 6),)], "day date").select(audit.bucket(F.col("day"), "week").alias("b")).collect()
    assert [r["b"] for r in rows] == [date(2024, 12, 30), date(2025, 1, 6)]


def test_periods_and_assessment(spark):
    timeline = spark.createDataFrame([(date(2025, 1, 1), "Chinese", 90, 4), (date(2025, 1, 1), "Local", 90, 4), (date(2025, 2, 1), "Chinese", 90, 4)], "bucket date, outlet_group string, articles long, active_outlets long")
    series = audit.periods(timeline, date(2025, 1, 1), date(2025, 2, 28), "month", [date(2025, 2, 15)])
    feb = {r["outlet_group"]: r for r in series.where("period = date'2025-02-01'").collect()}
    assert feb["Local"]["available_days"] == 27 and feb["Local"]["articles"] == 0
    found = audit.assess(series, 3, 20, 80).first()
    assert (found["complete"], found["passing"], found["excluded"], found["percent"], found["meets"]) == (1, 1, 1, 100.0, True)
    none = audit.assess(audit.periods(timeline, date(2025, 2, 15), date(2025, 2, 15), "month", [date(2025, 2, 15)]), 3, 20, 80).first()
    assert none["percent"] is None and not none["meets"]
    whole = audit.assess(audit.periods(timeline, date(2025, 1, 1), date(2025, 2, 28), "month", []), 3, 20, 80).first()
    assert whole["percent"] == 50 and not whole["meets"]
    leap = audit.periods(timeline, date(2024, 2, 1), date(2024, 2, 29), "month", []).first()
    assert leap["expected_days"] == 29


def test_csv(spark):
    rows = spark.createDataFrame([("=SUM(1)", 'a"b', None, -1)], "f string, q string, n string, i int")
    assert export.csv_lines(rows, ["f", "q", "n", "i"]).first()["line"] == '"\'=SUM(1)","a""b","","-1"'
    assert export.csv_header(["-a", "b"]) == '"\'-a","b"'


def test_latest_keeps_first_of_ties(spark):
    rows = spark.createDataFrame([("a", 1, 1, "saved"), ("a", 3, 2, "deferred"), ("a", 2, 3, "failed"), ("a", 3, 4, "partial")], "article_id string, updated_at int, seq long, status string")
    assert collection.latest(rows, ["article_id"]).first()["status"] == "deferred"


def test_cohort(spark):
    of = lambda *states: spark.createDataFrame([(s, True) for s in states], "state string, infrastructure_recoverable boolean")
    state = lambda w, p=1, t=1: collection.cohort_state(w, 2, p, t).first()["state"]
    assert state(of("completed")) == "running"
    assert state(of("completed", "working")) == "running"
    assert state(of("completed", None)) == "running"
    assert state(of("paused_limit", "failed")) == "failed"
    assert state(of("completed", "continuing")) == "completed"
    assert state(of("completed", "continuing"), 1, 2) == "continuing"
    ok = lambda w, s="failed": collection.recoverable(w, s, 2).first()["recoverable"]
    assert ok(of("failed", "completed")) and not ok(of("completed", "completed")) and not ok(of("failed", "working")) and not ok(of("failed", "completed"), "running")


def test_schedule_is_greedy(spark):
    import random

    random.seed(5)
    for _ in range(5):
        backlog = [(f"o{i}", random.randint(1, 9), random.randint(0, 2)) for i in range(5)]
        waiting, flight, picks = {o: w for o, w, _ in backlog}, {o: f for o, _, f in backlog}, []
        for _ in range(8):
            open_ = [o for o in waiting if waiting[o] and flight[o] < 4]
            if not open_:
                break
            best = max(open_, key=lambda o: (waiting[o] / (flight[o] + 1), o))
            picks.append(best)
            waiting[best] -= 1
            flight[best] += 1
        df = spark.createDataFrame(backlog, "outlet string, waiting int, inflight int")
        assert [r["outlet"] for r in collection.schedule(df, 8, 4).collect()] == picks


def test_components(spark):
    import random

    random.seed(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (300, 300)] + [(random.randrange(1000, 1100), random.randrange(1000, 1100)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    assert found == {x: root(x) for x in parent if x not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_urls(spark):
    cases = [
        ("https://web.archive.org/web/20200101id_/http://www.A.ke/x", "www.a.ke", True), ("https://web.archive.org/about", None, True),
        ("ftp://a.b/c", None, False), ("https://u:p@a.b/", "a.b", False), ("https://a.b:8080/", "a.b", False), ("https://a.b:443/x", "a.b", True), ("not a url", None, False), (None, None, False),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, u string").select("i", urls.publisher_host(F.col("u")).alias("h"), urls.is_public(F.col("u")).alias("p")).orderBy("i").collect()
    assert [(r["h"], r["p"]) for r in rows] == [(c[1], c[2]) for c in cases]
    two = spark.createDataFrame([("https://www.a.co.ke/x",), ("https://a.b.com",), ("https://host",)], "u string").select(classify.registrable_domain(F.col("u")).alias("d")).collect()
    assert [r["d"] for r in two] == ["a.co.ke", "b.com", None]


def test_retry_after(spark):
    rows = spark.createDataFrame([("7", 1), ("1", 1), ("x", 1), ("x", 3), (None, 9), ("Wed, 01 Jan 2025 00:01:00 GMT", 1)], "v string, n int")
    found = [r["s"] for r in rows.select(text.retry_after(F.col("v"), F.col("n"), F.to_timestamp(F.lit("2025-01-01 00:00:00"))).alias("s")).collect()]
    assert found == [7.0, 5.0, 10.0, 40.0, 120.0, 60.0]


def test_strata():
    assert text.stratum(0, 1) == "8" + "0" * 63
    assert text.stratum(0, 2) == "4" + "0" * 63


def _page(body, head=""):
    return f"<html><head>{head}</head><body><h1>Title</h1>{body}</body></html>"


LONG = "".join(f"<p>Sentence number {i} of a story that goes on for quite a while here.</p>" for i in range(12))


def test_extraction(spark):
    def read(html):
        return pages.extract_pages(spark.createDataFrame([(1, html)], "page_id int, html string")).first()

    assert read("")["quality"] == read(None)["quality"] == "missing"
    whole = read(_page(f"<nav><p>menu</p></nav><article>{LONG}</article><!-- <p>no</p> -->", "<title>Site</title>"))
    assert whole["quality"] == "candidate" and whole["method"] == "single article element" and whole["title"] == "Title" and whole["n_paragraphs"] == 12
    wall = read(_page(f"<article>{LONG}<p>Subscribe to read this article</p></article>"))
    assert wall["quality"] == "partial" and wall["reason"] == "paywall"
    assert read(_page(f"<aside>{LONG}</aside>"))["quality"] == "missing"
    assert read("<title>Access denied</title>" + LONG)["reason"] == "challenge or error page"
    assert read(_page("<article><p>card</p></article>" * 9))["reason"] == "listing"
    text = read("<p>a &amp; b&nbsp;<b>c</b><p>&lt;d&gt;</p> outside <P class='x'>e\n f")["text"]
    assert text == "a & b c\n\n<d>\n\ne f"


def test_pacing(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("a", 40), ("b", 7)], "host string, t long")
    got = {(r["host"], r["t"]): (r["start"], r["wait"]) for r in pacing.starts(rows, "host", F.col("t"), ["t"], 10).collect()}
    assert got == {("a", 0): (0, 0), ("a", 1): (10, 9), ("a", 2): (20, 18), ("a", 40): (40, 0), ("b", 7): (7, 0)}
    events = spark.createDataFrame([("x", 1, "claim", "a"), ("x", 2, "complete", "a"), ("x", 3, "renew", "b"), ("x", 4, "release", "a"), ("x", 5, "complete", "a"), ("x", 6, "claim", "b"), ("x", 30, "renew", "b"), ("x", 31, "claim", "c")], "article string, t long, kind string, owner string")
    got = [(r["holder"], r["ok"]) for r in pacing.leases(events, "article", F.col("t"), ["t"], 10).orderBy("t").collect()]
    assert got == [(None, True), ("a", True), ("a", False), ("a", True), (None, False), (None, True), (None, False), (None, True)]


def test_runs_over_pieces(spark):
    """Pieces of any size give what one window a key gives."""
    rows = spark.createDataFrame([(None if i % 9 == 0 else f"k{i % 2}", i, None if i % 10 == 3 else i % 7 in (1, 2, 3)) for i in range(120)], "key string, t long, hit boolean")
    from pyspark.sql import Window

    whole = collection.streaks(rows, "key", F.col("hit"), ["t"], F.lit(0))
    for size in (1, 4, 50):
        piece = F.floor(F.col("t") / size)
        assert sorted(map(tuple, collection.streaks(rows, "key", F.col("hit"), ["t"], piece).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
        got = {r["t"]: r["last"] for r in collection.rolling(rows, "key", "t", 4, ["t"], piece).collect()}
        want = {r["t"]: r["x"] for r in rows.select("t", F.collect_list("t").over(Window.partitionBy("key").orderBy("t").rowsBetween(-3, 0)).alias("x")).collect()}
        assert got == want
    assert {r["streak"] for r in whole.where("t in (0, 7, 21)").collect()} == {0}


def test_gzip_files(spark, tmp_path):
    import gzip

    one = gzip.compress(b"hello ")
    for name, data in {"two.gz": one + gzip.compress(b"world"), "short.gz": one[:-6], "plain.txt": b"plain", "large.gz": gzip.compress(b"x" * 1000), "bad.gz": one + b"rubbish"}.items():
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[1]: (r["text"], r["error"]) for r in files.bounded_texts(spark, str(tmp_path), 100).collect()}
    assert got["two.gz"] == ("hello world", None) and got["plain.txt"] == ("plain", None)
    assert got["short.gz"][0] is None and "ends" in got["short.gz"][1] and got["large.gz"] == (None, "larger than the limit") and got["bad.gz"][1]


def test_caches_and_checkpoints(spark, tmp_path):
    import json

    for i, n in enumerate((2, 3)):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"country": "KE", "fields": ["url", "countries"], "rows": [[f"u{i}{k}", ["KE"]] for k in range(n)]}))
    assert files.json_cache(spark, str(tmp_path), expected=5, rows_of={"p0.json": 2, "p1.json": 3}).count() == 5
    with pytest.raises(ValueError, match="p1.json"):
        files.json_cache(spark, str(tmp_path), rows_of={"p0.json": 2, "p1.json": 4})
    log = str(tmp_path / "log")
    for i in (1, 2):
        files.append_checkpoints(spark.createDataFrame([(i, "x")], "id long, more string"), log)
    assert {r["id"] for r in files.checkpoints(spark, log, "id long").collect()} == {1, 2}
    assert [r["value"] for r in export.jsonl(spark.createDataFrame([(1, "a")], "n int, s string")).collect()] == ['{"n":1,"s":"a"}']


def test_days_are_skipped_by_folder(spark, tmp_path):
    rows = spark.range(400).select("id", (F.col("id") % 5).alias("k"), F.timestamp_seconds(F.col("id") * 20_000).alias("at"))
    tables.write_by_day(rows, str(tmp_path / "t"), "at", ["k"], files=2)
    some = tables.read_days(spark, str(tmp_path / "t"), date(1970, 1, 3), date(1970, 1, 5))
    assert some.count() == rows.where("date(at) between '1970-01-03' and '1970-01-05'").count() > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1970-01-05)], PushedFilters: []" in plan


def test_index_is_rebuilt_when_counts_differ(spark):
    rows = spark.createDataFrame([("a", "done", "saved", "u", 1000), ("b", "done", "partial", "u", 1000), ("c", "ready", "saved", "u", 1000), ("d", "done", "saved", "u", 2000)], "url string, state string, status string, result_uri string, s long").withColumn("updated_at", F.timestamp_seconds("s"))
    mark = __import__("datetime").datetime(1970, 1, 1, 0, 33, 0)
    old = spark.createDataFrame([("a", "saved"), ("c", "saved")], "url string, status string")
    read = lambda df: {r["url"]: r["status"] for r in df.collect()}
    assert read(collection.refresh_index(old, rows, mark, 3)) == {"a": "saved", "c": "saved", "d": "saved"}  # the merge alone
    assert read(collection.refresh_index(old, rows, mark, 4)) == {"a": "saved", "b": "partial", "d": "saved"}  # built anew
    assert read(collection.refresh_index(None, rows, mark, 0)) == {"a": "saved", "b": "partial", "d": "saved"}


def test_domains_and_links(spark):
    def domain(url):
        return spark.range(1).select(classify.registrable_domain(F.lit(url)).alias("x")).first()["x"]

    assert [domain(f"https://{h}/x") for h in ("www.a.co.ke", "a.co.ke", "co.ke", "b.news.com", "www.a.com.au", "x.org", "localhost")] == ["a.co.ke", "a.co.ke", "co.ke", "news.com", "a.com.au", "x.org", None]

    def page(url, link):
        return spark.range(1).select(urls.other_page(F.lit(url), F.lit(link)).alias("x")).first()["x"]

    assert page("https://a.ke/n/story", "/n/other-story") == "https://a.ke/n/other-story" and page("https://a.ke/n/story", "second") == "https://a.ke/n/second"
    assert page("https://a.ke/n/story", "https://b.ke/n/other") is None and page("https://a.ke/n/story", "/n") is None and page("https://a.ke/n/story", "story") is None
    assert page("https://a.ke/n/story", "//a.ke/n/third1") == "https://a.ke/n/third1" and page("https://a.ke/n/story", "?p=2") == "https://a.ke/n/story?p=2"
    assert [spark.range(1).select(urls.normal_host(F.lit(x)).alias("x")).first()["x"] for x in (" A.ke. ", "a b", "", "x/y")] == ["a.ke", None, None, None]
    evidence = lambda uri, run="r.1": spark.range(1).select(urls.evidence_path(F.lit(uri), "b", F.lit(run), F.lit("art")).alias("x")).first()["x"]
    assert evidence("gs://b/runs/r.1/results/art/x.json.gz") and not evidence("gs://b/runs/rX1/results/art/x.json") and not evidence("gs://b/runs/r.1/results/art/x/y.json")


def test_lineage_needs_a_shared_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from presswork.plans import lineage

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        lineage.shared_dir(far)
    assert lineage.shared_dir(spark)


def test_stream_equals_batch(spark):
    from datetime import datetime

    from presswork.streaming import stateful

    at = lambda d: datetime(2025, 1, d)
    rows = spark.createDataFrame([("a", at(1), 1, "saved", "o"), ("a", at(3), 2, "deferred", "o"), ("a", at(2), 3, "failed", "o"), ("b", at(1), 4, "partial", "o"), ("b", at(1), 5, "failed", "o"), ("c", at(1), 6, "saved", "o"), ("c", at(4), 7, "partial", "o")], "article_id string, updated_at timestamp, seq long, status string, outlet string")
    assert {(r["outlet"], r["status"]): r["articles"] for r in stateful.stream_latest(spark, rows).collect()} == {("o", "partial"): 2}


def test_order_of_exports(spark):
    rows = spark.createDataFrame([("k", i) for i in range(10)] + [("k", 99)], "key string, i int")
    assert export.increasing(rows, "key", ["i"]).count() == 0 and export.duplicate_keys(rows, ["key"]).count() == 1


def test_files(spark, tmp_path):
    import gzip
    import json

    part = {"country": "KE", "fields": ["day", "url", "places"], "rows": [["2025-01-01", "u", ["Nairobi"]], ["2025-01-02", "v", []]]}
    (tmp_path / "c.json").write_text(json.dumps(part))
    rows = files.json_cache(spark, str(tmp_path / "c.json"), ("places",), 2).orderBy("day").collect()
    assert rows[0]["places"] == ["Nairobi"] and rows[1]["url"] == "v"
    with pytest.raises(ValueError):
        files.json_cache(spark, str(tmp_path / "c.json"), ("places",), 3)
    for name, body in {"good": '[{"a":1},{"a":2}]', "comma": '[{"a":1},]', "rest": '[{"a":1}] x', "kind": "[1]"}.items():
        (tmp_path / f"m-{name}.json").write_text(body)
    found = arrays.manifests(spark, str(tmp_path / "m-*.json")).collect()
    assert sum(r["item"] is not None for r in found) == 2 and sum(r["error"] is not None for r in found) == 3
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"x" * 1000))
    assert files.bounded_texts(spark, str(tmp_path / "b.gz"), 10).first()["error"] and files.bounded_texts(spark, str(tmp_path / "b.gz"), 1000).first()["text"] == "x" * 1000


def test_best_candidate(spark):
    rows = spark.createDataFrame([("a", 1, "r1", "candidate", "xxxx"), ("a", 2, "r1", "partial", "xx"), ("a", 3, "r2", "partial", "xxx")], "article_id string, stage_no int, raw_uri string, quality string, text string")
    assert collection.best_candidate(rows).first()["raw_uri"] == "r2"


def test_paused_outlets(spark):
    rows = spark.createDataFrame([("a", 1, "blocked"), ("a", 2, "blocked"), ("b", 1, "blocked"), ("b", 2, "saved"), ("b", 3, "blocked"), ("c", 1, "rate_limited")], "outlet string, t int, status string")
    assert {r["outlet"] for r in collection.paused_outlets(rows, ["t"]).collect()} == {"a", "c"}


PSL = ["// list", "", "com", "  co.ke  rest", "*.ck", "!www.ck", "jp", "city.jp", "*.kawasaki.jp", "!city.kawasaki.jp", "pvt.k12.ma.us", "us"]


def test_suffix_rules(spark, tmp_path):
    from presswork.functions import domains

    (tmp_path / "list.dat").write_text("\n".join(PSL), encoding="utf-8")
    rules = domains.read_rules(spark, str(tmp_path / "list.dat"))
    assert rules.count() == len(PSL) - 2
    want = {
        "com": None, "a.com": "a.com", "x.y.a.com": "a.com", "co.ke": None, "b.co.ke": "b.co.ke", "ke": None, "c.ke": "c.ke", "ck": None, "a.ck": None, "b.a.ck": "b.a.ck", "c.b.a.ck": "b.a.ck",
        "www.ck": "www.ck", "x.www.ck": "www.ck", "kawasaki.jp": "kawasaki.jp", "a.kawasaki.jp": None, "b.a.kawasaki.jp": "b.a.kawasaki.jp", "city.kawasaki.jp": "city.kawasaki.jp", "x.city.kawasaki.jp": "city.kawasaki.jp",
        "a.city.jp": "a.city.jp", "s.pvt.k12.ma.us": "s.pvt.k12.ma.us", "pvt.k12.ma.us": None, "k12.ma.us": "ma.us", "nolist": None, "a.nolist": "a.nolist", "b.a.nolist": "a.nolist", "a..com": None, "10.0.0.1": None, "[::1]": None, "": None,
    }
    hosts = spark.createDataFrame([(h,) for h in [*want, None, "a.com"]], "host string")
    got = {r["host"]: r["domain"] for r in domains.registrable(hosts, rules).collect()}
    assert got == want
    assert domains.registrable(hosts.limit(0), rules).count() == 0
    none = domains.registrable(hosts, rules.limit(0))
    assert {r["host"]: r["domain"] for r in none.collect()}["x.y.a.com"] == "a.com"


def test_evidence_by_host(spark):
    from presswork.functions import domains

    docs = spark.createDataFrame([("https://WWW.a.co.ke./1", 1), ("http://b.a.co.ke/2", 2), ("ftp://a.co.ke/3", 3), ("https://c.ck/4", 4), ("https:///5", 5), ("https://d.news.com/6", 6)], "url string, n int")
    outlets = spark.createDataFrame([("A.co.ke", "KE"), ("news.com", "US"), ("news.com", "GB")], "key string, value string")
    suffixes = spark.createDataFrame([("ke", "KE"), ("ck", "CK")], "key string, value string")
    read = lambda df: {r["n"]: (r["outlet"], r["estimated_country"], r["domain_country"]) for r in df.collect()}
    assert read(classify.with_evidence(docs, outlets, suffixes)) == {1: ("a.co.ke", "KE", "KE"), 2: ("a.co.ke", "KE", "KE"), 4: ("c.ck", None, "CK"), 5: (None, None, None), 6: ("news.com", None, None)}
    ruled = classify.with_evidence(docs, outlets, suffixes, domains.rules(spark.createDataFrame([(x,) for x in PSL], "line string")))
    assert read(ruled) == {1: ("a.co.ke", "KE", "KE"), 2: ("a.co.ke", "KE", "KE"), 4: (None, None, None), 5: (None, None, None), 6: ("news.com", None, None)}


def paced(times, spacing, hold, capacity):
    starts = []
    for t in times:
        out = [s + hold for s in starts]
        now = max(t, starts[-1] + spacing if starts else t)
        while sum(e > now for e in out) >= capacity:
            now = min(e for e in out if e > now)
        starts.append(now)
    return starts


@pytest.mark.parametrize(("capacity", "spacing", "hold"), [(1, 10, 0), (1, 3, 25), (4, 2, 40), (2, 0, 17), (4, 9, 5)])
def test_permits(spark, capacity, spacing, hold):
    import random

    rng = random.Random(capacity + spacing)
    rows = [(h, i, rng.randrange(600)) for h in ("hot", None, "b") for i in range(150 if h == "hot" else 25)]
    df = spark.createDataFrame(rows, "host string, i int, t long")
    got = {(r["host"], r["i"]): (r["start"], r["wait"]) for r in pacing.permits(df, "host", F.col("t"), ["t", "i"], spacing, hold, capacity, F.floor(F.col("t") / 50)).collect()}
    for host in ("hot", None, "b"):
        mine = sorted((t, i) for h, i, t in rows if h == host)
        want = paced([t for t, _ in mine], spacing, hold, capacity)
        assert [got[host, i] for _, i in mine] == [(s, s - t) for s, (t, _) in zip(want, mine, strict=True)]
    assert pacing.permits(df.limit(0), "host", F.col("t"), ["t", "i"], 1).count() == 0


def test_rolling_with_resets(spark):
    import random

    rng = random.Random(3)
    rows = [("k", i, rng.choice("abcr")) for i in range(80)] + [("j", i, "r") for i in range(5)]
    df = spark.createDataFrame(rows, "key string, i int, v string")
    got = {(r["key"], r["i"]): r["last"] for r in collection.rolling(df, "key", "v", 4, ["i"], F.floor(F.col("i") / 6), F.col("v") == "r").collect()}
    for key in "kj":
        held = []
        for k, i, v in rows:
            if k == key:
                held = [*held, v][-4:]
                assert got[k, i] == held
                held = [] if v == "r" else held


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([(f"r{i % 3}", f"a{i % 40}", f"o{i % 7}", i, ["saved", "deferred"][i % 2], i) for i in range(400)], "run_id string, article_id string, outlet string, updated_at long, status string, seq long")
    keys = ["run_id", "article_id"]
    tables.write_bucketed(rows, "bucketed_events", keys, 8, str(tmp_path / "events"))
    tables.write_bucketed(rows.select(*keys, "outlet").distinct(), "bucketed_manifest", keys, 8, str(tmp_path / "manifest"))
    events, manifest = spark.table("bucketed_events"), spark.table("bucketed_manifest")
    newest = collection.latest(events, keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (newest, collection.pending(manifest, newest)):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain = collection.latest(rows, keys)
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, plain.collect()))
    assert collection.pending(manifest, newest).count() == collection.pending(rows.select(*keys, "outlet").distinct(), plain).count() > 0
    for name in ("bucketed_events", "bucketed_manifest"):
        spark.sql(f"DROP TABLE {name}")


def test_padded_gzip(spark, tmp_path):
    import gzip

    one, two = gzip.compress(b"one "), gzip.compress(b"two")
    (tmp_path / "a.bin").write_bytes(one + bytes(512) + two + bytes(7))
    (tmp_path / "b.bin").write_bytes(one + b"\0\0rubbish")
    found = {r["path"][-5]: r for r in files.bounded_texts(spark, str(tmp_path / "*.bin"), 100).collect()}
    assert found["a"]["text"] == "one two" and found["a"]["error"] is None and found["b"]["error"]


def test_budget_and_sorting(spark):
    rows = spark.createDataFrame([("b", 2, None), ("a", 1, "z"), (None, 3, "y")], "outlet string, n int, v string")
    some = spark.range(1000)
    size = export.within_budget(some, 10**9)
    assert size == 8000
    with pytest.raises(ValueError, match="limit"):
        export.within_budget(some, size - 1)
    urls_ = spark.range(1).select(text.tail_link(F.array(*map(F.lit, ("b", "a", "b", "c")))).alias("x"), browse.pages(F.lit(43)).alias("n"), browse.pages(F.lit(0)).alias("none")).first()
    assert tuple(urls_) == (["b", "a"], 3, 1)
    assert [r["n"] for r in browse.sort_by(rows, "v", False, ("v", "n")).collect()] == [2, 3, 1]
    assert [r["n"] for r in browse.sort_by(rows, "n", True, ("v", "n")).collect()] == [3, 2, 1]
    with pytest.raises(ValueError, match="sort"):
        browse.sort_by(rows, "outlet", True, ("n",))
