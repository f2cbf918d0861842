import json
from datetime import date

from pyspark.sql import functions as F

from presswork import api
from presswork.functions import archive


def test_archive_service(spark):
    hit = lambda url: {"payload": {"archived_snapshots": {"closest": {"available": True, "url": url}}}}
    none = {"payload": {"archived_snapshots": {}}}
    web = "http://web.archive.org/web/1/x"
    cases = [
        (None, "archive.org"), ({"best": {"raw_uri": "r"}, "extractor_version": "1"}, "local"), ({"best": {"raw_uri": "r", "continuations": ["x"]}, "extractor_version": "2"}, "local"),
        ({"best": {"raw_uri": "r"}, "extractor_version": "2"}, "archive.org"), ({"archive_service": "web.archive.org"}, "web.archive.org"), ({"archive_service": "nowhere"}, "invalid"),
        ({"archive_lookups": {"20250102": hit(web)}}, "web.archive.org"), ({"archive_lookups": {"20250102": hit("https://evil.org/x")}}, "local"),
        ({"archive_lookups": {"20250102": none}}, "archive.org"), ({"archive_lookups": {"20250102": none, "": none}}, "local"),
        ({"archive_lookups": {"20250102": hit(web), "": none}, "archive_seen": [web.replace("http:", "https:")]}, "local"),
        ({"kind": "phased-toolbox", "pipeline": {"archive_service": "local"}}, "local"), ({"kind": "phased-toolbox", "pipeline": None}, "archive.org"),
    ]
    rows = spark.createDataFrame([(i, None if c is None else json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, c string")
    found = rows.select("i", archive.archive_service(F.col("c"), F.lit(date(2025, 1, 2)), "2").alias("s")).orderBy("i").collect()
    assert [r["s"] for r in found] == [s for _, s in cases]


def test_archive_outage(spark):
    http = ("http", "unavailable", "u", [(404,)])
    browser, out = ("browser", "not_applicable", None, []), ("archive_lookup", "error", None, [])
    cases = [
        ([http, browser, out], True), ([browser, out], False), ([http, out], False), ([http, browser], False), ([("http", "unavailable", "other", [(404,)]), browser, out], False),
        ([("http", "unavailable", "u", [(500,)]), browser, out], False), ([("http", "unavailable", "u", []), browser, out], False), ([http, browser, out, ("extract:x", "deferred", None, [])], False),
        ([http, browser, out, ("publisher_url_discovery", "unavailable", None, [(410,)])], True), ([http, browser, out, ("publisher_url_discovery", "temporary_error", None, [])], False), ([], False),
    ]
    rows = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], f"i int, a {archive.ATTEMPTS}")
    found = rows.select("i", archive.archive_outage(F.col("a"), F.lit("u")).alias("o")).orderBy("i").collect()
    assert [r["o"] for r in found] == [o for _, o in cases]


def test_api(spark):
    facts = spark.createDataFrame([("KE", date(2025, 1, 1), "Local", "a.ke", "KE", "KE", "KE", "estimate_domain_agree", 20), ("KE", date(2025, 1, 2), "Local", None, "KE", "KE", None, "estimate_only", 100)], "target_country string, day date, outlet_group string, outlet string, outlet_country string, estimated_country string, domain_country string, classification_basis string, article_count long")
    found = api.audit(facts, "KE", date(2025, 1, 1), date(2025, 1, 31))
    local = found["summary"].where("outlet_group = 'Local'").first()
    assert (local["largest_outlet"], local["largest_outlet_articles"], local["missing_domain_articles"], local["active_outlets"]) == ("a.ke", 20, 100, 1)
    assert found["summary"].where("outlet_group = 'Chinese'").first()["active_outlets"] == 0
    assert found["timeline"].count() == 1 and found["outlets"].first()["articles"] == 100
