"""The questions that users ask, each answered by DataFrames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from presswork.operators import audit as _audit
from presswork.operators import browse as _browse
from presswork.operators import classify as _classify
from presswork.operators import collection as _collection


def audit(facts: DataFrame, country: str, start: date, end: date, interval: str = "month") -> dict[str, DataFrame]:
    """summary, timeline and outlets of a country's coverage: facts as `daily` makes them,
    with target_country."""
    _audit.validate(country, start, end, interval)
    rows = _audit.audit(facts.where(facts["target_country"] == country), start, end, interval)
    return {
        "summary": _audit.summary(rows),
        "timeline": rows.where("kind = 'timeline'").select("bucket", "outlet_group", "articles", "active_outlets", "active_days").orderBy("bucket", "outlet_group"),
        "outlets": rows.where("kind = 'outlet'").drop("kind", "bucket").orderBy(rows["articles"].desc(), "outlet"),
    }


def article_catalog(obs: DataFrame, pivot: str = "CH") -> DataFrame:
    return _classify.catalog_codes(obs, pivot)


def browse(obs: DataFrame, country: str, start: date, end: date, mode: str = "broad", origin: str = "gdelt", place: bool = False, outlet: str = "") -> dict[str, DataFrame]:
    """outlets, timeline and totals of the stories that a selection has."""
    rows = _browse.select(obs, country, mode, origin, place)
    return {"outlets": _browse.outlets(rows, start, end), "timeline": _browse.timeline(rows, outlet), "totals": _browse.totals(rows, start, end, outlet)}


def stories(obs: DataFrame, country: str, start: date, end: date, mode: str = "broad", origin: str = "gdelt", place: bool = False, outlet: str = "", page: int = 0) -> DataFrame:
    return _browse.stories(_browse.select(obs, country, mode, origin, place), start, end, outlet, page)


def article_places(obs: DataFrame, country: str, day: date, url: str, origin: str = "gdelt") -> DataFrame:
    return _browse.article_places(_browse.select(obs, country, "broad", origin), country, day, url)


def downloads(index: DataFrame, changed: DataFrame) -> DataFrame:
    return _collection.download_index(index, changed)


def downloaded_article(events: DataFrame, wanted: DataFrame) -> DataFrame:
    return _collection.accepted(events, wanted)


def extraction_status(newest: DataFrame, live: DataFrame) -> DataFrame:
    return _collection.public_status(_collection.progress(newest, live))
