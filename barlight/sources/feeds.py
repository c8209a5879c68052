"""Landed article payloads to NEWS rows.

Each feed has the schema of what its provider returns, a reader for landed JSON, and a mapping. A
payload row also carries the ``ticker`` it was requested for, and may carry the ``page`` it answered:
a feed's order is page by page (a missing page counts as the first), then by place in the page. Caps
and duplicates go by that order, so the copy that stays is the first that the provider gave; articles
of one place (payloads that were landed one by one) go newest first into caps, and the earliest of
equal URLs stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.functions.text import first_text
from barlight.functions.times import to_utc
from barlight.operators.layout import KEY
from barlight.operators.news import (
    dedupe_canonical,
    in_date_range,
    long_enough,
    missing_last,
    relevant,
    tag_source,
    with_published,
    with_url,
)
from barlight.operators.skew import first_per_key, top_per_key
from barlight.session import use_utc

# Payload fields of the providers.
NEWSAPI = (
    "ticker string, status string, totalResults long, articles array<struct<title: string, description: string, "
    "content: string, url: string, publishedAt: string, source: struct<name: string>>>, page long"
)
MARKETAUX = (
    "ticker string, data array<struct<title: string, description: string, url: string, published_at: string, "
    "source: string>>, page long"
)
GDELT = (
    "ticker string, articles array<struct<title: string, url: string, seendate: string, published: string, "
    "sourceCommonName: string, domain: string>>, page long"
)
RSS = (
    "ticker string, entries array<struct<title: string, link: string, id: string, published: string, "
    "updated: string, summary: string, source: string>>, page long"
)
REGIONAL = (
    "ticker string, feed string, entries array<struct<title: string, link: string, published: string, summary: string>>, page long"
)


def read_payload(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed JSON payloads with an explicit schema; nothing is inferred."""
    return use_utc(spark).read.schema(schema).json(path)


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A landing folder that is missing or empty means the feed is skipped."""
    from pyspark.errors import AnalysisException

    try:
        df = read_payload(spark, path, schema)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return None if df.isEmpty() else df


_PLACE = ("_page", "_at")


def _items(payload: DataFrame, column: str, *keep: str) -> DataFrame:
    page = F.coalesce(F.col("page").cast("long"), F.lit(0)) if "page" in payload.columns else F.lit(0).cast("long")
    return payload.select(KEY, *keep, page.alias("_page"), F.posexplode(column).alias("_at", "a"))


def _name_or_text(c: Column, field: str) -> Column:
    """A source that is an object gives its ``field``, a plain string is itself."""
    return F.when(F.startswith(F.trim(c), F.lit("{")), F.get_json_object(c, f"$.{field}")).otherwise(c)


def newsapi_news(payload: DataFrame, max_results: int | None = None) -> DataFrame:
    a = _items(payload.filter((F.col("status") == "ok") | F.col("status").isNull()), "articles")
    rows = a.select(
        KEY, *_PLACE, "a.title", "a.description", "a.content", "a.url", to_utc("a.publishedAt").alias("published"),
        F.col("a.source.name").alias("source"),
    )
    return _capped(rows, max_results)


def marketaux_news(payload: DataFrame, max_results: int | None = None) -> DataFrame:
    a = _items(payload, "data")
    rows = a.select(
        KEY, *_PLACE, "a.title", "a.description", "a.url", to_utc("a.published_at").alias("published"),
        _name_or_text(F.col("a.source"), "name").alias("source"),
    )
    return _capped(rows, max_results)


def gdelt_news(payload: DataFrame, max_results: int | None = None) -> DataFrame:
    a = _items(payload, "articles")
    rows = a.select(
        KEY, *_PLACE, "a.title", first_text("a.title").alias("text"), "a.url",
        to_utc(_filled("a.seendate", "a.published")).alias("published"),
        _filled("a.sourceCommonName", "a.domain").alias("source"),
    )
    return _capped(with_url(rows), max_results)


def rss_news(payload: DataFrame, max_results: int | None = None) -> DataFrame:
    a = _items(payload, "entries")
    rows = a.select(
        KEY, *_PLACE, "a.title", first_text("a.title").alias("text"), _filled("a.link", "a.id").alias("url"),
        to_utc(_filled("a.published", "a.updated")).alias("published"),
        F.when(F.startswith(F.trim("a.source"), F.lit("{")), F.get_json_object("a.source", "$.title")).alias("source"),
    )
    return _first(dedupe_canonical(with_url(rows), _PLACE), max_results).drop(*_PLACE)


def regional_news(
    payload: DataFrame,
    query: Column | str,
    start: str | None = None,
    end: str | None = None,
    max_results: int | None = None,
    more_than: int = 50,
    feeds: int = 8,
) -> DataFrame:
    """Regional finance feeds: per-feed cap, query match, text = title, length and date filters.

    ``feeds`` is the number of feeds that were asked for; ``max_results`` is shared among them evenly.
    """
    rows = _items(payload, "entries", "feed").select(
        KEY, *_PLACE, "feed", "a.title", first_text("a.title").alias("text"), "a.summary", F.col("a.link").alias("url"),
        to_utc("a.published").alias("published"),
    )
    rows = _first(rows, max_results and max(1, max_results // feeds), KEY, "feed")
    rows = with_published(long_enough(relevant(rows, query), "text", more_than)).drop("feed")
    if start and end:
        rows = in_date_range(rows, start, end, whole_last_day=False)
    first = first_per_key(rows, [KEY, "url"], [*[F.col(c) for c in _PLACE], *missing_last("published")])
    return tag_source(first.drop(*_PLACE), "MoneyControl")


def _filled(*fields: str) -> Column:
    """First field that is neither missing nor empty."""
    return F.coalesce(*[F.when(F.col(f) != "", F.col(f)) for f in fields])


def _first(rows: DataFrame, max_results: int | None, *keys: str) -> DataFrame:
    """The first ``max_results`` of each key in the feed's order; of one place the newest."""
    if not max_results:
        return rows
    order = [*[F.col(c).asc() for c in _PLACE], F.col("published").desc_nulls_last(), F.col("url").asc_nulls_last()]
    return top_per_key(rows, [*keys] or [KEY], order, max_results)


def _capped(rows: DataFrame, max_results: int | None) -> DataFrame:
    """The first ``max_results`` per ticker as the provider gives them, then the first of each canonical URL."""
    return dedupe_canonical(_first(rows, max_results), _PLACE).drop(*_PLACE)
