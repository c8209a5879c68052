"""Article collection: relevance, date range, caps, de-duplication and the union of feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.functions.numeric import as_col
from barlight.functions.text import canonical_url, mentions_any, query_terms
from barlight.operators.layout import KEY
from barlight.operators.skew import first_per_key, top_per_key

# Feeds in the order in which a duplicate URL is kept.
SOURCE_ORDER = ["MoneyControl", "NewsAPI", "MarketAux", "RSS", "GDELT"]


def missing_last(c: Column | str) -> list[Column]:
    c = as_col(c)
    return [c.isNull(), c]


def relevant(news: DataFrame, query: Column | str) -> DataFrame:
    """Rows whose title or summary contains any term of an ' OR ' query."""
    fields = [c for c in ("title", "summary") if c in news.columns]
    return news.filter(mentions_any(query_terms(query), *fields))


def long_enough(news: DataFrame, column: str = "text", more_than: int = 50) -> DataFrame:
    return news.filter(F.length(column) > more_than)


def in_date_range(news: DataFrame, start: str, end: str, whole_last_day: bool = True) -> DataFrame:
    """Published inside [start, end]; the last day counts fully unless ``whole_last_day`` is off.

    Written as plain bounds on the column so the filter reaches the scan. Missing dates drop out.
    """
    lower = F.lit(start).cast("timestamp")
    upper = F.lit(end).cast("timestamp")
    published = F.col("published")
    if whole_last_day:
        return news.filter((published >= lower) & (published < upper + F.expr("INTERVAL 1 DAY")))
    return news.filter((published >= lower) & (published <= upper))


def with_keys(news: DataFrame) -> DataFrame:
    """``url`` and ``published`` as typed nulls where a feed lacks them."""
    absent = {"url": "string", "published": "timestamp"}
    missing = {c: F.lit(None).cast(kind) for c, kind in absent.items() if c not in news.columns}
    return news.withColumns(missing) if missing else news


def with_url(news: DataFrame) -> DataFrame:
    return news.filter(F.coalesce(F.col("url"), F.lit("")) != "")


def with_published(news: DataFrame) -> DataFrame:
    return news.filter(F.col("published").isNotNull())


def tag_source(news: DataFrame, source: str) -> DataFrame:
    return news.withColumn("source", F.lit(source))


def dedupe_canonical(news: DataFrame, first: list[str] | None = None) -> DataFrame:
    """One article per ticker and canonical URL: the first by the ``first`` columns (a feed's own order, where it is known),
    then the earliest published, then the smallest URL."""
    keyed = with_keys(news).withColumn("url_canon", canonical_url("url"))
    order = [*[F.col(c) for c in first or []], *missing_last("published"), *missing_last("url")]
    return first_per_key(keyed, [KEY, "url_canon"], order).drop("url_canon")


def dedupe_across_sources(news: DataFrame, source_order: list[str] | None = None) -> DataFrame:
    """One article per ticker and raw URL, kept from the first source in ``source_order``."""
    ranks = {name: i for i, name in enumerate(source_order or SOURCE_ORDER)}
    pairs = [F.lit(x) for item in ranks.items() for x in item]
    rank = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(len(ranks)))
    return first_per_key(with_keys(news), [KEY, "url"], [rank, *missing_last("published")])


def cap_per_source(news: DataFrame, max_results: int) -> DataFrame:
    """Newest ``max_results`` articles of each ticker and source."""
    news = with_keys(news)
    order = [F.col("published").desc_nulls_last(), F.col("url").asc_nulls_last()]
    return top_per_key(news, [KEY, "source"], order, max_results)


def newest_first(news: DataFrame) -> DataFrame:
    return news.orderBy(F.col("published").desc_nulls_last(), KEY, "url")


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def collect_news(
    feeds: dict[str, DataFrame | None],
    max_articles: int | None = None,
    start: str | None = None,
    end: str | None = None,
    query: Column | str | None = None,
    shares: int = 4,
) -> DataFrame:
    """All feeds in one frame: tagged, window, relevance, cap, union, de-duplication, in this order.

    With ``start`` and ``end`` only articles published in that range (last day included) take part, with
    ``query`` only those that mention one of its terms; each feed's cap counts what is left then.
    ``max_articles`` gives every feed one of ``shares`` equal shares, whatever the number of feeds. A
    duplicate URL is kept from the feed named first. A feed that is absent (``None``) is skipped; an
    empty one adds no rows. Sorting for display is left to :func:`newest_first`, so that the collection
    itself needs no global sort.
    """
    landed = {name: df for name, df in feeds.items() if df is not None}
    if not landed:
        raise ValueError("no feed has landed")
    taken = []
    for name, df in landed.items():
        df = tag_source(df, name)
        if start and end:
            df = in_date_range(with_published(with_keys(df)), start, end)
        if query is not None:
            df = relevant(df, query)
        taken.append(df if max_articles is None else cap_per_source(df, max(1, max_articles // shares)))
    return dedupe_across_sources(union_feeds(taken), [*feeds])


def with_fallback(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Secondary rows only for tickers without any primary row."""
    covered = primary.select(KEY).distinct()
    return primary.unionByName(secondary.join(covered, KEY, "left_anti"), allowMissingColumns=True)


def source_by_mode(feeds: dict[str, DataFrame], mode: str = "rss", fallback: str | None = "newsapi") -> DataFrame:
    """The feed a run asks for; RSS falls back to the secondary feed where it has nothing."""
    chosen = feeds[mode]
    if mode == "rss" and fallback and feeds.get(fallback) is not None:
        return with_fallback(chosen, feeds[fallback])
    return chosen


def text_column(news: DataFrame) -> Column:
    """text, else content, else description, else title, else ''."""
    present = [c for c in ("text", "content", "description", "title") if c in news.columns]
    return F.coalesce(*[F.col(c).cast(T.StringType()) for c in present], F.lit(""))
