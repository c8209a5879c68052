"""Queries over articles: feed mappings, de-duplication, filters, text keys, and sentiment scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barlight.functions import text as tx
from barlight.functions.numeric import clip01, signal
from barlight.operators import news as nw
from barlight.operators import sentiment as sm
from barlight.operators.calendar import normalize_timestamps
from barlight.operators.features import sentiment_flags
from barlight.session import shared_folder
from barlight.sources import feeds
from barlight.sources.scores import ScoreStore
from catalog.base import *  # noqa: F403

HEAD = "regexp_extract(url, '^(([A-Za-z][A-Za-z0-9+.\\-]*:)?(//[^/?#]*)?)')"
CANON = f"lower({HEAD}) || regexp_replace(substr(url, length({HEAD}) + 1), '[?#].*$', '', 's')"
FIRST_CANON = f"QUALIFY row_number() OVER (PARTITION BY ticker, {CANON} ORDER BY published NULLS LAST, url) = 1"


def naive(df, *columns: str):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("canonical_url", f"SELECT page_id, {CANON} AS url_canon FROM pages")
def canonical_url(spark, sf):
    return table(spark, sf, "pages", "page_id", "url").select("page_id", tx.canonical_url("url").alias("url_canon"))


@query("news_dedupe", f"{ctes(NEWS)} SELECT ticker, doc_id, url, title, text, published FROM news {FIRST_CANON}")
def news_dedupe(spark, sf):
    return naive(nw.dedupe_canonical(news(spark, sf)), "published").select("ticker", "doc_id", "url", "title", "text", "published")


_PAGES = """pg AS (SELECT upper(regexp_extract(url, '/([a-z]{2})/', 1)) AS ticker, url, html AS text, CAST(NULL AS TIMESTAMP) AS published FROM pages)"""
_SHORT = "regexp_replace(url, '[?].*$', '')"


def _page_feed(spark, sf):
    p = table(spark, sf, "pages", "url", "html")
    return p.select(F.upper(F.regexp_extract("url", "/([a-z]{2})/", 1)).alias("ticker"), "url", F.col("html").alias("text"))


@query(
    "news_union_dedupe",
    f"""{ctes(NEWS, _PAGES)}, u AS (
      SELECT 0 AS r, 'MoneyControl' AS source, ticker, {_SHORT} AS url, title, text, published FROM news
      UNION ALL SELECT 1, 'NewsAPI', ticker, url, NULL, text, published FROM pg
      UNION ALL SELECT 3, 'RSS', ticker, {_SHORT}, title, NULL, published FROM news
      UNION ALL SELECT 4, 'GDELT', ticker, url, title, NULL, published FROM news)
    SELECT ticker, url, source, title, text, published FROM u QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY r, published NULLS LAST, title, text) = 1""",
)
def news_union_dedupe(spark, sf):
    n = news(spark, sf).drop("source", "doc_id")
    short = n.withColumn("url", F.regexp_replace("url", "[?].*$", ""))
    collected = nw.collect_news(
        {"MoneyControl": short, "NewsAPI": _page_feed(spark, sf), "MarketAux": None, "RSS": short.drop("text"), "GDELT": n.drop("text")}
    )
    return naive(nw.newest_first(collected), "published").select("ticker", "url", "source", "title", "text", "published")


@query(
    "news_for_window",
    f"""{ctes(NEWS)}, u AS (SELECT 0 AS r, 'RSS' AS source, ticker, {_SHORT} AS url, title, published FROM news
      UNION ALL SELECT 1, 'NewsAPI', ticker, url, title, published FROM news UNION ALL SELECT 2, 'MarketAux', ticker, {_SHORT}, text, published FROM news)
    SELECT ticker, url, source, title, published FROM u WHERE published >= TIMESTAMP '2024-01-05' AND published < TIMESTAMP '2024-01-12'
    QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY r, published) = 1""",
)
def news_for_window(spark, sf):
    n = news(spark, sf).select("ticker", "url", "title", "published", "text")
    short = n.withColumn("url", F.regexp_replace("url", "[?].*$", ""))
    feeds_ = {"RSS": short.drop("text"), "NewsAPI": n.drop("text"), "MarketAux": short.withColumn("title", F.col("text")).drop("text")}
    out = nw.collect_news(feeds_, start="2024-01-05", end="2024-01-11")
    return naive(out, "published").select("ticker", "url", "source", "title", "published")


@query(
    "collect_news_capped_window",
    f"""{ctes(NEWS)}, u AS (SELECT 0 AS r, 'RSS' AS source, ticker, {_SHORT} AS url, title, published FROM news
      UNION ALL SELECT 1, 'NewsAPI', ticker, url, title, published FROM news UNION ALL SELECT 2, 'MarketAux', ticker, {_SHORT}, text, published FROM news),
    c AS (SELECT * FROM u WHERE published >= TIMESTAMP '2024-01-03' AND published < TIMESTAMP '2024-01-25' AND contains(lower(title), 'src1')
      QUALIFY row_number() OVER (PARTITION BY ticker, source ORDER BY published DESC, url) <= 10)
    SELECT ticker, url, source, title, published FROM c QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY r, published) = 1""",
)
def collect_news_capped_window(spark, sf):
    """Dates, relevance and cap together: the cap counts what the window and the query leave."""
    n = news(spark, sf).select("ticker", "url", "title", "published", "text")
    short = n.withColumn("url", F.regexp_replace("url", "[?].*$", ""))
    feeds_ = {"RSS": short.drop("text"), "NewsAPI": n.drop("text"), "MarketAux": short.withColumn("title", F.col("text")).drop("text")}
    out = nw.collect_news(feeds_, max_articles=40, start="2024-01-03", end="2024-01-24", query="SRC1")
    return naive(out, "published").select("ticker", "url", "source", "title", "published")

@query(
    "news_cap_per_source",
    f"""{ctes(NEWS)} SELECT ticker, source, doc_id, published FROM news
    QUALIFY row_number() OVER (PARTITION BY ticker, source ORDER BY published DESC, url) <= 5""",
)
def news_cap_per_source(spark, sf):
    return naive(nw.cap_per_source(news(spark, sf), 5), "published").select("ticker", "source", "doc_id", "published")


@query(
    "news_filters",
    f"""{ctes(NEWS)} SELECT ticker, doc_id, published FROM news WHERE (contains(lower(title), 'src1') OR contains(lower(title), 'fr 2'))
    AND length(text) > 500 AND published >= TIMESTAMP '2024-01-03' AND published < TIMESTAMP '2024-01-21' AND url <> ''""",
)
def news_filters(spark, sf):
    rows = nw.in_date_range(nw.with_url(nw.with_published(news(spark, sf))), "2024-01-03", "2024-01-20")
    rows = nw.long_enough(nw.relevant(rows, "SRC1 OR  fr 2"), "text", 500)
    return naive(rows.select("ticker", "doc_id", "published"), "published")


_TOXIC = "keyed AS (SELECT concat(lang, '/', source) AS ticker, d.doc_id, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query(
    "source_fallback",
    f"""{ctes(_TOXIC)} SELECT ticker, doc_id, 'primary' AS origin FROM keyed WHERE toxic = 1
    UNION ALL SELECT ticker, doc_id, 'secondary' FROM keyed WHERE ticker NOT IN (SELECT ticker FROM keyed WHERE toxic = 1)""",
)
def source_fallback(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "lang", "source")
    docs = docs.select("doc_id", F.concat_ws("/", "lang", "source").alias("ticker"))
    toxic = table(spark, sf, "labels", "doc_id", "toxic").filter("toxic = 1").select("doc_id")
    primary = docs.join(toxic, "doc_id", "left_semi").withColumn("origin", F.lit("primary"))
    out = nw.source_by_mode({"rss": primary, "newsapi": docs.withColumn("origin", F.lit("secondary"))})
    return out.select("ticker", "doc_id", "origin")


# ---- landed payloads: each article goes through the provider's JSON shape and back


def _payload(df, schema: str, body):
    return df.select(F.from_json(F.to_json(body), schema).alias("p")).select("p.*")


def _iso(pattern: str):
    return F.date_format("published", pattern)


@query(
    "feed_newsapi",
    f"""{ctes(NEWS)} SELECT ticker, title, NULL AS description, text AS content, url, published, source FROM news {FIRST_CANON}""",
)
def feed_newsapi(spark, sf, max_results=None):
    article = F.struct(
        "title", F.col("text").alias("content"), "url", _iso("yyyy-MM-dd'T'HH:mm:ssXXX").alias("publishedAt"),
        F.struct(F.col("source").alias("name")).alias("source"),
    )
    body = F.struct("ticker", F.lit("ok").alias("status"), F.array(article).alias("articles"))
    return naive(feeds.newsapi_news(_payload(news(spark, sf), feeds.NEWSAPI, body), max_results), "published")


@query(
    "feed_marketaux",
    f"""{ctes(NEWS)} SELECT ticker, title, text AS description, url, published, source FROM news {FIRST_CANON}""",
)
def feed_marketaux(spark, sf, max_results=None):
    as_object = F.to_json(F.struct(F.col("source").alias("name")))
    article = F.struct(
        "title", F.col("text").alias("description"), "url", _iso("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("published_at"),
        F.when(F.col("ticker") == "EN", as_object).otherwise(F.col("source")).alias("source"),
    )
    body = F.struct("ticker", F.array(article).alias("data"))
    return naive(feeds.marketaux_news(_payload(news(spark, sf), feeds.MARKETAUX, body), max_results), "published")


@query(
    "feed_gdelt",
    f"""{ctes(NEWS)} SELECT ticker, title, title AS text, url, published, source FROM news {FIRST_CANON}""",
)
def feed_gdelt(spark, sf, max_results=None):
    english = F.col("ticker") == "EN"
    stamp = _iso("yyyyMMdd'T'HHmmss'Z'")
    article = F.struct(
        "title", "url", F.when(english, stamp).alias("seendate"), F.when(~english, stamp).alias("published"),
        F.when(english, F.col("source")).otherwise("").alias("sourceCommonName"), F.col("source").alias("domain"),
    )
    body = F.struct("ticker", F.array(article).alias("articles"))
    return naive(feeds.gdelt_news(_payload(news(spark, sf), feeds.GDELT, body), max_results), "published")


@query(
    "feed_rss",
    f"""{ctes(NEWS)} SELECT ticker, title, title AS text, url, published, CASE WHEN ticker = 'EN' THEN source END AS source FROM news {FIRST_CANON}""",
)
def feed_rss(spark, sf, max_results=None):
    english = F.col("ticker") == "EN"
    stamp = _iso("EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    article = F.struct(
        "title", F.when(english, F.col("url")).alias("link"), F.col("url").alias("id"), F.when(english, stamp).alias("published"),
        stamp.alias("updated"), F.when(english, F.to_json(F.struct(F.col("source").alias("title")))).otherwise("plain").alias("source"),
    )
    body = F.struct("ticker", F.array(article).alias("entries"))
    return naive(feeds.rss_news(_payload(news(spark, sf), feeds.RSS, body), max_results), "published")


@query(
    "feed_regional",
    f"""{ctes(NEWS)} SELECT ticker, text AS title, text, title AS summary, url, published, 'MoneyControl' AS source FROM news
    WHERE (contains(lower(text), 'the') OR contains(lower(title), 'src1')) AND length(text) > 50
    AND published >= TIMESTAMP '2024-01-02' AND published <= TIMESTAMP '2024-01-25'""",
)
def feed_regional(spark, sf, max_results=None):
    article = F.struct(F.col("text").alias("title"), F.col("url").alias("link"), _iso("dd MMM yyyy HH:mm:ss +0000").alias("published"), F.col("title").alias("summary"))
    body = F.struct("ticker", F.col("source").alias("feed"), F.array(article).alias("entries"))
    payload = _payload(news(spark, sf), feeds.REGIONAL, body)
    return naive(feeds.regional_news(payload, "The OR src1", "2024-01-02", "2024-01-25", max_results), "published")


# Pages of a provider that gives newer articles first within a page; a URL's copies lie on several pages.
_PAGED = """paged AS (SELECT *, doc_id % 5 AS page, row_number() OVER (PARTITION BY ticker, doc_id % 5 ORDER BY published DESC, doc_id) - 1 AS place FROM news)"""
_IN_FEED = f"QUALIFY row_number() OVER (PARTITION BY ticker, {CANON} ORDER BY page, place) = 1"


def _paged(spark, sf, field, article, **more):
    at = F.struct(-F.unix_micros("published").alias("newest"), "doc_id", article.alias("a"))
    pages = news(spark, sf).withColumn("page", F.col("doc_id") % 5).groupBy("ticker", "page").agg(F.sort_array(F.collect_list(at)).alias("list"))
    return pages.select("ticker", "page", F.col("list.a").alias(field), *[F.lit(v).alias(k) for k, v in more.items()])


@query("news_dedupe_feed_order", f"{ctes(NEWS, _PAGED)} SELECT ticker, title, text AS content, url, published, source FROM paged {_IN_FEED}")
def news_dedupe_feed_order(spark, sf):
    """Of copies of one URL the first in the provider's own order stays."""
    article = F.struct(
        "title", F.lit(None).cast("string").alias("description"), F.col("text").alias("content"), "url",
        _iso("yyyy-MM-dd'T'HH:mm:ssXXX").alias("publishedAt"), F.struct(F.col("source").alias("name")).alias("source"),
    )
    out = feeds.newsapi_news(_paged(spark, sf, "articles", article, status="ok"))
    return naive(out.drop("description"), "published")


@query(
    "rss_feed_order_capped",
    f"""{ctes(NEWS, _PAGED)}, once AS (SELECT * FROM paged {_IN_FEED})
    SELECT ticker, title, title AS text, url, published, source FROM once QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY page, place) <= 40""",
)
def rss_feed_order_capped(spark, sf):
    """The first entries of a feed, duplicates not counted."""
    stamp = _iso("EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    article = F.struct(
        "title", F.col("url").alias("link"), F.col("url").alias("id"), stamp.alias("published"), stamp.alias("updated"),
        F.to_json(F.struct(F.col("source").alias("title"))).alias("source"),
    )
    return naive(feeds.rss_news(_paged(spark, sf, "entries", article), 40), "published")


_CAPPED = "capped AS (SELECT * FROM news QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY published DESC, url) <= 60)"


@query("feed_newsapi_capped", f"{ctes(NEWS, _CAPPED)} SELECT ticker, title, NULL AS description, text AS content, url, published, source FROM capped {FIRST_CANON}")
def feed_newsapi_capped(spark, sf):
    return feed_newsapi(spark, sf, 60)


@query("feed_marketaux_capped", f"{ctes(NEWS, _CAPPED)} SELECT ticker, title, text AS description, url, published, source FROM capped {FIRST_CANON}")
def feed_marketaux_capped(spark, sf):
    return feed_marketaux(spark, sf, 60)


@query("feed_gdelt_capped", f"{ctes(NEWS, _CAPPED)} SELECT ticker, title, title AS text, url, published, source FROM capped {FIRST_CANON}")
def feed_gdelt_capped(spark, sf):
    return feed_gdelt(spark, sf, 60)


@query(
    "feed_rss_capped",
    f"""{ctes(NEWS)}, once AS (SELECT * FROM news {FIRST_CANON}) SELECT ticker, title, title AS text, url, published,
    CASE WHEN ticker = 'EN' THEN source END AS source FROM once QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY published DESC, url) <= 60""",
)
def feed_rss_capped(spark, sf):
    return feed_rss(spark, sf, 60)


@query(
    "feed_regional_capped",
    f"""{ctes(NEWS)}, capped AS (SELECT * FROM news QUALIFY row_number() OVER (PARTITION BY ticker, source ORDER BY published DESC, url) <= 5)
    SELECT ticker, text AS title, text, title AS summary, url, published, 'MoneyControl' AS source FROM capped
    WHERE (contains(lower(text), 'the') OR contains(lower(title), 'src1')) AND length(text) > 50
    AND published >= TIMESTAMP '2024-01-02' AND published <= TIMESTAMP '2024-01-25'""",
)
def feed_regional_capped(spark, sf):
    return feed_regional(spark, sf, 40)

@query(
    "mixed_timestamps",
    f"{ctes(NEWS)} SELECT doc_id, CASE WHEN doc_id % 7 = 6 THEN NULL ELSE published END AS published FROM news",
)
def mixed_timestamps(spark, sf):
    """Seven date shapes in one column, each row parsed on its own."""
    offset = F.date_format(F.col("published") - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss'-05:00'")
    shapes = F.array(
        _iso("yyyy-MM-dd'T'HH:mm:ss'Z'"), offset, _iso("yyyy-MM-dd HH:mm:ss"), _iso("EEE, dd MMM yyyy HH:mm:ss +0000"),
        _iso("yyyyMMdd'T'HHmmss'Z'"), _iso("EEE, d MMM yyyy HH:mm:ss 'GMT'"), F.lit("yesterday"),
    )
    raw = news(spark, sf).select("doc_id", F.element_at(shapes, (F.col("doc_id") % 7 + 1).cast("int")).alias("published"))
    return naive(normalize_timestamps(raw), "published")


# ---- tickers, labels and text keys


@query(
    "query_expansion",
    """SELECT c_custkey, t || ' OR ' || b || CASE WHEN c_acctbal > 0 THEN ' OR "' || c_name || '"' ELSE '' END || ' OR ' || b || ' stock OR ' || b || ' news' AS query
    FROM (SELECT c_custkey, c_name, c_acctbal, c_mktsegment AS b, c_mktsegment || '.' || CAST(c_nationkey AS VARCHAR) AS t FROM customer) c""",
)
def query_expansion(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    t = F.concat_ws(".", "c_mktsegment", F.col("c_nationkey").cast("string"))
    company = F.when(F.col("c_acctbal") > 0, F.col("c_name"))
    return c.select("c_custkey", tx.expanded_query(t, company).alias("query"))


@query(
    "ticker_key",
    """SELECT c_custkey, upper(c_mktsegment) || '-' || CAST(c_custkey AS VARCHAR) AS ticker, lower(c_mktsegment) || '/' || CAST(c_custkey AS VARCHAR) AS base FROM customer""",
)
def ticker_key(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    t = F.concat_ws("/", F.lower("c_mktsegment"), F.col("c_custkey").cast("string"))
    return c.select("c_custkey", tx.ticker_key(t).alias("ticker"), tx.base_symbol(F.concat(t, F.lit(".NS"))).alias("base"))


_OWN_IDS = {0: "positive", 3: "POS", 4: "Bearish"}
_ID_LABELS = ["label_0", "label_3", "4", " Pos ", "label_7"]


@query(
    "label_ids",
    """SELECT event_id, ['negative', 'positive', 'bearish', 'positive', 'label_7'][event_id % 5 + 1] AS label FROM events""",
)
def label_ids(spark, sf):
    """A model's own names by id, after the fixed spellings."""
    e = table(spark, sf, "events", "event_id")
    raw = F.element_at(F.array(*[F.lit(x) for x in _ID_LABELS]), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select("event_id", tx.standard_label(raw, _OWN_IDS).alias("label"))


_RAW_LABELS = ["POS", "label_0", " Neutral ", "", "Bullish", "Label_2", "NEG", "LABEL_1"]


@query(
    "label_scores",
    f"""SELECT event_id, label, signed + 0.0 AS signed, CASE WHEN signed > 0.05 THEN 'positive' WHEN signed < -0.05 THEN 'negative' ELSE 'neutral' END AS compound_label,
    {sql_flag('signed > 0.1')} AS sentiment_positive, {sql_flag('signed < -0.1')} AS sentiment_negative, greatest(0.0::DOUBLE, least(1.0::DOUBLE, p * 1.5)) AS prob,
    {sql_flag('greatest(0.0::DOUBLE, least(1.0::DOUBLE, p * 1.5)) > 0.5')} AS signal FROM (
      SELECT event_id, p, label, CASE label WHEN 'positive' THEN p WHEN 'negative' THEN -p ELSE 0.0::DOUBLE END AS signed FROM (
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) / 100.0::DOUBLE AS p,
        ['positive', 'negative', 'neutral', 'neutral', 'bullish', 'positive', 'negative', 'neutral'][event_id % 8 + 1] AS label FROM events) a) b""",
)
def label_scores(spark, sf):
    e = table(spark, sf, "events", "event_id", "props")
    raw = F.element_at(F.array(*[F.lit(x) for x in _RAW_LABELS]), (F.col("event_id") % 8 + 1).cast("int"))
    e = e.select("event_id", raw.alias("raw"), (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).alias("p"))
    out = e.select("event_id", "p", tx.standard_label("raw").alias("label"), (tx.signed_score("raw", "p") + F.lit(0.0)).alias("signed"))
    out = out.withColumns({"compound_label": tx.score_label("signed"), **sentiment_flags("signed"), "prob": clip01(F.col("p") * 1.5)})
    return out.withColumn("signal", signal("prob")).drop("p")


@query(
    "text_prep",
    """SELECT doc_id, sha256(text) AS text_hash, substr(sha256(text), 1, 12) AS short_key, CAST(least(length(text), 2048) AS INTEGER) AS guarded_chars,
    CAST(length(text) AS INTEGER) AS chars FROM documents""",
)
def text_prep(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "text")
    return d.select(
        "doc_id", tx.text_key("text").alias("text_hash"), tx.short_key("text").alias("short_key"),
        F.length(tx.shorten("text")).alias("guarded_chars"), F.length(tx.as_text("text")).alias("chars"),
    )


# ---- scoring

_TOKENS = """tok AS (SELECT text_hash, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS word FROM (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents) d),
  val AS (SELECT text_hash, CAST(sum(coalesce(tenths, 0)) AS BIGINT) AS valence_tenths FROM tok LEFT JOIN lexicon USING (word) GROUP BY 1),
  sc AS (SELECT text_hash, valence_tenths, (valence_tenths / 10.0::DOUBLE) / sqrt((valence_tenths / 10.0::DOUBLE) * (valence_tenths / 10.0::DOUBLE) + 15) AS score FROM val),
  lx AS (SELECT text_hash, valence_tenths, score, CASE WHEN score > 0.05 THEN 'positive' WHEN score < -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM sc)"""


@query("lexicon_sentiment", sql_rounded(ctes(LEXICON, _TOKENS), "SELECT * FROM lx", "text_hash, valence_tenths, label", "score"))
def lexicon_sentiment(spark, sf):
    out = sm.lexicon_scores(table(spark, sf, "documents", "text"), lexicon(spark))
    return pick(out, "text_hash, valence_tenths, label", "score")


_NEGATIONS = ["not", "no", "the"]
_BOOSTERS = {"and": 0.293, "in": -0.293}


@query(
    "lexicon_rules_sentiment",
    sql_rounded(
        ctes(
            LEXICON,
            """tok AS (SELECT text_hash, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM (
              SELECT text_hash, string_split_regex(lower(text), '[^\\p{L}]+') AS w FROM (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents) d) e)""",
            """b AS (SELECT text_hash, pos, tenths / 10.0::DOUBLE AS v, CASE word WHEN 'and' THEN 0.293 WHEN 'in' THEN -0.293 ELSE 0 END::DOUBLE AS boost,
              CASE WHEN word IN ('not', 'no', 'the') THEN 1 ELSE 0 END AS neg FROM tok LEFT JOIN lexicon USING (word))""",
            """c AS (SELECT text_hash, v, coalesce(lag(boost, 1) OVER w, 0) + 0.95 * coalesce(lag(boost, 2) OVER w, 0) + 0.9 * coalesce(lag(boost, 3) OVER w, 0) AS lift,
              max(neg) OVER (PARTITION BY text_hash ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS negated FROM b WINDOW w AS (PARTITION BY text_hash ORDER BY pos))""",
            """t AS (SELECT text_hash, sum(CASE WHEN v IS NULL THEN 0 ELSE (v + CASE WHEN v < 0 THEN -lift ELSE lift END) * CASE WHEN negated = 1 THEN -0.74 ELSE 1 END END)::DOUBLE AS s FROM c GROUP BY 1)""",
        ),
        "SELECT text_hash, s / sqrt(s * s + 15) AS score FROM t", "text_hash", "score", 5,
    ),
)
def lexicon_rules_sentiment(spark, sf):
    out = sm.lexicon_scores_with_rules(table(spark, sf, "documents", "text"), lexicon(spark), _NEGATIONS, _BOOSTERS)
    return pick(out, "text_hash", "score", 5)


@query(
    "lexicon_emphasis_sentiment",
    sql_rounded(
        ctes(
            LEXICON,
            """tx AS (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents)""",
            """mk AS (SELECT text_hash, least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE + CASE WHEN q > 3 THEN 0.96 WHEN q > 1 THEN q * 0.18 ELSE 0 END::DOUBLE AS marks
              FROM (SELECT *, length(text) - length(replace(text, '?', '')) AS q FROM tx) a)""",
            """tok AS (SELECT text_hash, generate_subscripts(w, 1) AS pos, unnest(w) AS raw FROM (SELECT text_hash, string_split_regex(text, '[^\\p{L}]+') AS w FROM tx) e)""",
            """b AS (SELECT text_hash, pos, tenths / 10.0::DOUBLE AS v, lower(raw) AS word, length(raw) > 1 AND upper(raw) = raw AS cap, raw <> '' AS real FROM tok LEFT JOIN lexicon ON word = lower(raw))""",
            """c AS (SELECT *, count(*) FILTER (cap) OVER t AS caps, count(*) FILTER (NOT cap AND real) OVER t AS others, min(pos) FILTER (word = 'that') OVER t AS turn
              FROM b WINDOW t AS (PARTITION BY text_hash))""",
            """s AS (SELECT text_hash, sum(CASE WHEN v IS NULL THEN 0 ELSE (v + CASE WHEN cap AND caps > 0 AND others > 0 THEN CASE WHEN v < 0 THEN -0.733 ELSE 0.733 END ELSE 0 END)
              * CASE WHEN pos < turn THEN 0.5 WHEN pos > turn THEN 1.5 ELSE 1 END END)::DOUBLE AS s FROM c GROUP BY 1)""",
            """e AS (SELECT text_hash, s + sign(s) * marks AS s FROM s JOIN mk USING (text_hash))""",
        ),
        "SELECT text_hash, s / sqrt(s * s + 15) AS score FROM e", "text_hash", "score", 5,
    ),
)
def lexicon_emphasis_sentiment(spark, sf):
    """Capitals, marks and a contrast word."""
    out = sm.lexicon_scores_with_rules(table(spark, sf, "documents", "text"), lexicon(spark), [], {}, contrast="that", emphasis=True)
    return pick(out, "text_hash", "score", 5)


_IDIOMS = {"of the": 2.0, "is that it": -1.5, "for a": 0.5}


@query(
    "lexicon_idioms_sentiment",
    sql_rounded(
        ctes(
            LEXICON,
            """tok AS (SELECT text_hash, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM (
              SELECT text_hash, string_split_regex(lower(text), '[^\\p{L}]+') AS w FROM (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents) d) e)""",
            """n AS (SELECT text_hash, pos, word, tenths / 10.0::DOUBLE AS v, lead(word) OVER w AS w1, lead(word, 2) OVER w AS w2, lag(word) OVER w AS b1, lag(word, 2) OVER w AS b2
              FROM tok LEFT JOIN lexicon USING (word) WINDOW w AS (PARTITION BY text_hash ORDER BY pos))""",
            """s AS (SELECT text_hash, sum(CASE WHEN word = 'of' AND w1 = 'the' THEN 2.0 WHEN b1 = 'of' AND word = 'the' THEN 0
              WHEN word = 'is' AND w1 = 'that' AND w2 = 'it' THEN -1.5 WHEN b1 = 'is' AND word = 'that' AND w1 = 'it' THEN 0 WHEN b2 = 'is' AND b1 = 'that' AND word = 'it' THEN 0
              WHEN word = 'for' AND w1 = 'a' THEN 0.5 WHEN b1 = 'for' AND word = 'a' THEN 0 ELSE coalesce(v, 0) END)::DOUBLE AS s FROM n GROUP BY 1)""",
        ),
        "SELECT text_hash, s / sqrt(s * s + 15) AS score FROM s", "text_hash", "score", 5,
    ),
)
def lexicon_idioms_sentiment(spark, sf):
    """Phrases of two and three words whose valence stands for that of their words."""
    out = sm.lexicon_scores_with_rules(table(spark, sf, "documents", "text"), lexicon(spark), [], {}, idioms=_IDIOMS)
    return pick(out, "text_hash", "score", 5)


def length_scorer():
    """Deterministic stand-in for a model: the class follows the text length."""
    classes = [("NEGATIVE", 0.7), ("label_1", 0.5), ("Positive", 0.7)]
    return lambda texts: [classes[len(t) % 3] for t in texts]


_STUB = "CASE length({0}) % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END"
_STUB_SCORE = "CASE length({0}) % 3 WHEN 0 THEN -0.7 WHEN 1 THEN 0.0 ELSE 0.7 END::DOUBLE"


@query(
    "batch_sentiment",
    f"SELECT doc_id, {_STUB.format('text')} AS label, {_STUB_SCORE.format('text')} AS sent_score FROM documents",
)
def batch_sentiment(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    scored = sm.score_texts(docs, length_scorer)
    return sm.attach_scores(docs, scored).select("doc_id", "label", "sent_score")


@query(
    "score_cache",
    f"""WITH t AS (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents),
    c AS (SELECT DISTINCT sha256(text) AS text_hash FROM documents JOIN labels USING (doc_id))
    SELECT t.text_hash, CASE WHEN c.text_hash IS NOT NULL THEN 'cached' ELSE {_STUB.format('text')} END AS label,
    CASE WHEN c.text_hash IS NOT NULL THEN 0.25 ELSE {_STUB_SCORE.format('text')} END AS score FROM t LEFT JOIN c USING (text_hash)""",
)
def score_cache(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    known = sm.with_text_key(docs.join(table(spark, sf, "labels", "doc_id"), "doc_id", "left_semi"))
    cache = known.groupBy("text_hash").agg(F.first("text").alias("text"))
    cache = cache.withColumns({"label": F.lit("cached"), "score": F.lit(0.25)})
    scores, _ = sm.score_with_cache(docs, cache, length_scorer)
    return scores.select("text_hash", "label", "score")


@query("lexicon_duplicates", sql_rounded(ctes(LEXICON, _TOKENS), "SELECT * FROM lx", "text_hash, valence_tenths, label", "score"))
def lexicon_duplicates(spark, sf):
    """A word listed again, with a smaller valence, changes nothing."""
    words = lexicon(spark)
    out = sm.lexicon_scores(table(spark, sf, "documents", "text"), words.union(words.select("word", F.col("tenths") - 1)))
    return pick(out, "text_hash, valence_tenths, label", "score")


@query(
    "score_cache_duplicates",
    f"""WITH c AS (SELECT DISTINCT sha256(text) AS text_hash FROM documents JOIN labels USING (doc_id))
    SELECT doc_id, CASE WHEN c.text_hash IS NOT NULL THEN 'cached' ELSE {_STUB.format('text')} END AS label,
    CASE WHEN c.text_hash IS NOT NULL THEN 0.25 ELSE {_STUB_SCORE.format('text')} END AS sent_score FROM documents LEFT JOIN c ON c.text_hash = sha256(text)""",
)
def score_cache_duplicates(spark, sf):
    """A cache with every row twice still gives each article one score."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    known = sm.with_text_key(docs.join(table(spark, sf, "labels", "doc_id"), "doc_id", "left_semi"))
    cache = known.groupBy("text_hash").agg(F.first("text").alias("text"))
    cache = cache.withColumns({"label": F.lit("cached"), "score": F.lit(0.25)})
    scores, _ = sm.score_with_cache(docs, cache.union(cache), length_scorer)
    return sm.attach_scores(docs, scores).select("doc_id", "label", "sent_score")


@query(
    "score_cache_compacted",
    f"""WITH o AS (SELECT DISTINCT sha256(text) AS h FROM documents JOIN labels USING (doc_id)),
    n AS (SELECT DISTINCT sha256(text) AS h FROM documents JOIN labels USING (doc_id) WHERE quality = 1 UNION SELECT DISTINCT sha256(text) FROM documents WHERE doc_id % 3 = 0)
    SELECT sha256(text) AS text_hash, any_value(CASE WHEN n.h IS NOT NULL THEN 'new' WHEN o.h IS NOT NULL THEN 'old' ELSE {_STUB.format('text')} END) AS label,
    any_value(CASE WHEN n.h IS NOT NULL THEN 0.3 WHEN o.h IS NOT NULL THEN 0.1 ELSE {_STUB_SCORE.format('text')} END) AS score
    FROM documents LEFT JOIN o ON o.h = sha256(text) LEFT JOIN n ON n.h = sha256(text) GROUP BY 1""",
)
def score_cache_compacted(spark, sf):
    """A store that was appended to twice, then filled with what it lacked: one row a text, the newest score."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    judged = docs.join(table(spark, sf, "labels", "doc_id", "quality"), "doc_id")
    store = ScoreStore(spark, f"{shared_folder(spark)}/scores-{uuid.uuid4().hex}")
    better = judged.filter("quality = 1").select("text").union(docs.filter("doc_id % 3 = 0").select("text"))
    for texts, label, score in ((judged, "old", 0.1), (better, "new", 0.3)):
        store.append(sm.with_text_key(texts).select("text_hash", F.lit(label).alias("label"), F.lit(score).alias("score")))
    return store.score(docs, length_scorer).select("text_hash", "label", "score")
