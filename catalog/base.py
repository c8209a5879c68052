"""Base frames derived from the given tables, and the same frames as SQL common table expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from barlight.functions.numeric import flag
from barlight.operators.calendar import align_to_trading_day
from barlight.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places, with a plain zero instead of a negative one."""
    cols = [
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def sql_rounded(ctes: str, body: str, plain: str, doubles: str, digits: int = 6) -> str:
    keep = [c.strip() for c in plain.split(",") if c.strip()]
    num = [f"round({c.strip()}, {digits}) + 0.0 AS {c.strip()}" for c in doubles.split(",") if c.strip()]
    return f"{ctes} SELECT {', '.join(keep + num)} FROM ({body}) AS result"


def pick(df: DataFrame, plain: str, doubles: str, digits: int = 6) -> DataFrame:
    names = [c.strip() for c in f"{plain},{doubles}".split(",") if c.strip()]
    return rounded(df.select(*names), digits)


# Price bars: ticker = return flag, price = extended price per unit, open/close by line sequence.
def bars(spark: SparkSession, sf_dir: str, ticker: str = "l_returnflag") -> DataFrame:
    li = table(spark, sf_dir, "lineitem", ticker, "l_shipdate", "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber")
    px = F.col("l_extendedprice") / F.col("l_quantity")
    t = li.select(
        F.col(ticker).cast("string").alias("ticker"),
        F.to_date("l_shipdate").alias("date"),
        F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), px.alias("px")).alias("p"),
        "l_quantity",
    )
    g = t.groupBy("ticker", "date").agg(
        F.min("p").alias("o"), F.max("p.px").alias("high"), F.min("p.px").alias("low"), F.max("p").alias("c"),
        F.sum("l_quantity").alias("volume"),
    )
    return g.select("ticker", "date", F.col("o.px").alias("open"), "high", "low", F.col("c.px").alias("close"), "volume")


BARS = """bars AS (SELECT ticker, date, o.px AS open, high, low, c.px AS close, volume FROM (
  SELECT l_returnflag AS ticker, CAST(l_shipdate AS DATE) AS date, min(struct_pack(seq := seq, px := px)) AS o,
         max(px) AS high, min(px) AS low, max(struct_pack(seq := seq, px := px)) AS c, sum(l_quantity) AS volume
  FROM (SELECT l_returnflag, l_shipdate, l_quantity, l_extendedprice / l_quantity AS px,
               l_orderkey * 10 + l_linenumber AS seq FROM lineitem) t GROUP BY 1, 2) g)"""


def with_returns(b: DataFrame) -> DataFrame:
    """Damped bar-to-bar return under the names the operators read."""
    w = W.partitionBy("ticker").orderBy("date")
    prev = F.lag("close", 1).over(w)
    ret = 0.02 * (F.col("close") - prev) / (F.col("close") + prev)
    return b.withColumn("return", ret)


RBARS = """rbars AS (SELECT *, 0.02 * (close - lag(close) OVER w) / (close + lag(close) OVER w) AS ret
  FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


# Bars with a return, a made-up probability from the row number, and the next-bar direction as label.
def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("ticker").orderBy("date")
    b = with_returns(bars(spark, sf_dir)).withColumns({"rn": F.row_number().over(w), "nxt": F.lead("close", 1).over(w)})
    prob = ((F.col("rn") * 7919) % 1000).cast("double") / 1000
    out = b.select("ticker", "date", "rn", "return", prob.alias("prob_up"), flag(F.col("nxt") > F.col("close")).alias("label"))
    return out.withColumn("prediction", flag(F.col("prob_up") >= 0.5))


PREDS = """preds AS (SELECT ticker, date, rn, 0.02 * (close - prev) / (close + prev) AS ret,
  CAST((rn * 7919) % 1000 AS DOUBLE) / 1000 AS prob_up, CASE WHEN nxt > close THEN 1 ELSE 0 END AS label,
  CASE WHEN CAST((rn * 7919) % 1000 AS DOUBLE) / 1000 >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT ticker, date, close, row_number() OVER w AS rn, lag(close) OVER w AS prev, lead(close) OVER w AS nxt
        FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)) b)"""


# Events as scored articles.
def raw_news_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "props")
    score = (F.get_json_object("props", "$.k").cast("int") - 50) / F.lit(50.0)
    return e.select("event_id", F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("published"), score.alias("sent_score"))


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_to_trading_day(raw_news_events(spark, sf_dir))


SENT = """sent AS (SELECT event_id, ticker, published, sent_score,
  CASE WHEN isodow(lts) = 6 THEN CAST(lts AS DATE) + 2 WHEN isodow(lts) = 7 THEN CAST(lts AS DATE) + 1
       WHEN CAST(lts AS TIME) > TIME '16:00:00' THEN CAST(lts AS DATE) + CASE WHEN isodow(lts) = 5 THEN 3 ELSE 1 END
       ELSE CAST(lts AS DATE) END AS trading_date
  FROM (SELECT event_id, event_type AS ticker, ts AS published,
               (CAST(json_extract_string(props, '$.k') AS INT) - 50) / 50.0::DOUBLE AS sent_score,
               timezone('America/New_York', timezone('UTC', ts)) AS lts FROM events) e)"""


def ebars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    g = e.groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("date")).agg(
        F.max(F.struct("ts", "event_id", "value")).alias("c"), F.count(F.lit(1)).alias("volume")
    )
    return with_returns(g.select("ticker", "date", F.col("c.value").alias("close"), "volume"))


EBARS = """ebars AS (SELECT ticker, date, close, volume,
    0.02 * (close - lag(close) OVER w) / (close + lag(close) OVER w) AS ret
  FROM (SELECT ticker, date, c.value AS close, volume FROM (
    SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
           max(struct_pack(ts := ts, event_id := event_id, value := value)) AS c, count(*) AS volume
    FROM events GROUP BY 1, 2) g) b WINDOW w AS (PARTITION BY ticker ORDER BY date))"""

DAILY = """daily AS (SELECT ticker, trading_date, avg(sent_score) AS daily_mean_sentiment, count(*) AS daily_count,
  CAST(sum(CASE WHEN sent_score > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS daily_pos_count,
  CAST(sum(CASE WHEN sent_score < -0.05 THEN 1 ELSE 0 END) AS BIGINT) AS daily_neg_count,
  CAST(sum(CASE WHEN sent_score > 0.05 OR sent_score < -0.05 THEN 0 ELSE 1 END) AS BIGINT) AS daily_neutral_count
  FROM sent GROUP BY 1, 2)"""

MERGED = """merged AS (SELECT *, CASE WHEN target_return_1d > 0 THEN 1 ELSE 0 END AS target_dir_1d FROM (
  SELECT b.ticker, b.date, b.close, b.volume, b.ret, coalesce(d.daily_mean_sentiment, 0) AS daily_mean_sentiment,
    coalesce(d.daily_count, 0) AS daily_count, coalesce(d.daily_pos_count, 0) AS daily_pos_count,
    coalesce(d.daily_neg_count, 0) AS daily_neg_count, coalesce(d.daily_neutral_count, 0) AS daily_neutral_count,
    lead(b.ret) OVER (PARTITION BY b.ticker ORDER BY b.date) AS target_return_1d
  FROM ebars b LEFT JOIN daily d ON b.ticker = d.ticker AND b.date = d.trading_date) m)"""


# Minute bars of the events: many rows per ticker and day, ordered by timestamp.
def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    g = e.groupBy(F.col("event_type").alias("ticker"), minute.alias("date")).agg(
        F.min(F.struct("ts", "event_id", "value")).alias("o"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max(F.struct("ts", "event_id", "value")).alias("c"), F.count(F.lit(1)).cast("double").alias("volume"),
    )
    return g.select(
        "ticker", "date", F.col("o.value").alias("open"), "high", "low", F.col("c.value").alias("close"), "volume"
    )


MINUTES = """bars AS (SELECT ticker, date, o.value AS open, high, low, c.value AS close, volume FROM (
  SELECT event_type AS ticker, date_trunc('minute', ts) AS date,
         min(struct_pack(ts := ts, event_id := event_id, value := value)) AS o, max(value) AS high, min(value) AS low,
         max(struct_pack(ts := ts, event_id := event_id, value := value)) AS c, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2) g)"""


# Dated articles with duplicate canonical URLs.
def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    minutes = ((F.col("doc_id") * 37) % 43200).cast("int")
    return d.select(
        "doc_id",
        F.upper("lang").alias("ticker"),
        "source",
        F.concat_ws(" ", "source", "lang", F.col("doc_id").cast("string")).alias("title"),
        "text",
        F.concat(
            F.lit("HTTPS://News.Example.com/"), "lang", F.lit("/"), (F.col("doc_id") % 400).cast("string"),
            F.lit("?ref="), F.col("doc_id").cast("string"),
        ).alias("url"),
        F.expr("timestamp'2024-01-01 00:00:00'").alias("base"),
        minutes.alias("m"),
    ).select("doc_id", "ticker", "source", "title", "text", "url", F.timestamp_add("MINUTE", F.col("m"), F.col("base")).alias("published"))


NEWS = """news AS (SELECT doc_id, upper(lang) AS ticker, source, concat_ws(' ', source, lang, CAST(doc_id AS VARCHAR)) AS title, text,
  concat('HTTPS://News.Example.com/', lang, '/', doc_id % 400, '?ref=', doc_id) AS url,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes((doc_id * 37) % 43200) AS published FROM documents)"""

# Fixture lexicon, valence in integer tenths.
LEXICON_ROWS = [
    ("is", 10), ("that", -8), ("it", 5), ("for", -12), ("was", -4), ("with", 16), ("be", 3), ("by", -6), ("this", 9),
    ("are", -15),
]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON_ROWS, "word string, tenths int")


LEXICON = (
    "lexicon AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{w}', {t})" for w, t in LEXICON_ROWS)
    + ") l(word, tenths))"
)


def ctes(*parts: str) -> str:
    return "WITH " + ", ".join(parts)


SERIES = "PARTITION BY ticker ORDER BY date"


def over(rows: int) -> str:
    return f"OVER ({SERIES} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def sql_full(agg: str, c: str, rows: int) -> str:
    return f"CASE WHEN count({c}) {over(rows)} = {rows} THEN {agg}({c}) {over(rows)} END"


def sql_lag(c: str, k: int) -> str:
    return f"lag({c}, {k}) OVER ({SERIES})"


def sql_change(c: str, k: int) -> str:
    return f"{c} / {sql_lag(c, k)} - 1"


def sql_flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"
