"""Daily sentiment and news aggregates, and their join onto price bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.functions.numeric import flag
from barlight.operators.layout import KEY, lay_out
from barlight.schemas import COUNT_COLUMNS, DAILY_SENT, require

CELL_CHARS = 16_000_000  # characters of one text part; a longer day continues in the next
_ONE_PART = 2**62


def daily_sentiment(news: DataFrame) -> DataFrame:
    """Mean score, row count and class counts per ticker and trading date.

    Classes come from ``label`` when the frame has one, else from the score at +-0.05.
    """
    require(news, "trading_date", "sent_score")
    if "label" in news.columns:
        label = F.lower("label")
        pos, neg, neutral = label == "positive", label == "negative", label == "neutral"
    else:
        pos, neg = F.col("sent_score") > 0.05, F.col("sent_score") < -0.05
        neutral = ~(F.coalesce(pos, F.lit(False)) | F.coalesce(neg, F.lit(False)))

    def count(condition: Column) -> Column:
        return F.sum(flag(condition)).cast("long")

    rows = news.withColumn("trading_date", F.to_date("trading_date")).filter(F.col("trading_date").isNotNull())
    return rows.groupBy(KEY, "trading_date").agg(
        F.avg("sent_score").alias("daily_mean_sentiment"),
        F.count(F.lit(1)).alias("daily_count"),
        count(pos).alias("daily_pos_count"),
        count(neg).alias("daily_neg_count"),
        count(neutral).alias("daily_neutral_count"),
    )


def no_sentiment(bars: DataFrame) -> DataFrame:
    """Empty daily sentiment, for a run without news."""
    return bars.sparkSession.createDataFrame([], DAILY_SENT)


def add_targets(bars: DataFrame, order: str = "date") -> DataFrame:
    """Next-bar return and direction. The last row's direction is 0, its return missing."""
    require(bars, "return")
    lane = lay_out(bars, ahead=1, order=order)
    upcoming = F.lead("return", 1).over(lane.window)
    return lane.add({"target_return_1d": upcoming, "target_dir_1d": flag(upcoming > 0)}).finish()


def merge_with_stock(
    bars: DataFrame, daily: DataFrame, date_col_stock: str = "date", date_col_news: str = "trading_date"
) -> DataFrame:
    """Left join of daily sentiment onto bars by day, zero fill, then targets."""
    require(bars, "return", date_col_stock)
    require(daily, date_col_news)
    day = F.to_date(daily[date_col_news]).alias("trading_date")
    measures = [c for c in ["daily_mean_sentiment", *COUNT_COLUMNS] if c in daily.columns]
    right = daily.select(F.col(KEY).alias("_k"), day, *measures)
    on = (bars[KEY] == right["_k"]) & (F.to_date(bars[date_col_stock]) == right["trading_date"])
    merged = bars.join(right, on, "left").drop("_k")
    merged = merged.withColumns(
        {
            "daily_mean_sentiment": _or_zero(merged, "daily_mean_sentiment", "double"),
            **{c: _or_zero(merged, c, "long") for c in COUNT_COLUMNS},
        }
    )
    return add_targets(merged, order=date_col_stock)


def _or_zero(df: DataFrame, name: str, kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    return F.coalesce(F.col(name).cast(kind), zero) if name in df.columns else zero


def lookahead_violations(merged: DataFrame, order: str = "date") -> DataFrame:
    """Rows per ticker whose target is missing although a later bar exists; all zero in a clean table."""
    lane = lay_out(merged, ahead=1, order=order)
    has_next = F.lead(order, 1).over(lane.window).isNotNull()
    checked = lane.add({"_bad": flag(F.col("target_return_1d").isNull() & has_next)}).finish()
    return checked.groupBy(KEY).agg(F.sum("_bad").cast("long").alias("violations"), F.count(F.lit(1)).alias("rows"))


def daily_news_count(news: DataFrame) -> DataFrame:
    """Articles with a title per ticker and trading date."""
    rows = news.filter(F.col("trading_date").isNotNull())
    return rows.groupBy(KEY, "trading_date").agg(F.count("title").alias("news_count"))


def daily_news_text(news: DataFrame, cell_chars: int = CELL_CHARS) -> DataFrame:
    """Space-joined text per ticker and trading date in parts 0, 1, ..., ordered by (published, url, text).

    Joining the parts of a day by a space gives its whole text. A part ends with the article that
    fills ``cell_chars``. Positions are running sums over the minutes of a day and then inside a minute,
    so no task orders a whole day. A day without any text has the single part 0 with ''.
    """
    keys = [KEY, "trading_date"]
    rows = news.filter(F.col("trading_date").isNotNull())
    undated = F.expr("TIMESTAMP '0001-01-01 00:00:00'").cast(rows.schema["published"].dataType)
    minute = F.coalesce(F.date_trunc("minute", "published"), undated)
    rows = rows.withColumns({"_minute": minute, "_chars": F.coalesce(F.length("text") + 1, F.lit(0))})
    earlier = W.partitionBy(*keys).orderBy("_minute").rowsBetween(W.unboundedPreceding, -1)
    minutes = rows.groupBy(*keys, "_minute").agg(F.sum("_chars").alias("_sum"))
    minutes = minutes.select(*keys, "_minute", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    placed = rows.join(minutes, [*keys, "_minute"])
    inside = W.partitionBy(*keys, "_minute").orderBy("published", "url", "text").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("_chars").over(inside), F.lit(0))
    placed = placed.withColumn("text_part", F.floor(before / cell_chars).cast("int"))
    present = F.when(F.col("text").isNotNull(), F.struct("published", "url", "text"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(present)), lambda a: a["text"]), " ")
    return placed.groupBy(*keys, "text_part").agg(joined.alias("combined_text"))


def attach_news(bars: DataFrame, news: DataFrame | None, cell_chars: int | None = None) -> DataFrame:
    """Left join of daily news count and text onto bars by day: one row per bar, whatever its day holds.

    ``combined_text`` is the whole text of the day and ``text_parts`` 1 (0 without news), however long the text is. One task
    joins a day's text, and beyond the 2 GB that a Spark string can hold the query fails.
    With ``cell_chars``, ``text_parts`` counts the parts of the day in :func:`daily_news_text` cut at the same length; the text
    of a day of several parts stays in that table and is null here.
    """
    if news is None:
        return bars.withColumns({"news_count": F.lit(0).cast("long"), "text_parts": F.lit(0).cast("long"), "combined_text": F.lit("")})
    keys = [KEY, "trading_date"]
    parts = daily_news_text(news, _ONE_PART if cell_chars is None else cell_chars).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("text_parts"), F.max(F.when(F.col("text_part") == 0, F.col("combined_text"))).alias("_first")
    )
    day = F.to_date("date").alias("trading_date")
    out = bars.withColumn("trading_date", day).join(daily_news_count(news), keys, "left").join(parts, keys, "left")
    text = F.when(F.coalesce("text_parts", F.lit(0)) <= 1, F.coalesce("_first", F.lit("")))
    return out.withColumn("combined_text", text).drop("trading_date", "_first").fillna({"news_count": 0, "text_parts": 0})
