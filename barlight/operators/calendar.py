"""Market calendar: session days, next session, and trading-date alignment of articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.functions.times import after_close, is_weekday, market_time, session_date, to_utc
from barlight.schemas import require
from barlight.session import use_utc


def session_map(spark: SparkSession, holidays: DataFrame, start: str = "1970-01-01", end: str = "2100-01-01") -> DataFrame:
    """One row per calendar day: is it a session, and which session comes next.

    Monday to Friday less the ``holiday`` column of ``holidays``, however long a closure lasts; null for
    days after the last session. Its size is the number of days
    asked for (some 47,000 by default), so it carries a broadcast hint. The window runs in one task
    over those days only.
    """
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS cal_date")
    closed = holidays.select(F.to_date("holiday").alias("cal_date")).filter(F.col("cal_date").between(start, end))
    days = days.join(closed.distinct().withColumn("closed", F.lit(True)), "cal_date", "left")
    days = days.select("cal_date", (is_weekday("cal_date") & F.col("closed").isNull()).alias("is_session"))
    later = W.orderBy(F.col("cal_date").desc()).rowsBetween(W.unboundedPreceding, -1)  # grows row by row
    upcoming = F.min(F.when(F.col("is_session"), F.col("cal_date"))).over(later)
    return F.broadcast(days.select("cal_date", "is_session", upcoming.alias("next_session")))


def align_to_trading_day(
    news: DataFrame,
    timestamp_col: str = "published",
    market_tz: str = "America/New_York",
    market_open: str = "09:30",
    market_close: str = "16:00",
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Normalise ``timestamp_col`` to UTC and add ``trading_date``.

    Without a calendar every rule is a column expression (no join, no shuffle). With one, the
    next-session lookup is an equi-join on the local date (broadcast for :func:`session_map`); a date that
    the calendar does not cover, or after its last session, is an error. ``market_open`` never changes the date:
    an article before the open belongs to the same day as one inside the session.
    """
    out = normalize_timestamps(news, timestamp_col)
    out = out.withColumn("_local", market_time(timestamp_col, market_tz))  # staged, so it is worked out once
    if calendar is None:
        return out.withColumn("trading_date", session_date("_local", market_close)).drop("_local")
    out = out.withColumns({"cal_date": F.to_date("_local"), "_late": after_close(F.col("_local"), market_close)})
    out = out.join(calendar, "cal_date", "left")
    unknown = F.raise_error(F.concat(F.lit("the calendar has no session for "), F.col("cal_date").cast("string"))).cast("date")
    following = F.coalesce(F.col("next_session"), unknown)
    moved: Column = F.when(F.col("is_session") & ~F.col("_late"), F.col("cal_date")).otherwise(following)
    aligned = out.withColumn("trading_date", F.when(F.col(timestamp_col).isNotNull(), moved))
    return aligned.drop("_local", "cal_date", "_late", "is_session", "next_session")


def normalize_timestamps(df: DataFrame, timestamp_col: str = "published") -> DataFrame:
    require(df, timestamp_col)
    use_utc(df.sparkSession)
    kind = dict(df.dtypes)[timestamp_col]
    utc = to_utc(timestamp_col) if kind == "string" else F.col(timestamp_col).cast("timestamp")
    return df.withColumn(timestamp_col, utc)
