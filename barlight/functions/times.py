"""Timestamps to UTC, market trading days and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlight.functions.numeric import as_col, flag

# Date shapes of the feeds, tried in this order after ISO 8601.
FEED_PATTERNS = [
    "yyyyMMdd'T'HHmmssX",
    "yyyyMMddHHmmss",
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm:ss XXX",
    "d MMM yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mmX",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "yyyyMMdd",
]
WEEKDAY_PREFIX = r"^\s*[A-Za-z]{3,9},\s*"


def to_utc(c: Column | str) -> Column:
    """String in any known date shape to a UTC timestamp; no zone means UTC, anything else is null."""
    raw = as_col(c).cast("string")
    plain = F.regexp_replace(raw, WEEKDAY_PREFIX, "")
    return F.coalesce(F.try_to_timestamp(raw), *[F.try_to_timestamp(plain, F.lit(p)) for p in FEED_PATTERNS])


def market_time(ts: Column | str, market_tz: str = "America/New_York") -> Column:
    return F.from_utc_timestamp(as_col(ts).cast("timestamp"), market_tz)


def after_close(local: Column, market_close: str = "16:00") -> Column:
    """Later than the close; the close itself still belongs to the session."""
    hours, minutes = (int(x) for x in market_close.split(":"))
    time_of_day = F.pmod(F.unix_micros(local), F.lit(86_400_000_000))
    return time_of_day > (hours * 60 + minutes) * 60_000_000


def is_weekday(d: Column | str) -> Column:
    return F.weekday(as_col(d)) < 5


def next_weekday(d: Column | str) -> Column:
    d = as_col(d)
    step = F.when(F.weekday(d) == 4, 3).when(F.weekday(d) == 5, 2).otherwise(1)
    return F.date_add(d, step)


def session_date(local: Column | str, market_close: str = "16:00") -> Column:
    """Trading date of a market-local timestamp under a Monday to Friday calendar.

    The open never moves an article: before it and inside the session are the same day.
    """
    local = as_col(local)
    day = F.to_date(local)
    moves = ~is_weekday(day) | after_close(local, market_close)
    return F.when(moves, next_weekday(day)).otherwise(day)


def date_parts(d: Column | str) -> dict[str, Column]:
    d = F.to_date(as_col(d))
    month_end = d == F.last_day(d)
    return {
        "day_of_week": F.weekday(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "is_month_end": flag(month_end),
        "is_quarter_end": flag(month_end & (F.month(d) % 3 == 0)),
    }


def recent_window(lookback_days: int = 120, as_of: Column | None = None) -> tuple[Column, Column]:
    """[as_of - lookback, as_of - 1]; ``as_of`` defaults to today."""
    today = F.current_date() if as_of is None else as_of
    return F.date_sub(today, lookback_days), F.date_sub(today, 1)
