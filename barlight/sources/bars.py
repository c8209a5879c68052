"""Price bars: provider payloads to BARS rows, and the bars table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.functions.numeric import as_col, nan_to_null
from barlight.functions.text import ticker_key
from barlight.functions.times import to_utc
from barlight.operators.features import BAR_NAMES, lower_names
from barlight.operators.indicators import returns
from barlight.operators.layout import number_rows
from barlight.schemas import BARS, conform

# Bar intervals a request may ask for.
INTERVALS = ["1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h", "1d", "5d", "1wk", "1mo", "3mo"]
# Date columns a payload may carry, in order of preference, and the price columns of a bar.
DATE_NAMES = ["Date", "date", "datetime", "timestamp"]
PRICES = ["open", "high", "low", "close", "adj_close", "volume"]


def request_problems(ticker: str, start: str, end: str, interval: str = "1d") -> list[str]:
    """Everything wrong with a request for bars: no ticker, days that are not ISO, an empty period, an unknown interval."""
    days = [_iso_day(start), _iso_day(end)]
    checks = {
        "no ticker given": isinstance(ticker, str) and ticker.strip() != "",
        f"not a period of ISO days: {start} to {end}": None not in days,
        f"empty period: {start} to {end}": None in days or days[0] < days[1],
        f"unknown interval: {interval}": interval in INTERVALS,
    }
    return [problem for problem, holds in checks.items() if not holds]


def _iso_day(text: str) -> datetime | None:
    try:
        return datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None


def check_request(ticker: str, start: str, end: str, interval: str = "1d") -> None:
    if problems := request_problems(ticker, start, end, interval):
        raise ValueError("; ".join(problems))


def flatten_bars(wide: DataFrame, date: str = "date") -> DataFrame:
    """Two-level provider columns (``Close_AAPL``, ``Open_AAPL``, ...) to one row per ticker and date.

    Tickers and fields are known from the column names, so each row is unfolded in place without a
    shuffle. Days on which a ticker has no value at all yield no row.
    """
    fields = sorted(BAR_NAMES, key=len, reverse=True)
    split: dict[str, dict[str, str]] = {}
    for c in wide.columns:
        field = next((f for f in fields if c.startswith(f + "_") and c not in BAR_NAMES), None)
        if field:
            split.setdefault(c[len(field) + 1 :], {})[BAR_NAMES[field]] = c
    if not split:
        raise ValueError("no field_ticker columns found")
    names = sorted({f for of in split.values() for f in of})

    def row(ticker: str, of: dict[str, str]) -> Column:
        values = [F.col(f"`{of[f]}`").cast("double").alias(f) if f in of else F.lit(None).cast("double").alias(f) for f in names]
        return F.struct(F.lit(ticker).alias("ticker"), *values)

    rows = wide.select(date, F.explode(F.array(*[row(t, of) for t, of in split.items()])).alias("_r"))
    rows = rows.select(F.col("_r.ticker").alias("ticker"), date, *[F.col(f"_r.{f}").alias(f) for f in names])
    return rows.filter(F.coalesce(*names).isNotNull())


def drop_uniform_level(wide: DataFrame, ticker: str) -> DataFrame:
    """One-ticker payload: ``Close_AAPL`` is simply ``Close``."""
    suffix = f"_{ticker}"
    return wide.withColumnsRenamed({c: c.removesuffix(suffix) for c in wide.columns if c.endswith(suffix)})


def resolve_date(df: DataFrame) -> DataFrame:
    """A naive-UTC ``date`` column from whichever date column the payload carries."""
    present = [c for c in DATE_NAMES if c in df.columns]
    if not present:
        raise ValueError("no date column found")
    kinds = dict(df.dtypes)

    def parsed(c: str) -> Column:
        return to_utc(c) if kinds[c] == "string" else as_col(c).cast("timestamp")

    if kinds[present[0]] == "date":
        return df.withColumn("date", F.col(present[0])).drop(*[c for c in present if c != "date"])
    out = df.withColumn("_date", F.coalesce(*[parsed(c) for c in present]))
    return out.drop(*present).withColumnRenamed("_date", "date")


def normalize_bars(payload: DataFrame, daily: bool = True, with_returns: bool = True) -> DataFrame:
    """Provider bars to BARS: names, date, absent columns, adj_close := close, returns, column order."""
    df = resolve_date(lower_names(payload))
    if daily:
        df = df.withColumn("date", F.to_date("date"))
    known = {f.name: f.dataType.simpleString() for f in BARS.fields}
    absent = {c: F.lit(None).cast("double") for c in PRICES if c not in df.columns}
    df = df.withColumns(absent) if absent else df
    df = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in PRICES})
    if "adj_close" in absent:
        df = df.withColumn("adj_close", F.col("close"))
    if with_returns:
        df = returns(df)
    ordered = [c for c in known if c in df.columns]
    return df.select(*ordered, *[c for c in df.columns if c not in known])


def demo_defaults(df: DataFrame) -> DataFrame:
    """Stand-in prices (fixed values) for a frame without them; only for a caller that asks."""
    close = F.col("close") if "close" in df.columns else F.lit(100.0)
    defaults = {"close": close, "high": close * 1.02, "low": close * 0.98, "open": close, "volume": F.lit(1_000_000.0)}
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def number_days(df: DataFrame, order: str, start: str = "2020-01-01") -> DataFrame:
    """A daily ``date`` from ``start`` for a per-ticker series that has none, along ``order``.

    Positions come from the two-step numbering when ``order`` is a timestamp.
    """
    numbered = number_rows(df, order, name="_n")
    return numbered.withColumn("date", F.date_add(F.lit(start).cast("date"), (F.col("_n") - 1).cast("int"))).drop("_n")


def write_bars(bars: DataFrame, path: str) -> None:
    """Upsert whole tickers: only the partitions present in ``bars`` are replaced."""
    keyed = bars.withColumn("ticker", ticker_key("ticker"))
    keyed.hint("rebalance", "ticker").write.partitionBy("ticker").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_bars(
    spark: SparkSession, path: str, ticker: str | None = None, start: str | None = None, end: str | None = None, interval: str = "1d"
) -> DataFrame | None:
    """Bars table, pruned to a ticker and pushed down to [start, end); an empty table counts as absent."""
    if ticker is not None and start is not None and end is not None:
        check_request(ticker, start, end, interval)
    df = spark.read.schema(BARS).parquet(path)
    if ticker is not None:
        df = df.filter(F.col("ticker") == ticker.upper().replace("/", "-"))
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") < F.lit(end).cast("date"))
    return None if df.isEmpty() else conform(df, BARS)
