"""Fixed schemas at the engine boundary and the two plan-time checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """"name type, name type" without needing a running session."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BARS = _struct(
    "ticker string, date date, open double, high double, low double, close double, "
    "adj_close double, volume double, return double, log_return double"
)
NEWS = _struct(
    "ticker string, source string, title string, description string, content string, "
    "text string, summary string, url string, published timestamp"
)
SCORED = _struct("text_hash string, text string, label string, score double")
DAILY_SENT = _struct(
    "ticker string, trading_date date, daily_mean_sentiment double, daily_count long, "
    "daily_pos_count long, daily_neg_count long, daily_neutral_count long"
)
BACKTEST = _struct(
    "ticker string, date date, return double, prob_up double, position double, strategy_return double, equity double"
)

COUNT_COLUMNS = ["daily_count", "daily_pos_count", "daily_neg_count", "daily_neutral_count"]


def conform(df: DataFrame, schema: T.StructType, keep_rest: bool = True) -> DataFrame:
    """Schema columns first (absent ones as typed nulls), then whatever else the frame has."""
    present = set(df.columns)
    wanted = [
        F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
        if f.name in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in schema.names] if keep_rest else []
    return df.select(*wanted, *rest)


def ensure(df: DataFrame, **defaults: object) -> DataFrame:
    """Add the named columns with a constant where the frame lacks them."""
    missing = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df
