"""Lag and rolling features, gap filling, and the comprehensive feature set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.functions.numeric import flag, infinite_to_zero, pd_div
from barlight.functions.times import date_parts
from barlight.operators import indicators as ind
from barlight.operators.layout import KEY, Lane, fill_forward, lay_out
from barlight.operators.rolling import roll_mean, roll_sum
from barlight.schemas import COUNT_COLUMNS, ensure

# Columns that lag, average and sum, and the targets.
LAG_COLUMNS = ["daily_mean_sentiment", "sentiment_score", "returns", "volatility"]
MEAN_COLUMNS = [*LAG_COLUMNS, "news_count"]
SUM_COLUMNS = [*COUNT_COLUMNS, "news_count"]
TARGETS = ["target_return_1d", "target_dir_1d", "target_direction", "target_return"]

# Provider spellings of the bar columns.
BAR_NAMES = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Adj_Close": "adj_close",
    "Volume": "volume",
    "Stock Splits": "stock_splits",
    "Dividends": "dividends",
}


def lower_names(df: DataFrame) -> DataFrame:
    """Provider capitals to lower snake, unless the lower-case column is already there."""
    return df.withColumnsRenamed({a: b for a, b in BAR_NAMES.items() if a in df.columns and b not in df.columns})


def _lag_roll(lane: Lane, columns: list[str], lags: list[int], rolls: list[int]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for c in [c for c in LAG_COLUMNS if c in columns]:
        out |= {f"{c}_lag_{k}": F.lag(c, k).over(lane.window) for k in lags}
    for c in [c for c in MEAN_COLUMNS if c in columns]:
        out |= {f"{c}_roll_{w}": roll_mean(lane, c, w, partial=True) for w in rolls}
    for c in [c for c in SUM_COLUMNS if c in columns]:
        out |= {f"{c}_roll_{w}": roll_sum(lane, c, w, partial=True) for w in rolls}
    return out


def lag_and_roll(
    df: DataFrame, lags: list[int] | None = None, rolls: list[int] | None = None, order: str = "date"
) -> DataFrame:
    """Lags, rolling means and rolling count sums of whichever known columns the frame has."""
    lags, rolls = lags or [1, 2, 3], rolls or [3, 7]
    lane = lay_out(df, back=max(*lags, *rolls, 1), order=order)
    return lane.add(_lag_roll(lane, df.columns, lags, rolls)).finish()


def short_aliases(df: DataFrame) -> DataFrame:
    """sent_lag_k, sent_roll_w and count_roll_w beside the canonical names."""
    names = {"daily_mean_sentiment_": "sent_", "daily_count_": "count_"}
    out = {}
    for c in df.columns:
        for long, short in names.items():
            if c.startswith((f"{long}lag_", f"{long}roll_")):
                out[short + c.removeprefix(long)] = F.col(c)
    return df.withColumns(out) if out else df


def fill_clean(df: DataFrame, columns: list[str] | None = None, order: str = "date") -> DataFrame:
    """Forward fill, then 0 for leading gaps, then 0 for Infinity. Keys and targets are left alone."""
    kept = {KEY, order, *TARGETS}
    columns = columns or [f.name for f in df.schema.fields if f.name not in kept and isinstance(f.dataType, T.NumericType)]
    filled = fill_forward(df, columns, order)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def settled(c: str) -> Column:
        value = F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
        return infinite_to_zero(value) if c in floats else value

    return filled.withColumns({c: settled(c) for c in columns})


# Lags and windows of the comprehensive set.
FULL_LAGS = [1, 3, 7, 14]
FULL_ROLLS = [5, 10, 20]


def full_features(df: DataFrame, order: str = "date") -> DataFrame:
    """The comprehensive feature set; where two definitions share a name the later one stands.

    One block layout serves every bounded window; the gap fill is the only running aggregate.
    """
    df = lower_names(df)
    if "returns" not in df.columns and "return" in df.columns:
        df = df.withColumn("returns", F.col("return"))
    lane = lay_out(ind.pad_close(df, order=order), back=ind.TECHNICAL_BACK, order=order, blocks=True)
    lane = ind.technical_lane(lane)
    extra = {f"{p}_range": F.col(p) for p in ("doji", "hammer", "shooting_star")}
    extra |= _lag_roll(lane, df.columns, FULL_LAGS, FULL_ROLLS)
    if "sentiment_score" not in df.columns:
        extra["sentiment_score"] = F.col("daily_mean_sentiment") if "daily_mean_sentiment" in df.columns else F.lit(0.0)
    if "news_count" in df.columns:
        extra |= ind.news_count_stats(lane)
    else:
        extra["news_count"] = F.lit(0).cast("long")
        extra |= {c: F.lit(0.0) for c in ("news_count_ma5", "news_count_ma20", "news_count_std")}
    if "returns" in df.columns:
        extra |= ind.return_momentum(lane)
    extra |= {name: ind.change(lane, ind.PADDED, k) for name, k in ind.PRICE_CHANGES.items()}
    extra |= {f"price_ratio_{w}": pd_div("close", f"ma_{w}") for w in (5, 20)}
    extra["trend_50"] = flag(F.col("close") > roll_mean(lane, "close", 50))
    lane = lane.add(extra)
    if "volatility" in df.columns:
        lane = ind.volatility_stats(lane)
    lane = lane.add({**sentiment_flags("sentiment_score"), **ind.candles_shadow()})
    out = fill_clean(lane.finish(ind.PADDED), order=order)
    out = out.withColumns(date_parts(order))
    return ensure(out, target_direction=0, target_return=0.0)


def sentiment_flags(score: str, margin: float = 0.1) -> dict[str, Column]:
    s = F.col(score)
    return {"sentiment_positive": flag(s > margin), "sentiment_negative": flag(s < -margin)}


def basic_features(bars: DataFrame, order: str = "date") -> DataFrame:
    """Returns, log returns, 20-bar volatility, two averages, RSI and the same-bar targets.

    ``target_direction``/``target_return`` describe the row's own bar, so they leak; they are kept
    for parity and never used as a default label.
    """
    lane = lay_out(ind.pad_close(lower_names(bars), order=order), back=40, order=order)
    prev = F.lag("close", 1).over(lane.window)
    lane = lane.add({"returns": ind.change(lane, ind.PADDED, 1), "log_returns": ind.pd_log(pd_div("close", prev))})
    lane = lane.add(
        {
            "volatility": ind.roll_std(lane, "returns", 20),
            "sma_5": roll_mean(lane, "close", 5),
            "sma_20": roll_mean(lane, "close", 20),
            "target_direction": flag(F.col("returns") > 0),
            "target_return": F.col("returns"),
        }
    )
    return ind.add_rsi(lane, "rsi").finish(ind.PADDED)


# Which columns a trained model may read.
MODEL_PREFIXES = (
    "sent_", "count_roll_", "ma_", "price_", "volatility_", "momentum_", "bb_", "rsi_", "macd", "trend_",
    "volatility_regime",
)
MODEL_COLUMNS = [
    "daily_mean_sentiment", "daily_count", "high_low_ratio", "close_open_ratio", "volume_ratio", "doji", "hammer",
    "shooting_star",
]
SENTIMENT_PREFIXES = ("sent_", "count_roll_")
SENTIMENT_COLUMNS = ["daily_mean_sentiment", "daily_count"]
NOT_FEATURES = [
    "ticker", "date", "target_direction", "target_return", "trading_date", "daily_mean_sentiment", "daily_count",
    "daily_pos_count", "daily_neg_count", "daily_neutral_count",
]


def model_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(MODEL_PREFIXES) or c in MODEL_COLUMNS]


def sentiment_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(SENTIMENT_PREFIXES) or c in SENTIMENT_COLUMNS]


def remaining_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Every numeric column outside the exclusion list."""
    drop = set(exclude or NOT_FEATURES)
    return [f.name for f in df.schema.fields if f.name not in drop and isinstance(f.dataType, T.NumericType)]


def align_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Trained feature names first, in trained order, absent or missing values as 0.0; the rest after."""
    lead = [
        F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
        for c in names
    ]
    return df.select(*lead, *[F.col(f"`{c}`") for c in df.columns if c not in names])
