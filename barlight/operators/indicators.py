"""Technical indicators over price bars. Each operator takes bars and returns bars with columns added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlight.functions.numeric import flag, nan_to_null, pd_div, pd_log
from barlight.operators.layout import BLOCK_ROWS, Lane, fill_forward, lay_out
from barlight.operators.rolling import (
    change,
    decay_rows,
    ewm_means,
    frame_stats,
    full_mean,
    full_std,
    roll_mean,
    roll_std,
    roll_sum,
)
from barlight.schemas import require

PADDED = "_padded_close"
EWM_SPANS = (12, 26, 9)


def pad_close(bars: DataFrame, price: str = "close", order: str = "date") -> DataFrame:
    """Percent changes look through gaps: the last present price stands in for a missing one."""
    return fill_forward(bars.withColumn(PADDED, F.col(price)), [PADDED], order)


def returns(bars: DataFrame, price: str = "adj_close", order: str = "date") -> DataFrame:
    """Simple return (gaps padded) and log return of ``price``."""
    lane = lay_out(pad_close(require(bars, price), price, order), back=1, order=order)
    logs = pd_log(price)
    out = {"return": change(lane, PADDED, 1), "log_return": nan_to_null(logs - F.lag(logs, 1).over(lane.window))}
    return lane.add(out).finish(PADDED)


# Percent-change columns and how many bars each looks back.
PRICE_CHANGES = {"price_change_1d": 1, "price_change_5d": 5, "price_change_20d": 20}


def price_changes(bars: DataFrame, order: str = "date") -> DataFrame:
    lane = lay_out(pad_close(bars, order=order), back=20, order=order)
    cols = {name: change(lane, PADDED, k) for name, k in PRICE_CHANGES.items()}
    return lane.add(cols).add(_momentum_price(lane)).finish(PADDED)


def _momentum_price(lane: Lane) -> dict[str, Column]:
    return {"momentum_5": change(lane, "close", 5), "momentum_10": change(lane, "close", 10)}


def _average_stats(lane: Lane, windows: tuple[int, ...] = (5, 10, 20)) -> dict[str, Column]:
    return {k: c for w in windows for k, c in frame_stats(lane, "close", w, "sum").items()}


def _averages() -> dict[str, Column]:
    return {f"ma_{w}": full_mean("close", w) for w in (5, 10, 20)}


def _average_ratios() -> dict[str, Column]:
    return {f"price_ma_{w}_ratio": pd_div("close", f"ma_{w}") for w in (5, 10, 20)}


def _trends(windows: tuple[int, ...] = (5, 20, 50)) -> dict[str, Column]:
    return {f"trend_{w}": flag(F.col("close") > full_mean("close", w)) for w in windows}


def moving_averages(bars: DataFrame, order: str = "date") -> DataFrame:
    lane = lay_out(bars, back=50, order=order)
    stats = _average_stats(lane, (5, 10, 20, 50))
    return lane.add(stats).add({**_averages(), **_trends()}).add(_average_ratios()).finish(*stats)


def _volume_stats(lane: Lane) -> dict[str, Column]:
    return frame_stats(lane, "volume", 5, "sum")


def _volume_ratio() -> dict[str, Column]:
    return {"volume_ratio": pd_div("volume", full_mean("volume", 5))}


def _change_stats(lane: Lane, windows: tuple[int, ...] = (5, 10)) -> dict[str, Column]:
    return {k: c for w in windows for k, c in frame_stats(lane, "price_change", w, "std").items()}


def _price_volatility() -> dict[str, Column]:
    return {f"volatility_{w}": full_std("price_change", w) for w in (5, 10)}


def _regime_stats(lane: Lane) -> dict[str, Column]:
    return frame_stats(lane, "volatility_10", 20, "sum")


def _regime() -> dict[str, Column]:
    return {"volatility_regime": flag(F.col("volatility_10") > full_mean("volatility_10", 20))}


def volatility_stats(lane: Lane, c: str = "volatility") -> Lane:
    """5/20 means of a volatility column, its ratio to the 20-mean and the high/low regime flags."""
    lane = lane.add({f"{c}_ma5": roll_mean(lane, c, 5), f"{c}_ma20": roll_mean(lane, c, 20)})
    mean = F.col(f"{c}_ma20")
    return lane.add(
        {
            f"{c}_ratio": pd_div(c, mean),
            "vol_regime_high": flag(F.col(c) > mean * 1.5),
            "vol_regime_low": flag(F.col(c) < mean * 0.5),
        }
    )


def news_count_stats(lane: Lane, c: str = "news_count") -> dict[str, Column]:
    return {f"{c}_ma5": roll_mean(lane, c, 5), f"{c}_ma20": roll_mean(lane, c, 20), f"{c}_std": roll_std(lane, c, 20)}


def volatility(bars: DataFrame, order: str = "date") -> DataFrame:
    """Volume ratio, rolling volatility of returns and every regime flag derived from it."""
    lane = lay_out(pad_close(bars, order=order), back=45, order=order)
    volume = _volume_stats(lane)
    lane = lane.add({"price_change": change(lane, PADDED, 1), **volume}).add(_volume_ratio()).without(volume)
    spread = _change_stats(lane, (5, 10, 20))
    lane = lane.add(spread).add({**_price_volatility(), "volatility": full_std("price_change", 20)}).without(spread)
    regime = _regime_stats(lane)
    lane = lane.add(regime).add(_regime()).without(regime)
    return volatility_stats(lane).finish(PADDED)


def _band_edges(rows: int = 20, width: float = 2.0) -> dict[str, Column]:
    mean, std = full_mean("close", rows), full_std("close", rows)
    return {"bb_upper": mean + width * std, "bb_lower": mean - width * std}


def _band_place() -> dict[str, Column]:
    span = F.col("bb_upper") - F.col("bb_lower")
    return {"bb_width": span, "bb_position": pd_div(F.col("close") - F.col("bb_lower"), span)}


def bollinger(bars: DataFrame, order: str = "date") -> DataFrame:
    lane = lay_out(bars, back=20, order=order)
    stats = frame_stats(lane, "close", 20, "sum", "std")
    return lane.add(stats).add(_band_edges()).add(_band_place()).finish(*stats)


def _delta(lane: Lane) -> dict[str, Column]:
    return {"_delta": F.col("close") - F.lag("close", 1).over(lane.window)}


def _gains() -> dict[str, Column]:
    """A missing first difference counts as no gain and no loss."""
    delta = F.col("_delta")
    return {"_gain": F.when(delta > 0, delta).otherwise(0.0), "_loss": F.when(delta < 0, -delta).otherwise(0.0)}


def _strength_stats(lane: Lane, window: int = 14) -> dict[str, Column]:
    return {**frame_stats(lane, "_gain", window, "sum"), **frame_stats(lane, "_loss", window, "sum")}


def _relative_strength(name: str, window: int = 14) -> dict[str, Column]:
    """Simple-mean RSI."""
    ratio = pd_div(full_mean("_gain", window), full_mean("_loss", window))
    return {name: 100.0 - 100.0 / (1.0 + ratio)}


def add_rsi(lane: Lane, name: str, window: int = 14) -> Lane:
    lane = lane.add(_delta(lane)).add(_gains())
    stats = _strength_stats(lane, window)
    return lane.add(stats).add(_relative_strength(name, window)).without(["_delta", "_gain", "_loss", *stats])


def rsi(bars: DataFrame, window: int = 14, name: str = "rsi_14", order: str = "date") -> DataFrame:
    return add_rsi(lay_out(bars, back=window + 1, order=order), name, window).finish()


def add_macd_line(lane: Lane, fast: int = 12, slow: int = 26) -> Lane:
    lane = ewm_means(lane, {"_fast": ("close", fast), "_slow": ("close", slow)})
    return lane.add({"macd": F.col("_fast") - F.col("_slow")}).without(["_fast", "_slow"])


def add_macd(lane: Lane, fast: int = 12, slow: int = 26, signal: int = 9) -> Lane:
    """The line, its signal and their difference; block rows must suit ``slow`` and ``signal`` (see ``block_rows_for``)."""
    lane = ewm_means(add_macd_line(lane, fast, slow), {"macd_signal": ("macd", signal)})
    return lane.add({"macd_histogram": F.col("macd") - F.col("macd_signal")})


def block_rows_for(*spans: float) -> int:
    """Blocks of at least four times the rows after which a weight is below double precision."""
    return max(BLOCK_ROWS, 4 * max(decay_rows(s) for s in spans))


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, order: str = "date") -> DataFrame:
    lane = lay_out(bars, order=order, blocks=True, block_rows=block_rows_for(fast, slow, signal))
    return add_macd(lane, fast, slow, signal).finish()


def ewm(bars: DataFrame, column: str, spans: list[int], order: str = "date") -> DataFrame:
    """``{column}_ewm_{span}`` for each span; a missing value repeats the mean before it, however long the gap."""
    lane = lay_out(bars, order=order, blocks=True, block_rows=block_rows_for(*spans))
    return ewm_means(lane, {f"{column}_ewm_{s}": (column, s) for s in spans}).finish()


def momentum_sum(bars: DataFrame, order: str = "date") -> DataFrame:
    lane = lay_out(require(bars, "returns"), back=20, order=order)
    return lane.add(return_momentum(lane)).finish()


def return_momentum(lane: Lane) -> dict[str, Column]:
    return {f"momentum_{w}": roll_sum(lane, "returns", w) for w in (5, 10, 20)}


def candle_ratios() -> dict[str, Column]:
    return {"high_low_ratio": pd_div("high", "low"), "close_open_ratio": pd_div("close", "open")}


def candles_range(suffix: str = "") -> dict[str, Column]:
    """Patterns as shares of the day's range."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    span = h - l
    return {
        f"doji{suffix}": flag(pd_div(F.abs(o - c), span) < 0.1),
        f"hammer{suffix}": flag(pd_div(c - l, span) > 0.6),
        f"shooting_star{suffix}": flag(pd_div(h - c, span) > 0.6),
    }


def candles_shadow() -> dict[str, Column]:
    """Patterns from the body and its two shadows."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    body, lower, upper = F.abs(c - o), F.least(o, c) - l, h - F.greatest(o, c)
    return {
        "doji": flag(body < (h - l) * 0.1),
        "hammer": flag((lower > body * 2) & (upper < body)),
        "shooting_star": flag((upper > body * 2) & (lower < body)),
    }


TECHNICAL_BACK = 64  # rows that the deepest chain of frames reaches: two of 20 and a change, or one of 50


def technical_lane(lane: Lane) -> Lane:
    """The indicator set on a block lane whose frame carries the padded close.

    Windows are grouped by depth - on prices, on those results, on theirs - so the blocks are walked
    three times in all, and each frame's aggregates are evaluated once. Exponential means borrow no rows:
    blocks hand their state on.
    """
    lane = add_macd(lane)
    prices = {**_average_stats(lane, (5, 10)), **frame_stats(lane, "close", 20, "sum", "std"), **_volume_stats(lane)}
    lane = lane.add({**prices, "price_change": change(lane, PADDED, 1), **_momentum_price(lane), **_delta(lane)})
    lane = lane.add({**candle_ratios(), **candles_range(), **_volume_ratio(), **_averages(), **_band_edges()})
    lane = lane.add({**_trends((5, 20)), **_average_ratios(), **_band_place(), **_gains()}).without(prices)

    spread, strength = _change_stats(lane), _strength_stats(lane)
    lane = lane.add({**spread, **strength})
    lane = lane.add({**_price_volatility(), **_relative_strength("rsi_14")})
    lane = lane.without(["_delta", "_gain", "_loss", *spread, *strength])

    regime = _regime_stats(lane)
    return lane.add(regime).add(_regime()).without(regime)


def technical_indicators(bars: DataFrame, order: str = "date", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The full indicator set in one layout: one shuffle on ticker, windows staged on the same blocks."""
    require(bars, "open", "high", "low", "close", "volume")
    lane = lay_out(pad_close(bars, order=order), back=TECHNICAL_BACK, order=order, blocks=True, block_rows=block_rows)
    return technical_lane(lane).finish(PADDED)
