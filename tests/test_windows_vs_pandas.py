"""Indicator columns against pandas on a series with gaps, repeats and zeros."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlight.operators import features as ft
from barlight.operators import indicators as ind


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(11)
    n = 160
    close = pd.Series(100 + rng.normal(0, 2, n).cumsum())
    close[[30, 31, 77]] = np.nan
    spread = rng.random(n) * 3
    pdf = pd.DataFrame(
        {
            "ticker": "T",
            "date": pd.date_range("2023-01-02", periods=n, freq="B").date,
            "open": close.ffill() + rng.normal(0, 1, n),
            "high": close.ffill() + spread + 2,
            "low": close.ffill() - spread - 2,
            "close": close,
            "volume": rng.integers(0, 3, n).astype(float) * 100,
        }
    )
    pdf.loc[50, ["open", "high", "low", "close"]] = 100.0
    return pdf


@pytest.fixture(scope="module")
def bars(spark, series):
    rows = [tuple(None if v != v else v for v in r) for r in series.itertuples(index=False)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")


def got(df, *columns):
    pdf = df.toPandas().sort_values("date").reset_index(drop=True)
    return [pdf[c].astype(float) for c in columns]


def same(actual, expected, atol=1e-9):
    np.testing.assert_allclose(actual, expected.astype(float), atol=atol, rtol=1e-9)


def test_changes_pad_gaps(series, bars):
    one, five, momentum = got(ind.price_changes(bars), "price_change_1d", "price_change_5d", "momentum_5")
    padded = series["close"].ffill()
    same(one, padded / padded.shift(1) - 1)
    same(five, padded / padded.shift(5) - 1)
    same(momentum, series["close"] / series["close"].shift(5) - 1)


def test_means_stds_and_trends(series, bars):
    c = series["close"]
    ma, ratio, t50 = got(ind.moving_averages(bars), "ma_10", "price_ma_5_ratio", "trend_50")
    same(ma, c.rolling(10).mean())
    same(ratio, c / c.rolling(5).mean())
    same(t50, (c > c.rolling(50).mean()).astype(int))
    upper, position = got(ind.bollinger(bars), "bb_upper", "bb_position")
    mean, std = c.rolling(20).mean(), c.rolling(20).std()
    same(upper, mean + 2 * std)
    same(position, (c - (mean - 2 * std)) / (4 * std))


def test_volume_ratio_keeps_zero_over_zero_missing(series, bars):
    (ratio,) = got(ind.volatility(bars), "volume_ratio")
    same(ratio, series["volume"] / series["volume"].rolling(5).mean())


def test_rsi(series, bars):
    (rsi,) = got(ind.rsi(bars), "rsi_14")
    delta = series["close"].diff()
    gain, loss = delta.where(delta > 0, 0).rolling(14).mean(), (-delta.where(delta < 0, 0)).rolling(14).mean()
    same(rsi, 100 - 100 / (1 + gain / loss), atol=1e-8)
    assert np.isnan(rsi[12]) and not np.isnan(rsi[13])


def test_rsi_without_losses_is_100_and_flat_is_missing(spark):
    rows = [("UP", f"2024-01-{d:02d}", float(d)) for d in range(1, 21)] + [("FLAT", f"2024-01-{d:02d}", 5.0) for d in range(1, 21)]
    df = spark.createDataFrame(rows, "ticker string, d string, close double").select("ticker", F.to_date("d").alias("date"), "close")
    out = {(r["ticker"], r["date"].day): r["rsi_14"] for r in ind.rsi(df).collect()}
    assert out["UP", 14] == 100.0 and out["FLAT", 20] is None


def test_macd_decays_through_gaps(series, bars):
    c = series["close"]
    line = c.ewm(span=12).mean() - c.ewm(span=26).mean()
    macd, signal = got(ind.macd(bars), "macd", "macd_signal")
    same(macd, line)
    same(signal, line.ewm(span=9).mean())


def test_candles(series, bars):
    o, h, l, c = (series[x] for x in ("open", "high", "low", "close"))
    (doji,) = got(bars.withColumns(ind.candles_range()), "doji")
    same(doji, ((o - c).abs() / (h - l) < 0.1).astype(int))
    lower, upper, body = pd.concat([o, c], axis=1).min(axis=1, skipna=False) - l, h - pd.concat([o, c], axis=1).max(axis=1, skipna=False), (c - o).abs()
    (hammer,) = got(bars.dropna().withColumns(ind.candles_shadow()), "hammer")
    same(hammer, ((lower > body * 2) & (upper < body)).astype(int)[c.notna()].reset_index(drop=True))


def test_lags_and_rolls(spark):
    values = [0.0, 0.1, -0.2, 0.3, 0.0]
    rows = [("T", f"2024-06-{i + 3:02d}", v, i, 1, 0, 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(
        rows, "ticker string, d string, daily_mean_sentiment double, daily_count long, daily_pos_count long, daily_neg_count long, daily_neutral_count long"
    )
    df = df.withColumn("date", F.to_date("d")).drop("d")
    out = ft.short_aliases(ft.lag_and_roll(df, [1, 2], [3])).toPandas().sort_values("date").reset_index(drop=True)
    s = pd.Series(values)
    same(out["sent_lag_1"], s.shift(1))
    same(out["daily_mean_sentiment_lag_2"], s.shift(2))
    same(out["sent_roll_3"], s.rolling(3, min_periods=1).mean())
    assert out["count_roll_3"].tolist() == [0, 1, 3, 6, 9]


def test_fill_keeps_infinity_apart_from_missing(spark):
    rows = [("T", "2024-01-01", None), ("T", "2024-01-02", float("inf")), ("T", "2024-01-03", None), ("T", "2024-01-04", 2.0)]
    df = spark.createDataFrame(rows, "ticker string, d string, x double").select("ticker", F.to_date("d").alias("date"), "x", F.col("x").alias("target_return"))
    out = ft.fill_clean(df).toPandas().sort_values("date")
    assert out["x"].tolist() == [0.0, 0.0, 0.0, 2.0]
    assert np.isnan(out["target_return"].tolist()[0])


def test_full_set_overwrites_and_fills(series, bars):
    b = bars.withColumnsRenamed({"close": "Close", "open": "Open", "high": "High", "low": "Low", "volume": "Volume"})
    out = ft.full_features(b.withColumn("return", F.lit(0.01))).toPandas().sort_values("date").reset_index(drop=True)
    assert out.isna().sum().sum() == 0
    np.testing.assert_allclose(out["momentum_5"][10:], 0.05)  # the return-sum form stands
    assert {"doji_range", "trend_50", "news_count_std", "is_quarter_end", "target_direction"} <= set(out.columns)
    assert len(out) == len(series)
