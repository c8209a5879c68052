"""Block lanes and two-level scans must give exactly what plain per-ticker windows give."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.operators import indicators as ind
from barlight.operators import layout as lo
from barlight.operators.backtest import backtest_metrics, run_backtest
from barlight.operators.rolling import ewm_means, roll_mean, roll_std
from barlight.operators.splits import expanding_folds, holdout


@pytest.fixture(scope="module")
def ticks(spark):
    """Minute bars of three tickers, one of them with two thirds of all rows, over uneven days."""
    rng = np.random.default_rng(3)
    frames = []
    for ticker, n in (("HOT", 1600), ("MID", 500), ("ONE", 1)):
        steps = rng.integers(1, 9, size=n).cumsum()
        price = 100 + rng.normal(0, 1, size=n).cumsum()
        close = pd.Series(price).where(rng.random(n) > 0.05)
        frames.append(
            pd.DataFrame(
                {
                    "ticker": ticker,
                    "date": pd.Timestamp("2024-01-02") + pd.to_timedelta(steps, unit="min"),
                    "close": close,
                    "return": rng.normal(0, 0.01, size=n),
                    "prob_up": rng.random(n),
                }
            )
        )
    pdf = pd.concat(frames).sample(frac=1, random_state=1)
    rows = [(t, d.to_pydatetime(), None if c != c else c, r, p) for t, d, c, r, p in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "ticker string, date timestamp, close double, return double, prob_up double").cache()


def frame(df):
    return df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


def test_row_numbers(ticks):
    w = W.partitionBy("ticker")
    plain = ticks.withColumns({"_row": F.row_number().over(w.orderBy("date")).cast("long"), "n": F.count("*").over(w)})
    two_step = lo.number_rows(ticks, total="n").select(*plain.columns)
    pd.testing.assert_frame_equal(frame(plain), frame(two_step))


@pytest.mark.parametrize("block_rows", [7, 64, 4096])
def test_bounded_frames_across_blocks(ticks, block_rows):
    lane = lo.lay_out(ticks, back=12, ahead=2, block_rows=block_rows)
    plain = lo.Lane(ticks, ["ticker"], ["date"])

    def columns(x):
        return x.add(
            {
                "mean": roll_mean(x, "close", 10),
                "some": roll_mean(x, "close", 10, partial=True),
                "std": roll_std(x, "close", 12),
                "before": F.lag("close", 12).over(x.window),
                "after": F.lead("close", 2).over(x.window),
            }
        ).finish()

    a, b = frame(columns(lane)), frame(columns(plain).select(*columns(lane).columns))
    assert len(a) == ticks.count()
    pd.testing.assert_frame_equal(a, b, rtol=1e-12)


def test_running_aggregates_across_days(ticks):
    specs = {"grown": ("product", 1 + F.col("return")), "top": ("max", "close"), "filled": ("last", "close")}
    out = frame(lo.running(ticks, specs))
    for _, g in out.groupby("ticker"):
        np.testing.assert_allclose(g["grown"], (1 + g["return"]).cumprod(), rtol=1e-12)
        np.testing.assert_allclose(g["top"], g["close"].cummax().ffill())
        np.testing.assert_allclose(g["filled"], g["close"].ffill())


@pytest.mark.parametrize("span", [1, 2, 9, 26, 200])
def test_exponential_mean_matches_pandas(ticks, span):
    out = frame(ind.ewm(ticks, "close", [span]))
    for _, g in out.groupby("ticker"):
        expected = g["close"].ewm(span=span).mean()
        np.testing.assert_allclose(g[f"close_ewm_{span}"].astype(float), expected, rtol=1e-9)


@pytest.mark.parametrize("block_rows", [150, 100_000])
@pytest.mark.parametrize("kind", ["intraday", "daily"])
def test_short_span_in_cells(ticks, block_rows, kind):
    lane = lo.lay_out(ticks if kind == "intraday" else daily_copy(ticks), back=10, blocks=True, block_rows=block_rows)
    out = frame(ewm_means(lane, {"e": ("close", 2), "f": ("close", 1)}).finish())
    for _, g in out.groupby("ticker"):
        np.testing.assert_allclose(g["e"].astype(float), g["close"].ewm(span=2).mean(), rtol=1e-9)
        np.testing.assert_allclose(g["f"].astype(float), g["close"].ffill())


@pytest.mark.parametrize("kind", ["intraday", "daily"])
def test_macd_across_small_blocks(ticks, kind):
    some = ticks.dropna()
    lane = lo.lay_out(some if kind == "intraday" else daily_copy(some), back=7, blocks=True, block_rows=2000 if kind == "daily" else 500)
    out = frame(ind.add_macd(lane).finish())
    for _, g in out.groupby("ticker"):
        line = g["close"].ewm(span=12).mean() - g["close"].ewm(span=26).mean()
        np.testing.assert_allclose(g["macd"], line, atol=1e-9)
        np.testing.assert_allclose(g["macd_signal"], line.ewm(span=9).mean(), atol=1e-9)


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_states_of_nearly_empty_blocks_are_joined(spark, kind):
    """Values at the ends and the beginnings of blocks, whole blocks empty between them."""
    rows, size = 6000, 500
    close = pd.Series(np.nan, index=range(rows))
    for at in (0, 499, 500, 999, 1000, 1001, 1999, 4000, 4499, 4500, 5999):
        close[at] = 10.0 + at % 7
    days = pd.date_range("1990-01-01", periods=rows)
    pdf = pd.DataFrame({"ticker": "T", "date": days, "close": close.astype(object).where(close.notna(), None)})
    df = spark.createDataFrame(pdf, "ticker string, date timestamp, close double").withColumn("date", F.col("date").cast(kind))
    lane = lo.lay_out(df, blocks=True, block_rows=size)
    out = frame(ewm_means(lane, {f"e{s}": ("close", s) for s in (3, 12, 26)}).finish())
    for s in (3, 12, 26):
        np.testing.assert_allclose(out[f"e{s}"].astype(float), close.ewm(span=s).mean().ffill(), rtol=1e-9)


def daily_copy(ticks):
    """The same series under calendar days, which takes the plain lane."""
    n = F.row_number().over(W.partitionBy("ticker").orderBy("date"))
    return ticks.withColumn("day", F.date_add(F.lit("1990-01-01").cast("date"), n)).drop("date").withColumnRenamed("day", "date")


def test_both_lanes_agree_on_whole_operators(ticks):
    cols = ["position", "strategy_return", "equity", "buy_hold", "peak", "drawdown"]
    a, b = frame(run_backtest(ticks)), frame(run_backtest(daily_copy(ticks)))
    pd.testing.assert_frame_equal(a[cols], b[cols], rtol=1e-9)
    ma, mb = (backtest_metrics(run_backtest(x)).toPandas().sort_values("ticker").reset_index(drop=True) for x in (ticks, daily_copy(ticks)))
    pd.testing.assert_frame_equal(ma, mb, rtol=1e-9)
    one = ticks.filter("ticker = 'MID'")
    fa, fb = frame(expanding_folds(one)), frame(expanding_folds(daily_copy(one)))
    assert fa["fold"].tolist() == fb["fold"].tolist()
    ha, hb = frame(holdout(ticks, 7)), frame(holdout(daily_copy(ticks), 7))
    assert ha["is_holdout"].tolist() == hb["is_holdout"].tolist()


def test_one_ticker_alone_equals_its_part_of_many(ticks):
    both = frame(ind.macd(ticks))
    alone = frame(ind.macd(ticks.filter("ticker = 'MID'")))
    part = both[both["ticker"] == "MID"].reset_index(drop=True)
    pd.testing.assert_frame_equal(part[alone.columns], alone, rtol=1e-12)
