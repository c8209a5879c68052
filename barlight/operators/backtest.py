"""Long/flat strategy backtest for all tickers at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.functions.numeric import flag
from barlight.operators.layout import KEY, lay_out, running
from barlight.schemas import require

TRADING_DAYS = 252


def positions(
    df: DataFrame,
    pred_col: str = "prob_up",
    threshold: float = 0.55,
    tc: float = 0.0005,
    position_size: float = 1.0,
    order: str = "date",
) -> DataFrame:
    """Yesterday's signal as today's position, its change, and the net return after costs."""
    require(df, pred_col, "return")
    lane = lay_out(df, back=3, order=order)
    prob = F.coalesce(F.col(pred_col).cast("double"), F.lit(0.0))
    lane = lane.add({"_signal": flag(prob > threshold) * F.lit(float(position_size))})
    lane = lane.add({"position": F.coalesce(F.lag("_signal", 1).over(lane.window), F.lit(0.0))})
    step = F.abs(F.col("position") - F.lag("position", 1).over(lane.window))
    lane = lane.add({"pos_change": F.coalesce(step, F.abs("position"))})
    net = F.col("position") * F.col("return") - F.col("pos_change") * tc
    return lane.add({"strategy_return": net}).finish("_signal")


def equity_curves(positioned: DataFrame, order: str = "date") -> DataFrame:
    """Compounded strategy equity, buy-and-hold curve, running peak and drawdown.

    A bar without a return has no equity of its own and leaves the curve unchanged after it.
    """
    growth = {
        "equity": ("product", 1.0 + F.col("strategy_return")),
        "buy_hold": ("product", 1.0 + F.coalesce(F.col("return"), F.lit(0.0))),
    }
    out = running(positioned, growth, order)
    out = out.withColumn("equity", F.when(F.col("strategy_return").isNotNull(), F.col("equity")))
    out = running(out, {"peak": ("max", "equity")}, order, again=True)
    return out.withColumn("drawdown", F.col("equity") / F.col("peak") - 1.0)


def run_backtest(
    df: DataFrame,
    pred_col: str = "prob_up",
    threshold: float = 0.55,
    tc: float = 0.0005,
    position_size: float = 1.0,
    order: str = "date",
) -> DataFrame:
    return equity_curves(positions(df, pred_col, threshold, tc, position_size, order), order)


def backtest_metrics(curves: DataFrame, order: str = "date", bars_per_year: float = TRADING_DAYS) -> DataFrame:
    """Total return, annualised Sharpe (missing without spread), worst drawdown and trades, per ticker.

    ``bars_per_year`` annualises: 252 for daily bars, 252 times the bars of a session for intraday ones.
    """
    net = F.col("strategy_return")
    per = curves.groupBy(KEY).agg(
        F.max_by("equity", order).alias("_last"),
        (F.avg(net) * bars_per_year).alias("_mu"),
        (F.stddev_samp(net) * F.sqrt(F.lit(float(bars_per_year)))).alias("_sigma"),
        F.min("drawdown").alias("max_drawdown"),
        F.sum(flag(F.col("pos_change") > 0)).cast("double").alias("trades"),
    )
    return per.select(
        KEY,
        (F.col("_last") - 1.0).alias("total_return"),
        F.when(F.col("_sigma") > 0, F.col("_mu") / F.col("_sigma")).alias("annualized_sharpe"),
        "max_drawdown",
        "trades",
    )
