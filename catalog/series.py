"""Queries over daily and intraday series: alignment, sentiment, returns, indicators, features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barlight.functions.times import date_parts, recent_window
from barlight.operators import daily as dl
from barlight.operators import features as ft
from barlight.operators import indicators as ind
from barlight.operators.layout import lay_out, running
from barlight.operators.splits import expanding_folds, holdout, lookup_with_fallback
from barlight.operators.calendar import align_to_trading_day, session_map
from barlight.plans import compose as pl
from barlight.schemas import ensure
from barlight.session import shared_folder
from barlight.sources import bars as sb
from barlight.sources import tables as st
from catalog.base import *  # noqa: F403

_SENT_COLS = "daily_count, daily_pos_count, daily_neg_count, daily_neutral_count"


@query(
    "align_trading_date",
    f"{ctes(SENT)} SELECT event_id, ticker, published, trading_date FROM sent",
)
def align_trading_date(spark, sf):
    return sent(spark, sf).select("event_id", "ticker", F.col("published").cast("timestamp_ntz").alias("published"), "trading_date")


_HOLIDAYS = ["2024-01-01", "2024-01-15"]


@query(
    "align_with_holidays",
    f"""{ctes(SENT)}, loc AS (SELECT event_id, timezone('America/New_York', timezone('UTC', published)) AS lts FROM sent),
    days AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '2023-12-01', DATE '2024-03-01', INTERVAL 1 DAY) s(d)),
    open_days AS (SELECT d FROM days WHERE isodow(d) < 6 AND d NOT IN (DATE '2024-01-01', DATE '2024-01-15'))
    SELECT event_id, CASE WHEN CAST(lts AS DATE) IN (SELECT d FROM open_days) AND CAST(lts AS TIME) <= TIME '16:00:00'
      THEN CAST(lts AS DATE) ELSE (SELECT min(d) FROM open_days o WHERE o.d > CAST(loc.lts AS DATE)) END AS trading_date FROM loc""",
)
def align_with_holidays(spark, sf):
    holidays = spark.createDataFrame([(d,) for d in _HOLIDAYS], "holiday string")
    calendar = session_map(spark, holidays)
    return align_to_trading_day(raw_news_events(spark, sf), calendar=calendar).select("event_id", "trading_date")


_LABELLED = """labelled AS (SELECT *, CASE WHEN sent_score > 0.3 THEN 'Positive' WHEN sent_score < -0.3 THEN 'NEGATIVE'
  WHEN sent_score > 0.2 THEN 'other' ELSE 'neutral' END AS label FROM sent)"""


@query(
    "daily_sentiment",
    sql_rounded(
        ctes(SENT, _LABELLED),
        """SELECT ticker, trading_date, avg(sent_score) AS daily_mean_sentiment, count(*) AS daily_count,
        count(*) FILTER (lower(label) = 'positive') AS daily_pos_count, count(*) FILTER (lower(label) = 'negative') AS daily_neg_count,
        count(*) FILTER (lower(label) = 'neutral') AS daily_neutral_count FROM labelled GROUP BY 1, 2""",
        f"ticker, trading_date, {_SENT_COLS}", "daily_mean_sentiment", 8,
    ),
)
def daily_sentiment(spark, sf):
    s = F.col("sent_score")
    label = F.when(s > 0.3, "Positive").when(s < -0.3, "NEGATIVE").when(s > 0.2, "other").otherwise("neutral")
    return rounded(dl.daily_sentiment(sent(spark, sf).withColumn("label", label)), 8)


@query(
    "daily_sentiment_score_only",
    sql_rounded(ctes(SENT, DAILY), "SELECT * FROM daily", f"ticker, trading_date, {_SENT_COLS}", "daily_mean_sentiment", 8),
)
def daily_sentiment_score_only(spark, sf):
    return rounded(dl.daily_sentiment(sent(spark, sf)), 8)


def merged(spark, sf):
    return dl.merge_with_stock(ebars(spark, sf), dl.daily_sentiment(sent(spark, sf)))


_MERGED_PLAIN = f"ticker, date, volume, {_SENT_COLS}, target_dir_1d"
_MERGED_NUM = "close, ret, daily_mean_sentiment, target_return_1d"


@query(
    "merge_targets",
    sql_rounded(ctes(SENT, DAILY, EBARS, MERGED), "SELECT * FROM merged", _MERGED_PLAIN, _MERGED_NUM, 8),
)
def merge_targets(spark, sf):
    return pick(merged(spark, sf).withColumnRenamed("return", "ret"), _MERGED_PLAIN, _MERGED_NUM, 8)


@query(
    "lookahead_check",
    f"{ctes(SENT, DAILY, EBARS, MERGED)} SELECT ticker, CAST(0 AS BIGINT) AS violations, count(*) AS rows FROM merged WHERE ticker IS NOT NULL GROUP BY 1",
)
def lookahead_check(spark, sf):
    return dl.lookahead_violations(merged(spark, sf))


@query(
    "returns",
    sql_rounded(
        ctes(BARS),
        f"""SELECT ticker, date, {sql_change('close', 1)} AS ret, ln(close) - ln({sql_lag('close', 1)}) AS log_return,
        {sql_change('close', 1)} AS price_change_1d, {sql_change('close', 5)} AS price_change_5d,
        {sql_change('close', 20)} AS price_change_20d, {sql_change('close', 5)} AS momentum_5,
        {sql_change('close', 10)} AS momentum_10 FROM bars""",
        "ticker, date",
        "ret, log_return, price_change_1d, price_change_5d, price_change_20d, momentum_5, momentum_10",
    ),
)
def returns(spark, sf):
    out = ind.price_changes(ind.returns(bars(spark, sf), "close")).withColumnRenamed("return", "ret")
    return pick(out, "ticker, date", "ret, log_return, price_change_1d, price_change_5d, price_change_20d, momentum_5, momentum_10")


_LAG_NUM = (
    ", ".join(f"daily_mean_sentiment_lag_{k}" for k in (1, 2, 3))
    + ", "
    + ", ".join(f"daily_mean_sentiment_roll_{w}" for w in (3, 7))
)
_ROLL_SUMS = [f"{c}_roll_{w}" for c in _SENT_COLS.split(", ") for w in (3, 7)]


@query(
    "lag_roll",
    sql_rounded(
        ctes(SENT, DAILY, EBARS, MERGED),
        "SELECT ticker, date, "
        + ", ".join(f"{sql_lag('daily_mean_sentiment', k)} AS daily_mean_sentiment_lag_{k}" for k in (1, 2, 3)) + ", "
        + ", ".join(f"avg(daily_mean_sentiment) {over(w)} AS daily_mean_sentiment_roll_{w}" for w in (3, 7)) + ", "
        + ", ".join(f"CAST(sum({c}) {over(w)} AS BIGINT) AS {c}_roll_{w}" for c in _SENT_COLS.split(", ") for w in (3, 7))
        + ", sum(daily_count) " + over(3) + " AS count_roll_3 FROM merged",
        "ticker, date, CAST(count_roll_3 AS BIGINT) AS count_roll_3, " + ", ".join(_ROLL_SUMS),
        _LAG_NUM,
        8,
    ),
)
def lag_roll(spark, sf):
    out = ft.short_aliases(ft.lag_and_roll(merged(spark, sf)))
    return pick(out, "ticker, date, count_roll_3, " + ", ".join(_ROLL_SUMS), _LAG_NUM, 8)


_MA = ", ".join(f"{sql_full('avg', 'close', w)} AS ma_{w}" for w in (5, 10, 20))


@query(
    "moving_averages",
    sql_rounded(
        ctes(BARS, f"m AS (SELECT ticker, date, close, {_MA}, {sql_full('avg', 'close', 50)} AS ma_50 FROM bars)"),
        "SELECT *, " + ", ".join(f"close / ma_{w} AS price_ma_{w}_ratio" for w in (5, 10, 20)) + ", "
        + ", ".join(f"{sql_flag(f'close > ma_{w}')} AS trend_{w}" for w in (5, 20, 50)) + " FROM m",
        "ticker, date, trend_5, trend_20, trend_50",
        "ma_5, ma_10, ma_20, price_ma_5_ratio, price_ma_10_ratio, price_ma_20_ratio",
    ),
)
def moving_averages(spark, sf):
    return pick(
        ind.moving_averages(bars(spark, sf)),
        "ticker, date, trend_5, trend_20, trend_50",
        "ma_5, ma_10, ma_20, price_ma_5_ratio, price_ma_10_ratio, price_ma_20_ratio",
    )


_VOL_CTES = [
    f"c AS (SELECT ticker, date, close, volume, {sql_change('close', 1)} AS price_change FROM bars)",
    f"""v AS (SELECT *, volume / ({sql_full('avg', 'volume', 5)}) AS volume_ratio, {sql_full('stddev_samp', 'price_change', 5)} AS volatility_5,
      {sql_full('stddev_samp', 'price_change', 10)} AS volatility_10, {sql_full('stddev_samp', 'price_change', 20)} AS volatility FROM c)""",
    f"""s AS (SELECT *, {sql_full('avg', 'volatility_10', 20)} AS m10, {sql_full('avg', 'volatility', 5)} AS volatility_ma5,
      {sql_full('avg', 'volatility', 20)} AS volatility_ma20 FROM v)""",
]
_VOL_PLAIN = "ticker, date, volatility_regime, vol_regime_high, vol_regime_low"
_VOL_NUM = "volume_ratio, volatility_5, volatility_10, volatility, volatility_ma5, volatility_ma20, volatility_ratio"


@query(
    "volatility",
    sql_rounded(
        ctes(BARS, *_VOL_CTES),
        f"""SELECT *, volatility / volatility_ma20 AS volatility_ratio, {sql_flag('volatility_10 > m10')} AS volatility_regime,
        {sql_flag('volatility > volatility_ma20 * 1.5')} AS vol_regime_high, {sql_flag('volatility < volatility_ma20 * 0.5')} AS vol_regime_low FROM s""",
        _VOL_PLAIN, _VOL_NUM,
    ),
)
def volatility(spark, sf):
    return pick(ind.volatility(bars(spark, sf)), _VOL_PLAIN, _VOL_NUM)


_BB = f"""b AS (SELECT ticker, date, close, {sql_full('avg', 'close', 20)} + 2 * {sql_full('stddev_samp', 'close', 20)} AS bb_upper,
  {sql_full('avg', 'close', 20)} - 2 * {sql_full('stddev_samp', 'close', 20)} AS bb_lower FROM bars)"""


@query(
    "bollinger",
    sql_rounded(
        ctes(BARS, _BB),
        "SELECT *, bb_upper - bb_lower AS bb_width, (close - bb_lower) / (bb_upper - bb_lower) AS bb_position FROM b",
        "ticker, date", "bb_upper, bb_lower, bb_width, bb_position", 5,
    ),
)
def bollinger(spark, sf):
    return pick(ind.bollinger(bars(spark, sf)), "ticker, date", "bb_upper, bb_lower, bb_width, bb_position", 5)


def _rsi_ctes(frame: str = "bars") -> list[str]:
    return [
        f"dl AS (SELECT ticker, date, close - {sql_lag('close', 1)} AS d FROM {frame})",
        f"""gl AS (SELECT ticker, date, CASE WHEN count(*) {over(14)} = 14 THEN avg(CASE WHEN d > 0 THEN d ELSE 0 END) {over(14)} END AS g,
          CASE WHEN count(*) {over(14)} = 14 THEN avg(CASE WHEN d < 0 THEN -d ELSE 0 END) {over(14)} END AS l FROM dl)""",
    ]


_RSI = "CASE WHEN l = 0 AND g > 0 THEN 100 WHEN l = 0 THEN NULL ELSE 100 - 100 / (1 + g / l) END"


@query(
    "rsi",
    sql_rounded(ctes(BARS, *_rsi_ctes()), f"SELECT ticker, date, {_RSI} AS rsi_14 FROM gl", "ticker, date", "rsi_14"),
)
def rsi(spark, sf):
    return pick(ind.rsi(bars(spark, sf)), "ticker, date", "rsi_14")


def _ema(name: str, frame: str, column: str, span: int) -> str:
    q = f"(1 - 2.0::DOUBLE / {span + 1})"
    return f"""{name} AS (SELECT a.ticker, a.date, sum(b.{column} * pow({q}, a.rn - b.rn)) / sum(pow({q}, a.rn - b.rn)) AS v
      FROM {frame} a JOIN {frame} b ON a.ticker = b.ticker AND b.rn <= a.rn AND b.rn > a.rn - 900 GROUP BY 1, 2)"""


def _macd_ctes(frame: str = "bars") -> list[str]:
    return [
        f"r AS (SELECT ticker, date, close, row_number() OVER ({SERIES}) AS rn FROM {frame})",
        _ema("e12", "r", "close", 12),
        _ema("e26", "r", "close", 26),
        "md AS (SELECT r.ticker, r.date, r.rn, e12.v - e26.v AS macd FROM r JOIN e12 USING (ticker, date) JOIN e26 USING (ticker, date))",
        _ema("e9", "md", "macd", 9),
        "mc AS (SELECT ticker, date, macd, e9.v AS macd_signal, macd - e9.v AS macd_histogram FROM md JOIN e9 USING (ticker, date))",
    ]


@query(
    "ewm_macd",
    sql_rounded(ctes(BARS, *_macd_ctes()), "SELECT * FROM mc", "ticker, date", "macd, macd_signal, macd_histogram", 4),
)
def ewm_macd(spark, sf):
    return pick(ind.macd(bars(spark, sf)), "ticker, date", "macd, macd_signal, macd_histogram", 4)


@query(
    "momentum_sum",
    sql_rounded(
        ctes(BARS, RBARS),
        "SELECT ticker, date, " + ", ".join(f"{sql_full('sum', 'ret', w)} AS momentum_{w}" for w in (5, 10, 20)) + " FROM rbars",
        "ticker, date", "momentum_5, momentum_10, momentum_20", 8,
    ),
)
def momentum_sum(spark, sf):
    b = with_returns(bars(spark, sf)).withColumnRenamed("return", "returns")
    return pick(ind.momentum_sum(b), "ticker, date", "momentum_5, momentum_10, momentum_20", 8)


_RANGE_SQL = f"""CASE WHEN high = low THEN 0 WHEN abs(open - close) / (high - low) < 0.1 THEN 1 ELSE 0 END AS doji,
  CASE WHEN high = low THEN CASE WHEN close > low THEN 1 ELSE 0 END WHEN (close - low) / (high - low) > 0.6 THEN 1 ELSE 0 END AS hammer,
  CASE WHEN high = low THEN CASE WHEN high > close THEN 1 ELSE 0 END WHEN (high - close) / (high - low) > 0.6 THEN 1 ELSE 0 END AS shooting_star"""


@query(
    "candles_range",
    sql_rounded(
        ctes(BARS),
        f"SELECT ticker, date, high / low AS high_low_ratio, close / open AS close_open_ratio, {_RANGE_SQL} FROM bars",
        "ticker, date, doji, hammer, shooting_star", "high_low_ratio, close_open_ratio",
    ),
)
def candles_range(spark, sf):
    out = bars(spark, sf).withColumns({**ind.candle_ratios(), **ind.candles_range()})
    return pick(out, "ticker, date, doji, hammer, shooting_star", "high_low_ratio, close_open_ratio")


_SHADOW_SQL = f"""{sql_flag('abs(close - open) < (high - low) * 0.1')} AS doji,
  {sql_flag('least(open, close) - low > 2 * abs(close - open) AND high - greatest(open, close) < abs(close - open)')} AS hammer,
  {sql_flag('high - greatest(open, close) > 2 * abs(close - open) AND least(open, close) - low < abs(close - open)')} AS shooting_star"""


@query("candles_shadow", f"{ctes(BARS)} SELECT ticker, date, {_SHADOW_SQL} FROM bars")
def candles_shadow(spark, sf):
    return bars(spark, sf).withColumns(ind.candles_shadow()).select("ticker", "date", "doji", "hammer", "shooting_star")


_PARTS_SQL = f"""isodow(date) - 1 AS day_of_week, month(date) AS month, quarter(date) AS quarter,
  {sql_flag('date = last_day(date)')} AS is_month_end, {sql_flag('date = last_day(date) AND month(date) % 3 = 0')} AS is_quarter_end"""
_PARTS = ["day_of_week", "month", "quarter", "is_month_end", "is_quarter_end"]


def _ints(names: list[str]) -> str:
    return ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in names)


@query("date_parts", f"{ctes(BARS)} SELECT ticker, date, {_ints(_PARTS)} FROM (SELECT ticker, date, {_PARTS_SQL} FROM bars) p")
def date_parts_query(spark, sf):
    return bars(spark, sf).select("ticker", "date").withColumns(date_parts("date"))


_GAPPY = """gappy AS (SELECT ticker, date, CASE WHEN volume > 100 THEN close END AS close,
  CASE WHEN volume > 250 THEN 'Infinity'::DOUBLE WHEN volume > 150 THEN volume END AS volume FROM bars)"""


def gappy(b):
    vol = F.when(F.col("volume") > 250, float("inf")).when(F.col("volume") > 150, F.col("volume"))
    return b.select("ticker", "date", F.when(F.col("volume") > 100, F.col("close")).alias("close"), vol.alias("volume"))


_FILL = "coalesce(last_value({0} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {0}"


@query(
    "ffill_clean",
    sql_rounded(
        ctes(BARS, _GAPPY),
        f"""SELECT ticker, date, close, CASE WHEN isinf(volume) THEN 0 ELSE volume END AS volume FROM (
        SELECT ticker, date, {_FILL.format('close')}, {_FILL.format('volume')} FROM gappy) f""",
        "ticker, date", "close, volume", 8,
    ),
)
def ffill_clean(spark, sf):
    return pick(ft.fill_clean(gappy(bars(spark, sf))), "ticker, date", "close, volume", 8)


def _tech_sql(source: str) -> tuple[list[str], str]:
    parts = [source, *_VOL_CTES, _BB, *_rsi_ctes(), *_macd_ctes(), f"ma AS (SELECT ticker, date, close, {_MA} FROM bars)"]
    body = f"""SELECT bars.ticker, bars.date, s.price_change, high / low AS high_low_ratio, bars.close / open AS close_open_ratio,
      volume_ratio, ma_5, ma_10, ma_20, bars.close / ma_5 AS price_ma_5_ratio, bars.close / ma_10 AS price_ma_10_ratio,
      bars.close / ma_20 AS price_ma_20_ratio, volatility_5, volatility_10, p.momentum_5, p.momentum_10, bb_upper, bb_lower,
      (bars.close - bb_lower) / nullif(bb_upper - bb_lower, 0) AS bb_position, {_RSI} AS rsi_14, macd, macd_signal, macd_histogram,
      {_RANGE_SQL.replace('close', 'bars.close')}, {sql_flag('bars.close > ma_5')} AS trend_5, {sql_flag('bars.close > ma_20')} AS trend_20,
      {sql_flag('volatility_10 > m10')} AS volatility_regime
      FROM bars JOIN s USING (ticker, date) JOIN b USING (ticker, date) JOIN gl USING (ticker, date) JOIN mc USING (ticker, date)
      JOIN ma USING (ticker, date) JOIN (SELECT ticker, date, {sql_change('close', 5)} AS momentum_5,
      {sql_change('close', 10)} AS momentum_10 FROM bars) p USING (ticker, date)"""
    return parts, body


_TECH_PLAIN = "ticker, date, doji, hammer, shooting_star, trend_5, trend_20, volatility_regime"
_TECH_NUM = (
    "price_change, high_low_ratio, close_open_ratio, volume_ratio, ma_5, ma_10, ma_20, price_ma_5_ratio, price_ma_10_ratio, "
    "price_ma_20_ratio, volatility_5, volatility_10, momentum_5, momentum_10, bb_upper, bb_lower, bb_position, rsi_14, "
    "macd, macd_signal, macd_histogram"
)
_tech_parts, _tech_body = _tech_sql(BARS)


@query("tech_full", sql_rounded(ctes(*_tech_parts), _tech_body, _TECH_PLAIN, _TECH_NUM, 4))
def tech_full(spark, sf):
    return pick(ind.technical_indicators(bars(spark, sf)), _TECH_PLAIN, _TECH_NUM, 4)


def _gap_ema(name: str, frame: str, column: str, span: int) -> str:
    """Weights over all rows before, those without a value left out of both sums."""
    q = f"(1 - 2.0::DOUBLE / {span + 1})"
    return f"""{name} AS (SELECT a.ticker, a.date, sum(b.{column} * pow({q}, a.rn - b.rn)) / sum(CASE WHEN b.{column} IS NOT NULL THEN pow({q}, a.rn - b.rn) END) AS v
      FROM {frame} a JOIN {frame} b ON a.ticker = b.ticker AND b.rn <= a.rn GROUP BY 1, 2)"""


_GAP_ROWS = (300, 1300)


@query(
    "tech_full_gaps",
    sql_rounded(
        ctes(
            BARS,
            f"r AS (SELECT ticker, date, CASE WHEN rn < {_GAP_ROWS[0]} OR rn >= {_GAP_ROWS[1]} THEN close END AS close, rn FROM (SELECT *, row_number() OVER ({SERIES}) AS rn FROM bars) b)",
            _gap_ema("e12", "r", "close", 12),
            _gap_ema("e26", "r", "close", 26),
            "md AS (SELECT r.ticker, r.date, r.rn, r.close, e12.v - e26.v AS macd FROM r JOIN e12 USING (ticker, date) JOIN e26 USING (ticker, date))",
            _gap_ema("e9", "md", "macd", 9),
        ),
        f"""SELECT md.ticker, md.date, macd, e9.v AS macd_signal, macd - e9.v AS macd_histogram, {sql_full('avg', 'close', 20)} AS ma_20
          FROM md JOIN e9 ON e9.ticker = md.ticker AND e9.date = md.date""".replace("PARTITION BY ticker ORDER BY date", "PARTITION BY md.ticker ORDER BY md.date"),
        "ticker, date", "macd, macd_signal, macd_histogram, ma_20", 4,
    ),
)
def tech_full_gaps(spark, sf):
    """The indicator set where closes are missing for longer than a block: means repeat through the gap."""
    rn = F.row_number().over(W.partitionBy("ticker").orderBy("date"))
    b = bars(spark, sf).withColumn("close", F.when((rn < _GAP_ROWS[0]) | (rn >= _GAP_ROWS[1]), F.col("close")))
    return pick(ind.technical_indicators(b, block_rows=256), "ticker, date", "macd, macd_signal, macd_histogram, ma_20", 4)


_FULL_BARS = [RBARS, "named AS (SELECT ticker, date, open, high, low, close, volume, ret AS returns FROM rbars)"]
_FULL_FILLED = ["momentum_5", "momentum_10", "momentum_20", "price_change_20d", "price_ratio_20", "returns_lag_14", "returns_roll_10", "bb_width"]


@query(
    "features_full",
    sql_rounded(
        ctes(
            BARS, *_FULL_BARS, *_macd_ctes(), *_rsi_ctes(), _BB,
            f"""u AS (SELECT n.ticker, n.date, open, high, low, n.close, {sql_full('sum', 'returns', 5)} AS momentum_5,
              {sql_full('sum', 'returns', 10)} AS momentum_10, {sql_full('sum', 'returns', 20)} AS momentum_20,
              {sql_change('n.close', 20)} AS price_change_20d, n.close / ({sql_full('avg', 'n.close', 20)}) AS price_ratio_20,
              {sql_lag('returns', 14)} AS returns_lag_14, avg(returns) {over(10)} AS returns_roll_10,
              {sql_flag(f"n.close > ({sql_full('avg', 'n.close', 50)})")} AS trend_50
              FROM named n)""".replace("PARTITION BY ticker ORDER BY date", "PARTITION BY n.ticker ORDER BY n.date"),
            f"j AS (SELECT u.*, bb_upper - bb_lower AS bb_width, {_RSI} AS rsi_14, macd, macd_signal FROM u JOIN b USING (ticker, date) JOIN gl USING (ticker, date) JOIN mc USING (ticker, date))",
        ),
        f"""SELECT ticker, date, trend_50, {_SHADOW_SQL}, {_PARTS_SQL}, 0 AS sentiment_positive, CAST(0 AS BIGINT) AS news_count,
        0 AS target_direction, macd, macd_signal, {_FILL.format('rsi_14')}, """
        + ", ".join(_FILL.format(c) for c in _FULL_FILLED) + " FROM j",
        "ticker, date, trend_50, doji, hammer, shooting_star, sentiment_positive, news_count, target_direction, " + _ints(_PARTS),
        ", ".join(_FULL_FILLED) + ", rsi_14, macd, macd_signal", 4,
    ),
)
def features_full(spark, sf):
    b = with_returns(bars(spark, sf)).withColumnRenamed("return", "returns")
    return pick(
        ft.full_features(b),
        "ticker, date, trend_50, doji, hammer, shooting_star, sentiment_positive, news_count, target_direction, " + ", ".join(_PARTS),
        ", ".join(_FULL_FILLED) + ", rsi_14, macd, macd_signal", 4,
    )


_BASIC_NUM = "returns, log_returns, volatility, sma_5, sma_20, rsi, target_return"


@query(
    "preprocess_basic",
    sql_rounded(
        ctes(
            BARS, *_rsi_ctes(),
            f"c AS (SELECT ticker, date, close, {sql_change('close', 1)} AS returns, ln(close / {sql_lag('close', 1)}) AS log_returns FROM bars)",
            f"""x AS (SELECT c.ticker, c.date, returns, log_returns, {sql_full('stddev_samp', 'returns', 20)} AS volatility,
              {sql_full('avg', 'close', 5)} AS sma_5, {sql_full('avg', 'close', 20)} AS sma_20, {sql_flag('returns > 0')} AS target_direction,
              returns AS target_return FROM c)""",
            f"y AS (SELECT x.*, {_RSI} AS rsi FROM x JOIN gl USING (ticker, date))",
        ),
        "SELECT ticker, date, target_direction, target_return, CAST(0 AS BIGINT) AS news_count, '' AS combined_text, "
        + ", ".join(_FILL.format(c) for c in _BASIC_NUM.split(", ")[:-1]) + " FROM y",
        "ticker, date, target_direction, news_count, combined_text", _BASIC_NUM,
    ),
)
def preprocess_basic(spark, sf):
    return pick(pl.preprocess(bars(spark, sf)), "ticker, date, target_direction, news_count, combined_text", _BASIC_NUM)


_NEWS_DAYS = """ndates AS (SELECT ticker, text, title, url, published, timezone('America/New_York', timezone('UTC', published)) AS lts FROM news),
  nday AS (SELECT ticker, text, title, url, published, CASE WHEN isodow(lts) = 6 THEN CAST(lts AS DATE) + 2 WHEN isodow(lts) = 7 THEN CAST(lts AS DATE) + 1
    WHEN CAST(lts AS TIME) > TIME '16:00:00' THEN CAST(lts AS DATE) + CASE WHEN isodow(lts) = 5 THEN 3 ELSE 1 END
    ELSE CAST(lts AS DATE) END AS trading_date FROM ndates)"""


@query(
    "news_daily_text",
    f"""{ctes(NEWS, _NEWS_DAYS)} SELECT ticker, trading_date, count(title) AS news_count, 0 AS text_part,
    string_agg(text, ' ' ORDER BY published, url, text) AS combined_text FROM nday GROUP BY 1, 2""",
)
def news_daily_text(spark, sf):
    aligned = align_to_trading_day(news(spark, sf))
    text = dl.daily_news_text(aligned)
    return text.join(dl.daily_news_count(aligned), ["ticker", "trading_date"])


_STUB_BARS = """nbars AS (SELECT ticker, CAST(published AS DATE) AS date, avg(length(text)) AS close FROM news GROUP BY 1, 2)"""


@query(
    "preprocess_with_news",
    f"""{ctes(NEWS, _NEWS_DAYS, _STUB_BARS)}, agg AS (SELECT ticker, trading_date, count(title) AS news_count, string_agg(text, ' ' ORDER BY published, url, text) AS combined_text FROM nday GROUP BY 1, 2)
    SELECT b.ticker, b.date, coalesce(a.news_count, 0) AS news_count, coalesce(a.combined_text, '') AS combined_text, CAST(CASE WHEN a.news_count IS NULL THEN 0 ELSE 1 END AS BIGINT) AS text_parts,
    round(coalesce(b.close / lag(b.close) OVER (PARTITION BY b.ticker ORDER BY b.date) - 1, 0), 6) + 0.0 AS returns
    FROM nbars b LEFT JOIN agg a ON a.ticker = b.ticker AND a.trading_date = b.date""",
)
def preprocess_with_news(spark, sf):
    """Basic indicators with each bar's news count and text; articles also supply the bars."""
    n = news(spark, sf)
    b = n.groupBy("ticker", F.to_date("published").alias("date")).agg(F.avg(F.length("text")).alias("close"))
    return pick(pl.preprocess(b, n), "ticker, date, news_count, combined_text, text_parts", "returns")


_NC = "nc AS (SELECT ticker, date, daily_count AS news_count, ret AS returns FROM merged)"
_NC_NUM = "news_count_ma5, news_count_ma20, news_count_std, news_count_roll_20, returns_lag_7, returns_roll_10"


@query(
    "news_count_features",
    sql_rounded(
        ctes(SENT, DAILY, EBARS, MERGED, _NC),
        f"""SELECT ticker, date, {sql_full('avg', 'news_count', 5)} AS news_count_ma5, {sql_full('avg', 'news_count', 20)} AS news_count_ma20,
        {sql_full('stddev_samp', 'news_count', 20)} AS news_count_std, CAST(sum(news_count) {over(20)} AS DOUBLE) AS news_count_roll_20,
        {sql_lag('returns', 7)} AS returns_lag_7, avg(returns) {over(10)} AS returns_roll_10 FROM nc""",
        "ticker, date", _NC_NUM,
    ),
)
def news_count_features(spark, sf):
    m = merged(spark, sf).select("ticker", "date", F.col("daily_count").alias("news_count"), F.col("return").alias("returns"))
    lane = lay_out(ft.lag_and_roll(m, [1, 3, 7, 14], [5, 10, 20]), back=20)
    out = lane.add(ind.news_count_stats(lane)).finish()
    return pick(out.withColumn("news_count_roll_20", F.col("news_count_roll_20").cast("double")), "ticker, date", _NC_NUM)


@query("fold_assignment", f"""{ctes(BARS)}, n AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM bars) d)
  SELECT ticker, date, CAST(CASE WHEN rn >= n - 5 * (n // 6) THEN (rn - (n - 5 * (n // 6))) // (n // 6) ELSE -1 END AS INTEGER) AS fold FROM bars JOIN n USING (date)""")  # fmt: skip
def fold_assignment(spark, sf):
    return expanding_folds(bars(spark, sf).select("ticker", "date"))


@query("holdout_split", f"""{ctes(BARS)} SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 10 AS is_holdout FROM bars""")
def holdout_split(spark, sf):
    return holdout(bars(spark, sf).select("ticker", "date"))


_REQ = """req AS (SELECT DISTINCT l_returnflag AS ticker, CAST(o_orderdate AS DATE) AS target_date FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  UNION ALL SELECT 'unknown', DATE '1995-01-01')"""


@query(
    "lookup_with_fallback",
    sql_rounded(
        ctes(BARS, _REQ, f"l AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)"),
        """SELECT req.ticker, target_date, bars.date IS NOT NULL AS is_exact, coalesce(bars.date, l.date) AS date,
        coalesce(bars.close, l.close) AS close FROM req LEFT JOIN l USING (ticker) LEFT JOIN bars ON bars.ticker = req.ticker AND bars.date = req.target_date""",
        "ticker, target_date, is_exact, date", "close", 8,
    ),
)
def lookup(spark, sf):
    ordered = table(spark, sf, "orders", "o_orderkey", "o_orderdate").withColumnRenamed("o_orderkey", "l_orderkey")
    sold = table(spark, sf, "lineitem", "l_orderkey", "l_returnflag").join(ordered, "l_orderkey")
    requests = sold.select(F.col("l_returnflag").alias("ticker"), F.to_date("o_orderdate").alias("target_date")).distinct()
    requests = requests.union(spark.sql("SELECT 'unknown', DATE'1995-01-01'"))
    out = lookup_with_fallback(bars(spark, sf), requests)
    return pick(out, "ticker, target_date, is_exact, date", "close", 8)


@query(
    "normalize_bars",
    sql_rounded(
        ctes(BARS),
        f"SELECT *, close AS adj_close, {sql_change('close', 1)} AS ret, ln(close) - ln({sql_lag('close', 1)}) AS log_return FROM bars",
        "ticker, date", "open, high, low, close, adj_close, volume, ret, log_return", 8,
    ),
)
def normalize_bars(spark, sf):
    payload = bars(spark, sf).select(
        "ticker", F.date_format("date", "yyyy-MM-dd'T'00:00:00'Z'").alias("Date"), F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"),
    )
    out = sb.normalize_bars(payload).withColumnRenamed("return", "ret")
    return pick(out, "ticker, date", "open, high, low, close, adj_close, volume, ret, log_return", 8)


@query("flatten_bars", sql_rounded(ctes(BARS), "SELECT ticker, date, close, open, volume FROM bars", "ticker, date", "open, close, volume", 8))
def flatten_bars(spark, sf):
    tickers = ["A", "N", "R"]
    wide = bars(spark, sf).groupBy("date").agg(
        *[F.max(F.when(F.col("ticker") == t, F.col(c))).alias(f"{c.capitalize()}_{t}") for c in ("open", "close", "volume") for t in tickers]
    )
    return pick(sb.flatten_bars(wide), "ticker, date", "open, close, volume", 8)


@query("head_tail", sql_rounded(ctes(BARS), "SELECT * FROM bars ORDER BY date DESC, ticker LIMIT 5", "ticker, date", "open, high, low, close, volume", 8))
def head_tail(spark, sf):
    return rounded(st.newest(bars(spark, sf), 5, "date", "ticker"), 8)


@query(
    "date_window",
    sql_rounded(ctes(BARS), "SELECT * FROM bars WHERE date BETWEEN DATE '1999-06-30' - 120 AND DATE '1999-06-30' - 1", "ticker, date", "close, volume", 8),
)
def date_window(spark, sf):
    start, end = recent_window(120, as_of=F.lit("1999-06-30").cast("date"))
    return pick(bars(spark, sf).filter(F.col("date").between(start, end)), "ticker, date", "close, volume", 8)


@query(
    "features_roundtrip",
    sql_rounded(
        ctes(BARS),
        f"SELECT ticker, date, open, close, volume, CAST(0 AS DOUBLE) AS target_return, DATE '2020-01-01' + CAST(row_number() OVER ({SERIES}) - 1 AS INTEGER) AS synthetic FROM bars",
        "ticker, date, synthetic", "open, close, volume, target_return", 8,
    ),
)
def features_roundtrip(spark, sf):
    """Bars through the parquet, CSV and JSON tables and back, then a synthetic daily date."""
    root = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    b = bars(spark, sf)
    st.write_features(b, f"{root}/features")
    back = spark.read.schema(b.schema).parquet(f"{root}/features")
    st.write_stage(back, f"{root}/stage")
    staged = st.read_stage(spark, f"{root}/stage", back.schema)
    st.write_records(staged, f"{root}/records")
    records = spark.read.schema(back.schema).json(f"{root}/records")
    day = sb.number_days(records.withColumnRenamed("date", "bar_date"), "bar_date").withColumnsRenamed({"date": "synthetic", "bar_date": "date"})
    return pick(ensure(day, target_return=0.0), "ticker, date, synthetic", "open, close, volume, target_return", 8)


# ---- the same operators on intraday bars: block layout with borrowed rows, two-level running aggregates


_itech_parts, _itech_body = _tech_sql(MINUTES)


@query("intraday_indicators", sql_rounded(ctes(*_itech_parts), _itech_body, _TECH_PLAIN, _TECH_NUM, 7))
def intraday_indicators(spark, sf):
    out = ind.technical_indicators(minute_bars(spark, sf)).withColumn("date", F.col("date").cast("timestamp_ntz"))
    return pick(out, _TECH_PLAIN, _TECH_NUM, 7)


_IGAPPY = "gappy AS (SELECT ticker, date, CASE WHEN close > 20 THEN close END AS close FROM bars)"
_START = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query(
    "intraday_fill",
    sql_rounded(
        ctes(MINUTES, _IGAPPY),
        f"""SELECT ticker, date, last_value(close IGNORE NULLS) OVER ({SERIES} {_START}) AS filled,
        max(close) OVER ({SERIES} {_START}) AS peak FROM gappy""",
        "ticker, date", "filled, peak",
    ),
)
def intraday_fill(spark, sf):
    b = minute_bars(spark, sf).select("ticker", "date", F.when(F.col("close") > 20, F.col("close")).alias("close"))
    out = running(b, {"filled": ("last", "close"), "peak": ("max", "close")})
    return pick(out.withColumn("date", F.col("date").cast("timestamp_ntz")), "ticker, date", "filled, peak")


@query(
    "lookup_intraday",
    sql_rounded(
        ctes(
            MINUTES,
            """req AS (SELECT DISTINCT event_type AS ticker, CAST(ts AS DATE) AS target_date FROM events UNION ALL SELECT DISTINCT event_type, DATE '2030-01-01' FROM events)""",
        ),
        """SELECT req.ticker, target_date, bool_or(CAST(bars.date AS DATE) = target_date) AS is_exact,
        max_by(bars.close, CASE WHEN CAST(bars.date AS DATE) = target_date THEN bars.date + INTERVAL 100 YEAR ELSE bars.date END) AS close
        FROM req JOIN bars USING (ticker) GROUP BY 1, 2""",
        "ticker, target_date, is_exact", "close", 8,
    ),
)
def lookup_intraday(spark, sf):
    e = table(spark, sf, "events", "event_type", "ts")
    requests = e.select(F.col("event_type").alias("ticker"), F.to_date("ts").alias("target_date")).distinct()
    requests = requests.union(requests.select("ticker", F.lit("2030-01-01").cast("date")).distinct())
    return pick(lookup_with_fallback(minute_bars(spark, sf), requests), "ticker, target_date, is_exact", "close", 8)


_CLOSED = [f"2024-01-{d:02d}" for d in range(4, 20)]  # a closure of sixteen days


@query(
    "align_with_long_closure",
    f"""WITH days AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '2023-12-25', DATE '2024-03-31', INTERVAL 1 DAY) g(d)),
    sess AS (SELECT d FROM days WHERE isodow(d) < 6 AND d NOT IN ({", ".join(f"DATE '{d}'" for d in _CLOSED)})),
    nxt AS (SELECT days.d, min(sess.d) AS n, bool_or(sess.d = days.d) AS open FROM days JOIN sess ON sess.d >= days.d GROUP BY 1),
    e AS (SELECT event_id, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS d,
          CAST(timezone('America/New_York', timezone('UTC', ts)) AS TIME) > TIME '16:00:00' AS late FROM events)
    SELECT event_id, CASE WHEN a.open AND NOT late THEN e.d ELSE b.n END AS trading_date
    FROM e JOIN nxt a ON a.d = e.d JOIN nxt b ON b.d = e.d + 1""",
)
def align_with_long_closure(spark, sf):
    closed = spark.createDataFrame([(d,) for d in _CLOSED], "holiday string")
    calendar = session_map(spark, closed, "2023-12-25", "2024-03-31")
    return align_to_trading_day(raw_news_events(spark, sf), calendar=calendar).select("event_id", "trading_date")


@query("stage_roundtrip_text", """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' ELSE text END AS text,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source, n_chars FROM documents""")  # fmt: skip
def stage_roundtrip_text(spark, sf):
    """Documents through a CSV stage: line ends, quotes, empty and missing texts come back as they were."""
    d = table(spark, sf, "documents", "doc_id", "text", "source", "n_chars")
    text = F.when(F.col("doc_id") % 7 == 1, "").when(F.col("doc_id") % 7 != 0, F.col("text"))
    d = d.select("doc_id", text.alias("text"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"), "n_chars")
    path = f"{shared_folder(spark)}/stage_{uuid.uuid4().hex}"
    st.write_stage(d, path)
    return st.read_stage(spark, path, d.schema)


def _folder(spark):
    return f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"


_OHLCV = "open, high, low, close, volume"


@query("bars_table", sql_rounded(ctes(BARS), "SELECT * FROM bars WHERE ticker = 'R' AND date >= DATE '1993-01-01' AND date < DATE '1995-06-01'", "ticker, date", _OHLCV, 8))
def bars_table(spark, sf):
    """Bars through their table, then one ticker and period of it."""
    path = _folder(spark)
    sb.write_bars(bars(spark, sf), path)
    return pick(sb.read_bars(spark, path, "r", "1993-01-01", "1995-06-01"), "ticker, date", _OHLCV, 8)


@query("features_of_ticker", sql_rounded(ctes(BARS), "SELECT * FROM bars WHERE ticker = 'N'", "ticker, date", _OHLCV, 8))
def features_of_ticker(spark, sf):
    path = _folder(spark)
    b = bars(spark, sf)
    st.write_features(b.withColumn("ticker", F.lower("ticker")), path)
    return pick(st.read_features(spark, path, "n", b.schema), "ticker, date", _OHLCV, 8)


@query("news_table", f"{ctes(NEWS)} SELECT doc_id, ticker, source, title, text, url FROM news")
def news_table(spark, sf):
    """Articles through the table that is split by source and ticker."""
    path = _folder(spark)
    n = news(spark, sf)
    st.write_news(n, path)
    return spark.read.schema(n.schema).parquet(path).select("doc_id", "ticker", "source", "title", "text", "url")


@query("aligned_columns", sql_rounded(ctes(BARS), "SELECT ticker, date, coalesce(close, 0) AS close, CAST(0 AS DOUBLE) AS unseen, CASE WHEN volume > 40 THEN 0 ELSE volume END AS volume FROM bars", "ticker, date", "close, unseen, volume", 8))
def aligned_columns(spark, sf):
    """Trained names first: an absent column and missing values as 0."""
    b = bars(spark, sf).withColumn("volume", F.when(F.col("volume") <= 40, F.col("volume")))
    return pick(ft.align_columns(b, ["close", "unseen", "volume"]), "ticker, date", "close, unseen, volume", 8)
