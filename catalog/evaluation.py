"""Queries for backtests, evaluation tables, statistics, and the tables behind charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.operators import evaluate as ev
from barlight.operators import stats as ss
from barlight.operators.backtest import backtest_metrics, run_backtest
from catalog.base import *  # noqa: F403
from catalog.series import merged

START = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

# position -> net return -> equity, for a frame `preds` with ticker, date, ret, prob_up
BACKTEST = f"""p1 AS (SELECT ticker, date, ret, prob_up, {sql_lag('CASE WHEN prob_up > 0.55 THEN 1.0::DOUBLE ELSE 0 END', 1)} AS lagged FROM preds),
  p2 AS (SELECT *, coalesce(lagged, 0) AS position FROM p1),
  p3 AS (SELECT *, coalesce(abs(position - {sql_lag('position', 1)}), position) AS pos_change FROM p2),
  p4 AS (SELECT *, position * ret - pos_change * 0.0005 AS strategy_return FROM p3),
  p5 AS (SELECT *, CASE WHEN strategy_return IS NOT NULL THEN product(1 + strategy_return) OVER ({SERIES} {START}) END AS equity,
    product(1 + coalesce(ret, 0)) OVER ({SERIES} {START}) AS buy_hold FROM p4),
  curves AS (SELECT *, equity / max(equity) OVER ({SERIES} {START}) - 1 AS drawdown FROM p5)"""
_CURVE = "position, pos_change, strategy_return, equity, buy_hold, drawdown"
_METRICS = """SELECT ticker, arg_max(equity, date) FILTER (equity IS NOT NULL) - 1 AS total_return, avg(strategy_return) * 252 / (stddev_samp(strategy_return) * sqrt(252)) AS annualized_sharpe,
  min(drawdown) AS max_drawdown, CAST(count(*) FILTER (pos_change > 0) AS DOUBLE) AS trades FROM curves GROUP BY 1"""
_METRIC_COLS = "total_return, annualized_sharpe, max_drawdown, trades"


@query("backtest_equity", sql_rounded(ctes(BARS, PREDS, BACKTEST), "SELECT * FROM curves", "ticker, date", _CURVE, 8))
def backtest_equity(spark, sf):
    return pick(run_backtest(preds(spark, sf)), "ticker, date", _CURVE, 8)


@query("backtest_metrics", sql_rounded(ctes(BARS, PREDS, BACKTEST), _METRICS, "ticker", _METRIC_COLS, 8))
def backtest_metrics_query(spark, sf):
    return pick(backtest_metrics(run_backtest(preds(spark, sf))), "ticker", _METRIC_COLS, 8)


def intraday_preds(spark, sf):
    m = minute_bars(spark, sf)
    prob = (F.pmod(F.unix_timestamp("date") / 60, F.lit(997)) / 997).alias("prob_up")
    up = F.when(F.col("close") > F.col("open"), 1).otherwise(0).alias("label")
    return m.select("ticker", "date", (0.000282842712474619 * (F.col("close") - 20) / (F.col("close") + 20)).alias("return"), prob, up)


_IPREDS = f"""preds AS (SELECT ticker, date, 0.000282842712474619 * (close - 20) / (close + 20) AS ret,
  ((CAST(epoch(date) AS BIGINT) // 60) % 997) / 997.0::DOUBLE AS prob_up, {sql_flag('close > open')} AS label FROM bars)"""


@query("intraday_backtest", sql_rounded(ctes(MINUTES, _IPREDS, BACKTEST), "SELECT * FROM curves", "ticker, date", _CURVE, 8))
def intraday_backtest(spark, sf):
    out = run_backtest(intraday_preds(spark, sf))
    return pick(out.withColumn("date", F.col("date").cast("timestamp_ntz")), "ticker, date", _CURVE, 8)


@query("intraday_backtest_metrics", sql_rounded(ctes(MINUTES, _IPREDS, BACKTEST), _METRICS, "ticker", _METRIC_COLS, 6))
def intraday_backtest_metrics(spark, sf):
    return pick(backtest_metrics(run_backtest(intraday_preds(spark, sf))), "ticker", _METRIC_COLS, 6)


@query(
    "confusion",
    f"""{ctes(BARS, PREDS)} SELECT t.ticker, y.label, p.prediction, count(r.ticker) AS n FROM (SELECT DISTINCT ticker FROM preds) t
    CROSS JOIN (VALUES (0), (1)) y(label) CROSS JOIN (VALUES (0), (1)) p(prediction)
    LEFT JOIN preds r ON r.ticker = t.ticker AND r.label = y.label AND r.prediction = p.prediction GROUP BY 1, 2, 3""",
)
def confusion(spark, sf):
    return ev.confusion(preds(spark, sf))


_CLASS = """k AS (SELECT ticker, c AS class, count(*) FILTER (label = c AND prediction = c) AS hit, count(*) FILTER (prediction = c) AS said,
    count(*) FILTER (label = c) AS support FROM preds CROSS JOIN (VALUES (0), (1)) cls(c) GROUP BY 1, 2),
  m AS (SELECT *, coalesce(hit / nullif(said, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall, coalesce(2 * hit / nullif(said + support, 0), 0) AS f1 FROM k)"""


@query(
    "class_report",
    sql_rounded(
        ctes(BARS, PREDS, _CLASS),
        """SELECT ticker, CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM m
        UNION ALL SELECT ticker, 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), CAST(sum(support) AS BIGINT) FROM m GROUP BY 1
        UNION ALL SELECT ticker, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM m GROUP BY 1
        UNION ALL SELECT ticker, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m GROUP BY 1""",
        "ticker, class, support", "precision, recall, f1", 8,
    ),
)
def class_report(spark, sf):
    return rounded(ev.class_report(preds(spark, sf)), 8)


@query(
    "headline_scores",
    sql_rounded(
        ctes(BARS, PREDS),
        """SELECT ticker, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0 END) AS accuracy, count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (prediction = 1) AS precision,
        count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1) AS recall,
        2 * count(*) FILTER (label = 1 AND prediction = 1) / (count(*) FILTER (prediction = 1) + count(*) FILTER (label = 1)) AS f1 FROM preds GROUP BY 1""",
        "ticker", "accuracy, precision, recall, f1", 8,
    ),
)
def headline_scores(spark, sf):
    return rounded(ev.headline(preds(spark, sf)), 8)


def _auc_sql(keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""SELECT {keys + ',' if keys else ''} (sum(r) FILTER (label = 1) - p * (p + 1) / 2.0) / (p * n) AS auc FROM (
      SELECT *, rank() OVER ({part} ORDER BY prob_up) + (count(*) OVER ({part + ', prob_up' if keys else 'PARTITION BY prob_up'}) - 1) / 2.0 AS r,
        count(*) FILTER (label = 1) OVER ({part}) AS p, count(*) FILTER (label = 0) OVER ({part}) AS n FROM preds) t GROUP BY {keys + ',' if keys else ''} p, n"""


@query("roc_auc", sql_rounded(ctes(BARS, PREDS), _auc_sql("ticker"), "ticker", "auc", 8))
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(preds(spark, sf)), 8)


_SOME = "kept AS (SELECT * FROM preds WHERE rn % 5 <> 0)"


def _some_missing(df):
    """Every fifth probability missing, in turn null and NaN."""
    gap = F.when(F.col("rn") % 10 == 0, F.lit(None)).otherwise(F.lit(float("nan")))
    return df.withColumn("prob_up", F.when(F.col("rn") % 5 == 0, gap).otherwise(F.col("prob_up")))


@query("roc_auc_missing", sql_rounded(ctes(BARS, PREDS, _SOME), f"SELECT a.ticker || k.kind AS ticker, auc FROM ({_auc_sql('ticker').replace('FROM preds', 'FROM kept')}) a, (VALUES ('/day'), ('/time')) k(kind)", "ticker", "auc", 8))
def roc_auc_missing(spark, sf):
    """Rows without a probability take no part, by day and by timestamp alike."""
    p = _some_missing(preds(spark, sf))
    timed = p.withColumn("date", F.col("date").cast("timestamp"))
    out = [ev.roc_auc(d).withColumn("ticker", F.concat("ticker", F.lit(kind))) for kind, d in (("/day", p), ("/time", timed))]
    return rounded(out[0].unionByName(out[1]), 8)


@query("roc_auc_pooled", sql_rounded(ctes(MINUTES, _IPREDS), _auc_sql(""), "", "auc", 8))
def roc_auc_pooled(spark, sf):
    """One AUC over the rows of every ticker."""
    return rounded(ev.roc_auc(intraday_preds(spark, sf), keys=[]), 8)


_ROC = """g AS (SELECT ticker, prob_up AS prob, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM preds GROUP BY 1, 2),
  h AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY ticker) AS p, sum(neg) OVER (PARTITION BY ticker) AS n,
    row_number() OVER w AS i, lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg FROM g WINDOW w AS (PARTITION BY ticker ORDER BY prob DESC))"""
_ROC_KEEP = "i = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg"


def _roc_sql(keep: str) -> str:
    return f"""SELECT ticker, prob AS threshold, fp / n AS fpr, tp / p AS tpr FROM h WHERE {keep}
    UNION ALL SELECT DISTINCT ticker, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM preds"""


def _plain_start(curve):
    return curve.withColumn("threshold", F.when(F.col("threshold") <= 1, F.col("threshold")))


@query("roc_curve", sql_rounded(ctes(BARS, PREDS, _ROC), _roc_sql(_ROC_KEEP), "ticker", "threshold, fpr, tpr", 8))
def roc_curve(spark, sf):
    return rounded(_plain_start(ev.roc_curve(preds(spark, sf))), 8)


@query("intraday_roc_curve", sql_rounded(ctes(MINUTES, _IPREDS, _ROC), _roc_sql(_ROC_KEEP), "ticker", "threshold, fpr, tpr", 8))
def intraday_roc_curve(spark, sf):
    return rounded(_plain_start(ev.roc_curve(intraday_preds(spark, sf))), 8)


@query("intraday_roc_auc", sql_rounded(ctes(MINUTES, _IPREDS), _auc_sql("ticker"), "ticker", "auc", 8))
def intraday_roc_auc(spark, sf):
    return rounded(ev.roc_auc(intraday_preds(spark, sf)), 8)


@query("roc_curve_all_points", sql_rounded(ctes(BARS, PREDS, _ROC), _roc_sql("true"), "ticker", "threshold, fpr, tpr", 8))
def roc_curve_all_points(spark, sf):
    return rounded(_plain_start(ev.roc_curve(preds(spark, sf), drop_intermediate=False)), 8)


@query(
    "rolling_accuracy",
    sql_rounded(ctes(BARS, PREDS), f"SELECT ticker, date, avg({sql_flag('label = prediction')}) {over(20)} AS rolling_accuracy FROM preds", "ticker, date", "rolling_accuracy", 8),
)
def rolling_accuracy(spark, sf):
    return pick(ev.rolling_accuracy(preds(spark, sf)), "ticker, date", "rolling_accuracy", 8)


def _forecast(spark, sf):
    p = preds(spark, sf).filter(F.col("return").isNotNull())
    return p.select("ticker", "date", F.col("return").alias("label"), ((F.col("prob_up") - 0.5) / 100).alias("prediction"))


_FORECAST = "fc AS (SELECT ticker, date, ret AS label, (prob_up - 0.5) / 100 AS prediction FROM preds WHERE ret IS NOT NULL)"


@query(
    "regression_metrics",
    sql_rounded(
        ctes(BARS, PREDS, _FORECAST),
        """SELECT ticker, count(*) AS n, avg((label - prediction) ^ 2) AS mse, 1 - sum((label - prediction) ^ 2) / sum((label - m) ^ 2) AS r2
        FROM (SELECT *, avg(label) OVER (PARTITION BY ticker) AS m FROM fc) t GROUP BY 1""",
        "ticker, n", "mse, r2", 10,
    ),
)
def regression_metrics(spark, sf):
    return rounded(ev.regression_metrics(_forecast(spark, sf)), 10)


@query(
    "chart_residuals",
    sql_rounded(ctes(BARS, PREDS, _FORECAST), "SELECT *, label - prediction AS residual FROM fc", "ticker, date", "label, prediction, residual", 10),
)
def chart_residuals(spark, sf):
    return rounded(ev.residuals(_forecast(spark, sf)), 10)


# ---- statistics on the sentiment bars

_M = [SENT, DAILY, EBARS, MERGED]


def priced(spark, sf):
    return merged(spark, sf).withColumn("adj_close", F.col("close"))


_CORR = ["adj_close", "daily_mean_sentiment", "daily_count", "return", "target_return_1d"]
_CORR_SQL = {"adj_close": "close", "return": "ret"}


def _corr_body() -> str:
    cells = [
        f"SELECT ticker, '{a}' AS x, '{b}' AS y, corr({_CORR_SQL.get(a, a)}, {_CORR_SQL.get(b, b)}) AS corr FROM merged GROUP BY 1"
        for a in _CORR
        for b in _CORR
    ]
    return " UNION ALL ".join(cells)


@query("corr_matrix", sql_rounded(ctes(*_M), _corr_body(), "ticker, x, y", "corr", 7))
def corr_matrix(spark, sf):
    return rounded(ss.correlation_matrix(priced(spark, sf)), 7)


def _spearman(y: str, name: str) -> str:
    return f"""SELECT ticker, 'sentiment vs {name}' AS metric, count(*) AS n, corr(a, b) AS pearson_r, corr(ra, rb) AS spearman_rho FROM (
      SELECT *, rank() OVER (PARTITION BY ticker ORDER BY a) + (count(*) OVER (PARTITION BY ticker, a) - 1) / 2.0 AS ra,
        rank() OVER (PARTITION BY ticker ORDER BY b) + (count(*) OVER (PARTITION BY ticker, b) - 1) / 2.0 AS rb
      FROM (SELECT ticker, daily_mean_sentiment AS a, {y} AS b FROM merged WHERE {y} IS NOT NULL) q) t GROUP BY 1"""


def _p_value(r: str) -> str:
    """Two-sided t tail of a correlation with n - 2 degrees of freedom, as its finite cosine series."""
    even = f"abs({r}) * list_sum(list_transform(generate_series(0, (n - 2) // 2 - 1), lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1)) / sqrt(pi()) * pow(1 - {r} * {r}, j)))"
    odd = f"2 / pi() * (asin(abs({r})) + abs({r}) * list_sum(list_transform(generate_series(0, (n - 5) // 2), lambda j: sqrt(pi()) / 2 * exp(lgamma(j + 1) - lgamma(j + 1.5)) * pow(1 - {r} * {r}, j + 0.5))))"
    return f"1 - CASE WHEN n % 2 = 0 THEN {even} ELSE {odd} END"


_PS_NUM = "pearson_r, pearson_p, spearman_rho, spearman_p"


def _with_p(body: str) -> str:
    return f"SELECT *, {_p_value('pearson_r')} AS pearson_p, {_p_value('spearman_rho')} AS spearman_p FROM ({body}) c"


@query(
    "pearson_spearman",
    sql_rounded(ctes(*_M), _with_p(f"{_spearman('ret', 'return')} UNION ALL {_spearman('target_return_1d', 'target_return_1d')}"), "ticker, metric, n", _PS_NUM, 7),
)
def pearson_spearman(spark, sf):
    return pick(ss.sentiment_correlations(priced(spark, sf)), "ticker, metric, n", _PS_NUM, 7)


@query(
    "linear_fit",
    sql_rounded(
        ctes(*_M),
        """SELECT ticker, count(*) AS n, regr_slope(target_return_1d, daily_mean_sentiment) AS slope, regr_intercept(target_return_1d, daily_mean_sentiment) AS intercept,
        regr_r2(target_return_1d, daily_mean_sentiment) AS r2, corr(target_return_1d, daily_mean_sentiment) AS r FROM merged WHERE target_return_1d IS NOT NULL GROUP BY 1""",
        "ticker, n", "slope, intercept, r2, r", 8,
    ),
)
def linear_fit(spark, sf):
    return rounded(ss.linear_fit(priced(spark, sf)), 8)


def _ccf_sql(frame: str, x: str, y: str, max_lag: int) -> str:
    return f"""WITH z AS (SELECT ticker, row_number() OVER ({SERIES}) AS rn, coalesce({x}, 0) AS x, coalesce({y}, 0) AS y FROM {frame}),
    c AS (SELECT ticker, rn, x - avg(x) OVER (PARTITION BY ticker) AS x, y - avg(y) OVER (PARTITION BY ticker) AS y,
      stddev_pop(x) OVER (PARTITION BY ticker) * stddev_pop(y) OVER (PARTITION BY ticker) * count(*) OVER (PARTITION BY ticker) AS scale FROM z),
    k AS (SELECT unnest(generate_series({-max_lag}, {max_lag})) AS lag)
    SELECT a.ticker, CAST(k.lag AS INTEGER) AS lag, sum(a.x * b.y) / any_value(a.scale) AS ccf FROM k, c a JOIN c b ON a.ticker = b.ticker
    WHERE a.rn = b.rn + k.lag GROUP BY 1, 2"""


@query("ccf", sql_rounded(ctes(BARS, PREDS), _ccf_sql("preds", "prob_up", "ret", 10), "ticker, lag", "ccf", 8))
def ccf(spark, sf):
    return rounded(ss.cross_correlation(preds(spark, sf), "prob_up", "return"), 8)


@query(
    "ccf_best_lag",
    sql_rounded(ctes(*_M), f"SELECT ticker, lag, ccf FROM ({_ccf_sql('merged', 'daily_mean_sentiment', 'ret', 10)}) q QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY abs(ccf) DESC, lag) = 1", "ticker, lag", "ccf", 8),
)
def ccf_best_lag(spark, sf):
    return rounded(ss.best_lag(ss.cross_correlation(priced(spark, sf))), 8)


def intraday_scores(spark, sf):
    p = intraday_preds(spark, sf)
    y = F.when(F.col("prob_up") > 0.2, F.col("return"))
    return p.select("ticker", "date", F.round("prob_up", 2).alias("s"), "return", y.alias("target_return_1d"))


def _ispearman(y: str, name: str) -> str:
    return _spearman(y, name).replace("FROM merged", "FROM iscores")


@query(
    "intraday_spearman",
    sql_rounded(
        ctes(MINUTES, _IPREDS, "iscores AS (SELECT ticker, round(prob_up, 2) AS daily_mean_sentiment, ret, CASE WHEN prob_up > 0.2 THEN ret END AS target_return_1d FROM preds)"),
        f"{_ispearman('ret', 'return')} UNION ALL {_ispearman('target_return_1d', 'target_return_1d')}", "ticker, metric, n", "pearson_r, spearman_rho", 7,
    ),
)
def intraday_spearman(spark, sf):
    return pick(ss.sentiment_correlations(intraday_scores(spark, sf), x="s"), "ticker, metric, n", "pearson_r, spearman_rho", 7)


# one lag: the F statistic of a single added regressor follows from its partial correlation
_GRANGER1 = f"""lagged AS (SELECT ticker, y, {sql_lag('y', 1)} AS y1, {sql_lag('x', 1)} AS x1 FROM (SELECT ticker, date, ret AS y, prob_up AS x FROM preds WHERE ret IS NOT NULL) q),
  r AS (SELECT ticker, count(*) AS n, corr(y, x1) AS a, corr(y, y1) AS b, corr(x1, y1) AS c FROM lagged WHERE y1 IS NOT NULL GROUP BY 1),
  p AS (SELECT ticker, n, (a - b * c) ^ 2 / ((1 - b * b) * (1 - c * c)) AS r2 FROM r)"""


@query(
    "granger_lag1",
    sql_rounded(
        ctes(BARS, PREDS, _GRANGER1),
        """SELECT ticker, 1 AS lag, n, 'ssr_ftest' AS test, (n - 3) * r2 / (1 - r2) AS statistic FROM p
        UNION ALL SELECT ticker, 1, n, 'params_ftest', (n - 3) * r2 / (1 - r2) FROM p
        UNION ALL SELECT ticker, 1, n, 'ssr_chi2test', n * r2 / (1 - r2) FROM p
        UNION ALL SELECT ticker, 1, n, 'lrtest', -n * ln(1 - r2) FROM p""",
        "ticker, lag, n, test", "statistic", 6,
    ),
)
def granger_lag1(spark, sf):
    out = ss.granger(preds(spark, sf), x="prob_up", max_lag=1)
    return pick(out, "ticker, lag, n, test", "statistic")


def _sweep(lag: int) -> tuple[list[str], str]:
    """Both residual sums of squares by sweeping one regressor after another out of the rest."""
    own, other = [f"y{k}" for k in range(1, lag + 1)], [f"x{k}" for k in range(1, lag + 1)]
    rest = ["one", *own, *other, "y"]
    parts = [f"g{lag}_0 AS (SELECT ticker, n, 1.0::DOUBLE AS one, y, {', '.join(own + other)} FROM glags WHERE y{lag} IS NOT NULL)"]
    for k in range(2 * lag + 1):
        q, rest = rest[0], rest[1:]
        swept = [f"{c} - {q} * (sum({c} * {q}) OVER (PARTITION BY ticker) / sum({q} * {q}) OVER (PARTITION BY ticker)) AS {c}" for c in rest]
        kept = ", y AS y_own" if k == lag + 1 else (", y_own" if k > lag + 1 else "")
        parts.append(f"g{lag}_{k + 1} AS (SELECT ticker, n, {', '.join(swept)}{kept} FROM g{lag}_{k})")
    body = f"SELECT ticker, {lag} AS lag, count(*) AS n, sum(y_own * y_own) AS ssr0, sum(y * y) AS ssr1 FROM g{lag}_{2 * lag + 1} GROUP BY 1"
    return parts, body


_GLAGS = (
    "glags AS (SELECT ticker, y, count(*) OVER (PARTITION BY ticker) AS n, "
    + ", ".join(f"{sql_lag(v, k)} AS {v}{k}" for k in range(1, 6) for v in ("y", "x"))
    + " FROM (SELECT ticker, date, ret AS y, prob_up AS x FROM preds WHERE ret IS NOT NULL) q)"
)
_SWEEPS = [_sweep(lag) for lag in range(1, 6)]


@query(
    "granger",
    sql_rounded(
        ctes(BARS, PREDS, _GLAGS, *[p for parts, _ in _SWEEPS for p in parts], "ssr AS (" + " UNION ALL ".join(b for _, b in _SWEEPS) + ")"),
        """SELECT ticker, lag, n, 'ssr_ftest' AS test, ((ssr0 - ssr1) / lag) / (ssr1 / (n - 2 * lag - 1)) AS statistic FROM ssr
        UNION ALL SELECT ticker, lag, n, 'params_ftest', ((ssr0 - ssr1) / lag) / (ssr1 / (n - 2 * lag - 1)) FROM ssr
        UNION ALL SELECT ticker, lag, n, 'ssr_chi2test', n * (ssr0 - ssr1) / ssr1 FROM ssr
        UNION ALL SELECT ticker, lag, n, 'lrtest', n * ln(ssr0 / ssr1) FROM ssr""",
        "ticker, lag, n, test", "statistic", 6,
    ),
)
def granger(spark, sf):
    return pick(ss.granger(preds(spark, sf), x="prob_up"), "ticker, lag, n, test", "statistic")


# Tails as power series whose terms are written out with the logarithm of the gamma function: no continued fraction.
_GRANGER_P = """st AS (SELECT *, n - 2 * lag - 1 AS free, greatest(((ssr0 - ssr1) / lag) / (ssr1 / (n - 2 * lag - 1)), 0) AS f, n * (ssr0 - ssr1) / ssr1 AS chi2, n * ln(ssr0 / ssr1) AS lr FROM ssr),
  fx AS (SELECT ticker, lag, n, f, lag / 2.0::DOUBLE AS p, free / 2.0::DOUBLE AS q, lag * f / (free + lag * f) AS x FROM st),
  ft AS (SELECT ticker, lag, n, f, 1 - exp(p * ln(x) + q * ln(1 - x) + lgamma(p + q) - lgamma(p) - lgamma(q)) / p * sum(exp(lgamma(p + q + k) - lgamma(p + q) + lgamma(p + 1) - lgamma(p + 1 + k) + k * ln(x))) AS tail
    FROM fx, (SELECT unnest(range(0, 500)) AS k) r GROUP BY ticker, lag, n, f, p, q, x),
  cx AS (SELECT ticker, lag, n, 'ssr_chi2test' AS test, chi2 AS statistic, lag / 2.0::DOUBLE AS s, chi2 / 2 AS x FROM st UNION ALL SELECT ticker, lag, n, 'lrtest', lr, lag / 2.0::DOUBLE, lr / 2 FROM st),
  ct AS (SELECT ticker, lag, n, test, statistic, 1 - sum(exp((s + k) * ln(x) - x - lgamma(s + k + 1))) AS tail FROM cx, (SELECT unnest(range(0, 500)) AS k) r GROUP BY ticker, lag, n, test, statistic, s, x)"""


@query(
    "granger_p_values",
    sql_rounded(
        ctes(BARS, PREDS, _GLAGS, *[p for parts, _ in _SWEEPS for p in parts], "ssr AS (" + " UNION ALL ".join(b for _, b in _SWEEPS) + ")", _GRANGER_P),
        """SELECT ticker, lag, n, test, f AS statistic, tail AS p_value FROM ft, (VALUES ('ssr_ftest'), ('params_ftest')) t(test)
        UNION ALL SELECT ticker, lag, n, test, statistic, tail FROM ct""",
        "ticker, lag, n, test", "statistic, p_value", 6,
    ),
)
def granger_p_values(spark, sf):
    return pick(ss.granger(preds(spark, sf), x="prob_up"), "ticker, lag, n, test", "statistic, p_value", 6)


# ---- tables behind charts


@query("chart_price_sentiment", sql_rounded(ctes(*_M), "SELECT ticker, date, close AS adj_close, daily_mean_sentiment FROM merged", "ticker, date", "adj_close, daily_mean_sentiment", 8))
def chart_price_sentiment(spark, sf):
    return pick(priced(spark, sf), "ticker, date", "adj_close, daily_mean_sentiment", 8)


@query(
    "chart_scatter",
    sql_rounded(
        ctes(*_M),
        """SELECT m.ticker, date, daily_mean_sentiment, target_return_1d, f.slope * daily_mean_sentiment + f.intercept AS fitted FROM merged m JOIN (
        SELECT ticker, regr_slope(target_return_1d, daily_mean_sentiment) AS slope, regr_intercept(target_return_1d, daily_mean_sentiment) AS intercept FROM merged GROUP BY 1) f
        ON f.ticker = m.ticker WHERE target_return_1d IS NOT NULL""",
        "ticker, date", "daily_mean_sentiment, target_return_1d, fitted", 8,
    ),
)
def chart_scatter(spark, sf):
    m = priced(spark, sf).filter(F.col("daily_mean_sentiment").isNotNull() & F.col("target_return_1d").isNotNull())
    fit = ss.linear_fit(m).select("ticker", "slope", "intercept")
    out = m.join(fit, "ticker").withColumn("fitted", F.col("slope") * F.col("daily_mean_sentiment") + F.col("intercept"))
    return pick(out, "ticker, date", "daily_mean_sentiment, target_return_1d, fitted", 8)


@query("chart_equity", sql_rounded(ctes(BARS, PREDS, BACKTEST), "SELECT ticker, date, equity, buy_hold FROM curves", "ticker, date", "equity, buy_hold", 8))
def chart_equity(spark, sf):
    return pick(run_backtest(preds(spark, sf)), "ticker, date", "equity, buy_hold", 8)
