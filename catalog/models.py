"""Queries that train, vote, predict, evaluate, and run the pipeline end to end.

Every model trains on the whole bars table, less the holdout where it is judged. Five folds and every
model kind take part; the grids here hold two points a kind, since the default ones
(``barlight.operators.ml.CLASSIFIERS`` and ``REGRESSORS``) are 27 points a task with up to 200 deep trees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barlight.operators import ml
from barlight.operators.backtest import backtest_metrics, run_backtest
from barlight.operators.daily import add_targets
from barlight.operators.evaluate import top_importances
from barlight.operators.indicators import moving_averages, price_changes, technical_indicators
from barlight.operators.splits import holdout
from barlight.plans import compose as pl
from barlight.session import settle, shared_folder
from barlight.sources import tables as st
from catalog.articles import _TOKENS, length_scorer
from catalog.base import *  # noqa: F403
from catalog.evaluation import BACKTEST, _auc_sql

COLUMNS = ["momentum_5", "momentum_10", "price_ma_5_ratio", "price_ma_20_ratio", "volatility_10", "rsi_14", "bb_position"]
SMALL_FOREST = {"trees": [10], "depth": [5, 10], "min_leaf": [3]}
SMALL_BOOST = {"rounds": [5], "depth": [2, 3], "rate": [0.1]}
SMALL_CLASSIFIERS = {
    "logreg": ml.CLASSIFIERS["logreg"],
    "rf": ml.CLASSIFIERS["rf"]._replace(grid=SMALL_FOREST),
    "xgb": ml.CLASSIFIERS["xgb"]._replace(grid=SMALL_BOOST),
}
SMALL_REGRESSORS = {
    "ridge": ml.REGRESSORS["ridge"],
    "rfr": ml.REGRESSORS["rfr"]._replace(grid=SMALL_FOREST),
    "xgbr": ml.REGRESSORS["xgbr"]._replace(grid=SMALL_BOOST),
}
LOGREG, FOREST = ml.CLASSIFIERS["logreg"], ml.CLASSIFIERS["rf"]
FOREST_POINT = {"trees": 10, "depth": 5, "min_leaf": 1}
HELD_ROWS = 250


def model_frame(spark, sf):
    return settle(technical_indicators(add_targets(with_returns(bars(spark, sf)))))


def _results(spark, trained):
    rows = []
    for name, t in trained.items():
        for point in t.cv_results or [{"params": {}, "mean_score": t.best_score}]:
            params = ", ".join(f"{k}={v}" for k, v in point["params"].items())
            rows.append((name, params, float(point["mean_score"]), point["params"] == t.best_params))
    return spark.createDataFrame(rows, "model string, params string, mean_score double, is_best boolean")


@query("train_classifiers")
def train_classifiers(spark, sf):
    return _results(spark, ml.train_classifiers(model_frame(spark, sf), COLUMNS, models_config=SMALL_CLASSIFIERS))


@query("train_regressors")
def train_regressors(spark, sf):
    return _results(spark, ml.train_regressors(model_frame(spark, sf), COLUMNS, models_config=SMALL_REGRESSORS))


# Four features whose SQL is short, for models that SQL can solve.
RIDGE_COLUMNS = ["momentum_5", "momentum_10", "price_ma_5_ratio", "price_ma_20_ratio"]


def _ridge(spark, sf):
    frame = moving_averages(price_changes(add_targets(with_returns(bars(spark, sf)))))
    return ml.train_regressors(frame, RIDGE_COLUMNS, models_config={"ridge": ml.REGRESSORS["ridge"]})["ridge"]


def _ridge_rows(label: str = f"lead(ret) OVER ({SERIES})") -> str:
    ratios = ", ".join(f"coalesce(close / {sql_full('avg', 'close', w)}, 0) AS x{i}" for i, w in ((2, 5), (3, 20)))
    return f"""f AS (SELECT * FROM (SELECT ticker, date, coalesce({sql_change('close', 5)}, 0) AS x0, coalesce({sql_change('close', 10)}, 0) AS x1, {ratios},
        {label} AS y FROM rbars) t WHERE y IS NOT NULL)"""


# Rows with the fold they are tested in: five expanding folds on shared dates, or the last rows of each ticker as fold 0.
_BY_DATE = """d AS (SELECT date, (row_number() OVER (ORDER BY date) - 1 - (n - 5 * (n // 6))) AS o, n // 6 AS size FROM (SELECT date, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM f) x) y),
      g AS (SELECT f.*, CASE WHEN o >= 0 THEN o // size ELSE -1 END AS fold FROM f JOIN d USING (date))"""
_HOLDOUT = f"""g AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= greatest(1, least({HELD_ROWS}, count(*) OVER (PARTITION BY ticker) - 1)) THEN 0 ELSE -1 END AS fold FROM f)"""
_FITTED = "my + " + " + ".join(f"b[{i + 1}] * (x{i} - m{i}) / s{i}" for i in range(len(RIDGE_COLUMNS)))


def _ridge_sql(rows: str, alphas: str, folds: str, last: str) -> str:
    """Normal equations of standardised features for each (alpha, fold), by Gauss-Jordan steps over the augmented matrix."""
    p = len(RIDGE_COLUMNS)
    moments = ", ".join([*[f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}, covar_pop(x{i}, y) AS c{i}" for i in range(p)], *[f"corr(x{i}, x{j}) AS r{i}{j}" for i in range(p) for j in range(i)]])
    cell = lambda i, j: "1 + alpha / n" if i == j else f"r{max(i, j)}{min(i, j)}"
    matrix = ", ".join("[" + ", ".join([*[cell(i, j) for j in range(p)], f"c{i} / s{i}"]) + "]" for i in range(p))
    row = "list_transform(list_zip(m[i], m[k]), lambda a: a[1] - a[2] * m[i][k] / m[k][k])"
    own = "list_transform(m[k], lambda a: a / m[k][k])"
    return f"""WITH RECURSIVE {BARS}, {RBARS}, {_ridge_rows()}, {rows},
      t AS (SELECT k.fold AS k, count(*) AS n, avg(y) AS my, {moments} FROM g JOIN (VALUES {folds}) k(fold) ON g.fold < k.fold GROUP BY 1),
      e(k, alpha, i, m) AS (SELECT k, alpha, 0, [{matrix}] FROM t, (VALUES {alphas}) a(alpha) UNION ALL
        SELECT z, alpha, k, list_transform([{', '.join(str(i + 1) for i in range(p))}], lambda i: CASE WHEN i = k THEN {own} ELSE {row} END)
        FROM (SELECT k AS z, alpha, i + 1 AS k, m FROM e WHERE i < {p}) s),
      s AS (SELECT k, alpha, list_transform(m, lambda a: a[{p + 1}]) AS b FROM e WHERE i = {p}),
      {last}"""


_ALPHAS = "(0.1), (1.0), (5.0)"
_ERRORS = f"q AS (SELECT CAST(s.alpha AS DOUBLE) AS alpha, CAST(s.k AS INTEGER) AS fold, -avg((y - ({_FITTED})) * (y - ({_FITTED}))) AS neg_mse FROM s JOIN t ON t.k = s.k JOIN g ON g.fold = s.k GROUP BY 1, 2)"
_BEST = "best AS (SELECT alpha FROM (SELECT alpha, avg(neg_mse) AS v FROM q GROUP BY 1) x ORDER BY v DESC LIMIT 1)"
_WEIGHTS = f"""SELECT unnest([{', '.join(repr(c) for c in RIDGE_COLUMNS)}]) AS feature, round(unnest([{', '.join(f'b[{i + 1}] / s{i}' for i in range(4))}]), 12) + 0.0 AS weight
    FROM s JOIN t USING (k) WHERE k = 5 AND CAST(s.alpha AS DOUBLE) = (SELECT alpha FROM best)"""
_RIDGE_MODEL = _ridge_sql(_BY_DATE, _ALPHAS, "(0), (1), (2), (3), (4), (5)", f"{_ERRORS}, {_BEST} {_WEIGHTS}")


@query("ridge_grid", _ridge_sql(_BY_DATE, _ALPHAS, "(0), (1), (2), (3), (4)", f"{_ERRORS} SELECT alpha, fold, round(neg_mse, 13) + 0.0 AS neg_mse FROM q"))
def ridge_grid(spark, sf):
    """Every alpha in every fold."""
    rows = [(p["params"]["alpha"], fold, v) for p in _ridge(spark, sf).cv_results for fold, v in enumerate(p["fold_scores"])]
    return rounded(spark.createDataFrame(rows, "alpha double, fold int, neg_mse double"), 13)


def _weights(spark, model, names):
    scaler, linear = model.stages
    weights = [(c, float(b) / float(s) if s else 0.0) for c, b, s in zip(names, linear.coefficients, scaler.std)]
    return rounded(spark.createDataFrame(weights, "feature string, weight double"), 12)


@query("ridge_model", _RIDGE_MODEL)
def ridge_model(spark, sf):
    """Weights of the best ridge model, refitted on all rows, in the features' own units."""
    return _weights(spark, _ridge(spark, sf).model, RIDGE_COLUMNS)


@query("ridge_saved", _RIDGE_MODEL)
def ridge_saved(spark, sf):
    """The same model and its feature names from where they were saved; a path without a model is passed over."""
    folder = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    (path,) = st.save_results({"ridge": _ridge(spark, sf)}, folder, "reg", RIDGE_COLUMNS)
    found, model = st.load_first_model([f"{folder}/reg_none", path])
    return _weights(spark, model, st.load_feature_names(found))


def _held(spark, sf, *alphas):
    """The frame, its rows before the holdout answered for by one ridge model an alpha."""
    frame = moving_averages(price_changes(add_targets(with_returns(bars(spark, sf)))))
    label = "target_return_1d"
    split = settle(holdout(frame.filter(F.col(label).isNotNull()), HELD_ROWS))
    return frame, split, [ml.fit_rows(split.filter("not is_holdout"), RIDGE_COLUMNS, label, ml.REGRESSORS["ridge"], {"alpha": a}) for a in alphas]


@query(
    "ridge_eval",
    _ridge_sql(
        _HOLDOUT, "(1.0)", "(0)",
        f"""q AS (SELECT ticker, y, {_FITTED} AS p FROM s JOIN t USING (k) JOIN g ON g.fold = s.k)
        SELECT ticker, count(*) AS n, round(avg((y - p) * (y - p)), 13) + 0.0 AS mse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 9) + 0.0 AS r2 FROM q GROUP BY 1""",
    ),
)
def ridge_eval(spark, sf):
    """Errors on the holdout of a model of the rows before it."""
    frame, _, (model,) = _held(spark, sf, 1.0)
    m = pl.evaluate_regressor(model, frame, RIDGE_COLUMNS, rows=HELD_ROWS)["metrics"]
    return m.select("ticker", "n", (F.round("mse", 13) + 0.0).alias("mse"), (F.round("r2", 9) + 0.0).alias("r2"))


@query(
    "ridge_vote",
    _ridge_sql(
        _HOLDOUT, "(0.1), (50.0)", "(0)",
        f"SELECT ticker, date, round(avg({_FITTED}), 12) + 0.0 AS vote FROM s JOIN t USING (k) JOIN g ON g.fold = s.k GROUP BY 1, 2",
    ).replace("WHERE i = 4),\n      SELECT", "WHERE i = 4) SELECT"),
)
def ridge_vote(spark, sf):
    """The mean of two regressors on rows that neither has seen."""
    _, split, models = _held(spark, sf, 0.1, 50.0)
    data = ml.assemble(split.filter("is_holdout"), RIDGE_COLUMNS, "target_return_1d")
    return pick(ml.vote_regressors(data, models), "ticker, date", "vote", 12)


def _newton_sql(c: float, rounds: int = 8) -> str:
    """Penalised logistic weights of standardised features: rounds of solving for the step, each by Gauss-Jordan."""
    p = len(RIDGE_COLUMNS) + 1
    z = ["1"] + [f"z{i}" for i in range(p - 1)]
    scaled = ", ".join(f"(x{i} - avg(x{i}) OVER ()) / stddev_pop(x{i}) OVER () AS z{i}" for i in range(p - 1))
    score = " + ".join(f"b[{i + 1}] * {v}" for i, v in enumerate(z))
    out = f"""WITH {BARS}, {RBARS}, {_ridge_rows('CASE WHEN lead(ret) OVER (' + SERIES + ') > 0 THEN 1 ELSE 0 END')}, {_HOLDOUT},
      z AS MATERIALIZED (SELECT y, count(*) OVER () AS n, {scaled} FROM g WHERE fold < 0), b0 AS (SELECT [{', '.join('0.0::DOUBLE' for _ in z)}] AS b)"""
    for r in range(rounds):
        ridge = lambda i, j: f" + 1 / ({c} * any_value(n))" if i == j and i else ""
        rows = []
        for i, a in enumerate(z):
            cells = [f"avg(w * {a} * {v}){ridge(i, j)}" for j, v in enumerate(z)]
            rows.append("[" + ", ".join([*cells, f"avg((q - y) * {a})" + (f" + any_value(b)[{i + 1}] / ({c} * any_value(n))" if i else "")]) + "]")
        out += f""", m{r}_0 AS MATERIALIZED (SELECT [{', '.join(rows)}] AS m FROM (SELECT *, q * (1 - q) AS w FROM (SELECT z.*, b, 1 / (1 + exp(-({score}))) AS q FROM z, b{r}) s) t)"""
        for k in range(1, p + 1):
            cells = ", ".join(
                f"list_transform(m[{k}], lambda a: a / m[{k}][{k}])" if i == k else f"list_transform(list_zip(m[{i}], m[{k}]), lambda a: a[1] - a[2] * m[{i}][{k}] / m[{k}][{k}])" for i in range(1, p + 1)
            )
            out += f", m{r}_{k} AS MATERIALIZED (SELECT [{cells}] AS m FROM m{r}_{k - 1})"
        out += f", b{r + 1} AS MATERIALIZED (SELECT list_transform(list_zip(b, list_transform(m, lambda a: a[{p + 1}])), lambda a: a[1] - a[2]) AS b FROM b{r}, m{r}_{p})"
    names = ", ".join(repr(n) for n in ["intercept", *RIDGE_COLUMNS])
    return out + f" SELECT unnest([{names}]) AS feature, round(unnest(b), 4) + 0.0 AS weight FROM b{rounds}"


@query("logreg_model", _newton_sql(1.0))
def logreg_model(spark, sf):
    """Logistic weights of features scaled by their deviation, from the rows before the holdout."""
    frame = moving_averages(price_changes(add_targets(with_returns(bars(spark, sf)))))
    seen = settle(holdout(frame, HELD_ROWS).filter("not is_holdout"))
    scaler, logistic = ml.fit_rows(seen, RIDGE_COLUMNS, "target_dir_1d", LOGREG, {"C": 1.0}).stages
    n = seen.count()
    by_n = float(n / (n - 1)) ** 0.5  # the scaler divides by the deviation of n - 1
    weights = [("intercept", float(logistic.intercept)), *((c, float(b) / by_n) for c, b in zip(RIDGE_COLUMNS, logistic.coefficients))]
    return rounded(spark.createDataFrame(weights, "feature string, weight double"), 4)


def _fit(spark, sf, spec=FOREST, params=FOREST_POINT, label="target_dir_1d"):
    """The frame, and a model of the rows before each ticker's holdout."""
    frame = model_frame(spark, sf)
    seen = holdout(frame.filter(F.col(label).isNotNull()), HELD_ROWS).filter("not is_holdout")
    return frame, ml.fit_rows(seen, COLUMNS, label, spec, params)


@query("vote")
def vote(spark, sf):
    """Soft vote of two classifiers on the holdout, whose rows neither has seen."""
    frame, forest = _fit(spark, sf)
    split = holdout(frame, HELD_ROWS)
    logreg = ml.fit_rows(split.filter("not is_holdout"), COLUMNS, "target_dir_1d", LOGREG, {"C": 1.0})
    data = ml.assemble(split.filter("is_holdout"), COLUMNS, "target_dir_1d")
    return ml.vote_classifiers(data, [forest, logreg]).select("ticker", "date", "prob_up", "vote")


@query("predict_requests")
def predict_requests(spark, sf):
    """Requests for the days and flags of all orders, answered by a model of the rows before the holdout."""
    frame, model = _fit(spark, sf)
    ordered = table(spark, sf, "orders", "o_orderkey", "o_orderdate").withColumnRenamed("o_orderkey", "l_orderkey")
    sold = table(spark, sf, "lineitem", "l_orderkey", "l_returnflag").join(ordered, "l_orderkey")
    requests = sold.select(F.col("l_returnflag").alias("ticker"), F.to_date("o_orderdate").alias("target_date")).distinct()
    return pl.score_requests(frame, requests, model, COLUMNS)


@query("feature_importance")
def feature_importance(spark, sf):
    frame, model = _fit(spark, sf)
    return top_importances(ml.feature_importances(model, COLUMNS, frame))


@query("out_of_fold_backtest")
def out_of_fold_backtest(spark, sf):
    """Backtest on probabilities of models that saw earlier bars only."""
    scored = ml.out_of_fold(model_frame(spark, sf), COLUMNS, "target_dir_1d", LOGREG, {"C": 1.0})
    return backtest_metrics(run_backtest(scored.select("ticker", "date", "return", "prob_up"), threshold=0.5))


def _long(tables):
    """Evaluation tables below one another: table, ticker, the other columns as a JSON object."""
    rows = None
    for name, t in tables.items():
        ticker = F.col("ticker") if "ticker" in t.columns else F.lit(None).cast("string")
        values = F.to_json(F.struct(*[c for c in t.columns if c != "ticker"]))
        part = t.select(F.lit(name).alias("table"), ticker.alias("ticker"), values.alias("values"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("eval_classifier")
def eval_classifier(spark, sf):
    """All tables on the holdout, by a model of the rows before it."""
    frame, model = _fit(spark, sf)
    tables = pl.evaluate_classifier(model, frame, COLUMNS, rows=HELD_ROWS)
    keep = ["ticker", "date", "label", "prediction", "rolling_accuracy"]
    return _long(tables | {"rolling_accuracy": tables["rolling_accuracy"].select(*keep)})


@query("eval_regressor")
def eval_regressor(spark, sf):
    frame, model = _fit(spark, sf, ml.REGRESSORS["ridge"], {"alpha": 1.0}, "target_return_1d")
    tables = pl.evaluate_regressor(model, frame, COLUMNS, rows=HELD_ROWS)
    return _long(tables | {"residuals": tables["residuals"].select("ticker", "date", "label", "prediction", "residual")})


@query(
    "backtest_full",
    sql_rounded(
        ctes(BARS, PREDS, BACKTEST),
        """SELECT ticker, date, equity, drawdown, buy_hold, max(total) OVER (PARTITION BY ticker) AS total_return FROM (
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1 THEN equity - 1 END AS total FROM curves) c""",
        "ticker, date", "equity, drawdown, buy_hold, total_return", 8,
    ),
)
def backtest_full(spark, sf):
    curves, metrics = pl.full_backtest(preds(spark, sf))
    out = curves.join(metrics.select("ticker", "total_return"), "ticker")
    return pick(out, "ticker, date", "equity, drawdown, buy_hold, total_return", 8)


_HELD = "held AS (SELECT * FROM preds QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 250)"
_SCORES = """sc AS (SELECT ticker, count(*) AS holdout_rows, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0 END) AS accuracy,
    2 * count(*) FILTER (label = 1 AND prediction = 1) / (count(*) FILTER (prediction = 1) + count(*) FILTER (label = 1)) AS f1,
    count(*) FILTER (label = 0 AND prediction = 1) AS false_up, count(*) FILTER (label = 0) AS support_0 FROM held GROUP BY 1)"""


@query(
    "metrics_payload",
    sql_rounded(
        ctes(BARS, PREDS, BACKTEST, _HELD, _SCORES, f"au AS ({_auc_sql('ticker').replace('FROM preds', 'FROM held')})"),
        """SELECT sc.*, 1 AS feature_count, auc, t.total_return FROM sc JOIN au USING (ticker) JOIN (
        SELECT ticker, arg_max(equity, date) FILTER (equity IS NOT NULL) - 1 AS total_return FROM curves GROUP BY 1) t USING (ticker)""",
        "ticker, holdout_rows, feature_count, false_up, support_0", "accuracy, f1, auc, total_return", 8,
    ),
)
def metrics_payload(spark, sf):
    scored = holdout(preds(spark, sf), 250).filter("is_holdout")
    payload = pl.metrics_payload(scored, backtest_metrics(run_backtest(preds(spark, sf))), feature_count=1)
    e = F.col("eval_holdout")
    flat = payload.select(
        "ticker", "holdout_rows", "feature_count", e["confusion_matrix"][1]["n"].alias("false_up"),
        e["report"][0]["support"].alias("support_0"), e["accuracy"].alias("accuracy"), e["f1"].alias("f1"), e["auc"].alias("auc"),
        F.col("backtest.total_return").alias("total_return"),
    )
    return rounded(flat, 8)


def _article_bars(spark, sf):
    """Daily bars of the languages' articles, so that news and bars share tickers and days."""
    n = news(spark, sf)
    day = F.to_date("published").alias("date")
    price = F.avg(F.length("text")).alias("close")
    b = n.groupBy("ticker", day).agg(price, F.max(F.length("text")).cast("double").alias("high"), F.min(F.length("text")).cast("double").alias("low"), F.count(F.lit(1)).cast("double").alias("volume"))
    return with_returns(b.withColumn("open", F.col("close")))


_STUB_SENT = "CASE length(text) % 3 WHEN 0 THEN -0.7 WHEN 1 THEN 0.0 ELSE 0.7 END::DOUBLE"
_NDAYS = f"""sent AS (SELECT ticker, {_STUB_SENT} AS sent_score, CASE WHEN isodow(lts) = 6 THEN CAST(lts AS DATE) + 2 WHEN isodow(lts) = 7 THEN CAST(lts AS DATE) + 1
    WHEN CAST(lts AS TIME) > TIME '16:00:00' THEN CAST(lts AS DATE) + CASE WHEN isodow(lts) = 5 THEN 3 ELSE 1 END
    ELSE CAST(lts AS DATE) END AS trading_date FROM (SELECT ticker, text, timezone('America/New_York', timezone('UTC', published)) AS lts FROM news) n),
  nbars AS (SELECT ticker, CAST(published AS DATE) AS date FROM news GROUP BY 1, 2)"""


@query(
    "end_to_end_sentiment",
    sql_rounded(
        ctes(NEWS, _NDAYS, DAILY),
        """SELECT b.ticker, b.date, coalesce(daily_mean_sentiment, 0) AS daily_mean_sentiment, coalesce(daily_count, 0) AS daily_count,
        coalesce(daily_pos_count, 0) AS daily_pos_count, coalesce(daily_neg_count, 0) AS daily_neg_count, coalesce(daily_neutral_count, 0) AS daily_neutral_count
        FROM nbars b LEFT JOIN daily d ON b.ticker = d.ticker AND b.date = d.trading_date""",
        "ticker, date, daily_count, daily_pos_count, daily_neg_count, daily_neutral_count", "daily_mean_sentiment", 8,
    ),
)
def end_to_end_sentiment(spark, sf):
    """The sentiment half of the pipeline, batch scorer included, against SQL."""
    out = pl.sentiment_bars(_article_bars(spark, sf), news(spark, sf), scorer_factory=length_scorer)
    return pick(out, "ticker, date, daily_count, daily_pos_count, daily_neg_count, daily_neutral_count", "daily_mean_sentiment", 8)


_ARTICLE_BARS = """nb AS (SELECT *, 0.02 * (close - lag(close) OVER w) / (close + lag(close) OVER w) AS ret FROM (
    SELECT ticker, CAST(published AS DATE) AS date, avg(length(text)) AS close FROM news GROUP BY 1, 2) b WINDOW w AS (PARTITION BY ticker ORDER BY date)),
  nm AS (SELECT b.ticker, b.date, b.close, b.ret, coalesce(daily_mean_sentiment, 0) AS daily_mean_sentiment, coalesce(daily_count, 0) AS daily_count,
    lead(b.ret) OVER (PARTITION BY b.ticker ORDER BY b.date) AS target_return_1d FROM nb b LEFT JOIN daily d ON b.ticker = d.ticker AND b.date = d.trading_date)"""
_E2E_NUM = "close, daily_mean_sentiment, sent_lag_1, sent_roll_3, ma_5, momentum_5, bb_upper, volatility_10, target_return_1d"


@query(
    "end_to_end",
    sql_rounded(
        ctes(NEWS, _NDAYS, DAILY, _ARTICLE_BARS, f"pc AS (SELECT *, {sql_change('close', 1)} AS pc FROM nm)"),
        f"""SELECT *, {sql_lag('daily_mean_sentiment', 1)} AS sent_lag_1, avg(daily_mean_sentiment) {over(3)} AS sent_roll_3,
        CAST(sum(daily_count) {over(7)} AS BIGINT) AS count_roll_7, {sql_full('avg', 'close', 5)} AS ma_5, {sql_change('close', 5)} AS momentum_5,
        {sql_full('avg', 'close', 20)} + 2 * {sql_full('stddev_samp', 'close', 20)} AS bb_upper, {sql_full('stddev_samp', 'pc', 10)} AS volatility_10,
        {sql_flag('target_return_1d > 0')} AS target_dir_1d FROM pc""",
        "ticker, date, count_roll_7, target_dir_1d", _E2E_NUM, 7,
    ),
)
def end_to_end(spark, sf):
    """Articles to trading days, batch scores, daily sentiment, join, targets, lags, indicators."""
    out = pl.feature_build(_article_bars(spark, sf), news(spark, sf), scorer_factory=length_scorer)
    return pick(out, "ticker, date, count_roll_7, target_dir_1d", _E2E_NUM, 7)


_LEX_SENT = """al AS (SELECT ticker, text, timezone('America/New_York', timezone('UTC', published)) AS lts FROM news),
  sent AS (SELECT ticker, score AS sent_score, lx.label, CASE WHEN isodow(lts) = 6 THEN CAST(lts AS DATE) + 2 WHEN isodow(lts) = 7 THEN CAST(lts AS DATE) + 1
    WHEN CAST(lts AS TIME) > TIME '16:00:00' THEN CAST(lts AS DATE) + CASE WHEN isodow(lts) = 5 THEN 3 ELSE 1 END
    ELSE CAST(lts AS DATE) END AS trading_date FROM al JOIN lx ON lx.text_hash = sha256(al.text))"""
_FF = "coalesce(last_value({0} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {0}"
_COMP_NUM = "daily_mean_sentiment, sentiment_score, daily_mean_sentiment_lag_3, momentum_5, price_change_5d, target_return_1d"


@query(
    "comprehensive_features",
    sql_rounded(
        ctes(
            NEWS, LEXICON, _TOKENS, _LEX_SENT, DAILY, _ARTICLE_BARS,
            f"""raw AS (SELECT ticker, date, daily_mean_sentiment, daily_mean_sentiment AS sentiment_score, {sql_lag('daily_mean_sentiment', 3)} AS daily_mean_sentiment_lag_3,
              {sql_full('sum', 'ret', 5)} AS momentum_5, {sql_change('close', 5)} AS price_change_5d, target_return_1d, CAST(sum(daily_count) {over(5)} AS BIGINT) AS daily_count_roll_5 FROM nm)""",
        ),
        f"""SELECT ticker, date, daily_mean_sentiment, sentiment_score, {sql_flag('sentiment_score > 0.1')} AS sentiment_positive, daily_count_roll_5, target_return_1d,
        CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, {_FF.format('daily_mean_sentiment_lag_3')}, {_FF.format('momentum_5')}, {_FF.format('price_change_5d')} FROM raw""",
        "ticker, date, sentiment_positive, daily_count_roll_5, day_of_week", _COMP_NUM, 7,
    ),
)
def comprehensive_features(spark, sf):
    """The full feature set over lexicon sentiment."""
    bars_ = _article_bars(spark, sf)
    out = pl.comprehensive_build(bars_, news(spark, sf), lexicon=lexicon(spark))
    return pick(out, "ticker, date, sentiment_positive, daily_count_roll_5, day_of_week", _COMP_NUM, 7)
