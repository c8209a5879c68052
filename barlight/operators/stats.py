"""Correlation, cross-correlation, linear fit and Granger causality per ticker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from barlight.functions.tails import chi2_tail, correlation_p, f_tail
from barlight.operators.layout import KEY, is_intraday, lay_out
from barlight.operators.skew import running_by_value

CORRELATION_COLUMNS = ["adj_close", "daily_mean_sentiment", "daily_count", "return", "target_return_1d"]


@F.pandas_udf(T.DoubleType())
def correlation_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    p = correlation_p(r.astype(float).to_numpy(), n.astype(float).to_numpy())
    return pd.Series(p).where(~np.isnan(p), None)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form, all pairs in one aggregation pass."""
    columns = [c for c in (columns or CORRELATION_COLUMNS) if c in df.columns]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    per = df.groupBy(KEY).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a in columns:
        for b in columns:
            name = f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}"
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{name}`").alias("corr")))
    return per.select(KEY, F.inline(F.array(*cells)))


def average_ranks(df: DataFrame, keys: list[str], column: str, name: str, daily: bool = True) -> DataFrame:
    """Average rank of ``column`` inside its key, ties sharing their mean rank.

    A daily series is ranked by window (at most one row per calendar day in a task). Otherwise ranks
    come from counts per distinct value, taken over value steps, so that no task orders a whole key.
    """
    if daily:
        by_key = W.partitionBy(*keys)
        ties = F.count(F.lit(1)).over(W.partitionBy(*keys, column))
        return df.withColumn(name, F.rank().over(by_key.orderBy(column)) + (ties - 1) / 2.0)
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_by_value(counts, keys, column, ["_c"])
    ranked = ranked.select(*keys, column, (F.col("_c_before") + (F.col("_c") + 1) / 2.0).alias(name))
    return df.join(ranked, [*keys, column])


def sentiment_correlations(df: DataFrame, x: str = "daily_mean_sentiment", order: str = "date") -> DataFrame:
    """Pearson and Spearman with p-values of sentiment against the return and the next-bar return.

    Only rows with both values count; two or fewer give missing results. Both comparisons run as one
    long frame, so the input is read once.
    """
    keys = [KEY, "metric"]
    sides = [F.struct(F.lit(f"sentiment vs {y}").alias("metric"), F.col(y).alias("b")) for y in ("return", "target_return_1d")]
    pairs = df.select(KEY, F.col(x).alias("a"), F.inline(F.array(*sides)))
    pairs = pairs.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    daily = not is_intraday(df, order)
    for column in ("a", "b"):
        pairs = average_ranks(pairs, keys, column, f"_r{column}", daily)
    out = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.corr("a", "b").alias("pearson_r"), F.corr("_ra", "_rb").alias("spearman_rho")
    )
    enough = F.col("n") > 2
    out = out.withColumns({c: F.when(enough, F.col(c)) for c in ("pearson_r", "spearman_rho")})
    return out.select(
        *keys, "n", "pearson_r", correlation_p_value("pearson_r", "n").alias("pearson_p"),
        "spearman_rho", correlation_p_value("spearman_rho", "n").alias("spearman_p"),
    )


def linear_fit(df: DataFrame, x: str = "daily_mean_sentiment", y: str = "target_return_1d") -> DataFrame:
    """Least-squares line of y on x over complete rows."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(KEY).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"),
    )


def centred(df: DataFrame, *columns: str) -> DataFrame:
    """The columns less their mean over the ticker: sums of products keep their digits at any level of the series."""
    means = df.groupBy(KEY).agg(*[F.avg(c).alias(f"_mean{c}") for c in columns])
    out = df.join(means, KEY).withColumns({c: F.col(c) - F.col(f"_mean{c}") for c in columns})
    return out.drop(*[f"_mean{c}" for c in columns])


def cross_correlation(
    df: DataFrame, x: str = "daily_mean_sentiment", y: str = "return", max_lag: int = 10, order: str = "date"
) -> DataFrame:
    """Correlation of x[t + lag] with y[t] for lag -max_lag .. max_lag, missing values as 0.

    Shifted copies are lead columns of one window pass and all lags fold in one aggregation, with
    population deviations and the series length as divisor. Negative lags mean x leads y.
    """
    lags = range(-max_lag, max_lag + 1)
    zeroed = df.withColumns({"_x": F.coalesce(F.col(x), F.lit(0.0)), "_y": F.coalesce(F.col(y), F.lit(0.0))})
    lane = lay_out(centred(zeroed.select(KEY, order, "_x", "_y"), "_x", "_y"), back=max_lag, ahead=max_lag, order=order)
    shifted = lane.add({f"_x{k + max_lag}": F.lead("_x", k).over(lane.window) for k in lags}).finish()
    sums = []
    for k in lags:
        moved = F.col(f"_x{k + max_lag}")
        with_pair = F.when(moved.isNotNull(), F.col("_y"))
        sums.append(
            F.struct(
                F.lit(k).alias("lag"), F.sum(moved * F.col("_y")).alias("xy"), F.sum(moved).alias("sx"),
                F.sum(with_pair).alias("sy"), F.count(moved).alias("m"),
            )
        )
    per = shifted.groupBy(KEY).agg(
        F.avg("_x").alias("mx"), F.avg("_y").alias("my"), F.stddev_pop("_x").alias("sdx"),
        F.stddev_pop("_y").alias("sdy"), F.count(F.lit(1)).alias("n"), F.array(*sums).alias("lags"),
    )
    rows = per.select("*", F.inline("lags"))
    cov = F.col("xy") - F.col("my") * F.col("sx") - F.col("mx") * F.col("sy") + F.col("m") * F.col("mx") * F.col("my")
    scale = F.col("n") * F.col("sdx") * F.col("sdy")
    return rows.select(KEY, "lag", F.try_divide(cov, scale).alias("ccf"))


def best_lag(ccf: DataFrame) -> DataFrame:
    """Lag of the largest absolute correlation, the smallest lag on ties."""
    order = F.struct(F.abs("ccf"), -F.col("lag"))
    present = ccf.filter(F.col("ccf").isNotNull())
    return present.groupBy(KEY).agg(F.max_by(F.struct("lag", "ccf"), order).alias("b")).select(KEY, "b.lag", "b.ccf")


def granger(
    df: DataFrame, y: str = "return", x: str = "daily_mean_sentiment", max_lag: int = 5, order: str = "date"
) -> DataFrame:
    """Does x help predict y? F, chi-square and likelihood-ratio tests per ticker and lag.

    Lag columns come from one window pass and the normal-equation sums of every lag fold in one
    aggregation, which leaves one small row per ticker and lag. Only those rows reach numpy, where
    systems of at most 2 * max_lag + 1 unknowns are solved.
    """
    both = df.select(KEY, order, F.col(y).alias("_y"), F.col(x).alias("_x"))
    both = centred(both.filter(F.col("_y").isNotNull() & F.col("_x").isNotNull()), "_y", "_x")
    lane = lay_out(both, back=max_lag, order=order)
    names = ["_y"] + [f"_{v}{k}" for k in range(1, max_lag + 1) for v in ("y", "x")]
    cols = {f"_{v}{k}": F.lag(f"_{v}", k).over(lane.window) for k in range(1, max_lag + 1) for v in ("y", "x")}
    rows = lane.add(cols).finish()

    tables = []
    for lag in range(1, max_lag + 1):
        used = [F.lit(1.0), *[F.col(c) for c in names[: 2 * lag + 1]]]
        whole = F.col(f"_y{lag}").isNotNull()
        cells = [F.sum(F.when(whole, used[i] * used[j])) for i in range(len(used)) for j in range(i, len(used))]
        tables.append(F.struct(F.lit(lag).alias("lag"), F.count(F.when(whole, 1)).alias("n"), F.array(*cells).alias("cells")))
    per = rows.groupBy(KEY).agg(F.array(*tables).alias("tables")).select(KEY, F.inline("tables"))
    schema = "ticker string, lag int, n long, test string, statistic double, p_value double"
    return per.mapInPandas(_granger_tests, schema)


def _granger_tests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for ticker, lag, n, cells in zip(pdf[KEY], pdf["lag"], pdf["n"], pdf["cells"]):
            out.extend((ticker, lag, n, *t) for t in granger_tests(int(lag), int(n), cells))
        yield pd.DataFrame(out, columns=[KEY, "lag", "n", "test", "statistic", "p_value"])


def granger_tests(lag: int, n: int, cells) -> list[tuple[str, float | None, float | None]]:
    """Tests from the upper triangle of the moment matrix of (1, y, y1, x1, y2, x2, ...)."""
    names = ["ssr_ftest", "ssr_chi2test", "lrtest", "params_ftest"]
    size = 2 * lag + 2
    free = n - (2 * lag + 1)
    values = np.array([np.nan if c is None else c for c in cells], dtype=float)
    if free <= 0 or not np.isfinite(values).all():
        return [(t, None, None) for t in names]
    m = np.zeros((size, size))
    m[np.triu_indices(size)] = values
    m = m + np.triu(m, 1).T

    def ssr(terms: list[int]) -> float:
        a, b = m[np.ix_(terms, terms)], m[terms, 1]
        scale = 1.0 / np.sqrt(np.maximum(np.diag(a), 1e-300))
        beta = scale * np.linalg.lstsq(a * np.outer(scale, scale), b * scale, rcond=None)[0]
        return float(m[1, 1] - 2 * beta @ b + beta @ a @ beta)

    own = [0, *range(2, size, 2)]
    both = [0, *range(2, size)]
    restricted, full = ssr(own), ssr(both)
    if full <= 0:
        return [(t, None, None) for t in names]
    gain = max(restricted - full, 0.0)
    f = gain / lag / (full / free)
    chi2, lr = n * gain / full, n * np.log(restricted / full)
    p_f = float(f_tail(f, lag, free))
    return [
        (names[0], f, p_f),
        (names[1], chi2, float(chi2_tail(chi2, lag))),
        (names[2], float(lr), float(chi2_tail(lr, lag))),
        (names[3], f, p_f),
    ]

