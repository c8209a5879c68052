"""Leak-free splits of a per-ticker series, and point lookups in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.operators.layout import KEY, number_rows

TRAIN_ONLY = -1


def expanding_folds(df: DataFrame, n_splits: int = 5, order: str = "date") -> DataFrame:
    """``fold``: the test block a row belongs to, -1 for rows that only ever train.

    Blocks are cut on the times that all tickers share: each has n // (n_splits + 1) of the n distinct
    values of ``order``, and the last ends with the last of them. Fold i tests block i and trains on
    every smaller fold number, so no training row of any ticker is later than a test row of any other.
    Too few times to split make every row train-only.
    """
    times = number_rows(df.select(order).distinct().withColumn(KEY, F.lit("")), order, total="_n", name="_rn")
    block = F.floor(F.col("_n") / (n_splits + 1))
    offset = F.col("_rn") - 1 - (F.col("_n") - block * n_splits)
    fold = F.when((block > 0) & (offset >= 0), F.floor(offset / block)).otherwise(TRAIN_ONLY)
    return df.join(times.select(order, fold.cast("int").alias("fold")), order).select(*df.columns, "fold")


def holdout(df: DataFrame, rows: int = 10, order: str = "date") -> DataFrame:
    """``is_holdout``: the last ``rows`` rows of each ticker, never all of them and never none."""
    numbered = number_rows(df, order, total="_n", name="_rn")
    size = F.greatest(F.lit(1), F.least(F.lit(rows), F.col("_n") - 1))
    return numbered.withColumn("is_holdout", F.col("_rn") > F.col("_n") - size).drop("_n", "_rn")


def lookup_with_fallback(rows: DataFrame, requests: DataFrame, order: str = "date") -> DataFrame:
    """For each (ticker, target_date) request the last row of that date, else the ticker's last row.

    One row per request: a day of many bars gives its last one, an unknown ticker a row of missing
    values. Both are aggregates (one row per key and map task is shuffled) and equi-joins; no ticker is
    ever ordered as a whole.
    """
    values = [c for c in rows.columns if c != KEY]
    row = F.struct(*values)
    last = rows.groupBy(KEY).agg(F.max_by(row, F.col(order)).alias("_last"))
    exact = rows.groupBy(KEY, F.to_date(order).alias("target_date")).agg(F.max_by(row, F.col(order)).alias("_hit"))
    found = requests.join(exact, [KEY, "target_date"], "left").join(last, KEY, "left")
    found = found.withColumns(
        {"_row": F.coalesce("_hit", "_last"), "is_exact": F.col("_hit").isNotNull()}
    )
    return found.select(*requests.columns, "is_exact", "_row.*")
