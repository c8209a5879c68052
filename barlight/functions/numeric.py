"""Division, comparison and missing-value rules that follow pandas under ANSI Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pd_div(n: Column | str, d: Column | str) -> Column:
    """Float division: x/0 is signed Infinity, 0/0 and anything missing is null."""
    n, d = as_col(n), as_col(d)
    return F.when(d == 0, F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))).otherwise(n / d)


def pd_log(c: Column | str) -> Column:
    """log with log(0) = -Infinity, log(+Infinity) kept and negatives missing."""
    c = as_col(c)
    return F.when(c == 0, F.lit(-INF)).when(c > 0, F.log(c))


def flag(condition: Column) -> Column:
    """0/1 integer; a comparison with a missing value is 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def finite(c: Column | str) -> Column:
    """Infinity inside a rolling frame counts as missing."""
    c = as_col(c)
    return F.when((F.abs(c) < INF), c)


def infinite_to_zero(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(F.abs(c) == INF, F.lit(0.0)).otherwise(c)


def ratio_or_zero(n: Column | str, d: Column | str) -> Column:
    return F.coalesce(F.try_divide(as_col(n), as_col(d)), F.lit(0.0))


def clip01(c: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), as_col(c)))


def signal(prob: Column | str, threshold: float = 0.5) -> Column:
    return flag(as_col(prob) > threshold)
