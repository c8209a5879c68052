"""Model evaluation tables, one group per ticker (or any other key list).

Inputs carry ``label`` (0/1), ``prediction`` (0/1) and ``prob_up`` for classifiers, ``label`` and
``prediction`` as numbers for regressors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from barlight.functions.numeric import flag, ratio_or_zero
from barlight.operators.layout import KEY, lay_out
from barlight.operators.skew import running_by_value

KEYS = [KEY]
INF = float("inf")


def _cells() -> dict[str, Column]:
    y, p = F.col("label") == 1, F.col("prediction") == 1
    return {
        "tp": F.sum(flag(y & p)),
        "fp": F.sum(flag(~y & p)),
        "fn": F.sum(flag(y & ~p)),
        "tn": F.sum(flag(~y & ~p)),
    }


def _cell_counts(scored: DataFrame, keys: list[str]) -> DataFrame:
    return scored.groupBy(*keys).agg(*[c.cast("long").alias(n) for n, c in _cells().items()])


def confusion(scored: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Counts over the full 2x2 grid, zeros included."""
    grid = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    cells = [F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("n")) for y, p, n in grid]
    return _cell_counts(scored, keys).select(*keys, F.inline(F.array(*cells)))


def class_report(scored: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """precision, recall, f1 and support per class, accuracy, macro and weighted averages, as rows."""
    counts = _cell_counts(scored, keys)
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    sides = {"0": ("tn", "fn", "fp"), "1": ("tp", "fp", "fn")}
    for k, (hit, false, missed) in sides.items():
        h, f, m = F.col(hit), F.col(false), F.col(missed)
        counts = counts.withColumns(
            {
                f"p{k}": ratio_or_zero(h, h + f),
                f"r{k}": ratio_or_zero(h, h + m),
                f"f{k}": ratio_or_zero(h * 2, h * 2 + f + m),
                f"s{k}": h + m,
            }
        )
    total = F.col("s0") + F.col("s1")

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support"))

    def mean(m: str) -> Column:
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2.0

    def weighted(m: str) -> Column:
        return (F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1")) / total

    accuracy = ratio_or_zero(F.col("tp") + F.col("tn"), n)
    rows = [row(k, F.col(f"p{k}"), F.col(f"r{k}"), F.col(f"f{k}"), F.col(f"s{k}")) for k in sides]
    rows += [
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", mean("p"), mean("r"), mean("f"), total),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return counts.select(*keys, F.inline(F.array(*rows)))


def headline(scored: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Accuracy, precision, recall and F1 of the up class; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _cell_counts(scored, keys).select(
        *keys,
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def _by_probability(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Class counts per distinct probability: the only table the ranking metrics ever order.

    A row without a probability (missing or NaN) or label has no rank and takes no part.
    """
    prob = F.col("prob_up").cast("double")
    return scored.filter(prob.isNotNull() & ~F.isnan(prob)).groupBy(*keys, F.col("prob_up").cast("double").alias("prob")).agg(
        F.sum(flag(F.col("label") == 1)).cast("long").alias("pos"),
        F.sum(flag(F.col("label") == 0)).cast("long").alias("neg"),
    )


def _calendar_bounds(scored: DataFrame, keys: list[str], order: str) -> bool:
    """Per ticker over a daily column, a key has at most one row per calendar day."""
    return KEY in keys and order in scored.columns and isinstance(scored.schema[order].dataType, DateType)


def roc_auc(scored: DataFrame, keys: list[str] = KEYS, order: str = "date") -> DataFrame:
    """Exact rank-sum AUC with ties counted half; missing when a key has one class only."""
    bounded = _calendar_bounds(scored, keys, order)
    counts = _by_probability(scored, keys)
    ranked = running_by_value(counts, keys, "prob", ["pos", "neg"], 0.0, 1.0, bounded=bounded)
    won = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    totals = F.first("pos_total"), F.first("neg_total")
    return ranked.groupBy(*keys).agg(F.try_divide(F.sum(won), totals[0].cast("double") * totals[1]).alias("auc"))


def roc_curve(
    scored: DataFrame, keys: list[str] = KEYS, drop_intermediate: bool = True, order: str = "date"
) -> DataFrame:
    """(threshold, fpr, tpr) with the (0, 0) start at threshold Infinity.

    A point on a straight stretch between its neighbours is left out unless ``drop_intermediate`` is
    off: that is when the next lower probability adds the same class counts as this one.
    """
    counts = _by_probability(scored, keys)
    bounded = _calendar_bounds(scored, keys, order)
    points = running_by_value(counts, keys, "prob", ["pos", "neg"], 0.0, 1.0, previous="_lower", bounded=bounded)
    tp, fp = (F.col(f"{c}_total") - F.col(f"{c}_before") for c in ("pos", "neg"))
    is_first = (tp == F.col("pos")) & (fp == F.col("neg"))
    if drop_intermediate:
        repeats = (F.col("_lower.pos") == F.col("pos")) & (F.col("_lower.neg") == F.col("neg"))
        points = points.filter(is_first | ~F.coalesce(repeats, F.lit(False)))

    def point(threshold: Column, fpr: Column, tpr: Column) -> Column:
        return F.struct(threshold.alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))

    here = point(F.col("prob"), F.try_divide(fp, F.col("neg_total")), F.try_divide(tp, F.col("pos_total")))
    start = point(F.lit(INF), F.lit(0.0), F.lit(0.0))
    return points.select(*keys, F.inline(F.when(is_first, F.array(start, here)).otherwise(F.array(here))))


def rolling_accuracy(scored: DataFrame, rows: int = 20, order: str = "date") -> DataFrame:
    """Share of right directions over the last ``rows`` bars, from the first bar on."""
    lane = lay_out(scored, back=rows, order=order)
    right = flag(F.col("prediction") == F.col("label"))
    return lane.add({"rolling_accuracy": F.avg(right).over(lane.last(rows))}).finish()


def regression_metrics(scored: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """MSE and R2 in one pass; R2 needs two rows and a spread in the labels."""
    err = F.col("label") - F.col("prediction")
    per = scored.groupBy(*keys).agg(
        F.avg(err * err).alias("mse"), F.var_pop("label").alias("_var"), F.count(err).alias("n")
    )
    r2 = F.when((F.col("n") >= 2) & (F.col("_var") > 0), 1.0 - F.col("mse") / F.col("_var"))
    return per.select(*keys, "mse", r2.alias("r2"), "n")


def residuals(scored: DataFrame) -> DataFrame:
    return scored.withColumn("residual", F.col("label") - F.col("prediction"))


def top_importances(importances: DataFrame, n: int = 20) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature").limit(n)
