"""Rolling columns over a lane with pandas' min_periods rules."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.functions.numeric import as_col, finite, pd_div
from barlight.operators.layout import Lane, chained


def _full(lane: Lane, c: Column | str, rows: int, agg: Callable[[Column], Column]) -> Column:
    """Null until the frame holds ``rows`` present values."""
    c, frame = finite(c), lane.last(rows)
    return F.when(F.count(c).over(frame) == rows, agg(c).over(frame))


_STATS: dict[str, Callable[[Column], Column]] = {"n": F.count, "sum": F.sum, "std": F.stddev_samp}


def frame_stats(lane: Lane, c: str, rows: int, *stats: str) -> dict[str, Column]:
    """Scratch columns ``_{c}_{rows}_{stat}`` for :func:`full_mean` and :func:`full_std`.

    Spark evaluates every mention of a window aggregate anew; naming the few a frame needs keeps each
    to one evaluation however many indicators read it.
    """
    x, frame = finite(c), lane.last(rows)
    return {f"_{c}_{rows}_{s}": _STATS[s](x).over(frame) for s in ("n", *stats)}


def full_mean(c: str, rows: int) -> Column:
    return F.when(F.col(f"_{c}_{rows}_n") == rows, F.col(f"_{c}_{rows}_sum") / rows)


def full_std(c: str, rows: int) -> Column:
    return F.when(F.col(f"_{c}_{rows}_n") == rows, F.col(f"_{c}_{rows}_std"))


def roll_mean(lane: Lane, c: Column | str, rows: int, partial: bool = False) -> Column:
    return F.avg(finite(c)).over(lane.last(rows)) if partial else _full(lane, c, rows, F.avg)


def roll_sum(lane: Lane, c: Column | str, rows: int, partial: bool = False) -> Column:
    return F.sum(finite(c)).over(lane.last(rows)) if partial else _full(lane, c, rows, F.sum)


def roll_std(lane: Lane, c: Column | str, rows: int) -> Column:
    return _full(lane, c, rows, F.stddev_samp)


def change(lane: Lane, c: Column | str, rows: int) -> Column:
    """c over its value ``rows`` ago, minus one."""
    c = as_col(c)
    return pd_div(c, F.lag(c, rows).over(lane.window)) - 1


def decay_rows(span: float) -> int:
    """Rows after which an exponential weight is below double precision."""
    q = 1.0 - 2.0 / (span + 1.0)
    return 1 if q <= 0 else max(1, math.ceil(53 * math.log(2) / -math.log(q)))


LOG_RANGE = 1320.0  # natural logarithm of the largest ratio of two weights in one cell, with the double range to spare


def ewm_means(lane: Lane, means: dict[str, tuple[Column | str, float]]) -> Lane:
    """``name`` becomes the bias-adjusted exponentially weighted mean of (column, span); needs a block lane, no borrowed rows.

    With q = 1 - 2 / (span + 1), a row maps (numerator, denominator) to (q * numerator + x, q * denominator + 1), a missing x
    to q times both: an affine map, and so is any run of rows. Runs are cells of a block, short enough for weights q^-place in
    double range: inside, both are running sums. A cell's state is its mean and the logarithm of its denominator, which no
    gap underflows; cells are chained by composing their maps (see ``chained``: a cell is at least 36 / -ln q rows long, after
    which an older one is below double precision). A missing value repeats the mean before it, however far back that is.
    """
    if not lane.width:
        raise ValueError("an exponential mean needs a block lane")
    rates = {n: (math.log(1.0 / q) if (q := 1.0 - 2.0 / (span + 1.0)) > 0 else None) for n, (_, span) in means.items()}
    rows = min([lane.block_rows, *[int(LOG_RANGE / r) + 1 for r in rates.values() if r]])
    rows = -(-lane.block_rows // -(-lane.block_rows // rows))  # cells of near equal length
    place = lane.position - lane.back
    cell = F.when(lane.own, F.floor(place / rows))
    at = place - F.floor(place / rows) * rows - rows // 2
    is_end = lane.own & (place == F.least((F.floor(place / rows) + 1) * rows, F.lit(lane.block_rows)) - 1)
    so_far = W.partitionBy(*lane.part, "_cell").orderBy(*lane.order).rowsBetween(W.unboundedPreceding, 0)
    sums: dict[str, Column] = {}
    states: dict[str, Column] = {}
    for n, (column, _) in means.items():
        c, rate = as_col(column), rates[n]
        if rate is None:  # the last value itself
            sums |= {f"_num_{n}": F.last(c, ignorenulls=True).over(so_far), f"_den_{n}": F.lit(1.0)}
        else:
            weight = F.exp(F.lit(rate) * at)
            sums |= {f"_num_{n}": F.sum(c * weight).over(so_far), f"_den_{n}": F.sum(F.when(c.isNotNull(), weight)).over(so_far)}
        depth = F.log(F.col(f"_den_{n}")) - F.lit(rate or 0.0) * at
        mean = F.col(f"_num_{n}") / F.col(f"_den_{n}")
        states[f"_from_{n}"] = F.when(is_end & F.col(f"_num_{n}").isNotNull(), F.struct(mean.alias("mean"), depth.alias("depth"), lane.row.alias("row"), F.lit(rate or 0.0).alias("rate")))

    def join(before: Column, own: Column) -> Column:
        ratio = F.exp(before["depth"] - own["rate"] * (own["row"] - before["row"]) - own["depth"])
        ratio = F.when(own["rate"] > 0, ratio).otherwise(0.0)
        mean = (own["mean"] + ratio * before["mean"]) / (1.0 + ratio)
        return F.struct(mean.alias("mean"), (own["depth"] + F.log1p(ratio)).alias("depth"), own["row"].alias("row"), own["rate"].alias("rate"))

    lane = chained(lane.add({"_cell": cell}).add(sums), F.col("_cell"), states, join)
    out: dict[str, Column] = {}
    for n in means:
        before, num, den = F.col(f"_from_{n}"), F.col(f"_num_{n}"), F.col(f"_den_{n}")
        if rates[n] is None:
            out[n] = F.coalesce(num, before["mean"])
            continue
        share = F.exp(before["depth"] - F.lit(rates[n]) * (lane.row - before["row"]) + F.lit(rates[n]) * at)
        both = F.try_divide(F.coalesce(num, F.lit(0.0)) + before["mean"] * share, F.coalesce(den, F.lit(0.0)) + share)
        out[n] = F.when(before.isNull(), num / den).otherwise(F.coalesce(both, before["mean"]))
    return lane.add(out).without([*sums, *states])
