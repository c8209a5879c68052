"""Grouping helpers that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SALTS = 64
SMALL_ROWS = 200_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under ``order``, remaining ties broken by the whole row.

    An aggregate rather than a window: every map task reduces its copies to one row per key before
    the shuffle, so a group of copies costs one row per task however large it is.
    """
    rank = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*rank, *rest)).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[c if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns])


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key under ``order``, found in two rounds.

    Round one ranks inside (key, salt), so a hot key is shared by ``SALTS`` tasks; round two ranks
    the at most ``n * SALTS`` rows left per key, so ``n`` should be a few thousand at most. Any row of
    the true top n survives round one. The salt is a hash of the whole row: missing urls or titles
    do not gather rows.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)))
    for part in ([*keys, "_salt"], keys):
        salted = salted.withColumn("_rank", F.row_number().over(W.partitionBy(*part).orderBy(*order)))
        salted = salted.filter(F.col("_rank") <= n).drop("_rank")
    return salted.drop("_salt")


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint only after counting that the frame has at most ``max_rows`` rows.

    For stored dimension tables (calendar, lexicon): the count reads at most ``max_rows + 1`` rows. A
    larger table is returned unhinted and joins by shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def _octave_step(value: Column) -> Column:
    """A whole number that grows with the value: its power of two and 16 bits of what is left, sign first."""
    v = value.cast("double")
    size = F.abs(v)
    octave = F.floor(F.log2(size))
    step = (octave + 1100) * 131072 + F.floor(size / F.pow(F.lit(2.0), octave) * 65536)
    return F.when(v == 0, F.lit(0)).when(v > 0, step).otherwise(-step).cast("long")


def running_by_value(
    counts: DataFrame,
    keys: list[str],
    value: str,
    sums: list[str],
    low: float | None = None,
    high: float | None = None,
    previous: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """``{s}_before`` (sum over strictly smaller values of the key) and ``{s}_total`` for each s.

    ``counts`` has one row per (keys, value). Values are cut into steps that never reorder them - between
    ``low`` and ``high`` 65,536 of a fixed width for each unit, without them 65,536 for each power of two
    of the value's size, whatever its range - and the running sum is taken over step totals and then
    inside each step. No task sees a whole key. ``previous`` names a struct with
    the sums of the next smaller value. ``bounded`` says that a key's rows are bounded anyway (a daily
    series); then one window per key does.
    """
    if bounded:
        whole = W.partitionBy(*keys)
        ordered = whole.orderBy(value)
        smaller = ordered.rowsBetween(W.unboundedPreceding, -1)
        columns = {f"{s}_before": F.coalesce(F.sum(s).over(smaller), F.lit(0)) for s in sums}
        columns |= {f"{s}_total": F.sum(s).over(whole) for s in sums}
        if previous:
            columns[previous] = F.lag(F.struct(*sums), 1).over(ordered)
        return counts.withColumns(columns)
    if low is None or high is None:
        stepped = counts.withColumn("_step", _octave_step(F.col(value)))
    else:
        inside = F.greatest(F.lit(low), F.least(F.lit(high), F.col(value)))
        stepped = counts.withColumn("_step", F.floor(inside * 65536))
    group = F.struct(*sums)
    top = [F.max_by(group, value).alias("_top")] if previous else []
    steps = stepped.groupBy(*keys, "_step").agg(*[F.sum(s).alias(s) for s in sums], *top)
    by_key = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    ordered = by_key.orderBy("_step")
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    below = [F.lag("_top", 1).over(ordered).alias("_below")] if previous else []
    steps = steps.select(
        *keys,
        "_step",
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_steps") for s in sums],
        *[F.sum(s).over(by_key).alias(f"{s}_total") for s in sums],
        *below,
    )
    in_step = W.partitionBy(*keys, "_step").orderBy(value)
    so_far = in_step.rowsBetween(W.unboundedPreceding, -1)
    columns = {f"{s}_before": F.col(f"_{s}_steps") + F.coalesce(F.sum(s).over(so_far), F.lit(0)) for s in sums}
    if previous:
        columns[previous] = F.coalesce(F.lag(group, 1).over(in_step), F.col("_below"))
    out = stepped.join(steps, [*keys, "_step"]).withColumns(columns)
    return out.drop("_step", "_below", *[f"_{s}_steps" for s in sums])
