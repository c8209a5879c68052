"""How a time series is spread over tasks.

Every windowed operator asks :func:`lay_out` for a *lane*: the frame, and the window partition
its frames run in. The order column's type decides.

* ``date`` column - one row per ticker and calendar day, so a ticker's window partition is bounded
  by the calendar (about 25,000 sessions a century) however large the job is. The lane is the plain
  ticker window: one shuffle, shared by every operator in the chain.
* ``timestamp`` column (intraday bars) - a ticker may hold any share of all rows, so rows are
  numbered in two steps (per day, then over day counts) and cut into blocks of ``block_rows`` rows.
  Each block carries the ``back`` rows before it and the ``ahead`` rows after it, which makes
  bounded frames exact; the borrowed rows are dropped again by :meth:`Lane.finish`.

Running (unbounded) aggregates use :func:`running`, a two-level scan: inside a day, then over
day totals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from barlight.session import settle

KEY = "ticker"
BLOCK_ROWS = 4096

_ROW, _DAY, _BLOCK, _OWN, _POS, _CELL = "_row", "_day", "_block", "_own", "_pos", "_cell"


class Lane(NamedTuple):
    df: DataFrame
    part: list[str]
    order: list[str]
    width: int = 0  # rows a block can span, 0 when the lane is the whole series
    back: int = 0  # borrowed rows before a block's own
    block_rows: int = 0
    calendar: bool = True  # whether a ticker's series is short enough for one window

    @property
    def window(self) -> WindowSpec:
        return W.partitionBy(*self.part).orderBy(*self.order)

    def last(self, rows: int) -> WindowSpec:
        return self.window.rowsBetween(-(rows - 1), 0)

    @property
    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(W.unboundedPreceding, 0)

    @property
    def position(self) -> Column:
        return F.col(_POS)

    @property
    def row(self) -> Column:
        return F.col(_ROW)

    @property
    def own(self) -> Column:
        return F.col(_OWN)

    def add(self, columns: dict[str, Column]) -> "Lane":
        return self._replace(df=self.df.withColumns(columns)) if columns else self

    def without(self, columns: Iterable[str]) -> "Lane":
        return self._replace(df=self.df.drop(*columns))

    def finish(self, *scratch: str) -> DataFrame:
        df = self.df.filter(F.col(_OWN)) if self.width else self.df
        return df.drop(*scratch, _ROW, _BLOCK, _OWN, _POS)


def is_intraday(df: DataFrame, order: str) -> bool:
    return isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType))


def number_rows(df: DataFrame, order: str = "date", total: str | None = None, name: str = _ROW) -> DataFrame:
    """1-based position of each row in its ticker's series, optionally with the series length."""
    if not is_intraday(df, order):
        w = W.partitionBy(KEY)
        columns = {name: F.row_number().over(w.orderBy(order)).cast("long")}
        if total:
            columns[total] = F.count(F.lit(1)).over(w)
        return df.withColumns(columns)
    df = settle(df.withColumn(_DAY, F.to_date(order)))
    days = df.groupBy(KEY, _DAY).agg(F.count(F.lit(1)).alias("_n"))
    by_day = W.partitionBy(KEY).orderBy(_DAY)
    before = F.sum("_n").over(by_day.rowsBetween(W.unboundedPreceding, -1))
    days = days.select(
        KEY, _DAY, F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(W.partitionBy(KEY)).alias("_all")
    )
    in_day = W.partitionBy(KEY, _DAY).orderBy(order)
    out = df.join(days, [KEY, _DAY]).withColumn(name, F.col("_before") + F.row_number().over(in_day))
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop(_DAY, "_before", "_all")


def lay_out(
    df: DataFrame, back: int = 0, ahead: int = 0, order: str = "date", blocks: bool = False, block_rows: int = BLOCK_ROWS
) -> Lane:
    """``back``/``ahead`` are the furthest rows any frame in the chain reaches."""
    if not blocks and not is_intraday(df, order):
        return Lane(df, [KEY], [order])
    rows = number_rows(df, order)
    r = F.col(_ROW) - 1
    home = F.floor(r / block_rows)
    first = F.greatest(F.lit(0), F.floor((r - ahead) / block_rows))
    last = F.floor((r + back) / block_rows)
    spread = rows.withColumn(_BLOCK, F.explode(F.sequence(first, last)))
    spread = spread.withColumns({_OWN: F.col(_BLOCK) == home, _POS: r - F.col(_BLOCK) * block_rows + back})
    return Lane(spread, [KEY, _BLOCK], [_ROW], back + block_rows + ahead, back, block_rows, not is_intraday(df, order))


def chained(lane: Lane, cell: Column, states: dict[str, Column], join: Callable[[Column, Column], Column]) -> Lane:
    """What each cell of a block starts from: ``name`` becomes the state at the end of the cells before it in the series.

    A cell is a run of a block's own rows (``cell`` numbers it, null on borrowed rows). ``states[name]`` is a cell's own state, a
    struct at its last row or null; ``join(before, own)`` is the state after both. A cell starts from the last cell
    that has a state, joined with the one before that, so states must fade within a cell: what is older may not matter.

    Within a calendar this is a window over the ticker. Intraday, one row a cell is chained and joined back; the lane is
    stored for that, since both read it.
    """
    own = {f"_own_{n}": c for n, c in states.items()}
    lane = lane.add({_CELL: cell}).add(own)

    def chain(df: DataFrame, order: list[str]) -> DataFrame:
        before = W.partitionBy(KEY).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        last = lambda c: F.last(c, ignorenulls=True).over(before)
        df = df.withColumns({f"_prev_{n}": last(o) for n, o in zip(states, own)})
        joined = {o: F.when(F.col(o).isNotNull() & F.col(f"_prev_{n}").isNotNull(), join(F.col(f"_prev_{n}"), F.col(o))).otherwise(F.col(o)) for n, o in zip(states, own)}
        return df.withColumns(joined).withColumns({n: last(o) for n, o in zip(states, own)}).drop(*own, *[f"_prev_{n}" for n in states])

    if lane.calendar:
        return lane._replace(df=chain(lane.df, [_BLOCK, _ROW]).drop(_CELL))
    df = settle(lane.df)
    key = [KEY, _BLOCK, _CELL]
    cells = df.filter(F.col(_CELL).isNotNull()).groupBy(*key).agg(*[F.max(o).alias(o) for o in own])
    return lane._replace(df=df.drop(*own).join(chain(cells, [_BLOCK, _CELL]), key, "left").drop(_CELL))


# A running aggregate: how rows of a day fold, and how the fold of earlier days joins in.
_FOLDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "product": (F.product, lambda before, inside: F.coalesce(before, F.lit(1.0)) * F.coalesce(inside, F.lit(1.0))),
    "max": (F.max, lambda before, inside: F.greatest(before, inside)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda before, inside: F.coalesce(inside, before)),
}


def running(df: DataFrame, specs: dict[str, tuple[str, Column | str]], order: str = "date", again: bool = False) -> DataFrame:
    """Running aggregates from the series start: ``{output: (fold, input)}``, fold in product, max, last.

    An intraday frame is read twice, so it is stored first; ``again`` says that it comes straight from a
    stored one and is cheaper to work out twice than to write.
    """
    exprs = {out: (fold, F.col(c) if isinstance(c, str) else c) for out, (fold, c) in specs.items()}
    start = W.unboundedPreceding
    if not is_intraday(df, order):
        w = W.partitionBy(KEY).orderBy(order).rowsBetween(start, 0)
        return df.withColumns({out: _FOLDS[fold][0](c).over(w) for out, (fold, c) in exprs.items()})
    inputs = {f"_in_{out}": c for out, (_, c) in exprs.items()}
    df = df.withColumns({_DAY: F.to_date(order), **inputs})
    df = df if again else settle(df)

    def fold_day(out: str, fold: str) -> Column:
        c = F.col(f"_in_{out}")
        if fold == "last":  # order-free form, so it combines before the shuffle
            return F.max_by(c, F.when(c.isNotNull(), F.col(order)))
        return _FOLDS[fold][0](c)

    days = df.groupBy(KEY, _DAY).agg(*[fold_day(out, fold).alias(f"_d_{out}") for out, (fold, _) in exprs.items()])
    earlier = W.partitionBy(KEY).orderBy(_DAY).rowsBetween(start, -1)
    days = days.select(
        KEY, _DAY, *[_FOLDS[fold][0](F.col(f"_d_{out}")).over(earlier).alias(f"_b_{out}") for out, (fold, _) in exprs.items()]
    )
    in_day = W.partitionBy(KEY, _DAY).orderBy(order).rowsBetween(start, 0)
    rows = df.join(days, [KEY, _DAY])
    rows = rows.withColumns({f"_w_{out}": _FOLDS[fold][0](F.col(f"_in_{out}")).over(in_day) for out, (fold, _) in exprs.items()})
    rows = rows.withColumns(
        {out: _FOLDS[fold][1](F.col(f"_b_{out}"), F.col(f"_w_{out}")) for out, (fold, _) in exprs.items()}
    )
    scratch = [f"{p}{out}" for out in exprs for p in ("_in_", "_b_", "_w_")]
    return rows.drop(_DAY, *scratch)


def fill_forward(df: DataFrame, columns: list[str], order: str = "date") -> DataFrame:
    return running(df, {c: ("last", c) for c in columns}, order)
