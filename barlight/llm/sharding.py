"""K-d tree sharding: weighted medians along the widest metadata dimension until each leaf holds its share of bytes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from barlight.llm.common import stored

SPAN_BITS, TIE_BITS = 32, 30
BLOCK_BITS = 16  # rows numbered by one window: 2 ** BLOCK_BITS at most


@dataclass
class _Node:
    """One box of the tree that holds ``leaves`` shards from ``first`` on; a cut box has a dimension, a cut and two halves."""

    key: int
    first: int
    leaves: int
    dim: str | None = None
    cut: int = 0
    low: "_Node | None" = None
    high: "_Node | None" = None


def _coordinates(rows: DataFrame, dims: list[str]) -> dict[str, Column]:
    """Every dimension as a 62-bit position: 32 bits of value, 30 bits of a row hash, so equal values can still be cut."""
    numeric = [d for d in dims if isinstance(rows.schema[d].dataType, T.NumericType)]
    ends = rows.agg(*[f(F.col(d).cast("double")).alias(f"{n}_{d}") for d in numeric for f, n in ((F.min, "lo"), (F.max, "hi"))]).first() if numeric else None
    tie = F.pmod(F.xxhash64("doc_id", "text_crc32", "uid"), F.lit(1 << TIE_BITS))
    out = {}
    for d in dims:
        if d in numeric:
            lo, hi = ends[f"lo_{d}"], ends[f"hi_{d}"]
            scale = ((1 << SPAN_BITS) - 1) / (hi - lo) if lo is not None and hi > lo else 0.0
            place = F.floor((F.col(d).cast("double") - F.lit(lo or 0.0)) * F.lit(scale))
        else:
            place = F.crc32(F.col(d).cast("string"))
        out[d] = F.coalesce(place.cast("long"), F.lit(0)) * F.lit(1 << TIE_BITS) + tie
    return out


def _per_box(values: dict[int, int]) -> Column:
    """The value of a row's box, null for a box without one. Boxes number at most twice the shards."""
    filled = [F.lit(values.get(k)).cast("long") for k in range(max(values, default=0) + 1)]
    return F.get(F.array(*filled), F.col("box").cast("int"))


def _descend(rows: DataFrame, nodes: list[_Node], dims: list[str]) -> DataFrame:
    """``box`` one level further down, for rows in the boxes just cut. Stored by level, else the expression nests."""
    axis = F.get(F.array(*[F.col(f"c_{d}") for d in dims]), _per_box({n.key: dims.index(n.dim) for n in nodes}).cast("int"))
    below = axis < _per_box({n.key: n.cut for n in nodes})
    low = _per_box({n.key: n.low.key for n in nodes})
    return rows.withColumn("box", F.when(below, low).when(~below, low + 1).otherwise(F.col("box")))


def _medians(boxed: DataFrame, nodes: list[_Node], dims: list[str], stats: dict, bins: int, slack: float) -> None:
    """Cut every node at its weighted median: histograms of byte sums, each one inside the bin that holds the median."""
    state = {}
    for n in nodes:
        s = stats[n.key]
        state[n.key] = {"node": n, "lo": s[f"lo_{n.dim}"], "hi": s[f"hi_{n.dim}"], "below": 0, "goal": s["bytes"] * (n.leaves // 2) / n.leaves}
    axis = F.get(F.array(*[F.col(f"c_{d}") for d in dims]), _per_box({n.key: dims.index(n.dim) for n in nodes}).cast("int"))
    on_axis = boxed.select("box", "size", axis.alias("c"))
    while state:
        for x in state.values():
            x["step"] = max(1, -(-(x["hi"] - x["lo"] + 1) // bins))
        lo, hi, step = (_per_box({k: x[what] for k, x in state.items()}) for what in ("lo", "hi", "step"))
        zoomed = on_axis.filter(F.col("c").between(lo, hi)).select("box", "size", (F.col("c") - lo).alias("far"), step.alias("step"))
        found: dict[int, dict[int, int]] = {}
        for r in zoomed.groupBy("box", F.expr("far div step").alias("bin")).agg(F.sum("size").alias("bytes")).collect():
            found.setdefault(r["box"], {})[r["bin"]] = r["bytes"]
        for k, x in list(state.items()):
            acc = x["below"]
            for b, size in sorted(found[k].items()):
                if acc + size >= x["goal"]:
                    break
                acc += size
            start = x["lo"] + b * x["step"]
            if x["step"] == 1 or size <= slack:
                x["node"].cut = start if x["goal"] - acc <= acc + size - x["goal"] else start + x["step"]
                del state[k]
            else:
                x |= {"lo": start, "hi": start + x["step"] - 1, "below": acc}


def kd_shards(
    df: DataFrame,
    shards: int = 40,
    dims: tuple[str, ...] = ("lang", "source", "size", "doc_id"),
    id_col: str = "doc_id",
    text_col: str = "text",
    bins: int = 512,
    tolerance: float = 0.002,
) -> DataFrame:
    """Rows of ``df`` dealt into ``shards`` of near equal bytes, as (doc_id, size, text_crc32, shard, slot).

    The root box holds all rows; a box of n shards is cut along its widest dimension (the largest spread of positions,
    as a share of the whole table's) where floor(n / 2) / n of its bytes lie below, until a box is one shard. Boxes of a level
    are cut together, by histograms of ``bins`` byte sums a box that zoom in until a bin holds at most ``tolerance`` of a
    shard: what reaches the driver depends on shards and bins, not on rows. Text values lie on their axis by CRC-32, so a
    source or language stays together while it fits. Equal values are cut by a row hash, so that a source with a third of
    the rows, or a third of rows that are equal, splits like any other. Dimensions that the table lacks are left out.

    ``slot`` numbers a shard's rows from 0 without gaps, in blocks of stored rows. Nulls: a null text has size 16 and CRC 0,
    a null id or dimension lies at the start of its axis. A very long text counts as its size and is not moved; one larger
    than a shard's share makes its shard larger. Repeated rows are sharded each. An empty table gives no rows.
    """
    kept = [d for d in dims if d == "size" or d == "doc_id" or d in df.columns]
    text = F.col(f"`{text_col}`")
    rows = stored(
        df.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"),
            *[F.col(f"`{d}`").alias(d) for d in kept if d not in ("size", "doc_id")],
        )
    )
    axes = _coordinates(rows, kept)
    boxed = rows.select("uid", "doc_id", "size", "text_crc32", *[c.alias(f"c_{d}") for d, c in axes.items()], F.lit(0).cast("long").alias("box"))
    level, keys, whole, total, shard_of = [_Node(0, 0, shards)], 0, None, 0, {}
    while level:
        shard_of |= {n.key: n.first for n in level if n.leaves == 1}
        level = [n for n in level if n.leaves > 1]
        ends = [f(f"c_{d}").alias(f"{n}_{d}") for d in kept for f, n in ((F.min, "lo"), (F.max, "hi"))]
        inside = boxed.filter(F.col("box").isin([n.key for n in level]))
        stats = {r["box"]: r for r in inside.groupBy("box").agg(F.sum("size").alias("bytes"), *ends).collect()} if level else {}
        level = [n for n in level if n.key in stats]
        if not level:
            break
        whole = whole or {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) for d in kept}
        total = total or stats[0]["bytes"]
        for n in level:
            s = stats[n.key]
            n.dim = max(kept, key=lambda d, s=s: (s[f"hi_{d}"] - s[f"lo_{d}"]) / whole[d])
        _medians(inside, level, kept, stats, bins, tolerance * total / shards)
        for n in level:
            half = n.leaves // 2
            n.low, n.high = _Node(keys + 1, n.first, half), _Node(keys + 2, n.first + half, n.leaves - half)
            keys += 2
        boxed = stored(_descend(boxed, level, kept))
        level = [x for n in level for x in (n.low, n.high)]
    return _slots(boxed.select("uid", "doc_id", "size", "text_crc32", F.coalesce(_per_box(shard_of), F.lit(0)).cast("int").alias("shard")))


def _slots(sharded: DataFrame) -> DataFrame:
    """Gapless numbers in each shard: by block of stored rows, then over the block counts."""
    rows = sharded.withColumn("block", F.shiftrightunsigned("uid", BLOCK_BITS))
    before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "block").count().select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("shard", "block").orderBy("uid")) - 1
    numbered = rows.withColumn("inside", inside).join(starts, ["shard", "block"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("inside")).cast("long").alias("slot"))
