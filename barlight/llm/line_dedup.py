"""Repeated runs of lines, by a distributed suffix array over line ids; later copies are deleted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import Placed, bounded_batches, placed, stored, texts

_LINES = "uid long, ord long, i int, a long, b long, ahead int, behind int"
_LAST = (1 << 63) - 1


def _lines(least: int):
    """mapInArrow function: each line's two hashes, and how many lines from it on, or up to it, hold ``least`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for uid, ord_, text in zip(*(batch.column(c).to_pylist() for c in ("uid", "ord", "text")), strict=True):
                lines = text.split("\n")
                raw = [line.encode("utf-8", "replace") for line in lines]
                sums = np.concatenate([[0], np.cumsum([len(line) + 1 for line in lines])])
                at = np.arange(len(lines))
                ahead = np.searchsorted(sums, sums[:-1] + least, "left") - at
                behind = at + 1 - (np.searchsorted(sums, sums[1:] - least, "right") - 1)
                out[0] += [uid] * len(lines)
                out[1] += [ord_] * len(lines)
                out[2] += range(len(lines))
                out[3] += map(xxhash.xxh3_64_intdigest, raw)
                out[4] += map(xxhash.xxh64_intdigest, raw)
                out[5] += np.where(sums[:-1] + least <= sums[-1], ahead, 0).tolist()
                out[6] += np.where(sums[1:] >= least, behind, 0).tolist()
            hashes = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[3:5]]
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), *hashes, pa.array(out[5], pa.int32()), pa.array(out[6], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["uid", "ord", "i", "a", "b", "ahead", "behind"])

    return run


def _ranked(pairs: DataFrame) -> DataFrame:
    """(uid, ord, i, rank) of suffixes whose pair (a, b) is not the only one, ``rank`` growing with (a, b).

    Distinct pairs are counted before they move, sorted by range, and numbered by partition and place, so the numbers grow
    with the order. Every suffix with one rank shares a prefix: an LCP interval of this depth.
    """
    shared = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    names = stored(shared.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("rank", F.monotonically_increasing_id()))
    return stored(pairs.select("uid", "ord", "i", "a", "b").join(names, ["a", "b"]).select("uid", "ord", "i", "rank"))


def repeated_runs(df: DataFrame | Placed, id_col: str = "doc_id", text_col: str = "text", least: int = 40) -> DataFrame:
    """(uid, runs): for each row with deleted lines the runs (first line, number of lines) that cover them.

    Lines end at '\\n' and count their characters plus one. Occurrences are ordered by doc_id (null last), then row, then
    line. A run of lines is deleted if it holds ``least`` characters and occurs at an earlier place too, in the same document
    or another. A short line therefore goes only as part of a longer repeated run.

    Suffixes of all documents' line sequences are ranked by prefix doubling: ranks of 1, 2, 4, ... lines, each from the
    pairs of ranks before, until runs of ``least`` characters cannot be longer (a line counts at least one, so log2(least)
    rounds at most). A suffix whose prefix occurs once drops out. A run of any length is named by the two ranks that cover
    it. Every line of a repeated run of ``least`` characters lies in the shortest such run that starts or that ends at one
    of its lines, so those name all that has to go; of each name the earliest occurrence stays, unless occurrences overlap.
    In a document of periodic short lines (30 lines 'ab', a block of 41 blank lines) each start after the first is a later
    occurrence that overlaps the earliest, so the block collapses to the lines before the second occurrence.

    Ranks are joined back on pairs stored beforehand, so that a line in a third of all documents is a skewed join that Spark
    splits; firsts are removed by their own place, which no two rows share.
    """
    df = placed(df)
    bounded_batches(df.df.sparkSession)
    rows = texts(df, id_col, text_col).select("uid", F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "text")
    lines = stored(rows.mapInArrow(_lines(least), _LINES))
    ahead = lines.filter("ahead > 0").select("uid", "i", F.col("ahead").alias("n"))
    behind = lines.filter("behind > 0").select("uid", (F.col("i") + 1 - F.col("behind")).alias("i"), F.col("behind").alias("n"))
    wanted = ahead.unionByName(behind).distinct()
    most = lines.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    ranks, size, named = _ranked(lines), 1, None
    while True:
        level = wanted.filter((F.col("n") >= size) & (F.col("n") < 2 * size)) if size > 1 else wanted.filter("n = 1")
        start = ranks.select("uid", "i", "ord", F.col("rank").alias("a"))
        ends = ranks.select("uid", F.col("i").alias("e"), F.col("rank").alias("b"))
        runs = level.join(start, ["uid", "i"])
        if size > 1:
            runs = runs.withColumn("e", F.col("i") + F.col("n") - size).join(ends, ["uid", "e"])
        else:
            runs = runs.withColumn("b", F.lit(0).cast("long"))
        runs = runs.select("uid", "ord", "i", "n", "a", "b")
        named = runs if named is None else named.unionByName(runs)
        if 2 * size > most:
            break
        pairs = ranks.withColumnRenamed("rank", "a").join(ranks.select("uid", (F.col("i") - size).alias("i"), F.col("rank").alias("b")), ["uid", "i"])
        ranks, size = _ranked(pairs), 2 * size
        if ranks.isEmpty():
            break
    named = stored(named)
    firsts = named.groupBy("n", "a", "b").agg(F.min(F.struct("ord", "uid", "i")).alias("x")).select("x.uid", "x.i", "n")
    later = named.select("uid", "i", "n").join(firsts, ["uid", "i", "n"], "left_anti")
    return later.groupBy("uid").agg(F.collect_list(F.struct("i", "n")).alias("runs"))


def _without(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    out = []
    for t, rs in zip(text, runs, strict=True):
        lines = (t or "").split("\n")
        if rs is None or not len(rs):
            out.append((t or "", len(lines), 0))
            continue
        edge = np.zeros(len(lines) + 1, np.int64)
        np.add.at(edge, [r["i"] for r in rs], 1)
        np.add.at(edge, [r["i"] + r["n"] for r in rs], -1)
        gone = np.cumsum(edge[:-1]) > 0
        out.append(("\n".join(line for line, g in zip(lines, gone, strict=True) if not g), len(lines), int(gone.sum())))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 40) -> DataFrame:
    """(row, text, n_lines, n_removed): every row of ``df`` as a struct beside its text without later copies of line runs.

    A null or empty text is one empty line, and stays. Rows are told apart by file and row number; a frame that is not read from
    files is written once.
    """
    df = placed(df)
    runs = repeated_runs(df, id_col, text_col, least)
    both = df.whole().join(runs, "uid", "left")
    without = F.pandas_udf(_without, "text string, n_lines long, n_removed long")
    return both.select("row", without(F.col(f"row.`{text_col}`"), "runs").alias("x")).select("row", "x.*")
