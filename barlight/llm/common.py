"""Row identity, table access and stored intermediate frames for the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.session import settle, shared_folder, use_utc


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


class Placed(NamedTuple):
    """Rows that can be told apart in any scan: ``uid`` is the same whenever and wherever ``df`` is read."""

    df: DataFrame
    uid: Column

    def whole(self) -> DataFrame:
        """(uid, row): every row as a struct."""
        return self.df.select(self.uid.alias("uid"), F.struct("*").alias("row"))


_SELECTION = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def _plain_selection(plan) -> bool:
    """Whether a plan only selects columns and rows of one relation, so that no row comes out twice."""
    if plan.getClass().getSimpleName() not in _SELECTION:
        return False
    below = plan.children()
    return below.size() < 2 and all(_plain_selection(below.apply(i)) for i in range(below.size()))


def _file_ids(df: DataFrame) -> Column | None:
    """A number from file and row number, or None where two rows could get the same: a hash of the file's path plus the row.

    One row a file comes to the driver, to check that no two files' stretches of numbers overlap.
    """
    row, path = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    for salt in range(8):
        base = F.shiftright(F.xxhash64(path, F.lit(salt)), 1)
        files = df.groupBy(base.alias("base"), path.alias("path")).agg(F.max(row).alias("last"), F.count("*").alias("n")).collect()
        if any(f["n"] > f["last"] + 1 for f in files):  # a file read twice
            return None
        ordered = sorted((f["base"], f["base"] + f["last"]) for f in files)
        if all(x[1] < y[0] for x, y in zip(ordered, ordered[1:], strict=False)):
            return base + row
    return None


def placed(df: DataFrame | Placed) -> Placed:
    """The frame with a row number that does not depend on how a scan is planned.

    Parquet files with columns and rows selected from them have file path and row number. Any other frame is written once
    to the shared folder and read from there.
    """
    if isinstance(df, Placed):
        return df
    spark = df.sparkSession
    try:
        uid = _file_ids(df) if _plain_selection(df._jdf.queryExecution().analyzed()) else None
    except AnalysisException:  # not from files that number their rows
        uid = None
    if uid is None:
        path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
        df.write.parquet(path)
        df = spark.read.parquet(path)
        uid = _file_ids(df)
    if uid is None:
        raise RuntimeError("no row numbers without overlap were found")
    return Placed(df, uid)


def texts(df: DataFrame | Placed, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, text) of a table, whatever its other columns are called. A null text counts as empty.

    ``uid`` tells repeated rows apart. Of a plain frame it holds within one scan (a task that runs again gives the same
    numbers); what joins two scans by it takes a ``Placed``.
    """
    uid = df.uid if isinstance(df, Placed) else F.monotonically_increasing_id()
    df = df.df if isinstance(df, Placed) else df
    return df.select(
        uid.alias("uid"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def fingerprint(c: Column, *salt: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(c, *salt), F.xxhash64(F.lit("second"), c, *salt)


def stored(df: DataFrame) -> DataFrame:
    """The frame, written to the shared checkpoint folder: read more than once, computed once."""
    return settle(df)


def stored_anew(df: DataFrame) -> DataFrame:
    """``stored``, for what a loop makes of its own last round: Spark's estimate of its size starts again.

    A checkpoint keeps the estimate of the plan that it comes from, and a join's estimate is the product of its sides, a number of
    any length. Of tables joined with those of the round before, the digits double each round, and the driver holds such a
    number for every node of every plan that reads them. Without an estimate Spark takes the largest 64-bit number.
    """
    spark, kept = df.sparkSession, stored(df)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(kept.queryExecution().analyzed().rdd(), kept.schema(), False), spark)


def bounded_batches(spark: SparkSession, rows: int = 128) -> SparkSession:
    """Whole texts travel to Python in batches of few rows, so that a run of very long ones fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of ``rows`` rows for the jobs run inside; the session's own setting is put back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stretches(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and where each one's stretch begins and ends."""
    own, begin = np.unique(ordered, return_index=True)
    return own, begin, np.append(begin[1:], len(ordered))[: len(begin)]


def cut(values: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Stretches of an array as an Arrow array of their bytes."""
    import pyarrow as pa

    return pa.array([values[i:j].tobytes() for i, j in zip(begin, end, strict=True)], pa.binary())
