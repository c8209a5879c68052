"""Exact top-k inner products by a Voronoi join: pivots group vectors, group bounds leave out what cannot be an answer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.llm.common import stored


def _usable(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x); rows without an id or with a null, empty or non-finite vector take no part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("x")).filter(F.col("vec_id").isNotNull() & _usable(F.col("x"))).select(
        "vec_id", F.transform("x", lambda c: F.floor(c * F.lit(scale)).cast("long")).alias("v")
    )


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), dim)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products: in float64 while no sum can pass 2 ** 53, in 64-bit integers beyond."""
    most = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * q.shape[1]
    return (q @ x.T).astype(np.int64) if most < 2**53 else q.astype(np.int64) @ x.astype(np.int64).T


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(d, 0))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best by score, then smaller id; ``ids`` ascend."""
    if len(ids) <= k:
        return np.arange(len(ids))
    kth = np.partition(scores, len(ids) - k)[len(ids) - k]
    above, ties = np.flatnonzero(scores > kth), np.flatnonzero(scores == kth)
    return np.concatenate([above, ties[: k - len(above)]])


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    pivots: int = 64,
    block_rows: int = 20_000,
    query_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (a condition on vec_id) the ``k`` other rows with the
    highest integer inner product, ties to the smaller vec_id; all of them, if fewer.

    1. ``pivots`` rows with the smallest id hashes are pivots; every row joins the cell of its nearest pivot.
    2. A cell's summary holds its radius, its row count and the k + 1 rows nearest to its pivot, of different ids: at most
       pivots * (k + 1) vectors, whatever the table holds.
    3. A query's k-th best score among the summaries' rows bounds its final k-th score from below. No row of a cell can beat
       q.p + |q| * radius, so a query is sent only to the cells where that reaches its bound. The query side is the one that
       is replicated, being the smaller; inside a cell's task the bound leaves out single rows once more.
    4. A cell's rows are dealt into blocks of about ``block_rows`` by a hash of the row, so that a hot cell, or a vector that
       fills a third of the table, is many tasks; queries meet a block ``query_rows`` at a time.
    5. Each block is solved by one matrix product and hands on k rows a query; the last step ranks blocks * k rows a query.

    Rows that share a query's vec_id are not its answers; a repeated query row is answered once. Rows without an id, and
    null, empty or non-finite vectors, take no part. Shorter vectors count as padded by zeros. An empty table, or one without
    queries, gives no rows.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    rows = integer_vectors(df, id_col, vector_col, scale)
    schema = "query_id long, rank int, vec_id long, score long"
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], schema)
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).select("v").collect()
    centres = np.unique(np.array([r["v"] + [0] * (dim - len(r["v"])) for r in chosen], np.float64), axis=0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            size = np.diff(v.offsets.to_numpy())
            x = np.zeros((len(size), dim))
            x[np.arange(dim)[None, :] < size[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
            d = _distances(x, centres)
            cell = d.argmin(1) if len(x) else np.empty(0, np.int64)
            blobs = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), blobs, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(x)), cell])], names=["vec_id", "v", "cell", "far"])

    celled = stored(rows.mapInArrow(assign, "vec_id long, v binary, cell int, far double"))
    once = celled.groupBy("cell", "vec_id").agg(F.min(F.struct("far", "v")).alias("x")).select("cell", "vec_id", "x.*")
    near = W.partitionBy("cell", "part").orderBy("far", "vec_id")
    ranked = once.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1)
    nearest = ranked.groupBy("cell").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "vec_id", "v"))), 1, k + 1).alias("near"))
    sizes = celled.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n"))
    summary = sizes.join(nearest, "cell").collect()
    cells = np.array([r["cell"] for r in summary], np.int64)
    radius = np.array([r["radius"] for r in summary])
    blocks = np.array([-(-r["n"] // block_rows) for r in summary], np.int64)
    known_ids = np.array([x["vec_id"] for r in summary for x in r["near"]], np.int64)
    known = _matrix([bytes(x["v"]) for r in summary for x in r["near"]], dim)
    order = np.argsort(known_ids, kind="stable")
    known_ids, known = known_ids[order], known[order]

    def bound(q: np.ndarray, qid: int) -> float:
        """The k-th best score among the summaries' rows, one an id, without the query's own id."""
        scores = (known @ q)[known_ids != qid]
        ids = known_ids[known_ids != qid]
        _, first = np.unique(ids, return_index=True)
        top = np.sort(np.maximum.reduceat(scores, first))[::-1] if len(ids) else np.empty(0)
        return top[k - 1] if len(top) >= k else -np.inf

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, blobs = b.column("vec_id").to_pylist(), b.column("v").to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [])
            for qid, blob in zip(ids, blobs, strict=True):
                q = np.frombuffer(blob, np.float64)
                least = bound(q, qid)
                upper = centres[cells] @ q + np.sqrt(q @ q) * radius
                reach = np.flatnonzero(upper >= least - 1e-6 * (1 + np.abs(upper)))
                n = int(blocks[reach].sum())
                for column, values in zip(out, ([qid] * n, [blob] * n, [least] * n, np.repeat(cells[reach], blocks[reach]).tolist(), [j for c in blocks[reach] for j in range(c)]), strict=True):
                    column.extend(values)
            types = [pa.int64(), pa.binary(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["vec_id", "v", "least", "cell", "block"])

    queries = celled.filter(is_query).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
    parts = max(1, -(-queries.count() // query_rows))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    asked = queries.mapInArrow(send, "vec_id long, v binary, least double, cell int, block int").withColumn("part", part)
    counts = F.create_map(*[F.lit(int(x)) for c, n in zip(cells, blocks, strict=True) for x in (c, n)])
    home = F.pmod(F.xxhash64("vec_id", "v"), counts[F.col("cell")]).cast("int")
    data = celled.select("vec_id", "v", "cell", home.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def solve(q: pa.Table, x: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if q.num_rows and x.num_rows:
            ids = x.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, xs = ids[order], _matrix(x.column("v").to_pylist(), dim)[order]
            qids, qs, least = q.column("vec_id").to_numpy(), _matrix(q.column("v").to_pylist(), dim), q.column("least").to_numpy()
            for start in range(0, len(qids), 128):
                scores = _products(qs[start : start + 128], xs)
                for s, qid, low in zip(scores, qids[start : start + 128], least[start : start + 128], strict=True):
                    some = np.flatnonzero((ids != qid) & (s >= low))
                    top = some[_best(ids[some], s[some], k)]
                    out.append((np.full(len(top), qid), ids[top], s[top]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    keys = ("cell", "block", "part")
    found = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
