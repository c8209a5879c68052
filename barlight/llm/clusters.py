"""Centroid clustering with heaps of bounds: a vector is looked at again only when the centroids may have moved past its gap."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.llm.common import batches_of, stored

BLOCK = 1024  # vectors of one row of the stored table
BUCKET = 256  # blocks of one bucket about
SLACK = 1e-4  # far above the rounding of distances up to 2 ** 33, far below a step of one unit
LARGEST = 1 << 26  # integer components up to which distances fit in 64 bits

_BLOCKS = "ids array<bigint>, v binary"
_HEAPS = "ends binary, keys binary, members binary"
_STEP = f"block long, scanned long, changes array<array<bigint>>, {_HEAPS}"
_LABELS = "vec_id long, cluster int, distance long"


class Clustering(NamedTuple):
    """``rows`` is (vec_id, cluster, distance); ``scanned`` counts the vectors that each assignment compared with all centroids."""

    rows: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def _usable(v: Column, dim: int) -> Column:
    return v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _pack(scale: int, dim: int):
    """mapInArrow function: blocks of integer vectors, row by row as they lie in the table."""

    def block(ids: list[pa.Array], vectors: list[np.ndarray]) -> pa.RecordBatch:
        own = pa.concat_arrays(ids)
        listed = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
        return pa.RecordBatch.from_arrays([listed, pa.array([np.concatenate(vectors).tobytes()], pa.binary())], names=["ids", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, held = [], [], 0
        for b in batches:
            x = np.floor(scale * b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim))
            if np.abs(x).max(initial=0) > LARGEST:
                raise ValueError(f"a component passes {LARGEST} after scaling, so that distances would not fit in 64 bits")
            x, at = x.astype(np.int32), 0
            while at < len(x):
                n = min(BLOCK - held, len(x) - at)
                ids.append(b.column("vec_id").slice(at, n))
                vectors.append(x[at : at + n])
                at, held = at + n, held + n
                if held == BLOCK:
                    yield block(ids, vectors)
                    ids, vectors, held = [], [], 0
        if held:
            yield block(ids, vectors)

    return run


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids: in float64 while no sum can pass 2 ** 53."""
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(centroids).max(initial=0))
    if reach * reach * x.shape[1] < 1 << 53:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (a @ c.T)).astype(np.int64)
    a = x.astype(np.int64)
    return np.stack([((a - c) ** 2).sum(1) for c in centroids], 1)


class _Heaps:
    """The heaps of one block, one a cluster, each an ascending array of keys (which is a heap) beside its members' rows.

    The key of a vector is its gap (distance to the second nearest centroid less that to its own, when last compared) plus
    its cluster's offset at that time. The offset grows by what the gap may have lost, so a key at or below it has expired.
    """

    def __init__(self, k: int, ends: bytes | None, keys: bytes | None, members: bytes | None) -> None:
        self.k = k
        if ends is None:
            self.keys, self.members = [np.empty(0)] * k, [np.empty(0, np.int32)] * k
        else:
            cuts = np.frombuffer(ends, np.int32)[:-1]
            self.keys = np.split(np.frombuffer(keys, np.float64), cuts)
            self.members = np.split(np.frombuffer(members, np.int32), cuts)

    def pop(self, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose gap has expired, and the cluster each was in."""
        rows, own = [], []
        for c in range(self.k):
            n = int(np.searchsorted(self.keys[c], offsets[c] + SLACK, "right"))
            rows.append(self.members[c][:n])
            own.append(np.full(n, c))
            self.keys[c], self.members[c] = self.keys[c][n:], self.members[c][n:]
        return np.concatenate(rows), np.concatenate(own)

    def push(self, rows: np.ndarray, cluster: np.ndarray, keys: np.ndarray) -> None:
        for c in np.unique(cluster):
            mine = cluster == c
            merged = np.concatenate([self.keys[c], keys[mine]])
            order = np.argsort(merged, kind="stable")
            self.keys[c], self.members[c] = merged[order], np.concatenate([self.members[c], rows[mine].astype(np.int32)])[order]

    def cells(self) -> list[bytes]:
        ends = np.cumsum([len(m) for m in self.members]).astype(np.int32)
        return [ends.tobytes(), np.concatenate(self.keys).tobytes(), np.concatenate(self.members).tobytes()]

    def labels(self, n: int) -> np.ndarray:
        out = np.empty(n, np.int64)
        for c, m in enumerate(self.members):
            out[m] = c
        return out


def _assign(x: np.ndarray, heaps: _Heaps, fresh: bool, centroids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compare the expired vectors with all centroids: (rows, cluster before or -1, cluster now)."""
    rows, before = (np.arange(len(x)), np.full(len(x), -1)) if fresh else heaps.pop(offsets)
    squares = _squares(x[rows], centroids)
    now = squares.argmin(1)  # of equal ones the first, which is the smaller number
    if len(centroids) > 1:
        two = np.sqrt(np.partition(squares, 1, axis=1)[:, :2].astype(np.float64))
        gap = two[:, 1] - two[:, 0]
    else:
        gap = np.full(len(rows), np.inf)
    heaps.push(rows, now, gap + offsets[now])
    return rows, before, now


def _step(centroids: np.ndarray, offsets: np.ndarray, fresh: bool):
    """mapInArrow function: one assignment, its new heaps, and by how much each cluster's count and sums change."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = np.frombuffer(r["v"], np.int32).reshape(-1, dim)
                heaps = _Heaps(k, *(None if fresh else r[c] for c in ("ends", "keys", "members")))
                rows, before, now = _assign(x, heaps, fresh, centroids, offsets)
                moved = before != now
                change = np.zeros((k, dim + 1), np.int64)
                counted = np.column_stack([np.ones(int(moved.sum()), np.int64), x[rows[moved]].astype(np.int64)])
                np.add.at(change, now[moved], counted)
                if not fresh:
                    np.subtract.at(change, before[moved], counted)
                cells = [[r["block"]], [len(rows)], [change.tolist() if moved.any() else None], *([c] for c in heaps.cells())]
                types = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.binary(), pa.binary()]
                names = ["block", "scanned", "changes", "ends", "keys", "members"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=names)

    return run


def _finish(centroids: np.ndarray, offsets: np.ndarray, fresh: bool):
    """mapInArrow function: the last assignment, with every vector's exact squared distance to its own centroid."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, r in zip(b.column("ids"), b.drop_columns(["ids"]).to_pylist(), strict=True):
                x = np.frombuffer(r["v"], np.int32).reshape(-1, dim)
                heaps = _Heaps(k, *(None if fresh else r[c] for c in ("ends", "keys", "members")))
                _assign(x, heaps, fresh, centroids, offsets)
                own = heaps.labels(len(x))
                far = ((x.astype(np.int64) - centroids[own]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(own, pa.int32()), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


class _Tables:
    """Tables bucketed by block, so that vectors and heaps meet without a shuffle. They are dropped when the work is done."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, df: DataFrame) -> str:
        name = f"barlight_clusters_{uuid.uuid4().hex}"
        self.names.append(name)
        df.write.bucketBy(self.buckets, "block").saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.names.remove(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def heap_kmeans(
    df: DataFrame, k: int = 8, rounds: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, scale: int = 1024, seed: str = "3"
) -> Clustering:
    """Lloyd's rounds over integer vectors floor(scale * x), exact, comparing few vectors with all centroids.

    Centroids 0, 1, ... start as the ``k`` vectors with the smallest sha256 of ``seed:id``. A round assigns every vector to
    the nearest centroid and replaces each centroid that has vectors by their componentwise floor(sum / count); after
    ``rounds`` of them vectors are assigned once more.

    Vectors lie in blocks of ``BLOCK`` rows, in a table bucketed by block. Each cluster of a block has a heap of gaps. When a
    centroid moves, its heaps' offset grows by its own move plus the largest move of another; only vectors whose key that
    offset has reached are popped and compared with all centroids, and their changes to counts and sums are added up. Each
    assignment writes its heaps beside the blocks (bucketed alike, so the join has no exchange), from where a lost task
    starts again. Blocks cut the table by rows, not by cluster, so a cluster or one vector that fills a third of the table is
    spread like any other. The driver holds k centroids and their sums.

    Rows whose vector is null, is not of ``dim`` components or holds a null or non-finite one take no part. Rows without an
    id start a centroid only if too few others are there, and are clustered with a null id. Repeated rows count each. Equal
    hashes start by the smaller vector; of equally near centroids the smaller number wins; with fewer than k vectors there
    are as many centroids. An empty table gives no rows. A component beyond ``LARGEST`` after scaling is an error.
    """
    spark = df.sparkSession
    x = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).filter(_usable(F.col("x"), dim))
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = rows.orderBy(first.asc_nulls_last(), "x").limit(k).select("x").collect()
    if not start:
        return Clustering(spark.createDataFrame([], _LABELS), np.empty((0, dim), np.int64), [])
    centroids = np.floor(scale * np.array([r["x"] for r in start])).astype(np.int64)
    k = len(centroids)
    blocks = -(-rows.count() // BLOCK)
    tables = _Tables(spark, max(-(-blocks // BUCKET), min(blocks, 2 * spark.sparkContext.defaultParallelism)))
    offsets, sums, scanned, state = np.zeros(k), [[0] * (dim + 1) for _ in range(k)], [], None
    try:
        with batches_of(spark, 4096):
            packed = rows.mapInArrow(_pack(scale, dim), _BLOCKS).withColumn("block", F.monotonically_increasing_id())
            vectors = tables.write(packed.repartition(tables.buckets, "block"))
        with batches_of(spark, 32):
            for _ in range(rounds):
                now = tables.write(_joined(spark, vectors, state).mapInArrow(_step(centroids, offsets, state is None), _STEP))
                if state is not None:
                    tables.drop(state)
                state = now
                scanned.append(_add_changes(spark.table(state), sums))
                after = np.array([[s // c[0] for s in c[1:]] if c[0] else own for c, own in zip(sums, centroids.tolist(), strict=True)], np.int64)
                move = np.sqrt(((after - centroids).astype(np.float64) ** 2).sum(1))
                others = np.array([np.delete(move, c).max(initial=0) for c in range(k)])
                offsets, centroids = offsets + move + others, after
            labelled = _joined(spark, vectors, state).mapInArrow(_finish(centroids, offsets, state is None), _LABELS)
            return Clustering(stored(labelled), centroids, scanned)
    finally:
        for name in list(tables.names):
            tables.drop(name)


def _joined(spark: SparkSession, vectors: str, state: str | None) -> DataFrame:
    both = spark.table(vectors)
    return both if state is None else both.join(spark.table(state).drop("scanned", "changes").hint("shuffle_hash"), "block")


def _add_changes(state: DataFrame, sums: list[list[int]]) -> int:
    """Move counts and sums by cluster by what the blocks report: k * (dim + 1) numbers, added up by Spark. Vectors scanned."""
    by_cluster = state.select("scanned", F.posexplode_outer("changes").alias("c", "change"))
    cells = by_cluster.select("scanned", "c", F.posexplode_outer("change").alias("i", "x"))
    once = F.coalesce(F.col("c"), F.lit(0)) + F.coalesce(F.col("i"), F.lit(0)) == 0  # one row a block
    found = cells.groupBy("c", "i").agg(F.sum("x").alias("x"), F.sum(F.when(once, F.col("scanned"))).alias("scanned")).collect()
    for r in found:
        if r["c"] is not None:
            sums[r["c"]][r["i"]] += r["x"]
    return sum(r["scanned"] or 0 for r in found)


def clusters(df: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part; see heap_kmeans."""
    found = heap_kmeans(df, **options)
    far = {r["cluster"]: r["d"] for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    spelled = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    of = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))
    if not far:
        inertia, hashed = F.lit(None).cast("long"), F.lit(None).cast("string")
    else:
        inertia, hashed = of([far.get(c, 0) for c in range(len(spelled))], "long"), of(spelled, "string")
    return found.rows.select("vec_id", "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(sum(far.values())).cast("long").alias("inertia"), hashed.alias("centroid_sha256"))
