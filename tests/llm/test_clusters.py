from __future__ import annotations

import hashlib

import numpy as np

from barlight.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, block string, x string"


def brute(rows, dim, k=8, rounds=10):
    """(sorted (vec_id, cluster, distance), centroids) by comparing every vector with every centroid."""
    kept = [(i, np.floor(1024 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v is not None and len(v) == dim and None not in v and np.isfinite(v).all()]
    order = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"3:{kept[j][0]}".encode()).hexdigest() if kept[j][0] is not None else "~", list(kept[j][1])))[:k]
    x = np.array([v for _, v in kept])
    c = x[order]
    for r in range(rounds + 1):
        far = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        own = far.argmin(1)
        if r < rounds:
            c = np.array([x[own == j].sum(0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    label = sorted(((i if i is not None else -1, int(own[j]), int(far[j, own[j]])) for j, (i, _) in enumerate(kept)))
    return label, c


def found(df, dim, **more):
    got = clusters.heap_kmeans(df, dim=dim, **more)
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in got.rows.collect()), got


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "d", "b", "x") for i, v in rows], SCHEMA)


def test_grouped_vectors_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 6)) * 3
    rows = [(i, (centres[i % 5] + rng.normal(size=6) * 0.4).tolist()) for i in range(4000)]
    monkeypatch.setattr(clusters, "BLOCK", 64)
    got, result = found(frame(spark, rows), 6, k=6)
    want, centroids = brute(rows, 6, k=6)
    assert got == want and (centroids == result.centroids).all()
    assert result.scanned[0] == 4000 and result.scanned[-1] < 2000


def test_ties_repeats_nulls_and_other_lengths(spark):
    rows = [(i % 9, [float(i % 3), float(i % 2)]) for i in range(60)]  # repeated rows, equal distances
    rows += [(100, None), (101, [1.0]), (102, [1.0, None]), (103, [float("nan"), 1.0]), (104, [float("inf"), 0.0]), (None, [0.5, 0.5]), (105, [1.0, 2.0, 3.0])]
    assert found(frame(spark, rows), 2, k=4)[0] == brute(rows, 2, k=4)[0]


def test_one_vector_fills_the_table_and_large_components(spark):
    rows = [(i, [0.25, -0.75, 1.0]) for i in range(2000)] + [(5000 + i, [float(i), -20000.0 * i, 3.0]) for i in range(3)]
    assert found(frame(spark, rows), 3, k=3)[0] == brute(rows, 3, k=3)[0]


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 1.0]), (2, [3.0, 1.0])]
    assert found(frame(spark, rows), 2)[0] == brute(rows, 2)[0]
    for none in (frame(spark, [(1, None)]), frame(spark, [])):
        assert clusters.clusters(none, dim=2).collect() == []


def test_rounds_have_no_exchange_and_leave_no_table(spark):
    seen = {t.name for t in spark.catalog.listTables()}
    plans = []

    class Kept(clusters._Tables):
        def write(self, df):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().write(df)

    own, clusters._Tables = clusters._Tables, Kept
    try:
        clusters.heap_kmeans(frame(spark, [(i, [float(i), 1.0]) for i in range(50)]), dim=2, k=3, rounds=3)
    finally:
        clusters._Tables = own
    assert all("Exchange" not in p for p in plans[1:]) and any("ShuffledHashJoin" in p for p in plans[1:])
    assert {t.name for t in spark.catalog.listTables()} == seen


def test_columns(spark):
    out = clusters.clusters(frame(spark, [(1, [0.5, 1.0]), (2, [0.0, 1.0])]), dim=2, k=1).collect()
    assert {r.inertia for r in out} == {r.cluster_inertia for r in out} == {sum(r.distance for r in out)}
    assert {r.centroid_sha256 for r in out} == {hashlib.sha256(b"256,1024").hexdigest()}
