"""The bucketed score store: what it keeps, and that it is read in place."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from barlight.operators import sentiment as sm
from barlight.sources.scores import ScoreStore


def scores(spark, *rows):
    return spark.createDataFrame(rows, "text string, label string, score double").withColumn("text_hash", F.sha2("text", 256)).drop("text")


def held(store):
    return {(r.text_hash[:6], r.label, r.score) for r in store.table().collect()}


def test_newest_score_stands_and_keys_stay_single(spark, tmp_path):
    store = ScoreStore(spark, str(tmp_path / "s"), buckets=8)
    assert store.table().count() == 0
    store.append(scores(spark, ("a", "positive", 0.1), ("b", "negative", -0.2), ("a", "neutral", 0.3)))
    store.append(scores(spark, ("b", "positive", 0.9), ("c", None, None)))
    h = {t: spark.range(1).select(F.sha2(F.lit(t), 256).alias("h")).first()["h"][:6] for t in "abc"}
    want = {(h["a"], "neutral", 0.3), (h["b"], "positive", 0.9), (h["c"], None, None)}
    assert held(store) == want
    store.vacuum()
    assert held(ScoreStore(spark, str(tmp_path / "s"), buckets=99)) == want  # what is there decides on the buckets


def test_another_session_reads_it_and_only_misses_are_scored(spark, tmp_path):
    path = str(tmp_path / "s")
    ScoreStore(spark, path, 8).append(scores(spark, ("known", "kept", 0.5)))
    other = ScoreStore(spark.newSession(), path, 8)
    texts = other.spark.createDataFrame([("known",), ("new",), ("new",), (None,)], "text string")
    got = {r.text_hash: r.label for r in other.score(texts, lambda: lambda given: [("POS", 0.7) for _ in given]).collect()}
    assert sorted(got.values()) == ["kept", "positive", "positive"]
    assert other.lookup(texts)[1].isEmpty()


def test_store_side_is_not_exchanged(spark, tmp_path):
    store = ScoreStore(spark, str(tmp_path / "s"), buckets=8)
    store.append(scores(spark, *[(str(i), "x", 0.0) for i in range(100)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = spark.range(50).select(F.col("id").cast("string").alias("text"))
        for frame in store.lookup(texts):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and re.search(r"SelectedBucketsCount|Bucketed: true", plan)
            frame.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sm.one_score(store.table()).count() == 100
