"""Scores by text key in a table bucketed by that key: looked up and extended without an exchange of what it holds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.operators.sentiment import Scorer, one_score, score_texts, with_text_key

SCHEMA = "text_hash string, label string, score double"


class ScoreStore:
    """(text_hash, label, score), one row a key, under ``path``.

    Each append writes a new generation, in which the newest score of a key stands, and notes it in a log; readers of the
    generation before are not disturbed. Generations are bucketed by key, so a join reads them in place: only the other
    side is shuffled, to as many partitions as there are buckets. Choose ``buckets`` for the size to come (a bucket is
    one task) and not below ``spark.sql.shuffle.partitions``, or Spark shuffles both sides. Old generations stay
    until :meth:`vacuum`. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _generations(self) -> list[tuple[int, str, int]]:
        """(number, folder, buckets), oldest first: one row an append."""
        try:
            rows = self.spark.read.schema("number int, folder string, buckets int").json(f"{self.path}/log").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        return sorted((r["number"], r["folder"], r["buckets"]) for r in rows)

    def table(self) -> DataFrame:
        """The newest generation, read through its buckets; empty before the first append."""
        known = self._generations()
        if not known:
            return self.spark.createDataFrame([], SCHEMA)
        _, folder, buckets = known[-1]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(folder)} ({SCHEMA}) USING parquet OPTIONS (path '{self.path}/{folder}')"
            f" CLUSTERED BY (text_hash) SORTED BY (text_hash) INTO {buckets} BUCKETS"
        )
        return self.spark.table(self._name(folder))

    @staticmethod
    def _name(folder: str) -> str:
        return f"barlight_scores_{folder}"

    def append(self, fresh: DataFrame) -> None:
        """Add scores; of a key that is there already the new one stands, of several new ones the first by (label, score)."""
        known = self._generations()
        new = one_score(fresh.select("text_hash", "label", "score"))
        if known:
            new = new.select("text_hash", F.struct("label", "score").alias("new"))
            both = self.table().join(new, "text_hash", "full_outer")
            kept = lambda c: F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)
            new = both.select("text_hash", kept("label"), kept("score"))
        folder, buckets = uuid.uuid4().hex, known[-1][2] if known else self.buckets
        if not known:
            new = new.repartition(buckets, "text_hash")
        writer = new.write.bucketBy(buckets, "text_hash").sortBy("text_hash").option("path", f"{self.path}/{folder}")
        writer.saveAsTable(self._name(folder))
        entry = self.spark.createDataFrame([(len(known), folder, buckets)], "number int, folder string, buckets int")
        entry.coalesce(1).write.mode("append").json(f"{self.path}/log")

    def lookup(self, texts: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
        """(score rows of the wanted texts, wanted texts without one)."""
        wanted = with_text_key(texts, text)
        held = self.table()
        return held.join(wanted.select("text_hash"), "text_hash", "left_semi"), wanted.join(held.select("text_hash"), "text_hash", "left_anti")

    def score(self, texts: DataFrame, scorer_factory: Callable[[], Scorer], text: str = "text", batch_size: int = 16) -> DataFrame:
        """Score rows of every wanted text; only those the store lacks are scored, and stored."""
        _, misses = self.lookup(texts, text)
        self.append(score_texts(misses, scorer_factory, text, batch_size))
        return self.lookup(texts, text)[0]

    def vacuum(self) -> None:
        """Empty every generation but the newest; no reader may be left on them."""
        for _, folder, _ in self._generations()[:-1]:
            self.spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(folder)}")
