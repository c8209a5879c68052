"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import stored_anew


ROWS = 50_000  # rows of a round's tables that one task writes, at least


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the smallest node it can reach.

    Every round takes the smallest root among a node and its neighbours (counted before the shuffle), for the node and for the
    root that it had, and then the root's own root. So whole trees hook onto lower ones and paths halve, however nodes are
    numbered; without the hook a lower root crawls through a tree by one node a round. Roots only fall, so their sum tells when
    none did. Both tables of a join are stored, so a hub with a third of the edges is a skewed join that Spark splits. They are
    stored in as many parts as their rows ask for, one a core at least, so that a round over few rows is no round of as many
    near-empty files as a shuffle has partitions. Their size estimates start again each round, so what the driver holds does not
    grow with the rounds.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    linked = edges.select("a", "b").unionByName(turned).filter("a <> b").distinct()
    both = stored_anew(linked.unionByName(linked.select("a", F.col("a").alias("b")).distinct()))
    parts = max(edges.sparkSession.sparkContext.defaultParallelism, both.count() // ROWS)
    both = both.coalesce(parts)
    roots = stored_anew(both.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").coalesce(parts))
    before = None
    for _ in range(rounds):
        total = roots.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return roots
        before = total
        seen = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("root"), F.max(F.when(F.col("a") == F.col("b"), F.col("root"))).alias("had"))
        hooked = seen.select(F.explode(F.array("a", "had")).alias("node"), "root").groupBy("node").agg(F.min("root").alias("root"))
        lower = stored_anew(hooked.coalesce(parts))
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = stored_anew(lower.join(up, "root").select("node", F.col("top").alias("root")).coalesce(parts))
    raise RuntimeError(f"components not found in {rounds} rounds")
