"""Merkle manifest of a table: digests of every few levels are stored, what lies between is worked out again for proofs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.llm.common import stored

EVERY = 5  # levels from one stored level to the next: an aligned subtree has 2 ** EVERY digests at most
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<sib:string,left:boolean>>"


class Manifest(NamedTuple):
    """Stored levels of one or more trees. ``levels[k]`` has (tree, pos, n, digest) of the nodes ``EVERY * k`` levels above the
    leaves, where a tree still has more than one node (level 0: every leaf); ``roots`` has (tree, stage, digest), ``stage``
    being how many stored levels the tree has above its leaves."""

    levels: list[DataFrame]
    roots: DataFrame


def spelled(c: Column) -> Column:
    """A value as it enters a leaf: '-' for null, else its UTF-8 length, ':' and itself."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``pos`` (from 0) in the order of each tree, and ``n``, the tree's number of rows.

    Rows are sorted by range and stored; a tree's rows in one partition follow each other, so its places come from counts by
    (partition, tree). A tree with most of the rows is many ranges, and a window sees one row a range.
    """
    sorted_ = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = stored(sorted_.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    counts = placed.groupBy("part", tree).agg(F.count("*").alias("c"), F.min("at").alias("first"))
    w = W.partitionBy(tree)
    before = F.coalesce(F.sum("c").over(w.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", tree, (before - F.col("first")).alias("shift"), F.sum("c").over(w).alias("n"))
    return placed.join(starts, ["part", tree]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _height(n: Column) -> Column:
    """Levels above the leaves: the smallest h with 2 ** h >= n."""
    return F.length(F.bin(n - 1)) * F.when(n > 1, 1).otherwise(0)


def _up(a: Column) -> Column:
    """The level above: every two digests, and a last one alone, become the digest of their text."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(a, 2 * i), F.coalesce(F.get(a, 2 * i + 1), F.lit(""))), 256))


def _subtrees(nodes: DataFrame, level: int, every: int, *more: str) -> DataFrame:
    """One row an aligned subtree: (tree, block, n, steps, nodes), its nodes in order; 2 ** every of them at most."""
    node = F.struct("pos", "digest", *more)
    grouped = nodes.groupBy("tree", F.shiftright("pos", every).alias("block")).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(node)).alias("nodes"))
    return grouped.withColumn("steps", F.least(F.lit(every), _height(F.col("n")) - level * every))


def build(leaves: DataFrame, every: int = EVERY) -> Manifest:
    """Trees over ``leaves`` (tree, pos, n, digest), which must be stored. Every ``every``-th level is stored, no other."""
    levels, roots = [leaves], leaves.filter("n = 1").select("tree", F.lit(0).alias("stage"), "digest")
    most = leaves.agg(F.max(_height(F.col("n")))).first()[0] or 0
    for k in range(-(-most // every)):
        open_ = levels[k].filter(_height(F.col("n")) > k * every)
        folded = F.reduce(F.sequence(F.lit(1), F.col("steps")), F.col("nodes.digest"), lambda a, _: _up(a))
        above = stored(_subtrees(open_, k, every).select("tree", F.col("block").alias("pos"), "n", F.element_at(folded, 1).alias("digest")))
        done = _height(F.col("n")) <= (k + 1) * every
        roots = roots.unionByName(above.filter(done).select("tree", F.lit(k + 1).alias("stage"), "digest"))
        levels.append(above)
    return Manifest(levels, roots)


def _paths(subtrees: DataFrame) -> DataFrame:
    """(tree, node, path) of every node of the subtrees: its siblings in the subtree, whose levels are worked out again here
    and dropped with the row, then ``above``, the path of the subtree's top."""
    grown = F.reduce(
        F.sequence(F.lit(2), F.col("steps")),
        F.array(F.col("nodes.digest")),
        lambda acc, i: F.concat(acc, F.array(_up(F.element_at(acc, -1)))),
    )
    subtrees = subtrees.withColumn("grown", F.when(F.col("steps") > 1, grown).otherwise(F.array(F.col("nodes.digest"))))
    spread = subtrees.select("tree", "subroot", "above", "grown", F.posexplode("nodes").alias("x", "node"))

    def step(digests: Column, j: Column) -> Column:
        at = F.call_function("shiftright", F.col("x"), j)
        return F.struct(F.get(digests, at.bitwiseXOR(F.lit(1))).alias("sib"), (at % 2 == 1).alias("left"))

    return spread.select("tree", "subroot", "node", F.concat(F.transform("grown", step), "above").cast(_PATH).alias("path"))


def extract(made: Manifest, tops: DataFrame, leaves: DataFrame, every: int = EVERY, more: tuple[str, ...] = ()) -> DataFrame:
    """(tree, subroot, digest, path, more...) of every leaf; ``tops`` is (tree, above), the path from a tree's root on.

    Paths go down from stored level to stored level: the nodes of a level meet the path of their subtree's top, and only the
    siblings below it are worked out. What is stored between levels is one path an inner node, a 2 ** every-th of the leaves.
    """
    roots = made.roots.withColumnRenamed("digest", "subroot").join(tops, "tree")
    known = None
    for k in reversed(range(len(made.levels) - 1)):
        top = roots.filter(F.col("stage") == k + 1).select("tree", F.lit(0).cast("long").alias("block"), "subroot", "above")
        parents = top if known is None else top.unionByName(known)
        nodes = (leaves if k == 0 else made.levels[k]).filter(_height(F.col("n")) > k * every)
        groups = _subtrees(nodes, k, every, *(more if k == 0 else ())).join(parents, ["tree", "block"])
        below = _paths(groups)
        if k:
            known = stored(below.select("tree", F.col("node.pos").alias("block"), "subroot", F.col("path").alias("above")))
        else:
            known = below.select("tree", "subroot", "node.digest", "path", *[f"node.{c}" for c in more])
    lone = leaves.filter("n = 1").join(roots.select("tree", "subroot", "above"), "tree")
    lone = lone.select("tree", "subroot", "digest", F.col("above").alias("path"), *more)
    return lone if known is None else known.unionByName(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    joined = lambda acc, p: F.when(p["left"], F.concat(p["sib"], acc)).otherwise(F.concat(acc, F.coalesce(p["sib"], F.lit(""))))
    return F.reduce(path, leaf, lambda acc, p: F.sha2(joined(acc, p), 256))


def _leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[spelled(columns[c]) for c in FIELDS]), 256)


def manifest(df: DataFrame, every: int = EVERY) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: a Merkle tree a language, one over them.

    A leaf is the sha256 (lowercase hex) of doc_id, source, lang, n_chars and text, each '-' if null, else its UTF-8 length,
    ':' and itself. In a language, leaves ascend by doc_id (null first, then by digest, so the order of repeated ids does not
    depend on files); while several nodes remain, every two in a row become the digest of their digests' text, a last one
    alone too. Languages ascend by bytes, null first, and their roots make the upper tree. ``proof_sha256`` is the digest of a
    leaf's siblings from its own level to the root. Where 7 divides the unsigned crc32 of doc_id, the tampered leaf has one
    more n_chars (null stays null), and ``folded_root`` is what that leaf gives with the original siblings.

    Leaves are digested where the text is read; nothing else reads texts. Of the tree only every ``every``-th level is stored.
    Proofs are extracted from the top down: each aligned subtree (2 ** every digests) works out its inner nodes again from the
    stored ones below, adds its siblings to the path of its top, and drops them. Neither a language with most of the rows nor
    a third of repeated rows meets in one task: places come from a sort by range that ends in a row number, and groups are
    aligned subtrees. All of it is column expressions. An empty table gives no rows; long texts cost their length once; other
    columns do not matter.
    """
    c = {x: F.col(f"`{x}`") for x in FIELDS}
    hit = F.crc32(c["doc_id"].cast("string").cast("binary")) % 7 == 0
    tampered = F.when(hit & c["n_chars"].isNotNull(), _leaf(c | {"n_chars": c["n_chars"].cast("decimal(20,0)") + 1}))
    tree = F.coalesce(F.concat(F.lit("="), c["lang"].cast("string")), F.lit(""))  # null first, and joined like a value
    read = df.select(tree.alias("tree"), c["doc_id"].cast("long").alias("doc_id"), _leaf(c).alias("digest"), tampered.alias("tampered"))
    rows = stored(read.withColumn("uid", F.monotonically_increasing_id()))
    leaves = stored(numbered(rows, "tree", ["doc_id", "digest", "uid"]).drop("uid"))
    langs = build(leaves.select("tree", "pos", "n", "digest"), every)
    subroots = stored(langs.roots.select(F.lit("").alias("all"), F.col("tree").alias("lang"), "digest"))
    upper = stored(numbered(subroots, "all", ["lang"]).withColumnRenamed("all", "tree"))
    top = build(upper.select("tree", "pos", "n", "digest"), every)
    root = top.roots.select("digest").first()
    whole = top.roots.select("tree", F.array().cast(_PATH).alias("above"))
    tops = stored(extract(top, whole, upper, every, ("lang",)).select(F.col("lang").alias("tree"), F.col("path").alias("above")))
    out = extract(langs, tops, leaves, every, ("doc_id", "tampered"))
    given = F.lit(root["digest"] if root else None).cast("string")
    proof = F.sha2(F.array_join(F.col("path.sib"), ""), 256)
    found = out.select("doc_id", F.col("digest").alias("leaf"), "subroot", given.alias("root"), proof.alias("proof_sha256"), folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
