"""Jaccard join of word shingles by token-combination prefixes, exact."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import Placed, bounded_batches, cut, placed, stored, stretches, texts
from barlight.llm.components import components

WORDS = 5
ZONE = 0.5  # share of the hash space whose shingles every document posts
RARE = 8  # distinct texts up to which a posted shingle is rare
SPARE = 2  # rare shingles that a pair may share without being a candidate for it
BUCKET = 1 << 17  # postings a bucket holds about
BLOCK = 512  # texts compared at once
_CACHED_WORDS = 120_000
_STEP = 1.26  # sizes of linked sets differ by a factor of 1.25 at most, so by one level at most
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash of a word, kept while the table is small."""

    def __init__(self) -> None:
        import xxhash

        super().__init__()
        self.digest = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        h = self[word] = self.digest(word)
        return h


class Shingles:
    """Sorted distinct 64-bit shingle hashes of texts, given as UTF-8."""

    def __init__(self) -> None:
        self.known = _Words()

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: only A-Z change, only ASCII blanks split
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        size = min(WORDS, len(words))
        n = len(words) - size + 1
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = (out + h[k : k + n]) * _ODD
            out ^= out >> np.uint64(32)
        out = _mix(out)
        out.sort()
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


def level(n: int) -> int:
    return int(math.log(n) / math.log(_STEP))


def classes(at: int) -> int:
    """Classes of frequent shingles for a level: about a quarter of the plain prefix."""
    return max(1, math.ceil(0.05 * _STEP**at))


def extension(n: int) -> int:
    return classes(level(n) + 1) + SPARE


def prefix(n: int) -> int:
    """Prefix length: two linked sets share at least 1 + the smaller extension of shingles within their prefixes."""
    return min(n, n - (80 * n + 99) // 100 + 1 + extension(n))


def posted(s: np.ndarray) -> int:
    return max(int(np.searchsorted(s, np.uint64(int(ZONE * 2**64)))), prefix(len(s))) if len(s) else 0


def _key(s: np.ndarray) -> int:
    """One key for equal sets, as a signed 64-bit number."""
    import xxhash

    k = xxhash.xxh3_64_intdigest(s.tobytes())
    return k - (1 << 64) if k >> 63 else k


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles()
    for batch in batches:
        sets = [shingles.of(t) for t in _texts(batch)]
        n = pa.array([len(s) for s in sets], pa.int64())
        z = pa.array([posted(s) for s in sets], pa.int64())
        keys = pa.array([_key(s) if len(s) else None for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), keys, n, z], names=["uid", "doc_id", "key", "n", "z"])


def _postings(buckets: int):
    """mapInArrow function: the posted shingles of many documents, packed by bucket: 48 bits of token, key, and size code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        tokens: list[np.ndarray] = []
        keys: list[int] = []
        codes: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            sizes = [len(t) for t in tokens]
            t = np.concatenate(tokens)
            k = np.repeat(np.array(keys, np.int64), sizes)
            c = np.repeat(np.array(codes, np.uint8), sizes)
            t = _mix(t * _ODD)  # 48 bits besides the bucket tell shingles apart
            b = (t >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16) if buckets <= 1 << 16 else (t >> np.uint64(16)) % np.uint64(buckets)
            order = np.argsort(b, kind="stable")
            t, k, c, b = t[order], k[order], c[order], b[order]
            own, start, ends = stretches(b)
            tokens.clear(), keys.clear(), codes.clear()
            held = 0
            low, high = t.astype(np.uint32), (t >> np.uint64(32)).astype(np.uint16)
            return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *(cut(x, start, ends) for x in (low, high, k, c))], names=["bucket", "low", "high", "k", "c"])

        for batch in batches:
            for text in _texts(batch):
                s = shingles.of(text)
                if len(s):
                    tokens.append(s[: posted(s)])
                    keys.append(_key(s))
                    codes.append(int(2 * math.log(len(s)) / math.log(1.25)))
                    held += len(tokens[-1])
                    if held >= 1 << 19:
                        yield flush()
        if held:
            yield flush()

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Of one bucket: pairs of texts that share rare shingles, with their number, and the frequent shingles of each text."""
    join = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()])
    t = join("low", np.uint32) | (join("high", np.uint16).astype(np.uint64) << np.uint64(32))
    k, c = join("k", np.int64), join("c", np.uint8)
    order = np.lexsort((k, t))
    t, k, c = t[order], k[order], c[order]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    t, k, c = t[fresh], k[fresh], c[fresh].astype(np.int32)
    start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    size = np.diff(np.append(start, len(t)))
    left, right = [], []
    for step in range(1, RARE):
        for first in range(RARE - step):
            at = start[(size <= RARE) & (size > first + step)] + first
            near = np.abs(c[at] - c[at + step]) <= 3
            left.append(k[at[near]])
            right.append(k[at[near] + step])
    a, b = np.concatenate(left), np.concatenate(right)
    if len(a):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        a, b, shared = a[new], b[new], np.diff(np.append(new, len(a)))
    else:
        shared = np.empty(0, np.int64)
    often = np.repeat(size > RARE, size)
    tier = np.repeat(np.log2(size).astype(np.uint64), size)
    ft, fk = (t | tier << np.uint64(48))[often], k[often]
    order = np.argsort(fk, kind="stable")
    ft, fk = ft[order], fk[order]
    own, at, ends = stretches(fk)
    blobs = [ft[i:j].tobytes() for i, j in zip(at, ends, strict=True)]
    return pa.table(
        {
            "a": pa.array(np.concatenate([a, own])),
            "b": pa.array([*b.tolist(), *[None] * len(own)], pa.int64()),
            "shared": pa.array(np.concatenate([shared, ends - at]).astype(np.int64)),
            "t": pa.array([*[None] * len(a), *blobs], pa.binary()),
        }
    )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For texts short of rare shingles: pairs of the frequent ones in their prefix of one class, for their own level and the next."""
    for batch in batches:
        keys, sigs = [], []
        for key, n, r, blobs in zip(*(batch.column(x).to_pylist() for x in ("key", "n", "r", "ts")), strict=True):
            t = np.concatenate([np.frombuffer(x, np.uint64) for x in blobs])
            t.sort()  # by tier, the most frequent last
            t = t[: prefix(n) - r]
            for at in (level(n), level(n) + 1):
                kind = _mix(t + np.uint64(at)) % np.uint64(classes(at))
                order = np.lexsort((t, kind))
                ts, ks = t[order], kind[order]
                step = 1
                while step < len(ts):
                    same = ks[step:] == ks[:-step]
                    if not same.any():
                        break
                    sigs.append(_mix(ts[:-step][same] * _ODD + ts[step:][same] + np.uint64(at)))
                    keys.append(np.full(int(same.sum()), key, np.int64))
                    step += 1
        sig = np.concatenate(sigs).view(np.int64) if sigs else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)), pa.array(sig)], names=["key", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles()
    for batch in batches:
        blobs = pa.array([shingles.of(t).tobytes() for t in _texts(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("cluster"), batch.column("copies"), batch.column("blocks"), blobs], names=["key", "cluster", "copies", "blocks", "s"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets: products of their incidence in slices of shared shingles."""
    m = len(sets)
    who = np.repeat(np.arange(m), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[at] > 1
    slot = np.cumsum(n > 1) - 1
    who, at = who[shared], slot[at[shared]]
    order = np.argsort(at, kind="stable")
    who, at = who[order], at[order]
    out = np.zeros((m, m), np.float32 if (n > 1).sum() < 1 << 24 else np.float64)
    width = max(256, (1 << 22) // m)
    for low in range(0, int((n > 1).sum()), width):
        i, j = np.searchsorted(at, [low, low + width])
        part = np.zeros((m, width), np.float32)
        part[who[i:j], at[i:j] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _verify(table: pa.Table) -> pa.Table:
    """Links within one group of clusters, or across one pair of blocks: (key, root, links) of texts with a link."""
    keys, cluster, copies = (table.column(x).to_numpy() for x in ("key", "cluster", "copies"))
    block = table.column("block").to_numpy()
    blobs = table.column("s").to_pylist()
    x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    order = np.argsort(cluster, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
        if len(members) < 2:
            continue
        sets = [np.frombuffer(blobs[i], np.uint64) for i in members]
        n = np.array([len(s) for s in sets], np.int64)
        both = _overlaps(sets)
        linked = 100 * both >= 80 * (n[:, None] + n[None, :] - both)
        np.fill_diagonal(linked, False)
        if x != y:
            linked &= block[members][:, None] != block[members][None, :]
        links = linked @ copies[members]
        root = np.arange(len(members))
        while True:
            reach = np.where(linked, root[None, :], len(members)).min(1)
            lower = np.minimum(root, reach)
            lower = lower[lower]
            if (lower == root).all():
                break
            root = lower
        some = links > 0
        k = keys[members]
        out.append((k[some], k[root[some]], links[some]))
    cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
    return pa.table({"key": pa.array(cols[0]), "root": pa.array(cols[1]), "links": pa.array(cols[2].astype(np.int64))})


def join_ngrams(df: DataFrame | Placed, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, n_shingles, n_links, component_id) of every row.

    A row's set is its distinct five-word shingles (fewer words: the whole sequence; no word: empty, linked with nothing).
    Two rows link if 100 * intersection >= 80 * union; n_links counts linked rows, component_id is the smallest doc_id that
    links reach. Rows with equal sets are linked. Null texts count as empty, null ids take no part in the smallest id.

    1. Rows of one set become one text by a hash of the set (64 bits; sets are compared by 64-bit shingle hashes).
    2. Each text posts the shingles of the lower half of hash space, and at least its extended prefix. Postings are packed by
       hash bucket. A shingle that more than ``RARE`` texts post is frequent. The global order is: rare ones of that half,
       its frequent ones by frequency, the rest; two linked sets share 1 + extension shingles in their prefixes under it.
    3. Rare shingles are indexed alone. If one of the texts has a whole prefix of rare ones, a linked pair shares at least
       1 + extension of those, so pairs with fewer drop out. Texts short of rare shingles also index pairs of the frequent ones in their
       prefix: these are dealt into SPARE fewer classes than the extension, so a linked pair shares more than SPARE rare
       ones, or two frequent ones of one class; the number of pairs stays in proportion to the text.
    4. Candidates form clusters: a star for each combination, never all pairs of it. A cluster is verified whole, by products
       of incidence matrices; one of more than ``BLOCK`` texts in pairs of blocks, each a task of its own.

    Nothing is capped: the numbers above only shift work between the ways.
    """
    df = placed(df)
    bounded_batches(df.df.sparkSession)
    rows = texts(df, id_col, text_col)
    docs = stored(rows.mapInArrow(_documents, "uid long, doc_id long, key long, n long, z long"))
    distinct = stored(docs.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.min("uid").alias("uid"), F.max("n").alias("n"), F.max("z").alias("z"), F.count("*").alias("copies")))
    buckets = max(1, -(-(distinct.agg(F.sum("z")).first()[0] or 0) // BUCKET))
    packed = rows.select("text").mapInArrow(_postings(buckets), "bucket int, low binary, high binary, k binary, c binary")
    met = stored(packed.groupBy("bucket").applyInArrow(_meet, "a long, b long, shared long, t binary"))

    frequent = met.filter("t is not null").groupBy(F.col("a").alias("key")).agg(F.sum("shared").alias("f"), F.collect_list("t").alias("ts"))
    short = stored(distinct.join(frequent, "key").select("key", "n", "ts", (F.col("z") - F.col("f")).alias("r")).filter(F.col("r") < _prefix_column("n")))
    sigs = stored(short.select("key", "n", "r", "ts").mapInArrow(_signatures, "key long, sig long").distinct())
    hubs = stored(sigs.groupBy("sig").agg(F.min("key").alias("hub"), F.count("*").alias("m")).filter("m > 1").select("sig", "hub"))
    stars = sigs.join(hubs, "sig").filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()

    pairs = met.filter("t is null").groupBy("a", "b").agg(F.sum("shared").alias("shared")).filter(F.col("shared") > SPARE)
    facts = distinct.select("key", "n").join(short.select("key", F.lit(True).alias("short")), "key", "left")
    side = lambda c: facts.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.coalesce("short", F.lit(False)).alias(f"short_{c}"))
    known = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = (100 * F.least("n_a", "n_b") >= 80 * F.greatest("n_a", "n_b")) & (
        (F.col("short_a") & F.col("short_b")) | (F.col("shared") >= 1 + F.least(_extension_column("n_a"), _extension_column("n_b")))
    )
    clusters = components(known.filter(fits).select("a", "b").unionByName(stars))

    sizes = clusters.groupBy("root").agg(F.count("*").alias("m"))
    split = stored(clusters.join(sizes, "root").select(F.col("node").alias("key"), F.col("root").alias("cluster"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    chosen = distinct.join(split, "key").select("uid", "key", "copies", "cluster", "blocks")
    whole = rows.select("uid", "text").join(chosen, "uid").select("key", "cluster", "copies", "blocks", "text")
    sets = whole.mapInArrow(_sets, "key long, cluster long, copies long, blocks int, s binary")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    one = F.col("blocks") == 1
    groups = max(64, buckets)
    dealt = dealt.select(
        "key", "cluster", "copies", "block", "s",
        F.when(one, F.pmod(F.xxhash64("cluster"), F.lit(groups))).otherwise(F.col("cluster")).alias("g"),
        F.when(one, -1).otherwise(F.least("block", "other")).alias("x"),
        F.when(one, -1).otherwise(F.greatest("block", "other")).alias("y"),
    )
    links = stored(dealt.groupBy("g", "x", "y").applyInArrow(_verify, "key long, root long, links long"))
    roots = components(links.filter("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    return _labelled(docs, distinct, links, roots)


def _prefix_column(n: str):
    """``prefix`` as SQL."""
    return F.least(F.col(n), F.col(n) - F.expr(f"(80 * {n} + 99) div 100") + 1 + _extension_column(n))


def _extension_column(n: str):
    """``extension`` as SQL."""
    at = F.expr(f"cast(ln(cast({n} as double)) / ln({_STEP}D) as int)") + 1
    return F.greatest(F.lit(1), F.ceil(F.lit(0.05) * F.pow(F.lit(_STEP), at))) + SPARE


def _labelled(docs: DataFrame, distinct: DataFrame, links: DataFrame, roots: DataFrame) -> DataFrame:
    rooted = distinct.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = stored(rooted.select("key", "least", "copies", "root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    label = stored(
        rooted.join(least, "root").join(counted, "key", "left").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    full = docs.filter("n > 0").join(label, "key").select("uid", "doc_id", F.col("n").alias("n_shingles"), "n_links", "component_id")
    empty = docs.filter("n = 0").select("uid", "doc_id", F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one of each component (its smallest id, then its first row), with all their columns.

    Rows without a word belong to no component and stay. Rows are told apart by file
    and row number; a frame that is not read from files is written once.
    """
    df = placed(df)
    found = join_ngrams(df, id_col, text_col)
    full = found.filter("n_shingles > 0")
    grouped = full.select("uid", "doc_id", F.coalesce("component_id", F.lit(-1)).alias("component_id"))
    first = grouped.groupBy("component_id").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("o"), "uid")).alias("x")).select("x.uid")
    gone = full.select("uid").join(first, "uid", "left_anti")
    return df.whole().join(gone, "uid", "left_anti").select("row.*")
