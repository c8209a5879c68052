"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


CLASHING = "uid long, doc_id long, text string, lang string, source string, n_chars long, key string, row string, bucket int, size string, n int"

LONG = ("Lorem ipsum dolor sit amet " * 9000).strip()


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns that clash with inner names."""
    rows = [
        (5, 1, "The cat sat on the mat and the dog ran over the hill.\nSecond line of this very document, long enough.", "en", "a", 10, "k", "r", 1, "s", 2),
        (5, 2, "The cat sat on the mat and the dog ran over the hill.\nSecond line of this very document, long enough.", "en", "a", 10, None, None, None, None, None),
        (5, 2, "The cat sat on the mat and the dog ran over the hill.\nSecond line of this very document, long enough.", "en", "a", 10, None, None, None, None, None),
        (None, 3, "", "en", None, None, None, None, None, None, None),
        (None, 4, None, None, None, None, None, None, None, None, None),
        (1, None, "A text without an id: der Hund und die Katze gehen über den Berg.", "de", "b", 1, "x", "y", 3, "z", 4),
        (1, 6, LONG, "la", "b", 1, "x", "y", 3, "z", 4),
        (1, 7, LONG + " end", "la", "b", 1, "x", "y", 3, "z", 4),
        (1, 8, "x" * 70_000, None, "b", 1, "x", "y", 3, "z", 4),
        (1, 9, " \n\t ", "de", "b", 1, "x", "y", 3, "z", 4),
        (1, 10, "12345 67890", "de", "b", 1, "x", "y", 3, "z", 4),
    ]
    return spark.createDataFrame(rows, CLASHING)


def empty(spark):
    return spark.createDataFrame([], CLASHING)


def as_files(spark, df, tmp_path):
    """The same rows from files, as the operators that tell rows apart by their place need them."""
    path = str(tmp_path / "docs")
    df.write.parquet(path)
    return spark.read.parquet(path)


def lower_ascii(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def shingle_set(text: str | None) -> set:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def ngram_components(docs: list[tuple[int, str]]) -> Counter:
    """Multiset of (doc_id, n_shingles, component_id, n_links)."""
    sets = [shingle_set(t) for _, t in docs]
    parent, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            posts[x].append(i)
    for i, s in enumerate(sets):
        for j, k in Counter(j for x in s for j in posts[x] if j > i).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(docs))


def removed_lines(docs: list[tuple[int, str]], least: int = 40) -> list[set[int]]:
    """Lines of each text in the longest runs that occur earlier; texts in order of place."""
    seqs = [(t or "").split("\n") for _, t in docs]
    where = defaultdict(list)
    for k, lines in enumerate(seqs):
        for i, line in enumerate(lines):
            where[line].append((k, i))
    out = [set() for _ in seqs]
    for k, lines in enumerate(seqs):
        for i, line in enumerate(lines):
            best = 0
            for k2, i2 in where[line]:
                if (k2, i2) >= (k, i):
                    break
                n, other = 0, seqs[k2]
                while i + n < len(lines) and i2 + n < len(other) and lines[i + n] == other[i2 + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x) + 1 for x in lines[i : i + best]) >= least:
                out[k].update(range(i, i + best))
    return out


def removed_bytes(docs: list[tuple[int, str]], length: int = 50) -> Counter:
    """Multiset of (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    order = lambda d: float("inf") if d is None else d
    raws = [(d, (t or "").encode()) for d, t in docs]
    first: dict[bytes, float] = {}
    for d, b in raws:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, order(d)), order(d))
    out = Counter()
    for d, b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < order(d):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[(d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


