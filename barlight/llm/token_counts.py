"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where both chunks must agree."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import bounded_batches, placed, stored, texts

_CACHED_WORDS = 150_000
_JOINED = 512  # new words encoded by one call
_SIDE = "array<struct<start: int, end: int, id: int>>"


def _small_counts(path: str):
    """mapInArrow function: tokens of each text, each distinct blank-separated word encoded once while it is cached.

    A word is encoded like it is in its text: the tokenizer turns blanks into one space and drops it before words are split,
    so no token, merge or composition reaches over a blank. Only ASCII blanks cut; the rest is left to the tokenizer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        known: dict[bytes, int] = {}
        for batch in batches:
            words = [t.split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            if len(known) > _CACHED_WORDS:
                known.clear()
            new = list({w for doc in words for w in doc if w not in known})
            for i in range(0, len(new), _JOINED):
                part = new[i : i + _JOINED]
                spelled = [w.decode("utf-8", "replace") for w in part]
                starts = [a for a, _ in tokenizer.encode(" ".join(spelled), add_special_tokens=False).offsets]
                ends = np.cumsum([len(w) + 1 for w in spelled])
                known.update(zip(part, np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(part)).tolist(), strict=True))
            counts = [sum(map(known.__getitem__, doc)) for doc in words]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["uid", "doc_id", "n_bytes", "n"])

    return run


def _tokenizer(path: str):
    """The library's tokenizer on one thread; Spark runs the tasks side by side."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _chunk_sides(path: str, size: int, overlap: int):
    """mapInArrow function: tokens of a chunk, and those of its first and last ``overlap`` characters with their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        side = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("id", pa.int32())]))
        for batch in batches:
            n, heads, tails = [], [], []
            for i, text in zip(batch.column("i").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                e = tokenizer.encode(text, add_special_tokens=False)
                spans, ids = e.offsets, e.ids
                head = bisect_left(spans, (overlap, 0)) if i else 0
                tail = len(spans)
                while tail and spans[tail - 1][1] > size:
                    tail -= 1
                n.append(len(ids))
                heads.append([{"start": a, "end": b, "id": k} for (a, b), k in zip(spans[:head], ids[:head], strict=True)])
                tails.append([{"start": a - size, "end": b - size, "id": k} for (a, b), k in zip(spans[tail:], ids[tail:], strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("i"), pa.array(n, pa.int64()), pa.array(heads, side), pa.array(tails, side)], names=["uid", "i", "n", "head", "tail"])

    return run


def splice(tail: list, head: list) -> tuple[int, int] | None:
    """Tokens to leave out of the left chunk's tail and of the right chunk's head, or None if no boundary is proven.

    A boundary is proven where both streams leave the same gap between two equal tokens: the gap is blank, and nothing
    reaches over a blank, so the left stream is right up to it and the right stream from it on.
    """
    ends = {(a["start"], a["end"], a["id"], b["start"], b["end"], b["id"]): k for k, (a, b) in enumerate(zip(tail, tail[1:], strict=False)) if b["start"] > a["end"]}
    for k, (a, b) in enumerate(zip(head, head[1:], strict=False)):
        at = ends.get((a["start"], a["end"], a["id"], b["start"], b["end"], b["id"]))
        if b["start"] > a["end"] and at is not None:
            return len(tail) - at - 1, k + 1
    return None


def _splices():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [splice(t, h) for t, h in zip(batch.column("tail").to_pylist(), batch.column("head").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array([-sum(f) if f else 0 for f in found], pa.int64()), pa.array([f is None for f in found])], names=["uid", "n", "open"]
            )

    return run


def _large_counts(large: DataFrame, path: str, size: int, overlap: int) -> DataFrame:
    """(uid, n, open) of documents in chunks; ``open`` marks those with a seam that no boundary closes."""
    pieces = f"regexp_extract_all(text, '(?s).{{1,{size}}}', 0)"
    cut = f"posexplode(zip_with({pieces}, slice({pieces}, 2, greatest(1, length(text))), (a, b) -> concat(a, left(coalesce(b, ''), {overlap})))) as (i, piece)"
    chunks = large.selectExpr("uid", cut).repartition("uid", "i")
    sides = stored(chunks.mapInArrow(_chunk_sides(path, size, overlap), f"uid long, i int, n long, head {_SIDE}, tail {_SIDE}"))
    left = sides.select("uid", (F.col("i") + 1).alias("i"), "tail")
    right = sides.filter("i > 0").select("uid", "i", "head")
    seams = left.join(right, ["uid", "i"]).select("uid", "tail", "head").mapInArrow(_splices(), "uid long, n long, open boolean")
    return sides.select("uid", "n", F.lit(False).alias("open")).unionByName(seams).groupBy("uid").agg(F.sum("n").alias("n"), F.max("open").alias("open"))


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1 << 15, overlap: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, as the tokenizers library counts the whole text.

    Texts of up to ``size`` characters are counted at once. Longer ones are cut into chunks of ``size`` characters, each with
    the next ``overlap`` characters besides, which other tasks may encode; the two encodings of an overlap are spliced at a
    boundary that both prove. A document with a seam that cannot be closed is cut again with four times the chunk and
    overlap, until it closes or is one chunk. No special tokens are added; their strings in a text count as the library
    takes them. Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted
    each: rows are told apart by file and row number, and a frame that is not read from files is written once. ``path`` must
    be readable on the executors.
    """
    bounded_batches(df.sparkSession)
    rows = texts(placed(df), id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    schema = "uid long, doc_id long, n_bytes long, n long"
    small = rows.filter(F.length("text") <= size).select("uid", "doc_id", "n_bytes", "text").mapInArrow(_small_counts(path), schema)
    large = rows.filter(F.length("text") > size)
    done = None
    todo = large.select("uid", "text")
    while True:
        counted = stored(_large_counts(todo, path, size, overlap))
        closed = counted.filter("not open").select("uid", "n")
        done = closed if done is None else done.unionByName(closed)
        if counted.filter("open").isEmpty():
            break
        size, overlap = size * 4, overlap * 4
        todo = todo.join(counted.filter("open").select("uid"), "uid", "left_semi")
    spliced = large.select("uid", "doc_id", "n_bytes").join(done, "uid").select("uid", "doc_id", "n_bytes", "n")
    return small.unionByName(spliced).select("doc_id", "n_bytes", F.col("n").alias("n_tokens"))
