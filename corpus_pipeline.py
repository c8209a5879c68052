"""Documents through language ID, line dedup, near-duplicate removal, decontamination and SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept, read again from Parquet files. All but the
last return the columns of ``documents``. A null text counts as empty and has no language, so the first stage rejects it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.llm import decontaminate, language, line_dedup, ngram_join, pieces
from barlight.llm.queries import PIECES, vocabulary
from barlight.session import shared_folder, use_utc

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with margin; those without a letter or with a tie go.

    Null and empty texts have no letter. Very long texts are packed whole. Repeated rows are judged alike; a null ``lang`` or
    ``doc_id`` teaches nothing more than its text allows and is no reason to go. An empty table stays empty.
    """
    return language.keep_accepted(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs, ``n_chars`` to match; a document of which no line is left goes.

    A null or empty text is one empty line and stays as it is. Of repeated rows the first stays, a null ``doc_id`` counts as
    the last. Very long texts are one row of lines. An empty table stays empty.
    """
    kept = line_dedup.dedup_lines(docs).filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_removed") == 0))
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return kept.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of shingle links: the smallest ``doc_id`` (null last), then the first row.

    Texts without a word (null, empty, blank) belong to no component and stay. Repeated rows are one component. Very long texts
    are sets like any other. An empty table stays empty.
    """
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts hold none and stay; very long texts are searched whole; repeated rows stay or go together; an empty
    table, or an empty benchmark, leaves the documents as they are.
    """
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, round_trip, ids) of every document, in no order.

    Null and empty texts have no ids. Repeated rows are encoded each, a null ``doc_id`` is kept. Very long texts are encoded
    whole. An empty table gives no rows.
    """
    return pieces.encode(docs, vocabulary(PIECES))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", repeated_lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Stages are written to a folder of this run under ``spark.checkpoint.dir``."""
    folder = f"{shared_folder(use_utc(spark))}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
