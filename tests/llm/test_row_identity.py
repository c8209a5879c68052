"""Rows keep their number however a scan is planned: plans are built at one parallelism and run at another."""

from __future__ import annotations

import pytest

from barlight.llm import common, decontaminate, line_dedup, ngram_join, queries, suffix_dedup, token_counts

SF = "/root/testdata/sf0.01"
WIDE = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "documents.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(5).write.option("parquet.block.size", 1 << 16).parquet(path)
    return path



OPERATORS = {
    "line_dedup": lambda docs: line_dedup.dedup_lines(docs).select("row.doc_id", "n_removed", "text"),
    "ngram_join": lambda docs: ngram_join.keep_one(docs),
    "decontamination": lambda docs: decontaminate.without_leaks(docs, docs.sparkSession.read.parquet(f"{SF}/benchmark.parquet")),
    "token_counts": lambda docs: token_counts.count_tokens(docs, queries.vocabulary(queries.WORD_BPE), size=2000, overlap=100),
    "suffix_dedup": lambda docs: suffix_dedup.dedup_bytes(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_built_at_one_parallelism_and_run_at_another(spark, folder, name):
    def rows(build, run):
        spark.conf.set(WIDE, build)
        made = OPERATORS[name](spark.read.parquet(folder))
        spark.conf.set(WIDE, run)
        return sorted(map(str, made.collect()))

    try:
        assert rows("2", "23") == rows("7", "7")
    finally:
        spark.conf.unset(WIDE)


def test_numbers_are_the_same_in_every_scan_and_no_two_rows_share_one(spark, folder):
    def numbers(parallelism):
        spark.conf.set(WIDE, parallelism)
        p = common.placed(spark.read.parquet(folder).select("doc_id"))
        return {r["uid"]: r["doc_id"] for r in p.df.select(p.uid.alias("uid"), "doc_id").collect()}

    try:
        one, other = numbers("1"), numbers("17")
    finally:
        spark.conf.unset(WIDE)
    assert one == other and len(one) == 1000


def test_frames_without_own_rows_are_written_once(spark, folder):
    docs = spark.read.parquet(folder)
    twice = spark.read.parquet(folder, folder)
    for df in (twice, docs.union(docs), docs.selectExpr("*", "explode(array(1, 2)) as e"), spark.range(2000), docs.crossJoin(spark.range(2))):
        p = common.placed(df)
        seen = p.df.select(p.uid.alias("uid")).distinct().count()
        assert seen == df.count() == 2000


def test_filtered_files_are_not_written_again(spark, folder):
    docs = spark.read.parquet(folder).filter("doc_id % 3 = 0")
    assert common.placed(docs).df is docs
