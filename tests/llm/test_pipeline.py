from __future__ import annotations

import random

from brute import as_files, awkward, empty, ngram_components, removed_lines

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def test_stages_over_the_given_table(spark):
    out = cp.run(spark, SF)
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: list(r.ids) for r in out.collect()}
    assert len(got) == out.count() <= len(docs)

    import sentencepiece

    from barlight.llm.queries import PIECES, vocabulary

    accepted = {r.doc_id for r in cp.language_id(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()}
    docs = [(d, t) for d, t in docs if d in accepted]
    cut = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone), gone, t) for (d, t), gone in zip(docs, removed_lines(docs), strict=True)]
    docs = [(d, t) for d, t, gone, old in cut if not gone or len(gone) < len(old.split("\n"))]
    components = {d: c for d, _, c, _ in ngram_components(docs)}
    docs = [(d, t) for d, t in docs if components[d] == d]
    squeeze = lambda s: " ".join(s.lower().split())
    items = [squeeze(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, t in docs if any(i in squeeze(t) for i in items)}
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    want = {d: sp.encode(t) for d, t in docs if d not in leaked}
    assert got == want


def test_stages_keep_columns_and_stand_awkward_rows(spark, tmp_path):
    docs = as_files(spark, awkward(spark), tmp_path)
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() > 0


def test_stages_stand_an_empty_table(spark, tmp_path):
    docs = as_files(spark, empty(spark), tmp_path)
    for k, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path / f"e{k}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() == 0


def test_a_chain_of_near_copies_keeps_one_and_no_plan_grows_with_it(spark, tmp_path):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**7)}" for _ in range(1300)]
    docs = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(300)]
    df = as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path)
    kept = cp.near_duplicates(spark, df, "")
    assert [r.doc_id for r in kept.collect()] == [0]
    assert kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 2000
