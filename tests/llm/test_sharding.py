from __future__ import annotations

import zlib

from brute import awkward, empty

from barlight.llm import sharding

SF = "/root/testdata/sf0.01"


def test_sizes_are_near_equal_and_slots_gapless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sharding.kd_shards(docs, 40).toPandas()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    assert len(got) == len(texts)
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in got.itertuples())
    by = got.groupby("shard")
    assert sorted(by.groups) == list(range(40))
    assert by["size"].sum().max() - by["size"].sum().min() <= 2 * got["size"].max()
    assert all(sorted(g) == list(range(len(g))) for _, g in by["slot"])


def test_a_hot_source_of_equal_rows_is_cut(spark):
    df = spark.range(3000).selectExpr("if(id < 1500, 7, id) as doc_id", "repeat('a', 100) as text", "if(id < 2000, 'hot', string(id)) as source")
    got = sharding.kd_shards(df, 8).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == 3000 and len(sizes) == 8 and sizes.max() - sizes.min() < 0.1 * sizes.mean()


def test_awkward_rows_and_an_empty_table(spark):
    df = awkward(spark)
    got = sharding.kd_shards(df, 4, dims=("lang", "source", "size", "doc_id")).toPandas()
    assert len(got) == df.count() and got["shard"].between(0, 3).all()
    assert got[got["doc_id"] == 4]["size"].tolist() == [16] and got[got["doc_id"] == 4]["text_crc32"].tolist() == [0]
    assert sharding.kd_shards(empty(spark), 4).count() == 0
