from __future__ import annotations

import random
from collections import Counter

from brute import as_files, awkward, empty, ngram_components, removed_bytes, removed_lines, rows

from barlight.llm import components, line_dedup, ngram_join, suffix_dedup
from barlight.llm.common import stored_anew

SF = "/root/testdata/sf0.001"


def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def line_soup(rng):
    pool = ["A line that is long enough to count by itself, really.", "short.", "", "tiny", "Another line of middling size", "x" * 39, "x" * 38]
    return "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))


def test_line_runs_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i // 2, line_soup(rng)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = line_dedup.dedup_lines(as_files(spark, df, tmp_path)).select("row.doc_id", "text", "n_removed")
    want = Counter()
    for (d, t), gone in zip(docs, removed_lines(docs), strict=True):
        want[(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone), len(gone))] += 1
    assert rows(got) == want


def test_line_runs_of_the_given_table(spark):
    docs = sorted((r.doc_id, r.text) for r in small(spark).collect())
    want = Counter((d, len(g)) for (d, _), g in zip(docs, removed_lines(docs), strict=True))
    assert rows(line_dedup.dedup_lines(small(spark)).select("row.doc_id", "n_removed")) == want


def near_copies(rng, base, edits):
    words = base.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_of_shingles_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    bases = [" ".join(word() for _ in range(rng.choice([3, 5, 8, 40, 120]))) for _ in range(12)]
    passage = " ".join(word() for _ in range(30))
    docs = []
    for b in bases:
        docs += [b, b.upper(), b.replace(" ", "\t\n")]
        docs += [near_copies(rng, b, rng.randint(0, 3)) for _ in range(rng.choice([1, 4, 40]))]
    docs += [" ".join(word() for _ in range(40)) + " " + passage for _ in range(60)]
    docs += ["", " ", "a", "a a a a a a a", "a a a a a", "É é", "é É"]
    docs = list(enumerate(docs))
    df = as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path)
    got = ngram_join.join_ngrams(df).select("doc_id", "n_shingles", "component_id", "n_links")
    assert rows(got) == ngram_components(docs)


def test_a_cluster_of_several_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(8)
    base = " ".join(f"b{i}" for i in range(60))
    docs = list(enumerate([base] + [near_copies(rng, base, rng.randint(1, 2)) for _ in range(150)]))
    df = as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path)
    got = ngram_join.join_ngrams(df).select("doc_id", "n_shingles", "component_id", "n_links")
    assert rows(got) == ngram_components(docs)


def test_sql_prefix_equals_the_python_one(spark):
    sizes = [*range(1, 400), 1250, 10**4, 10**6]
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    got = {r.n: (r.p, r.e) for r in df.select("n", ngram_join._prefix_column("n").alias("p"), ngram_join._extension_column("n").alias("e")).collect()}
    assert got == {n: (ngram_join.prefix(n), ngram_join.extension(n)) for n in sizes}


def test_one_row_of_each_component_stays(spark, tmp_path):
    docs = as_files(spark, awkward(spark), tmp_path)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    by_id = Counter(r.doc_id for r in kept.collect())
    assert by_id == Counter({1: 1, 3: 1, 4: 1, None: 1, 6: 1, 8: 1, 9: 1, 10: 1})


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1200), 1000)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_few_edges_come_in_few_parts(spark):
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        roots = components.components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
        assert roots.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert {(r.node, r.root) for r in roots.collect()} == {(i, 0) for i in range(41)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_components_of_a_long_path_in_any_numbering(spark):
    names = random.Random(6).sample(range(10**9), 5000)
    edges = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "a long, b long")
    roots = components.components(edges, rounds=20)
    assert {(r.node, r.root) for r in roots.collect()} == {(n, min(names)) for n in names}


def test_size_estimates_do_not_grow_with_the_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    roots = components.components(edges)
    assert roots._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 64


def test_what_is_stored_anew_has_the_same_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (None, "", 2.5)], "n long, s string, x double")
    kept = stored_anew(df)
    assert kept.schema == df.schema and rows(kept) == rows(df)


def byte_soup(rng):
    pool = ["abcde" * 12, "the passage that is shared by many documents and is long enough to count", "é" * 30, "z" * 120, "0123456789" * 6]
    return "".join(rng.choice([rng.choice(pool), rng.choice(pool)[rng.randint(0, 30) :], str(rng.random())]) for _ in range(rng.randint(0, 6)))


def test_removed_bytes_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    docs = [(rng.choice([None, *range(60)]), byte_soup(rng)) for _ in range(150)]
    df = as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path)
    assert rows(suffix_dedup.dedup_bytes(df)) == removed_bytes(docs)


def test_removed_bytes_with_small_runs_segments_and_hot_anchors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN", 300)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 97)
    monkeypatch.setattr(suffix_dedup, "HOT", 4)
    docs = [(r.doc_id, r.text[:3000]) for r in small(spark).limit(60).collect()]
    rng = random.Random(2)
    docs += [(1000 + i, byte_soup(rng)) for i in range(80)]
    df = as_files(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), tmp_path)
    assert rows(suffix_dedup.dedup_bytes(df)) == removed_bytes(docs)


def test_loser_tree_merges_and_gives_common_prefixes():
    rng = random.Random(4)
    for _ in range(50):
        runs = []
        for _ in range(rng.randint(0, 9)):
            strings = sorted("".join(rng.choices("ab", k=rng.randint(0, 6))).encode() for _ in range(rng.randint(0, 8)))
            lcp = [0] + [next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))) for a, b in zip(strings, strings[1:], strict=False)]
            runs.append((strings, lcp[: len(strings)]))
        order, lcps = suffix_dedup.merge(runs)
        got = [runs[r][0][p] for r, p in order]
        assert got == sorted(s for run, _ in runs for s in run)
        for a, b, n in zip(got, got[1:], lcps[1:], strict=False):
            assert n == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    docs = as_files(spark, awkward(spark), tmp_path)
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows(suffix_dedup.dedup_bytes(docs)) == removed_bytes(plain)
    assert rows(ngram_join.join_ngrams(docs).select("doc_id", "n_shingles", "component_id", "n_links")) == ngram_components(plain)
    lines = line_dedup.dedup_lines(docs)
    assert lines.count() == len(plain) and lines.select("row.*").columns == docs.columns
    none = empty(spark)
    assert suffix_dedup.dedup_bytes(none).count() == 0
    assert ngram_join.join_ngrams(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
