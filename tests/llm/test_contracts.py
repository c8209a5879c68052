"""First columns and types of every numbered query, as they were agreed."""

from __future__ import annotations

import pytest

from barlight.llm import language, queries

SF = "/root/testdata/sf0.001"
AGREED = {
    "op1": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op4": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op5": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op9": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op10": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op11": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    "op12": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op13": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
}


@pytest.mark.parametrize("number", AGREED)
def test_columns_come_first_and_in_order(spark, number):
    (name,) = [q for q in queries.QUERIES if q.startswith(f"{number}_")]
    got = [f"{n} {t}" for n, t in queries.QUERIES[name](spark, SF).dtypes]
    want = AGREED[number].split(", ")
    assert got[: len(want)] == want


def test_number_characters_are_no_letters(spark):
    labelled = [(i, "der Hund und die Katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in range(40)]
    marks = [(100, "½ ² Ⅷ ①", "en"), (101, "Ⅷ", "en"), (102, "ª", "en"), (103, "_", "en"), (104, "é", "en")]
    df = spark.createDataFrame(labelled + marks, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(df).collect()}
    assert [got[i] == "und" for i in (100, 101, 102, 103, 104)] == [True, True, False, True, False]
