from __future__ import annotations

import random
import zlib

import pytest
from brute import LONG, as_files, awkward, empty, rows
from pyspark.sql import functions as F

from barlight.llm import decontaminate, language, pieces, token_counts, topk
from barlight.llm.queries import PIECES, SQL, WORD_BPE, vocabulary

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_rows(spark, documents):
    got = language.identify(documents).join(documents.select("doc_id", F.col("lang").alias("truth")), "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got["doc_id"]]).all()
    own = got[got["held_out"]]
    assert (own["lang_pred"] == own["truth"]).mean() > 0.97
    assert got["score"].between(0, 1).all() and got["accepted"].mean() > 0.98


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, documents):
    first = language.identify(documents.limit(300))
    other = documents.limit(300).withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert rows(first) == rows(language.identify(other))


def test_language_of_awkward_rows(spark, tmp_path):
    docs = as_files(spark, awkward(spark), tmp_path)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert [got[d].lang_pred for d in (3, 4, 9, 10)] == ["und"] * 4
    assert set(r.lang_pred for r in got.values()) <= {"und", "en", "de", "la"}
    kept = language.keep_accepted(docs)
    assert kept.columns == docs.columns and not {3, 4, 9, 10} & {r.doc_id for r in kept.collect()}
    assert language.identify(empty(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    with pytest.raises(ValueError):
        language.train(docs, max_languages=2)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(WORD_BPE))


def awkward_texts():
    rng = random.Random(9)
    parts = ["word", "<|endoftext|>", "<|startoftext|>x", " ", "\n", " ", " ", "é", "́", "don't", "'ll", "ÀÉ", "日本", "12", "...", "\x1c", "\x85", "🙂"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(120)] + [LONG, "", "y" * 3000]


@pytest.mark.parametrize(("size", "overlap"), [(1 << 15, 512), (64, 16), (40, 4)])
def test_counts_equal_the_library(spark, tokenizer, size, overlap):
    texts = awkward_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(df, vocabulary(WORD_BPE), size=size, overlap=overlap).collect()}
    assert got == {i: (len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False))) for i, t in enumerate(texts)}


def test_counts_of_awkward_rows(spark, tokenizer):
    df = awkward(spark)
    got = rows(token_counts.count_tokens(df, vocabulary(WORD_BPE)))
    assert sum(got.values()) == df.count() and got[(4, 0, 0)] == 1 and got[(3, 0, 0)] == 1
    assert token_counts.count_tokens(empty(spark), vocabulary(WORD_BPE)).count() == 0


def word_soup():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdet  \n\tñé日.,1<>▁") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    return texts + ["", " ", "  a  b\n\n c ", "日本語テキスト 🙂🙂", "<s> hello </s>", "<0x0A>", "\x00abc", "ab" * 700 + " end", " " * 37 + "z"]


def test_ids_equal_the_library_and_decode_to_the_text(spark):
    import sentencepiece

    sp, texts = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES)), word_soup()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.encode(df, vocabulary(PIECES)).collect()}
    assert {i: list(r.ids) for i, r in got.items()} == dict(enumerate(sp.encode(texts)))
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got.values())
    encoder = pieces.Encoder(pieces.load(vocabulary(PIECES)))
    import numpy as np

    assert all(encoder.decode(np.array(r.ids, int)) == texts[i].replace("▁", " ") for i, r in got.items())


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_viterbi_equals_the_library_on_a_unigram_model(byte_fallback):
    """The same pieces with scores in 64ths, whose sums are exact, as a unigram model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(vocabulary(PIECES), "rb") as f:
        m = proto.ModelProto.FromString(f.read())
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, byte_fallback
    kept = [p for p in m.pieces if byte_fallback or p.type != 6]
    for p in kept:
        if p.type == 1:
            p.score = -(64 + zlib.crc32(p.piece.encode()) % 997) / 64
    del m.pieces[:]
    m.pieces.extend(kept)
    sp, encoder, texts = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString()), pieces.Encoder(pieces.from_proto(m)), word_soup()
    flat, sizes = encoder.encode(texts)
    ends = sizes.cumsum()
    assert [flat[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == sp.encode(texts)


def test_pieces_of_awkward_rows(spark):
    df = awkward(spark)
    got = pieces.encode(df, vocabulary(PIECES)).collect()
    assert len(got) == df.count() and all(r.round_trip for r in got)
    assert pieces.encode(empty(spark), vocabulary(PIECES)).count() == 0


def brute_top(vectors, k):
    import math

    v = [(i, [math.floor(1024 * float(c)) for c in x]) for i, x in vectors]
    out = {}
    for q, a in v:
        if q % 100 == 0:
            scored = sorted((-sum(s * t for s, t in zip(a, b, strict=False)), i) for i, b in v if i != q)
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def test_top_k_of_the_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0, block_rows=130).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute_top([(r.vec_id, r.embedding) for r in df.collect()], 10)


def test_top_k_with_ties_hot_vectors_and_unusable_rows(spark):
    rng = random.Random(6)
    vectors = [(i, [0.5, -0.25, 0.125]) for i in range(300)] + [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(300, 800)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    bad = spark.createDataFrame([(900, None), (901, [1.0, None, 2.0]), (1000, [float("nan")] * 3), (902, []), (None, [1.0] * 3), (903, [float("inf")] * 3)], "vec_id long, embedding array<float>")
    both = df.unionByName(bad).withColumns({"cell": F.lit("x"), "v": F.lit(1), "far": F.lit(None).cast("string"), "is_query": F.lit("no")})
    got = {}
    for r in topk.top_k(both, F.col("vec_id") % 100 == 0, block_rows=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_top([(r.vec_id, r.embedding) for r in df.collect()], 10)
    assert {q: sorted(v) for q, v in got.items()} == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(df.filter("vec_id = 300 or vec_id = 301"), F.col("vec_id") % 100 == 0).count() == 1


def test_planted_benchmark_items_and_no_others(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    squeeze = lambda s: " ".join(s.lower().split())
    docs = [(r.doc_id, squeeze(r.text)) for r in documents.collect()]
    want = {(d, r.item_id) for r in items.collect() for d, t in docs if squeeze(r.text) in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, items).collect()}
    assert want and got == want


ITEM = "A train leaves Boston at 60 km per hour and after 60 minutes another train leaves Chicago at 90 km per hour, so when do they meet?"
CHANGED = "Quiz. A train leaves Denver at 75 km per hour and after 75 minutes another train leaves Dallas at 95 km per hour, so when do they meet? End."
BROKEN = "Quiz. A train leaves Denver at 75 km per hour and after 33 minutes another train leaves Dallas at 95 km per hour, so when do they meet? End."


@pytest.mark.parametrize("broadcast_windows", [1000, 0])
def test_reparameterised_items_need_consistent_slots(spark, tmp_path, broadcast_windows):
    docs = spark.createDataFrame([(1, ITEM), (2, CHANGED), (3, BROKEN), (4, "Nothing of that kind is in this document at all, it is clean."), (5, ITEM.upper()), (6, None), (7, "")], "doc_id long, text string")
    docs = as_files(spark, docs.withColumns({"h": F.lit("x"), "at": F.lit(1), "size": F.lit(2)}), tmp_path)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "short item")], "item_id long, text string").withColumn("doc_id", F.lit(9))
    got = {(r.doc_id, r.item_id): r.changed for r in decontaminate.leaks(docs, items, broadcast_windows=broadcast_windows).collect()}
    assert got == {(1, 1): False, (2, 1): True, (5, 1): False} or got == {(1, 1): False, (2, 1): True}
    clean = decontaminate.without_leaks(docs, items)
    assert clean.columns == docs.columns and {3, 4, 6, 7} <= {r.doc_id for r in clean.collect()} and 1 not in {r.doc_id for r in clean.collect()}
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast_windows", [1000, 0])
def test_items_of_few_literal_words_are_found_as_they_stand(spark, tmp_path, broadcast_windows):
    names = "Friends: " + ", ".join(f"the {a} {b}" if i % 3 == 0 else f"{a} {b}" for i, (a, b) in enumerate(zip(["Anna", "Boris", "Clara", "Dora", "Emil", "Fritz"], ["Abel", "Bauer", "Curie", "Dietz", "Euler", "Frey"], strict=True))) + " met."
    items = [(1, "Compute 12 + 7 - 3 * 5 = ?"), (2, "What is 15 % of 240 kg ?"), (3, names)]
    docs = [(i, f"Some words come before. {t} And some words come after it.") for i, t in items]
    docs += [(4, "Some words come before. Compute 12 + 8 - 3 * 5 = ? And more."), (5, "Fine. What is 15 % of 250 kg ? More."), (6, names.replace("Anna", "Mary").replace("Clara", "Jean").replace("Emil", "Lee").replace("Boris", "Max"))]
    found = decontaminate.leaks(as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path), spark.createDataFrame(items, "item_id long, text string"), broadcast_windows=broadcast_windows)
    assert {(r.doc_id, r.item_id, r.coverage, r.changed) for r in found.collect()} == {(i, i, 1.0, False) for i, _ in items}


NAMED = "In the morning Anna sold three old books to Boris at the market near the river, and later Clara gave all of them back to Anna in return for some cheese."


def test_longer_slot_values_and_added_words_are_one_alignment(spark, tmp_path):
    longer = NAMED.replace("Anna", "Mary Ann").replace("Boris", "Jean Paul").replace("Clara", "Lee Smith")
    added = NAMED.replace("old", "very old").replace("gave all", "soon gave all").replace("Anna", "Mary")
    broken = longer.replace("to Mary Ann", "to Peter Pan")
    counted = "The list of all the numbers drawn is 12 30 and the answer to this is 45"
    docs = [(1, longer), (2, added), (3, broken), (4, NAMED + " Anna knew."), (5, f"Question. {counted} 46 47 is next."), (6, "Nothing of that kind is in this one.")]
    docs += [(7, "They sang row your boat and row your boat and went home.")]
    items = [(1, NAMED), (2, counted), (3, "row your boat and " * 8)]
    found = decontaminate.leaks(as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.coverage, r.changed) for r in found.collect()}
    assert got[1, 1] == (1.0, True) and got[4, 1] == (1.0, False) and got[5, 2] == (1.0, False)
    assert got[2, 1][0] > 0.7 and got[2, 1][1] and set(got) <= {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2)}
    assert got.get((3, 1), (0.0,))[0] < 1.0


REWORDED = [
    ("Anna has 12 red apples and 7 pears.", "Mary has 15 red apples and 9 pears."),
    ("Weng earns $12 an hour for babysitting.", "Bob earns $15 an hour for babysitting."),
    (
        "A shop sells three pens for five dollars and two books for nine dollars every day.",
        "A shop sells six pens for twenty-one dollars and four books for eight dollars every day.",
    ),
]


def test_opening_names_and_spelled_out_numbers_are_slots(spark, tmp_path):
    items = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(REWORDED)], "item_id long, text string")
    docs = [(i, b) for i, (_, b) in enumerate(REWORDED)] + [(10 + i, f"Here, in passing: {a} So it goes.") for i, (a, _) in enumerate(REWORDED)]
    docs += [(20, "A shop sells ink and paper. Bob earns little. Mary has no pears."), (21, "Anna has 12 red apples and Mary has 12 pears.")]
    found = decontaminate.leaks(as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path), items)
    got = {(r.doc_id, r.item_id): r.changed for r in found.collect()}
    assert {k: v for k, v in got.items() if k[0] < 20} == {**{(i, i): True for i in range(3)}, **{(10 + i, i): False for i in range(3)}}
    assert 20 not in {d for d, _ in got}


def test_very_long_texts_are_searched_whole(spark, tmp_path):
    docs = [(1, "some words of no item at all " * 60_000 + ITEM), (2, "filler " * 200_000)]
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    found = decontaminate.leaks(as_files(spark, spark.createDataFrame(docs, "doc_id long, text string"), tmp_path), items)
    assert [(r.doc_id, r.coverage) for r in found.collect()] == [(1, 1.0)]


def test_registered_sql_names_registered_queries():
    from barlight.llm.queries import QUERIES

    assert set(SQL) <= set(QUERIES) and [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
