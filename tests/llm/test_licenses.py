from __future__ import annotations

import random
import re

import pytest
from brute import awkward, empty, lower_ascii

from barlight.llm import licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text, given=licenses.TEMPLATES, least=licenses.LEAST):
    """The row of one text: every phrase at every place, every template against every block."""
    w = re.findall(WORD, lower_ascii(text or ""))
    places, base, labels, share = [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    for label, template in given:
        t = re.findall(WORD, lower_ascii(template))
        step = 8
        while step < len(t):
            step *= 2
        for start in range(0, len(w), step):
            k, n = len(set(t) & set(w[start : start + 2 * step])), len(set(t))
            if 100 * k >= least * n:
                labels.add(label)
                share = max(share, k / n)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else share


def scanned(df, **more):
    return sorted((tuple(r) for r in licenses.scan_licenses(df, **more).collect()), key=str)


def expected(rows, **more):
    return sorted(((i, *brute(t, **more)) for i, t in rows), key=str)


def check(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert scanned(df, **more) == expected(rows, **more)


def test_phrases_overlap_cross_marks_and_keep_other_letters(spark):
    texts = ["cc by cc by CC-BY", "ccby cc  by\nnc", "all rights\treserved. All Rights Reserved", "General/Public\u0000License general public licenses",
             "cc bÿ ÇC by 𝔠cc by", "general public general public license", "allrights reserved", "K cc by Kcc by", ""]
    check(spark, list(enumerate(texts)))


def test_templates_at_block_edges_with_changed_words(spark):
    rng = random.Random(4)
    rows = []
    for n in range(300):
        label, template = rng.choice(licenses.TEMPLATES)
        words = template.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["the", "x", "license", "of"])
        before = [rng.choice(["the", "of", "a", "license", "word", "software", "mit"]) for _ in range(rng.randrange(150))]
        after = [rng.choice(["the", "to", "version", "3"]) for _ in range(rng.randrange(40))]
        rows.append((n, " ".join(before + words + after)))
    check(spark, rows)
    found = [r for r in expected(rows) if r[-2]]
    assert 50 < len(found) < 300


@pytest.mark.parametrize("least", [50, 80, 100])
def test_own_templates_where_common_words_are_the_prefix(spark, least):
    rng = random.Random(least)
    given = (("one", "a b c d e f g h i j"), ("two", "a b"), ("three", "c c c d"), ("four", "x y z a b c"))
    rows = [(n, " ".join(rng.choice("abcdefghijxyzwvu") for _ in range(rng.randrange(60)))) for n in range(200)]
    check(spark, rows, given=given, least=least)


def test_very_long_text_and_a_word_everywhere(spark):
    notice = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    long = "license mit " * 100_000 + notice + " tail" * 10_000 + " cc by"
    check(spark, [(1, long)] + [(n, "Released under the MIT License") for n in range(2, 60)])


def test_awkward_rows_and_an_empty_table(spark):
    df = awkward(spark)
    assert scanned(df) == expected([(r.doc_id, r.text) for r in df.collect()])
    assert scanned(empty(spark)) == []


def test_no_python_on_executors(spark):
    plan = licenses.scan_licenses(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
