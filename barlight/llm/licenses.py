"""License notices: phrases word by word, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import texts

LEAST = 90  # percent of a template's words that a block must hold
SMALLEST = 8  # words of the smallest block step
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# The author's choice of notices, as their licenses ask for them to be written; an argument.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


class Template(NamedTuple):
    label: str
    tokens: tuple[str, ...]  # distinct words
    step: int  # blocks of 2 * step words begin at every step-th word, so that one holds any run of step words
    needed: int  # words that a block must share


def templates(given=TEMPLATES, least: int = LEAST) -> list[Template]:
    out = []
    for label, text in given:
        words = re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))
        if not words:
            raise ValueError(f"a template of {label} has no word")
        step, size = SMALLEST, len(set(words))
        while step < len(words):
            step *= 2
        out.append(Template(label, tuple(sorted(set(words))), step, -(-least * size // 100)))
    return out


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _places(phrase: str) -> Column:
    """Starts of a phrase in ``words``; only texts that hold all of its words are walked."""
    parts = phrase.split(" ")
    here = lambda i: F.forall(F.array(*[F.get("words", i + k) == F.lit(p) for k, p in enumerate(parts)]), lambda x: x)
    holds = F.array_contains("words", parts[0])
    for p in parts[1:]:
        holds &= F.array_contains("words", p)
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), here)
    return F.when(holds & (F.size("words") >= len(parts)), starts).otherwise(F.array().cast("array<int>"))


def word_ranks(words: DataFrame, tokens: list[str]) -> list[str]:
    """Template words by the number of texts that hold them, rarest first: the global order of the join."""
    seen = words.select(F.explode(F.array_intersect(_strings(tokens), "words")).alias("token")).groupBy("token").count()
    n = {r["token"]: r["count"] for r in seen.collect()}  # as many rows as the templates have words
    return sorted(tokens, key=lambda t: (n.get(t, 0), t))


def _blocks(ordered: list[str], known: list[Template], prefixes: list[str]) -> tuple[Column, Column]:
    """Places of prefix words (``hits``), and the blocks around them: array<struct<step, at, b>>, ``b`` being the block's
    template words in global order.

    ``array_intersect`` keeps the order of its first argument, so ``b`` comes out sorted.
    """
    none = F.array().cast("array<struct<step:int,at:bigint,b:array<string>>>")
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(prefixes), i)), lambda i: i.isNotNull())
    parts = [_blocks_of(step, ordered) for step in sorted({t.step for t in known})]
    return F.when(F.arrays_overlap("words", _strings(prefixes)), hits), F.when(F.size("hits") > 0, F.concat(*parts)).otherwise(none)


def _blocks_of(step: int, ordered: list[str]) -> Column:
    home = F.transform("hits", lambda i: F.floor(i / F.lit(step)))
    at = F.filter(F.array_distinct(F.concat(home, F.transform(home, lambda h: h - 1))), lambda a: a >= 0)
    words = lambda a: F.slice("words", (a * step + 1).cast("int"), F.lit(2 * step))
    return F.transform(at, lambda a: F.struct(F.lit(step).alias("step"), a.alias("at"), F.array_intersect(_strings(ordered), words(a)).alias("b")))


def scan_licenses(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", given=TEMPLATES, phrases=PHRASES, least: int = LEAST
) -> DataFrame:
    """One row per row of ``df``: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Base places are where a phrase's words stand
    consecutively, overlapping ones too. A template's label is added where some block of the text holds ``least`` percent of
    the template's distinct words; a block is 2 * step words from a multiple of step on, step being the template's length
    rounded up, so that a notice always lies whole in one. ``score`` is the largest share of a template's words found, 1 for a
    base phrase, 0 where nothing is found.

    The join: template words are ordered by the number of texts that hold them, rarest first. A template that needs m of its
    n words is indexed by its first n - m + 1 (its prefix), since a block without any of them cannot hold m. Only blocks
    around a word of some prefix are made, each as its template words in global order. A block meets a template at their
    first common word: there the length filter asks for m words in the block, the positional filter for m words in what
    is left of both, and what passes is verified by intersection. Nothing is capped.

    All of it is column expressions and one broadcast join with the prefixes (a table as long as the templates' arguments).
    Texts are never shuffled: one shuffle by row carries digests of the texts with candidate blocks. A text's words are one
    array, so a text needs memory in proportion to its length. Null and empty texts have no words: counts 0, positions null,
    labels empty. Repeated rows stay apart, rows without an id too. An empty table gives no rows.
    """
    known = templates(given, least)
    tokens = sorted({t for x in known for t in x.tokens})
    rows = texts(df, id_col, text_col).select("uid", "doc_id", _words(F.col("text")).alias("words"))
    ordered = word_ranks(rows.select("words"), tokens) if tokens else []
    rank = {t: i for i, t in enumerate(ordered)}
    index = []
    for n, t in enumerate(known):
        own = sorted(t.tokens, key=rank.__getitem__)
        for p in range(len(own) - t.needed + 1):
            index.append((own[p], t.step, n, p, t.needed, t.label, own))
    prefixes = sorted({x[0] for x in index})

    base_labels = F.concat(*[F.when(F.size(F.col(f"p{i}")) > 0, F.array(F.lit(x))).otherwise(F.array().cast("array<string>")) for i, (_, x) in enumerate(phrases)])
    hits, blocks = _blocks(ordered, known, prefixes)
    found = rows.withColumns({f"p{i}": _places(p) for i, (p, _) in enumerate(phrases)} | {"hits": hits})
    found = found.withColumn("places", F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])).select(
        "uid",
        F.struct(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.size("places").cast("long").alias("n_base"),
            F.array_min("places").cast("long").alias("first_word"),
            F.array_max("places").cast("long").alias("last_word"),
            F.array_sort(F.array_distinct(base_labels)).alias("base"),
        ).alias("row"),
        blocks.alias("blocks"),
    )
    spread = found.select("uid", "row", F.explode_outer("blocks").alias("x")).select("uid", "row", "x.*")
    spread = spread.select("uid", "row", "step", "b", F.posexplode_outer("b").alias("q", "token"))
    schema = "token string, step int, template int, p int, needed int, label string, own array<string>"
    sides = F.broadcast(df.sparkSession.createDataFrame(index, schema))
    met = spread.join(sides, ["token", "step"], "left")
    first = ~F.arrays_overlap(F.slice("b", F.lit(1), F.col("q")), F.slice("own", F.lit(1), F.col("p")))
    length = F.size("b") >= F.col("needed")
    position = F.least(F.size("b") - F.col("q"), F.size("own") - F.col("p")) >= F.col("needed")  # this word and what follows it
    candidate = F.col("template").isNotNull() & length & position & first
    shared = F.when(candidate, F.size(F.array_intersect("own", "b")))
    met = met.withColumn("shared", shared)
    passed = F.col("shared") >= F.col("needed")
    digest = met.groupBy("uid").agg(
        F.first("row").alias("row"),
        F.collect_set(F.when(passed, F.col("label"))).alias("more"),
        F.max(F.when(passed, F.col("shared") / F.size("own"))).alias("share"),
    )
    labels = F.array_join(F.array_sort(F.array_union("row.base", "more")), ",")
    score = F.when(F.col("row.n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return digest.select(
        "row.doc_id", "row.n_words", "row.n_base", "row.first_word", "row.last_word", F.array_join("row.base", ",").alias("base_labels"), labels.alias("labels"), score.alias("score")
    )
