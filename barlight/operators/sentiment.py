"""Text scoring: a relational lexicon scorer, distributed batch inference, and the score cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlight.functions.text import as_text, score_label, shorten, signed_score, standard_label, text_key
from barlight.operators.skew import broadcast_if_small

TOKEN_BREAK = r"[^\p{L}]+"

# The published normalisation and rule weights of the lexicon method.
NORM_ALPHA = 15.0
NEGATION_FACTOR = -0.74
BOOST_DECAY = {1: 1.0, 2: 0.95, 3: 0.9}
CAPITALS = 0.733
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, FEW_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5

Scorer = Callable[[list[str]], list[tuple[str, float]]]


def with_text_key(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("text_hash", text_key(text))


def compound(valence: Column) -> Column:
    """Sum of valences to [-1, 1]: s / sqrt(s^2 + 15)."""
    return valence / F.sqrt(valence * valence + F.lit(NORM_ALPHA))


def _words(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("word").agg(F.max("tenths").alias("tenths"))


def lexicon_scores(texts: DataFrame, lexicon: DataFrame, text: str = "text") -> DataFrame:
    """(text_hash, valence_tenths, score, label) for every distinct text.

    ``lexicon`` is (word, tenths) with valence in integer tenths, so sums are exact; of a word listed
    more than once the largest valence counts. Tokens join the
    broadcast lexicon and fold back to one row per text inside the map task; only hashes and partial
    sums are shuffled, never text. Copies of a text fold together and are divided out again: each
    copy contributes exactly one first token.
    """
    tokens = with_text_key(texts, text).select(
        "text_hash", F.posexplode(F.split(F.lower(as_text(text)), TOKEN_BREAK)).alias("pos", "word")
    )
    scored = tokens.join(broadcast_if_small(_words(lexicon)), "word", "left")
    scored = scored.filter(F.col("tenths").isNotNull() | (F.col("pos") == 0))  # misses carry nothing
    per_text = scored.groupBy("text_hash").agg(
        F.sum(F.coalesce(F.col("tenths"), F.lit(0)).cast("long")).alias("_sum"),
        F.sum((F.col("pos") == 0).cast("long")).alias("_copies"),
    )
    out = per_text.select("text_hash", F.expr("_sum div _copies").alias("valence_tenths"))
    out = out.withColumn("score", compound(F.col("valence_tenths").cast("double") / 10))
    return out.withColumn("label", score_label("score"))


def _occurrences(text: str, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(mark), F.lit("")))


def phrase_places(words: Column, phrases: dict[str, float]) -> Column:
    """array<struct<at, size, value>> of phrases in an array of lower-case words, first come first served, the longest first.

    The phrases of each length are one map from their joined words, so a place costs one lookup a length. A place inside an
    earlier match starts none of its own.
    """
    by_size: dict[int, dict[str, float]] = {}
    for phrase, value in phrases.items():
        parts = [w for w in re.split(r"[\W\d_]+", phrase.lower()) if w]
        if not parts:
            raise ValueError(f"a phrase without words: {phrase!r}")
        by_size.setdefault(len(parts), {})[" ".join(parts)] = float(value)

    def at(i: Column, size: int, known: dict[str, float]) -> Column:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        value = F.try_element_at(table, F.array_join(F.slice(words, i + 1, size), " "))
        return F.when(value.isNotNull(), F.struct(i.alias("at"), F.lit(size).alias("size"), value.alias("value")))

    def longest(i: Column) -> Column:
        return F.coalesce(*[at(i, size, by_size[size]) for size in sorted(by_size, reverse=True)])

    firsts = F.lit(False)
    for known in by_size.values():
        firsts |= F.arrays_overlap(words, F.array(*[F.lit(x) for x in sorted({p.split(" ")[0] for p in known})]))
    found = F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), longest), lambda m: m.isNotNull())
    none = F.array().cast("array<struct<at:int,size:int,value:double>>")
    start = F.struct(F.lit(0).alias("free"), none.alias("kept"))
    kept = F.aggregate(
        found,
        start,
        lambda acc, m: F.when(m["at"] >= acc["free"], F.struct((m["at"] + m["size"]).alias("free"), F.concat(acc["kept"], F.array(m)).alias("kept"))).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return F.when(firsts, kept).otherwise(none)


def _given_values(places: Column) -> Column:
    """array<double> by token: an idiom's value at its first word, 0 at its others, null where no idiom stands."""
    after = F.filter(F.arrays_zip(places.alias("p"), F.concat(F.array(F.lit(None)), places).alias("before")), lambda x: x["p"].isNotNull())

    def stretch(x: Column) -> Column:
        p, end = x["p"], F.coalesce(x["before"]["at"] + x["before"]["size"], F.lit(0))
        free = F.array_repeat(F.lit(None).cast("double"), p["at"] - end)
        return F.concat(free, F.array(p["value"]), F.array_repeat(F.lit(0.0), p["size"] - 1))

    return F.flatten(F.transform(after, stretch))


def lexicon_scores_with_rules(
    texts: DataFrame,
    lexicon: DataFrame,
    negations: list[str],
    boosters: dict[str, float],
    text: str = "text",
    contrast: str | None = None,
    emphasis: bool = False,
    idioms: dict[str, float] | None = None,
) -> DataFrame:
    """Lexicon scores with negation and booster words among the three tokens before a scored word.

    ``contrast`` (such as "but") halves what comes before its first use and lifts what comes after by half.
    ``emphasis`` lifts words in capitals, in a text that has others too, and the whole by its marks: up to
    four '!', two '?' or more. ``idioms`` are phrases with a valence of their own, which stands for all their words and for
    what negation and boosters would make of them.

    What a token needs of its text (the three tokens before it, the idiom it belongs to, the place of the contrast word)
    is taken from the array of the text's tokens, so tokens are neither sorted nor kept: they join the broadcast lexicon and
    fold back to one row a text inside the map task, in their order. Only hashes and sums are shuffled. Every copy of a text
    is scored, to the same sum, and one stays.
    """
    rows = with_text_key(texts, text).select("text_hash", F.monotonically_increasing_id().alias("_row"), as_text(text).alias("_text"))
    marks = F.least(_occurrences("_text", "!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION
    asked = _occurrences("_text", "?")
    marks += F.when(asked > FEW_QUESTIONS, MANY_QUESTIONS).when(asked > 1, asked * QUESTION).otherwise(0.0)
    rows = rows.select("text_hash", "_row", marks.alias("_marks"), F.split("_text", TOKEN_BREAK).alias("_raws"))

    def capital(raw: Column) -> Column:
        return (F.length(raw) > 1) & (F.upper(raw) == raw)

    aligned, whole = ["_raws"], ["_marks"]
    if negations or boosters:
        for d in BOOST_DECAY:
            rows = rows.withColumn(f"_before{d}", F.concat(F.array_repeat(F.lit(None).cast("string"), d), "_raws"))
            aligned.append(f"_before{d}")
    if idioms:
        rows = rows.withColumn("_lower", F.transform("_raws", F.lower))
        rows = rows.withColumn("_places", phrase_places(F.col("_lower"), idioms))
        rows = rows.withColumn("_given", _given_values(F.col("_places")))
        aligned.append("_given")
    if emphasis:
        rows = rows.withColumn("_others", F.exists("_raws", lambda raw: ~capital(raw) & (raw != "")))
        whole.append("_others")
    if contrast:
        rows = rows.withColumn("_turn", F.nullif(F.array_position(F.transform("_raws", F.lower), contrast), F.lit(0)) - 1)
        whole.append("_turn")
    tokens = rows.select("text_hash", "_row", *whole, F.posexplode(F.arrays_zip(*aligned)).alias("pos", "_token"))
    tokens = tokens.select("text_hash", "_row", *whole, "pos", "_token.*").filter(F.col("_raws").isNotNull())  # befores are longer
    tokens = tokens.withColumn("word", F.lower("_raws")).join(broadcast_if_small(_words(lexicon)), "word", "left")
    given = F.col("_given") if idioms else F.lit(None).cast("double")
    tokens = tokens.filter(F.col("tenths").isNotNull() | given.isNotNull() | (F.col("pos") == 0))  # misses carry nothing

    valence = F.col("tenths") / F.lit(10.0)
    sign = F.when(valence < 0, -1.0).otherwise(1.0)
    befores = {d: F.lower(f"_before{d}") for d in BOOST_DECAY if f"_before{d}" in aligned}
    weights = F.create_map(*[F.lit(x) for kv in boosters.items() for x in kv]) if boosters else None
    lift, negated = F.lit(0.0), F.lit(False)
    for d, word in befores.items():
        if boosters:
            lift += F.coalesce(F.try_element_at(weights, word), F.lit(0.0)) * BOOST_DECAY[d]
        if negations:
            negated |= F.coalesce(word.isin(negations), F.lit(False))
    if emphasis:
        valence += F.when(capital(F.col("_raws")) & F.col("_others"), sign * CAPITALS).otherwise(0.0)
    value = F.coalesce((valence + sign * lift) * F.when(negated, NEGATION_FACTOR).otherwise(1.0), F.lit(0.0))
    value = F.coalesce(given, value)
    if contrast:
        value *= F.when(F.col("pos") < F.col("_turn"), BEFORE_CONTRAST).when(F.col("pos") > F.col("_turn"), AFTER_CONTRAST).otherwise(1.0)
    out = tokens.groupBy("text_hash", "_row").agg(F.sum(value).alias("_total"), F.first("_marks").alias("_marks"))
    if emphasis:
        out = out.withColumn("_total", F.col("_total") + F.signum("_total") * F.col("_marks"))
    out = out.groupBy("text_hash").agg(F.min("_total").alias("_total"))
    out = out.select("text_hash", compound(F.col("_total")).alias("score"))
    return out.withColumn("label", score_label("score"))


def score_texts(
    texts: DataFrame,
    scorer_factory: Callable[[], Scorer],
    text: str = "text",
    batch_size: int = 16,
    max_chars: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """SCORED rows (text_hash, text, label, score) for every distinct text.

    ``scorer_factory`` runs once per task and hides model loading and device choice; the scorer gets
    lists of at most ``batch_size`` texts. Duplicate texts are scored once. Whole texts are passed
    on unless ``max_chars`` asks for the guard of :func:`barlight.functions.text.shorten`. ``tasks``
    spreads the distinct texts over that many tasks, where byte-sized partitions would be too few for
    a slow model.
    """
    keyed = with_text_key(texts, text)
    distinct = keyed.groupBy("text_hash").agg(F.first(as_text(text)).alias("text"))
    if tasks:
        distinct = distinct.repartition(tasks, "text_hash")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for batch in batches:
            given = batch.tolist()
            scored: list[tuple[str, float]] = []
            for i in range(0, len(given), batch_size):
                scored.extend(scorer(given[i : i + batch_size]))
            yield pd.DataFrame({"raw_label": [s[0] for s in scored], "prob": [float(s[1]) for s in scored]})

    # one copy of a text goes to Python, and none comes back
    given = shorten("text", max_chars // 4) if max_chars else F.col("text")
    raw = distinct.withColumn("_s", F.pandas_udf(run, "raw_label string, prob double")(given))
    label, prob = F.col("_s.raw_label"), F.col("_s.prob")
    return raw.select("text_hash", "text", standard_label(label).alias("label"), signed_score(label, prob).alias("score"))


def one_score(scored: DataFrame) -> DataFrame:
    """One row per text key; a cache that was appended to may hold more."""
    best = F.min(F.struct("label", "score")).alias("_best")
    kept = scored.groupBy("text_hash").agg(best, *([F.first("text").alias("text")] if "text" in scored.columns else []))
    return kept.select(*[c if c in ("text_hash", "text") else F.col(f"_best.{c}").alias(c) for c in scored.columns if c in ("text_hash", "text", "label", "score")])


def attach_scores(articles: DataFrame, scored: DataFrame, text: str = "text") -> DataFrame:
    """Scores back onto articles by text key, as ``label``, ``score`` and ``sent_score``.

    One score a text: of several the first by (label, score). A text in a large share of the articles
    makes a skewed join, which Spark splits (``spark.sql.adaptive.skewJoin.enabled``).
    """
    right = one_score(scored).select("text_hash", "label", "score")
    out = with_text_key(articles, text).join(right, "text_hash", "left")
    return out.withColumn("sent_score", F.col("score"))


def split_by_cache(texts: DataFrame, cache: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(cached score rows for the requested texts, requested texts the cache lacks)."""
    wanted = with_text_key(texts, text)
    keys = wanted.select("text_hash").distinct()
    return one_score(cache).join(keys, "text_hash", "left_semi"), wanted.join(cache.select("text_hash"), "text_hash", "left_anti")


def all_cached(texts: DataFrame, cache: DataFrame, text: str = "text") -> bool:
    return split_by_cache(texts, cache, text)[1].isEmpty()


def score_with_cache(
    texts: DataFrame,
    cache: DataFrame,
    scorer_factory: Callable[[], Scorer],
    text: str = "text",
    batch_size: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """(scores for every requested text, rows to append to the cache): only misses are scored."""
    hits, misses = split_by_cache(texts, cache, text)
    fresh = score_texts(misses, scorer_factory, text, batch_size)
    return hits.select("text_hash", "text", "label", "score").unionByName(fresh), fresh


def in_request_order(requests: DataFrame, scored: DataFrame, seq: str = "seq", text: str = "text") -> DataFrame:
    """One score per request, in the order of the explicit ``seq`` column."""
    return attach_scores(requests, scored, text).orderBy(seq)
