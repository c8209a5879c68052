"""Rules that hold across tickers, gaps and levels of a series."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlight.functions.text import standard_label
from barlight.operators import indicators as ind
from barlight.operators import sentiment as sm
from barlight.operators import stats as ss
from barlight.operators.calendar import align_to_trading_day, session_map
from barlight.operators.splits import expanding_folds
from barlight.sources import tables as st


def test_no_ticker_trains_on_a_day_that_another_is_tested_on(spark):
    old = spark.sql("SELECT 'OLD' AS ticker, explode(sequence(DATE'2000-01-03', DATE'2000-07-01')) AS date")
    new = spark.sql("SELECT 'NEW' AS ticker, explode(sequence(DATE'2000-05-01', DATE'2000-09-01')) AS date")
    rows = expanding_folds(old.union(new), 5).toPandas()
    assert set(rows["fold"]) == {-1, 0, 1, 2, 3, 4}
    for fold in range(5):
        assert rows[rows["fold"] < fold]["date"].max() < rows[rows["fold"] == fold]["date"].min()


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_means_pass_a_gap_of_any_length(spark, kind):
    rng = np.random.default_rng(5)
    close = pd.Series(100 + rng.normal(0, 1, 3000).cumsum())
    close[200:2600] = np.nan
    days = pd.date_range("2000-01-01", periods=len(close))
    pdf = pd.DataFrame({"ticker": "T", "date": days, "close": close.astype(object).where(close.notna(), None)})
    df = spark.createDataFrame(pdf, "ticker string, date timestamp, close double").withColumn("date", F.col("date").cast(kind))
    out = ind.macd(ind.ewm(df, "close", [12])).toPandas().sort_values("date")
    expected = close.ewm(span=12).mean()
    np.testing.assert_allclose(out["close_ewm_12"].astype(float), expected, rtol=1e-9)
    line = expected - close.ewm(span=26).mean()
    np.testing.assert_allclose(out["macd"].astype(float), line, atol=1e-9)
    np.testing.assert_allclose(out["macd_signal"].astype(float), line.ewm(span=9).mean(), atol=1e-9)


def test_causality_does_not_depend_on_the_level(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, 300)
    y = 0.5 * np.roll(x, 1) + rng.normal(0, 1, 300)
    pdf = pd.DataFrame({"ticker": "T", "date": pd.date_range("2020-01-01", periods=300), "return": y, "daily_mean_sentiment": x})

    def f(offset):
        df = spark.createDataFrame(pdf.assign(daily_mean_sentiment=x + offset)).withColumn("date", F.to_date("date"))
        return {(r["lag"], r["test"]): r["statistic"] for r in ss.granger(df).collect()}

    plain, moved = f(0.0), f(1e8)
    assert all(moved[k] == pytest.approx(v, rel=1e-5) for k, v in plain.items())


def test_ranks_of_prices_and_volumes_far_from_zero(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(15, 3, 500), -rng.lognormal(2, 5, 200), [0.0, 0.0, 1e300, -1e-300, 2.0**40]])
    df = spark.createDataFrame([("t", float(v)) for v in values], "ticker string, v double")
    got = sorted((r["v"], r["rank"]) for r in ss.average_ranks(df, ["ticker"], "v", "rank", daily=False).collect())
    assert got == sorted(zip(values.tolist(), pd.Series(values).rank().tolist(), strict=True))


def test_a_date_outside_the_calendar_is_an_error(spark):
    calendar = session_map(spark, spark.createDataFrame([], "holiday string"), "2024-01-01", "2024-02-01")
    news = spark.createDataFrame([("2024-03-05T12:00:00Z",)], "published string")
    with pytest.raises(Exception, match="no session"):
        align_to_trading_day(news, calendar=calendar).collect()


def test_stage_keeps_awkward_texts(spark, tmp_path):
    rows = [(0, None), (1, ""), (2, 'a "quoted" one'), (3, "two\nlines\r\nand a third"), (4, "  blanks  "), (5, "back\\slash\\"), (6, ",;\t'"), (7, '"'), (8, "null")]
    rows += [(9, "\\N"), (10, "\ue000"), (11, "\\n is no line end, \n is"), (12, "\\\n\\\\n\r\\r"), (13, "\\"), (14, "N"), (15, "\u2028 \x85 \x0b")]
    df = spark.createDataFrame(rows, "i int, text string")
    st.write_stage(df, str(tmp_path / "s"))
    assert sorted((r["i"], r["text"]) for r in st.read_stage(spark, str(tmp_path / "s"), df.schema).collect()) == rows


def test_a_stage_file_is_read_by_several_tasks(spark, tmp_path):
    df = spark.range(3000).selectExpr("id", "concat('line one of ', id, '\n', 'line \"two\"', '\r\n', repeat('x', id % 50)) as text")
    st.write_stage(df.coalesce(1), str(tmp_path / "s"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        back = st.read_stage(spark, str(tmp_path / "s"), df.schema)
        assert back.rdd.getNumPartitions() > 4 and back.exceptAll(df).isEmpty() and back.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_idioms_are_taken_leftmost_and_longest(spark):
    phrases = {"yeah right": -2.0, "kiss of death": -1.5, "of death star": 3.0, "death": 9.0, "kiss of": 1.0}
    texts = ["Kiss of death star", "a kiss of life, yeah -- RIGHT!", "of death star of death", "yeah yeah right right", "death", "", "kiss"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.transform(F.split("t", sm.TOKEN_BREAK), F.lower)
    got = [[(p["at"], p["size"], p["value"]) for p in r["p"]] for r in df.select(sm.phrase_places(words, phrases).alias("p")).collect()]

    def brute(text):
        w, i, out = re.split(r"[\W\d_]+", text.lower()), 0, []
        while i < len(w):
            for size in (3, 2, 1):
                if " ".join(w[i : i + size]) in phrases and i + size <= len(w):
                    out.append((i, size, phrases[" ".join(w[i : i + size])]))
                    i += size
                    break
            else:
                i += 1
        return out

    assert got == [brute(t) for t in texts]


def test_fixed_spellings_come_before_a_models_own_names(spark):
    rows = [("label_0", "negative"), ("LABEL_3", "positive"), ("4", "bearish"), ("pos", "positive"), ("", "neutral"), (None, "neutral"), ("odd", "odd")]
    df = spark.createDataFrame(rows, "l string, want string").select(standard_label("l", {0: "positive", 3: "POS", 4: "Bearish", 9: "pos"}).alias("got"), "want")
    assert df.filter("not got <=> want").count() == 0


RULES = {"negations": ["not", "no"], "boosters": {"very": 0.293, "hardly": -0.293}, "contrast": "but", "emphasis": True, "idioms": {"kiss of death": -1.5, "yeah right": -2.0}}
RULE_TEXTS = ["Not VERY good, but no bad day!", "a kiss of death but GOOD!! yeah right?? bad", "", "GOOD GOOD", "hardly very not good", None, "1 good but bad but good ????"] * 2 + ["good kiss of death " * 3000]
VALENCES = {"good": 1.9, "bad": -2.5, "death": -3.0, "right": 0.5}


def rule_score(text):
    raws = re.split(r"[\W\d_]+", text)
    words = [w.lower() for w in raws]
    capital = [len(r) > 1 and r.upper() == r for r in raws]
    others = any(r and not c for r, c in zip(raws, capital, strict=True))
    turn, total, free = words.index("but") if "but" in words else None, 0.0, 0
    for i, w in enumerate(words):
        phrase = next((p for p in RULES["idioms"] if i >= free and words[i : i + len(p.split())] == p.split()), None)
        if phrase:
            free, value = i + len(phrase.split()), RULES["idioms"][phrase]
        elif i < free or w not in VALENCES:
            continue
        else:
            sign = -1.0 if VALENCES[w] < 0 else 1.0
            near = [words[i - d] for d in (1, 2, 3) if i >= d]
            value = VALENCES[w] + sign * (0.733 if capital[i] and others else 0.0)
            value += sign * sum(RULES["boosters"].get(b, 0.0) * f for b, f in zip(near, (1, 0.95, 0.9), strict=False))
            value *= -0.74 if {"not", "no"} & set(near) else 1.0
        total += value * (1.0 if turn is None or i == turn else 0.5 if i < turn else 1.5)
    asked = text.count("?")
    marks = min(text.count("!"), 4) * 0.292 + (0.96 if asked > 3 else asked * 0.18 if asked > 1 else 0.0)
    total += marks * ((total > 0) - (total < 0))
    return total / (total * total + 15) ** 0.5


def ruled(spark, **rules):
    df = spark.createDataFrame([(t,) for t in RULE_TEXTS], "text string")
    lexicon = spark.createDataFrame([(w, round(10 * v)) for w, v in VALENCES.items()], "word string, tenths int")
    return sm.lexicon_scores_with_rules(df, lexicon, **rules)


def test_rule_scores_equal_a_plain_loop(spark):
    got = {r["text_hash"]: r["score"] for r in ruled(spark, **RULES).collect()}
    want = {hashlib.sha256((t or "").encode()).hexdigest(): rule_score(t or "") for t in RULE_TEXTS}
    assert got.keys() == want.keys() and len(got) == 7
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("kind", ["emphasis", "rules", "idioms"])
def test_rule_scores_neither_sort_nor_keep_tokens(spark, kind):
    rules = {"negations": [], "boosters": {}}
    rules |= {k: RULES[k] for k in {"emphasis": ("emphasis", "contrast"), "rules": ("negations", "boosters"), "idioms": ("idioms",)}[kind]}
    plan = ruled(spark, **rules)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Window" not in plan and "Sort" not in plan
