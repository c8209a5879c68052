"""Hot keys: aggregates, two-round top-n, stepped running sums and text parts against brute force."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlight.operators import evaluate as ev
from barlight.operators import skew
from barlight.operators.daily import attach_news, daily_news_text
from barlight.operators.stats import average_ranks


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", i, rng.randrange(50), f"t{i % 7}") for i in range(3000)]
    return spark.createDataFrame(rows, "key string, id long, at long, text string"), rows


def test_first_per_key(copies):
    df, rows = copies
    got = {r["key"]: (r["at"], r["id"]) for r in skew.first_per_key(df, ["key"], [F.col("at"), F.col("id")]).collect()}
    expected = {}
    for key, i, at, _ in rows:
        expected[key] = min(expected.get(key, (10**9, 0)), (at, i))
    assert got == expected


def test_top_per_key(copies):
    df, rows = copies
    out = skew.top_per_key(df, ["key"], [F.col("at").desc(), F.col("id")], 9)
    got = {(r["key"], r["id"]) for r in out.collect()}
    pdf = pd.DataFrame(rows, columns=["key", "id", "at", "text"]).sort_values(["at", "id"], ascending=[False, True])
    expected = set(pdf.groupby("key").head(9)[["key", "id"]].itertuples(index=False, name=None))
    assert got == expected


def test_running_by_value(spark):
    rng = random.Random(1)
    values = [("a", v / 997) for v in range(300)] + [("b", 0.5 + rng.random() * 1e-9) for _ in range(200)] + [("b", 9.0), ("b", -3.0)]
    rows = [(k, v, rng.randrange(1, 5)) for k, v in values]
    df = spark.createDataFrame(rows, "key string, v double, n long")
    out = skew.running_by_value(df, ["key"], "v", ["n"], 0.0, 1.0, previous="prev").collect()
    assert len(out) == len(rows)
    for r in out:
        smaller = [(v, n) for k, v, n in rows if k == r["key"] and v < r["v"]]
        assert r["n_before"] == sum(n for _, n in smaller)
        assert r["n_total"] == sum(n for k, _, n in rows if k == r["key"])
        assert (r["prev"]["n"] if r["prev"] else None) == (max(smaller)[1] if smaller else None)


def test_auc_against_all_pairs(spark):
    rng = random.Random(9)
    rows = [("t", rng.randrange(2), rng.choice([0.1, 0.25, 0.5, rng.random()])) for _ in range(300)] + [("u", 1, 0.3)]
    df = spark.createDataFrame(rows, "ticker string, label int, prob_up double")
    got = {r["ticker"]: r["auc"] for r in ev.roc_auc(df).collect()}
    pos = [p for t, y, p in rows if t == "t" and y == 1]
    neg = [p for t, y, p in rows if t == "t" and y == 0]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    assert got["t"] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)
    assert got["u"] is None


def test_ranks_by_value_equal_ranks_by_window(spark):
    rng = random.Random(2)
    rows = [("t", rng.choice([0.0, 0.0, rng.gauss(0, 1), 40.0 * rng.random()])) for _ in range(400)]
    df = spark.createDataFrame(rows, "ticker string, v double")
    a = sorted((r["v"], r["rank"]) for r in average_ranks(df, ["ticker"], "v", "rank", daily=True).collect())
    b = sorted((r["v"], r["rank"]) for r in average_ranks(df, ["ticker"], "v", "rank", daily=False).collect())
    expected = sorted(zip([v for _, v in rows], pd.Series([v for _, v in rows]).rank()))
    assert a == b == expected


def test_long_day_is_spread_over_parts_without_loss(spark):
    rows = [("T", "2024-06-03", f"u{i}", f"2024-06-03 10:{i % 60:02d}:00", f"word{i}") for i in range(500)]
    rows += [("T", "2024-06-04", "u", "2024-06-04 10:00:00", "alone")]
    df = spark.createDataFrame(rows, "ticker string, d string, url string, p string, text string")
    df = df.select("ticker", F.to_date("d").alias("trading_date"), "url", F.to_timestamp("p").alias("published"), "text")
    whole = daily_news_text(df).filter("trading_date = '2024-06-03'").collect()
    parts = daily_news_text(df, cell_chars=600).collect()
    assert len(whole) == 1 and whole[0]["text_part"] == 0
    hot = sorted((r for r in parts if str(r["trading_date"]) == "2024-06-03"), key=lambda r: r["text_part"])
    assert len(hot) > 5
    assert max(len(r["combined_text"]) for r in hot) <= 600 + len("word999")
    assert " ".join(r["combined_text"] for r in hot) == whole[0]["combined_text"]
    bars = spark.createDataFrame([("T", "2024-06-03"), ("T", "2024-06-04"), ("T", "2024-06-05")], "ticker string, d string")
    bars = bars.select("ticker", F.to_date("d").alias("date"))
    got = [(str(r["date"]), r["text_parts"], r["combined_text"]) for r in attach_news(bars, df.withColumn("title", F.lit("t")), cell_chars=600).orderBy("date").collect()]
    assert got == [("2024-06-03", len(hot), None), ("2024-06-04", 1, "alone"), ("2024-06-05", 0, "")]
    assert [r["combined_text"] for r in parts if str(r["trading_date"]) == "2024-06-04"] == ["alone"]


def test_bar_holds_the_whole_text_of_a_day_of_any_length(spark):
    df = spark.range(17).select(
        F.lit("T").alias("ticker"), F.to_date(F.lit("2024-06-03")).alias("trading_date"), F.concat(F.lit("u"), "id").alias("url"), F.lit("t").alias("title"),
        F.to_timestamp(F.format_string("2024-06-03 10:%02d:00", "id")).alias("published"), F.repeat(F.format_string("%02d", "id"), 500_000).alias("text"),
    )
    bars = spark.sql("SELECT 'T' AS ticker, DATE'2024-06-03' AS date")
    got = attach_news(bars, df).collect()
    assert [(r["news_count"], r["text_parts"]) for r in got] == [(17, 1)]
    assert got[0]["combined_text"] == " ".join(f"{i:02d}" * 500_000 for i in range(17))


def test_broadcast_only_when_small(spark):
    small, big = spark.range(10), spark.range(1000)
    assert "broadcast" in skew.broadcast_if_small(small, 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in skew.broadcast_if_small(big, 10)._jdf.queryExecution().logical().toString().lower()
