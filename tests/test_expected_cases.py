"""Small published expectations: alignment, aggregates, targets, backtests, feeds, scoring."""

from __future__ import annotations

import datetime as dt
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from barlight.functions import text as tx
from barlight.functions import times as tm
from barlight.functions.numeric import flag, pd_div
from barlight.operators import daily as dl
from barlight.operators import news as nw
from barlight.operators import sentiment as sm
from barlight.operators.backtest import backtest_metrics, run_backtest
from barlight.operators.calendar import align_to_trading_day, normalize_timestamps, session_map
from barlight.operators.layout import KEY
from barlight.operators.splits import expanding_folds, lookup_with_fallback
from barlight.session import use_utc
from barlight.sources import bars as sb
from barlight.sources import feeds

D = dt.date


def strings(spark, values, name="published"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_timestamps_are_parsed_row_by_row(spark):
    df = strings(use_utc(spark), ["2024-06-03T12:00:00Z", "2024-06-03T07:00:00-05:00", "2024-06-03 12:00:00", "Mon, 03 Jun 2024 12:00:00 GMT", "20240603T120000Z", "soon", None])
    out = [r["p"] for r in normalize_timestamps(df).select(F.col("published").cast("string").alias("p")).collect()]
    assert out == ["2024-06-03 12:00:00"] * 5 + [None, None]
    shapes = ["June 3, 2024", "Jun 3, 2024", "06/03/2024", "20240603", "2024/06/03", "2024-06-03T00:00Z", "3 Jun 2024 05:30:00 +05:30"]
    days = normalize_timestamps(strings(spark, shapes)).select(F.col("published").cast("string").alias("p")).collect()
    assert {r["p"] for r in days} == {"2024-06-03 00:00:00"}


@pytest.mark.parametrize(
    ("published", "expected"),
    [
        ("2024-06-03T07:00:00-04:00", D(2024, 6, 3)),
        ("2024-06-03T10:00:00-04:00", D(2024, 6, 3)),
        ("2024-06-03T16:00:00-04:00", D(2024, 6, 3)),
        ("2024-06-03T16:00:00.000001-04:00", D(2024, 6, 4)),
        ("2024-06-03T17:30:00-04:00", D(2024, 6, 4)),
        ("2024-05-31T17:30:00-04:00", D(2024, 6, 3)),
        ("2024-06-01T10:00:00-04:00", D(2024, 6, 3)),
        ("2024-01-15T21:00:00Z", D(2024, 1, 15)),  # winter time: 16:00 in New York
        ("nonsense", None),
    ],
)
def test_trading_date(spark, published, expected):
    row = align_to_trading_day(strings(spark, [published])).first()
    assert row["trading_date"] == expected


def test_holidays_move_articles_to_the_next_session(spark):
    calendar = session_map(spark, strings(spark, ["2024-07-04"], "holiday"), "2024-06-01", "2024-08-01")
    df = strings(spark, ["2024-07-03T18:00:00-04:00", "2024-07-04T10:00:00-04:00", "2024-07-05T10:00:00-04:00", None])
    out = [r["trading_date"] for r in align_to_trading_day(df, calendar=calendar).collect()]
    assert out == [D(2024, 7, 5), D(2024, 7, 5), D(2024, 7, 5), None]


def test_daily_counts(spark):
    rows = [("T", "2024-06-03", 0.2, "positive"), ("T", "2024-06-03", -0.1, "Negative"), ("T", "2024-06-04", 0.0, "neutral"), ("T", None, 1.0, "positive")]
    df = spark.createDataFrame(rows, "ticker string, trading_date string, sent_score double, label string")
    first, second = dl.daily_sentiment(df).orderBy("trading_date").collect()
    assert first["daily_mean_sentiment"] == pytest.approx(0.05)
    assert first.asDict().items() >= {"daily_count": 2, "daily_pos_count": 1, "daily_neg_count": 1, "daily_neutral_count": 0}.items()
    assert second["daily_neutral_count"] == 1
    by_score = dl.daily_sentiment(spark.createDataFrame([("T", "2024-06-03", None), ("T", "2024-06-03", 0.06)], "ticker string, trading_date string, sent_score double")).first()
    assert (by_score["daily_count"], by_score["daily_pos_count"], by_score["daily_neutral_count"]) == (2, 1, 1)
    with pytest.raises(KeyError):
        dl.daily_sentiment(df.drop("sent_score"))


@pytest.fixture(scope="module")
def four_bars(spark):
    rows = [("T", "2024-06-03", 0.01), ("T", "2024-06-04", -0.02), ("T", "2024-06-05", 0.03), ("T", "2024-06-06", -0.01)]
    return spark.createDataFrame(rows, "ticker string, d string, return double").select(KEY, F.to_date("d").alias("date"), "return")


def test_targets_look_one_bar_ahead(spark, four_bars):
    daily = spark.createDataFrame([("T", "2024-06-03", 0.1, 2)], "ticker string, trading_date string, daily_mean_sentiment double, daily_count long")
    out = dl.merge_with_stock(four_bars, daily).orderBy("date").collect()
    assert [r["target_return_1d"] for r in out] == [-0.02, 0.03, -0.01, None]
    assert [r["target_dir_1d"] for r in out] == [0, 1, 0, 0]
    assert [(r["daily_mean_sentiment"], r["daily_count"], r["daily_pos_count"]) for r in out] == [(0.1, 2, 0)] + [(0.0, 0, 0)] * 3
    empty = dl.merge_with_stock(four_bars, dl.no_sentiment(four_bars))
    assert empty.agg(F.sum("daily_count")).first()[0] == 0
    assert dl.lookahead_violations(empty).first()["violations"] == 0
    with pytest.raises(KeyError):
        dl.merge_with_stock(four_bars.drop("return"), daily)


def series(spark, returns, probs):
    rows = [("T", i, r, p) for i, (r, p) in enumerate(zip(returns, probs))]
    df = spark.createDataFrame(rows, "ticker string, i int, return double, prob_up double")
    return df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i"))).drop("i")


def test_no_trade_is_flat_and_always_long_compounds(spark):
    flat = run_backtest(series(spark, [0.01] * 20, [0.5] * 20), threshold=0.6)
    metrics = backtest_metrics(flat).first()
    assert (metrics["trades"], metrics["total_return"], metrics["max_drawdown"], metrics["annualized_sharpe"]) == (0.0, 0.0, 0.0, None)
    long = backtest_metrics(run_backtest(series(spark, [0.01] * 10, [1.0] * 10), tc=0.0)).first()
    assert long["total_return"] == pytest.approx(1.01**9 - 1)
    assert long["trades"] == 1.0
    with pytest.raises(KeyError):
        run_backtest(series(spark, [0.0], [0.0]).drop("prob_up"))


def test_backtest_golden(spark):
    from catalog.base import preds

    curves = run_backtest(preds(spark, "/root/testdata/sf0.01"))
    out = {r["ticker"]: r for r in backtest_metrics(curves).collect()}
    # last equity, worst drawdown, trades, Sharpe
    golden = {
        "A": (0.6979028, -0.34223081, 405, -0.23066806),
        "N": (0.77205382, -0.27990481, 405, -0.14971863),
        "R": (1.04539602, -0.15152629, 405, 0.09798314),
    }
    for ticker, (equity, worst, trades, sharpe) in golden.items():
        r = out[ticker]
        assert r["total_return"] + 1 == pytest.approx(equity, abs=1e-8)
        assert r["max_drawdown"] == pytest.approx(worst, abs=1e-8)
        assert r["trades"] == trades
        assert r["annualized_sharpe"] == pytest.approx(sharpe, abs=1e-8)


def test_expanding_folds_never_train_on_the_future(spark):
    df = series(spark, [0.0] * 50, [0.0] * 50)
    rows = expanding_folds(df, 5).collect()
    for fold in range(5):
        test = [r["date"] for r in rows if r["fold"] == fold]
        train = [r["date"] for r in rows if r["fold"] < fold]
        assert len(test) == 8 and max(train) < min(test)
    assert {r["fold"] for r in expanding_folds(df.limit(3), 5).collect()} == {-1}


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTPS://News.Example.COM/Path/A?x=1#top", "https://news.example.com/Path/A"),
        ("http://a.b/c#frag?not", "http://a.b/c"),
        ("//Host/P?q", "//host/P"),
        ("plain/Path?q", "plain/Path"),
        ("MailTo:Someone@Example.com", "mailto:Someone@Example.com"),
        ("https://a.b/x;P=1?y", "https://a.b/x;P=1"),
        (None, ""),
    ],
)
def test_canonical_url(spark, url, expected):
    assert spark.createDataFrame([(url,)], "u string").select(tx.canonical_url("u")).first()[0] == expected


def test_rss_links_that_differ_in_query_are_one_article(spark):
    entry = "named_struct('title', {0}, 'link', {1}, 'id', NULL, 'published', 'Mon, 03 Jun 2024 12:00:00 GMT', 'updated', NULL, 'summary', NULL, 'source', '{{\"title\":\"S\"}}')"
    items = ", ".join(entry.format(f"'t{i}'", f"'{u}'") for i, u in enumerate(["https://x.com/a?u=1", "https://x.com/a?u=2", "https://x.com/b"]))
    payload = spark.sql(f"SELECT 'T' AS ticker, array({items}) AS entries")
    out = feeds.rss_news(payload).collect()
    assert sorted(r["url"] for r in out) == ["https://x.com/a?u=1", "https://x.com/b"]
    assert {r["source"] for r in out} == {"S"} and all(r["text"] == r["title"] for r in out)
    assert len(feeds.rss_news(payload, max_results=1).collect()) == 1


def test_missing_feed_is_skipped_and_unknown_columns_align(spark, tmp_path):
    assert feeds.read_landed(spark, str(tmp_path / "none"), feeds.RSS) is None
    (tmp_path / "p.json").write_text(
        '{"ticker": "T", "status": "ok", "totalResults": 2, "articles": [{"title": "a", "url": "https://x.com/1?a", "publishedAt": "2024-06-03T12:00:00Z", "source": {"name": "S"}},'
        ' {"title": "b", "url": "https://x.com/1?b", "publishedAt": "2024-06-04T12:00:00Z", "source": null}]}\n{"ticker": "T", "status": "error"}\n'
    )
    landed = feeds.read_landed(spark, str(tmp_path / "p.json"), feeds.NEWSAPI)
    rows = feeds.newsapi_news(landed)
    assert [(r["title"], r["source"]) for r in rows.collect()] == [("a", "S")]
    both = nw.collect_news({"NewsAPI": rows, "RSS": None})
    assert [r["source"] for r in both.collect()] == ["NewsAPI"]
    bare = spark.createDataFrame([("T", "https://x.com/1?a"), ("T", "https://x.com/2"), ("T", "https://x.com/3")], "ticker string, url string")
    capped = nw.collect_news({"NewsAPI": rows, "RSS": bare, "GDELT": None}, max_articles=8)
    assert sorted((r["source"], r["url"][-1]) for r in capped.collect()) == [("NewsAPI", "a"), ("RSS", "2")]
    with pytest.raises(ValueError):
        nw.collect_news({"RSS": None})


def test_range_ends_at_midnight_or_with_the_day(spark):
    df = strings(spark, ["2024-01-05 00:00:00", "2024-01-05 13:00:00", "2024-01-06 00:00:00", None])
    df = df.select(F.to_timestamp("published").alias("published"))
    assert nw.in_date_range(df, "2024-01-01", "2024-01-05").count() == 2
    assert nw.in_date_range(df, "2024-01-01", "2024-01-05", whole_last_day=False).count() == 1


def test_labels_and_scores(spark):
    rows = [("LABEL_2", 0.9), (" neg ", 0.4), ("", 0.8), (None, 0.8), ("Bullish", 0.7)]
    out = spark.createDataFrame(rows, "l string, p double").select(tx.standard_label("l").alias("l"), tx.signed_score("l", "p").alias("s")).collect()
    assert [r["l"] for r in out] == ["positive", "negative", "neutral", "neutral", "bullish"]
    assert [r["s"] for r in out] == [0.9, -0.4, 0.0, 0.0, 0.0]


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def cycling_scorer():
    labels = [("NEGATIVE", 0.7), ("NEUTRAL", 0.5), ("POSITIVE", 0.7)]
    return lambda texts: [labels[int(t[-1]) % 3] for t in texts]


def test_batch_scoring_scores_each_distinct_text_once(spark):
    df = spark.createDataFrame([(i, f"text {i % 3}") for i in range(9)] + [(9, None)], "id int, text string")
    df = df.withColumn("text", F.coalesce("text", F.lit("text 1")))
    scored = sm.score_texts(df, cycling_scorer, batch_size=2)
    assert scored.count() == 3
    out = sm.in_request_order(df.withColumn("seq", F.col("id")), scored).collect()
    assert [r["label"] for r in out[:3]] == ["negative", "neutral", "positive"]
    assert [r["score"] for r in out[:3]] == [-0.7, 0.0, 0.7] and len(out) == 10


def test_cache_scores_only_misses(spark):
    seen = spark.createDataFrame([("text 0",), ("text 1",)], "text string")
    cache = sm.score_texts(seen, cycling_scorer)
    wanted = spark.createDataFrame([("text 1",), ("text 2",), ("text 1",)], "text string")
    scores, fresh = sm.score_with_cache(wanted, cache, cycling_scorer)
    assert {r["text"] for r in fresh.collect()} == {"text 2"}
    assert {r["text"] for r in scores.collect()} == {"text 1", "text 2"}
    assert sm.all_cached(seen, cache) and not sm.all_cached(wanted, cache)


def test_lexicon_score_is_bounded_and_counts_copies_once(spark):
    lex = spark.createDataFrame([("good", 19), ("bad", -25)], "word string, tenths int")
    df = spark.createDataFrame([("good good",), ("good good",), ("bad thing",), ("",)], "text string")
    out = {r["text_hash"]: r for r in sm.lexicon_scores(df, lex).collect()}
    by_text = {t: out[spark.sql(f"SELECT sha2('{t}', 256)").first()[0]] for t in ("good good", "bad thing", "")}
    assert by_text["good good"]["valence_tenths"] == 38 and by_text["good good"]["label"] == "positive"
    assert by_text["bad thing"]["score"] == pytest.approx(-2.5 / (2.5**2 + 15) ** 0.5)
    assert by_text[""]["label"] == "neutral" and all(-1 <= r["score"] <= 1 for r in out.values())


def test_division_rules(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (3.0, 2.0)]
    df = spark.createDataFrame(rows, "n double, d double")
    out = [r[0] for r in df.select(pd_div("n", "d")).collect()]
    assert out == [float("inf"), float("-inf"), None, None, None, 1.5]
    assert [r[0] for r in df.select(flag(F.col("n") > 0)).collect()] == [1, 0, 0, 0, 1, 1]


def test_request_checks():
    sb.check_request("AAPL", "2024-01-01", "2024-02-01")
    for bad in (("", "2024-01-01", "2024-02-01"), ("A", "2024-02-01", "2024-01-01"), ("A", "soon", "2024-01-01"), ("A", "2024-01-01", "2024-02-01", "2d")):
        with pytest.raises(ValueError):
            sb.check_request(*bad)


def test_provider_bars(spark):
    rows = [("T", f"2020-01-0{i}", 1.0, 2.0, 0.5, 1.5 + i, 0.4 + i, 100) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "ticker string, Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume long")
    out = sb.normalize_bars(df).orderBy("date")
    assert out.columns == ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume", "return", "log_return"]
    first, second = out.take(2)
    assert first["return"] is None and second["return"] == pytest.approx(2.4 / 1.4 - 1)
    bare = sb.normalize_bars(df.select("ticker", "Date", "Close")).first()
    assert bare["open"] is None and bare["adj_close"] == bare["close"]
    with pytest.raises(ValueError):
        sb.normalize_bars(df.drop("Date"))


def test_two_level_columns(spark):
    wide = spark.sql("SELECT DATE'2024-01-02' AS date, 1.0D AS Close_AAPL, 2.0D AS `Adj Close_AAPL`, 3.0D AS Close_BRK_B, CAST(NULL AS DOUBLE) AS `Adj Close_BRK_B`")
    out = {r["ticker"]: r for r in sb.flatten_bars(wide).collect()}
    assert out["AAPL"]["adj_close"] == 2.0 and out["BRK_B"]["close"] == 3.0 and out["BRK_B"]["adj_close"] is None
    assert sb.drop_uniform_level(wide.select("date", "Close_AAPL"), "AAPL").columns == ["date", "Close"]
    assert sb.demo_defaults(spark.sql("SELECT 10.0D AS close")).first()["high"] == pytest.approx(10.2)


def test_lookup_falls_back_to_the_last_row(spark, four_bars):
    requests = spark.createDataFrame([("T", D(2024, 6, 4)), ("T", D(2024, 6, 30)), ("NONE", D(2024, 6, 4))], "ticker string, target_date date")
    rows = lookup_with_fallback(four_bars, requests).collect()
    unknown = [r for r in rows if r["ticker"] == "NONE"]
    assert len(rows) == 3 and [(r["return"], r["is_exact"]) for r in unknown] == [(None, False)]
    out = {r["target_date"]: r for r in rows if r["ticker"] == "T"}
    assert out[D(2024, 6, 4)]["return"] == -0.02 and out[D(2024, 6, 4)]["is_exact"]
    assert out[D(2024, 6, 30)]["date"] == D(2024, 6, 6) and not out[D(2024, 6, 30)]["is_exact"]


def test_recent_window(spark):
    start, end = tm.recent_window(30, F.lit("2024-03-01").cast("date"))
    row = spark.range(1).select(start, end).first()
    assert tuple(row) == (D(2024, 1, 31), D(2024, 2, 29))
