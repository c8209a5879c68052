"""Sinks, sources and the shape of the plans that reach the scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barlight.operators import daily as dl
from barlight.operators import indicators as ind
from barlight.operators import news as nw
from barlight.schemas import BARS, COUNT_COLUMNS, conform
from barlight.session import settle
from barlight.sources import bars as sb
from barlight.sources import tables as st
from catalog import base

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_table_replaces_whole_tickers_and_prunes(spark, tmp_path):
    path = str(tmp_path / "bars")
    b = conform(base.bars(spark, SF), BARS)
    sb.write_bars(b, path)
    assert spark.read.parquet(path).count() == b.count()
    fixed = b.filter("ticker = 'A'").limit(5)
    sb.write_bars(fixed, path)
    again = sb.read_bars(spark, path)
    assert again.filter("ticker = 'A'").count() == 5 and again.filter("ticker = 'N'").count() == b.filter("ticker = 'N'").count()
    one = sb.read_bars(spark, path, "n", "1996-01-01", "1997-01-01")
    text = plan(one.select("close"))
    assert "PartitionFilters: [isnotnull(ticker" in text and "PushedFilters: [IsNotNull(date)" in text
    assert "ReadSchema: struct<date:date,close:double>" in text
    assert sb.read_bars(spark, path, "GONE") is None
    with pytest.raises(ValueError):
        sb.read_bars(spark, path, "N", "1997-01-01", "1996-01-01")


def test_features_of_an_unknown_ticker_are_an_error(spark, tmp_path):
    path = str(tmp_path / "features")
    st.write_features(base.bars(spark, SF).withColumn("ticker", F.lower("ticker")), path)
    assert st.read_features(spark, path, "a").count() > 0
    with pytest.raises(FileNotFoundError):
        st.read_features(spark, path, "zzz")


def test_news_partitions(spark, tmp_path):
    path = str(tmp_path / "news")
    st.write_news(base.news(spark, SF), path)
    assert spark.read.parquet(path).count() == base.news(spark, SF).count()
    assert {p.name.split("=")[0] for p in (tmp_path / "news").iterdir() if p.is_dir()} == {"source"}


def test_scores_append(spark, tmp_path):
    path = str(tmp_path / "scores")
    one = spark.createDataFrame([("h", "t", "positive", 0.5)], "text_hash string, text string, label string, score double")
    st.append_scores(one, path)
    st.append_scores(one.withColumn("text_hash", F.lit("g")), path)
    assert spark.read.parquet(path).count() == 2


def test_reports_as_csv(spark, tmp_path):
    path = str(tmp_path / "corr")
    st.write_report(spark.createDataFrame([("T", "a", "b", 0.5)], "ticker string, x string, y string, corr double"), path)
    back = st.read_stage(spark, path, spark.sql("SELECT '' AS ticker, '' AS x, '' AS y, 0.0D AS corr").schema)
    assert [tuple(r) for r in back.collect()] == [("T", "a", "b", 0.5)]


def test_observed_rows_cost_no_extra_job(spark):
    df, seen = st.observed(spark.range(7), "stage")
    df.collect()
    assert seen.get["rows"] == 7


def test_settle_reads_the_session_folder(spark, tmp_path):
    df = settle(spark.range(5))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir() is not None


def test_column_pruning_and_pushdown_reach_the_scan(spark):
    out = nw.in_date_range(spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("ts", "published"), "2024-01-03", "2024-01-04")
    text = plan(out.select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "value" not in text.split("ReadSchema")[1]


def test_indicator_set_shuffles_once(spark, tmp_path):
    path = str(tmp_path / "plain")
    base.bars(spark, SF).write.parquet(path)
    text = plan(ind.technical_indicators(spark.read.parquet(path)))
    assert text.count("Exchange hashpartitioning") == 1 and "Python" not in text and "Join" not in text


def test_daily_sentiment_is_one_partial_aggregate(spark):
    text = plan(dl.daily_sentiment(base.sent(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text and "Python" not in text


def test_copies_combine_before_the_shuffle(spark):
    text = plan(nw.dedupe_canonical(base.news(spark, SF)))
    assert "partial_min" in text and "Window" not in text


def test_caps_limit_before_the_shuffle(spark):
    text = plan(nw.cap_per_source(base.news(spark, SF), 5))
    assert text.count("WindowGroupLimit") >= 2


def test_conform_adds_typed_nulls(spark):
    out = conform(spark.sql("SELECT 'T' AS ticker, 1 AS close, 2 AS extra"), BARS)
    assert out.columns == [*BARS.names, "extra"] and dict(out.dtypes)["open"] == "double"
    assert len(COUNT_COLUMNS) == 4
