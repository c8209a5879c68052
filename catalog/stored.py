"""Queries through the smaller sinks, and over what has no chart or model of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barlight.operators import evaluate as ev
from barlight.operators import features as ft
from barlight.operators import sentiment as sm
from barlight.operators import stats as ss
from barlight.session import settle, shared_folder
from barlight.sources import tables as st
from catalog.articles import length_scorer
from catalog.base import *  # noqa: F403
from catalog.evaluation import priced
from catalog.series import merged


def _through_report(spark, frame):
    """The rows of a frame from the CSV report that it was written to."""
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    st.write_report(frame, path)
    return spark.read.schema(frame.schema).option("header", True).csv(path)


@query("correlation_report", REGISTRY["corr_matrix"][1])
def correlation_report(spark, sf):
    return rounded(_through_report(spark, ss.correlation_matrix(priced(spark, sf))), 7)


@query("causality_report", REGISTRY["granger_p_values"][1])
def causality_report(spark, sf):
    return pick(_through_report(spark, ss.granger(preds(spark, sf), x="prob_up")), "ticker, lag, n, test", "statistic, p_value", 6)


@query("observed_rows", f"{ctes(BARS)} SELECT count(*) AS rows FROM bars")
def observed_rows(spark, sf):
    """Rows counted by the job that writes them."""
    counted, seen = st.observed(bars(spark, sf), f"bars-{uuid.uuid4().hex}")
    st.write_metrics(counted, f"{shared_folder(spark)}/observed-{uuid.uuid4().hex}")
    return spark.createDataFrame([(seen.get["rows"],)], "rows long")


@query(
    "cached_sources",
    """WITH c AS (SELECT DISTINCT sha256(text) AS h FROM documents JOIN labels USING (doc_id))
    SELECT lang, count(*) = count(c.h) AS all_cached FROM documents LEFT JOIN c ON c.h = sha256(text) GROUP BY 1
    UNION ALL SELECT 'labelled', count(*) = count(c.h) FROM documents JOIN labels USING (doc_id) LEFT JOIN c ON c.h = sha256(text)""",
)
def cached_sources(spark, sf):
    """Whether a cache holds every text of a set: of each language, and of the documents that filled it."""
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    judged = docs.join(table(spark, sf, "labels", "doc_id"), "doc_id", "left_semi")
    cache = settle(sm.with_text_key(judged).select("text_hash", F.lit("kept").alias("label"), F.lit(0.0).alias("score")).distinct())
    sets = [(r["lang"], docs.filter(F.col("lang").eqNullSafe(r["lang"]))) for r in docs.select("lang").distinct().collect()]
    rows = [(name, sm.all_cached(texts, cache)) for name, texts in [*sets, ("labelled", judged)]]
    return spark.createDataFrame(rows, "lang string, all_cached boolean")


@query(
    "scores_in_order",
    """SELECT row_number() OVER (ORDER BY doc_id % 97, doc_id) - 1 AS place, doc_id, CASE length(text) % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS label FROM documents""",
)
def scores_in_order(spark, sf):
    """Scores in the order of the requests, with the place at which each came out."""
    seq = F.struct(F.col("doc_id") % 97, "doc_id")
    docs = table(spark, sf, "documents", "doc_id", "text").withColumn("seq", seq)
    out = sm.in_request_order(docs, sm.score_texts(docs, length_scorer)).select("doc_id", "label")
    return out.rdd.zipWithIndex().map(lambda x: (x[1], x[0]["doc_id"], x[0]["label"])).toDF("place long, doc_id long, label string")


@query(
    "top_features",
    f"{ctes(BARS)} SELECT feature, round(importance, 8) + 0.0 AS importance FROM (SELECT ticker || ' ' || year(date) AS feature, avg(close) AS importance FROM bars GROUP BY 1) x ORDER BY x.importance DESC, feature LIMIT 20",
)
def top_features(spark, sf):
    """The twenty largest of a table of importances."""
    name = F.concat_ws(" ", "ticker", F.year("date").cast("string")).alias("feature")
    return rounded(ev.top_importances(bars(spark, sf).groupBy(name).agg(F.avg("close").alias("importance"))), 8)


_CHOSEN = {
    "model": ["daily_count", "daily_mean_sentiment", "ma_5", "sent_lag_1"],
    "sentiment": ["daily_count", "daily_mean_sentiment", "sent_lag_1"],
    "remaining": ["close", "ma_5", "ret", "sent_lag_1", "target_dir_1d", "target_return_1d", "volume"],
}


@query(
    "chosen_columns",
    ctes(SENT, DAILY, EBARS, MERGED, f"x AS (SELECT *, {sql_lag('daily_mean_sentiment', 1)} AS sent_lag_1, {sql_full('avg', 'close', 5)} AS ma_5 FROM merged)")
    + " UNION ALL ".join(f" SELECT '{kind}' AS kind, '{c}' AS name, count({c}) AS present FROM x" for kind, names in _CHOSEN.items() for c in names),
)
def chosen_columns(spark, sf):
    """What each way of choosing features takes from one frame, and how many values each column has."""
    w = W.partitionBy("ticker").orderBy("date")
    five = w.rowsBetween(-4, 0)
    m = merged(spark, sf).withColumnRenamed("return", "ret").withColumns(
        {"sent_lag_1": F.lag("daily_mean_sentiment", 1).over(w), "ma_5": F.when(F.count("close").over(five) == 5, F.avg("close").over(five))}
    )
    chosen = {"model": ft.model_columns(m), "sentiment": ft.sentiment_columns(m), "remaining": ft.remaining_columns(m)}
    counts = m.agg(*[F.count(c).alias(c) for c in m.columns])
    cells = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("name"), F.col(c).alias("present")) for kind, names in chosen.items() for c in names])
    return counts.select(F.inline(cells))
