"""End-to-end plans composed from the operators; every function stays one lazy plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.operators import evaluate as ev
from barlight.operators import ml
from barlight.operators.backtest import backtest_metrics, run_backtest
from barlight.operators.calendar import align_to_trading_day
from barlight.operators.daily import attach_news, daily_sentiment, merge_with_stock, no_sentiment
from barlight.operators.features import (
    align_columns,
    basic_features,
    fill_clean,
    full_features,
    lag_and_roll,
    short_aliases,
)
from barlight.operators.indicators import technical_indicators
from barlight.operators.layout import KEY
from barlight.operators.news import text_column
from barlight.operators.sentiment import Scorer, attach_scores, lexicon_scores, score_texts
from barlight.operators.splits import holdout, lookup_with_fallback


def scored_articles(
    news: DataFrame,
    scorer_factory: Callable[[], Scorer] | None = None,
    lexicon: DataFrame | None = None,
    calendar: DataFrame | None = None,
    batch_size: int = 16,
) -> DataFrame:
    """Articles aligned to trading days with their sentiment, by batch model or by lexicon."""
    aligned = align_to_trading_day(news, calendar=calendar)
    aligned = aligned.withColumn("_scored_text", text_column(aligned))
    if scorer_factory is not None:
        scored = score_texts(aligned, scorer_factory, "_scored_text", batch_size)
    elif lexicon is not None:
        scored = lexicon_scores(aligned, lexicon, "_scored_text")
    else:
        raise ValueError("a scorer_factory or a lexicon is needed")
    return attach_scores(aligned, scored, "_scored_text").drop("_scored_text", "text_hash")


def sentiment_bars(bars: DataFrame, news: DataFrame | None, **scoring) -> DataFrame:
    """Bars with daily sentiment and next-bar targets; no news means zero sentiment."""
    daily = no_sentiment(bars) if news is None else daily_sentiment(scored_articles(news, **scoring))
    return merge_with_stock(bars, daily)


def feature_build(bars: DataFrame, news: DataFrame | None, **scoring) -> DataFrame:
    """Align, score, aggregate, join, lag and roll, indicators."""
    return short_aliases(technical_indicators(lag_and_roll(sentiment_bars(bars, news, **scoring))))


def comprehensive_build(bars: DataFrame, news: DataFrame | None, **scoring) -> DataFrame:
    return full_features(sentiment_bars(bars, news, **scoring))


def preprocess(bars: DataFrame, news: DataFrame | None = None) -> DataFrame:
    """Basic indicators plus each day's news count and text; one row per bar."""
    aligned = None if news is None else align_to_trading_day(news)
    base = fill_clean(basic_features(bars))
    return attach_news(base, aligned)


def score_requests(features: DataFrame, requests: DataFrame, model: PipelineModel, names: list[str]) -> DataFrame:
    """(ticker, target_date) requests to probability and signal: lookup, alignment, scoring, clipping."""
    rows = lookup_with_fallback(features, requests)
    aligned = align_columns(rows, names)
    scored = ml.trade_signal(ml.score_rows(model, ml.assemble(aligned, names)))
    return scored.select(KEY, "target_date", "is_exact", "probability_up", "signal")


def classifier_tables(scored: DataFrame) -> dict[str, DataFrame]:
    """Every evaluation table of a classifier from its scored rows."""
    return {
        "confusion": ev.confusion(scored),
        "report": ev.class_report(scored),
        "headline": ev.headline(scored),
        "auc": ev.roc_auc(scored),
        "roc": ev.roc_curve(scored),
        "rolling_accuracy": ev.rolling_accuracy(scored),
    }


def evaluate_classifier(model: PipelineModel, features: DataFrame, names: list[str], label: str = "target_dir_1d", rows: int = 10) -> dict[str, DataFrame]:
    """Tables on the last ``rows`` rows per ticker, rolling accuracy on the rows before them."""
    split = holdout(features, rows)
    scored = ml.score_rows(model, ml.assemble(split, names, label))
    test, train = scored.filter("is_holdout"), scored.filter("not is_holdout")
    tables = classifier_tables(test) | {"rolling_accuracy": ev.rolling_accuracy(train)}
    if hasattr(model.stages[-1], "featureImportances"):
        tables["importances"] = ev.top_importances(ml.feature_importances(model, names, features))
    return tables


def evaluate_regressor(model: PipelineModel, features: DataFrame, names: list[str], label: str = "target_return_1d", rows: int = 10) -> dict[str, DataFrame]:
    split = holdout(features.filter(F.col(label).isNotNull()), rows)
    scored = ml.predict_values(model, ml.assemble(split, names, label)).filter("is_holdout")
    return {"metrics": ev.regression_metrics(scored), "residuals": ev.residuals(scored)}


def metrics_payload(scored: DataFrame, backtest: DataFrame, feature_count: int) -> DataFrame:
    """One nested row per ticker: holdout size, scores, confusion matrix, class report, backtest."""
    cells = ev.confusion(scored).groupBy(KEY).agg(
        F.sort_array(F.collect_list(F.struct("label", "prediction", "n"))).alias("confusion_matrix")
    )
    report = ev.class_report(scored).groupBy(KEY).agg(
        F.sort_array(F.collect_list(F.struct("class", "precision", "recall", "f1", "support"))).alias("report")
    )
    sizes = scored.groupBy(KEY).agg(F.count(F.lit(1)).alias("holdout_rows"))
    out = sizes.withColumn("feature_count", F.lit(feature_count))
    for part in (ev.headline(scored), ev.roc_auc(scored), cells, report):
        out = out.join(part, KEY, "left")
    scores = F.struct("accuracy", "precision", "recall", "f1", "auc", "confusion_matrix", "report")
    bt = backtest.select(KEY, F.struct(*[c for c in backtest.columns if c != KEY]).alias("backtest"))
    return out.select(KEY, "holdout_rows", "feature_count", scores.alias("eval_holdout")).join(bt, KEY, "left")


def full_backtest(scored: DataFrame, **rules) -> tuple[DataFrame, DataFrame]:
    curves = run_backtest(scored, **rules)
    return curves, backtest_metrics(curves)
