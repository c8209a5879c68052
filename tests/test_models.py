"""Training, voting, persistence and the composed plans on a small separable series."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlight.operators import ml
from barlight.operators.features import align_columns, model_columns, remaining_columns, sentiment_columns
from barlight.plans import compose as pl
from barlight.sources import tables as st

COLUMNS = ["x1", "x2"]
TINY = {"trees": [5], "depth": [3], "min_leaf": [1]}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    out = []
    for ticker in ("A", "B"):
        x = rng.normal(size=(80, 2))
        y = x[:, 0] + 0.5 * x[:, 1]
        days = pd.date_range("2024-01-01", periods=80).date
        out += [(ticker, d, float(a), float(b), int(t > 0), float(t)) for d, (a, b), t in zip(days, x, y)]
    return spark.createDataFrame(out, "ticker string, date date, x1 double, x2 double, target_dir_1d int, target_return_1d double").cache()


def test_classifiers(rows, tmp_path):
    config = {
        "logreg": ml.CLASSIFIERS["logreg"],
        "rf": ml.CLASSIFIERS["rf"]._replace(grid=TINY),
        "xgb": ml.CLASSIFIERS["xgb"]._replace(grid={"rounds": [3], "depth": [2], "rate": [0.1]}),
    }
    out = ml.train_classifiers(rows, COLUMNS, models_config=config, n_splits=3)
    assert set(out) == {"logreg", "rf", "xgb", "ensemble"}
    assert out["logreg"].best_score > 0.9 and len(out["logreg"].cv_results) == 3
    assert 0.8 < out["ensemble"].best_score <= 1.0 and len(out["ensemble"].model) == 3
    paths = st.save_results(out, str(tmp_path), "clf", COLUMNS)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["clf_logreg", "clf_rf", "clf_xgb", "clf_ensemble"]
    data = ml.assemble(rows, COLUMNS, "target_dir_1d")
    saved, kept = (ml.vote_classifiers(data, m).select("ticker", "date", "prob_up") for m in (st.load_ensemble(paths[-1], 3), out["ensemble"].model))
    assert saved.exceptAll(kept).isEmpty()
    assert st.load_first_model([f"{tmp_path}/clf_rf", paths[0]])[0].endswith("clf_rf")
    again = ml.train_classifiers(rows, COLUMNS, models_config={"rf": config["rf"]}, n_splits=3)
    assert again["rf"].best_score == out["rf"].best_score and "ensemble" not in again


def test_regressors(rows):
    config = {
        "ridge": ml.REGRESSORS["ridge"],
        "rfr": ml.REGRESSORS["rfr"]._replace(grid=TINY),
        "xgbr": ml.REGRESSORS["xgbr"]._replace(grid={"rounds": [3], "depth": [2], "rate": [0.1]}),
    }
    out = ml.train_regressors(rows, COLUMNS, models_config=config, n_splits=3)
    assert set(out) == {"ridge", "rfr", "xgbr", "ensemble"}
    assert -0.01 < out["ridge"].best_score <= 0 and out["ridge"].best_params == {"alpha": 0.1}


def test_grid_points_cover_the_default_grids():
    assert len(ml._points(ml.FOREST_GRID)) == 12 and len(ml._points(ml.BOOST_GRID)) == 12
    assert ml._depth(None) == 30


def test_save_load_and_first_that_loads(rows, tmp_path):
    data = ml.assemble(rows, COLUMNS, "target_dir_1d")
    model = ml.CLASSIFIERS["logreg"].build({"C": 1.0}, 160).fit(data)
    path = str(tmp_path / "clf_logreg")
    st.save_model(model, path, COLUMNS)
    assert st.load_feature_names(path) == COLUMNS
    found, loaded = st.load_first_model([str(tmp_path / "clf_rf"), path])
    assert found == path
    a = ml.score_rows(model, data).agg(F.sum("prob_up")).first()[0]
    b = ml.score_rows(loaded, data).agg(F.sum("prob_up")).first()[0]
    assert a == pytest.approx(b) and st.load_first_model([str(tmp_path / "none")]) is None


def test_votes(rows):
    data = ml.assemble(rows, COLUMNS, "target_dir_1d")
    lr = ml.CLASSIFIERS["logreg"].build({"C": 1.0}, 160).fit(data)
    rf = ml.CLASSIFIERS["rf"].build({"trees": 5, "depth": 3, "min_leaf": 1}, 160).fit(data)
    voted = ml.vote_classifiers(data, [lr, rf])
    assert voted.filter((F.col("prob_up") > 0.5) != (F.col("vote") == 1)).count() == 0
    with pytest.raises(ValueError):
        ml.vote_classifiers(data, [lr])


def test_out_of_fold_covers_test_blocks_once(rows):
    out = ml.out_of_fold(rows, COLUMNS, "target_dir_1d", ml.CLASSIFIERS["logreg"], {"C": 1.0}, n_splits=3)
    assert out.count() == out.select("ticker", "date").distinct().count() == 2 * 3 * 20


def test_evaluation_plans(rows):
    data = ml.assemble(rows, COLUMNS, "target_dir_1d")
    rf = ml.CLASSIFIERS["rf"].build({"trees": 5, "depth": 3, "min_leaf": 1}, 160).fit(data)
    tables = pl.evaluate_classifier(rf, rows, COLUMNS, rows=10)
    assert tables["confusion"].agg(F.sum("n")).first()[0] == 20
    assert tables["importances"].first()["feature"] == "x1"
    ridge = ml.REGRESSORS["ridge"].build({"alpha": 1.0}, 160).fit(ml.assemble(rows, COLUMNS, "target_return_1d"))
    metrics = pl.evaluate_regressor(ridge, rows, COLUMNS)["metrics"].collect()
    assert all(r["mse"] < 0.1 and r["r2"] > 0.9 for r in metrics)


def test_requests(spark, rows):
    data = ml.assemble(rows, COLUMNS, "target_dir_1d")
    model = ml.CLASSIFIERS["logreg"].build({"C": 1.0}, 160).fit(data)
    requests = spark.sql("SELECT 'A' AS ticker, DATE'2024-01-05' AS target_date UNION ALL SELECT 'A', DATE'2030-01-01'")
    out = pl.score_requests(rows, requests, model, ["x1", "x2", "absent"][:2]).collect()
    assert len(out) == 2 and all(0 <= r["probability_up"] <= 1 and r["signal"] == int(r["probability_up"] > 0.5) for r in out)


def test_column_choice(spark):
    df = spark.sql("SELECT 'T' AS ticker, 1 AS sent_lag_1, 2 AS ma_5, 3 AS other, 4 AS daily_count, 5 AS target_return, 6.0D AS x")
    assert model_columns(df) == ["sent_lag_1", "ma_5", "daily_count"]
    assert sentiment_columns(df) == ["sent_lag_1", "daily_count"]
    assert remaining_columns(df) == ["sent_lag_1", "ma_5", "other", "x"]
    aligned = align_columns(df, ["x", "gone"])
    assert aligned.columns[:2] == ["x", "gone"] and aligned.first()["gone"] == 0.0


def test_metrics_payload_is_one_json_object_per_ticker(rows, tmp_path):
    scored = rows.select("ticker", "date", F.col("target_dir_1d").alias("label"), F.lit(0.7).alias("prob_up"), F.lit(1).alias("prediction"), F.lit(0.01).alias("return"))
    curves, metrics = pl.full_backtest(scored)
    st.write_metrics(pl.metrics_payload(scored, metrics, 2), str(tmp_path / "m"))
    lines = [json.loads(x) for p in (tmp_path / "m").glob("*.json") for x in p.read_text().splitlines()]
    assert {x["ticker"] for x in lines} == {"A", "B"} and lines[0]["eval_holdout"]["report"][0]["class"] == "0"


def _folds(rows, label):
    from barlight.operators.splits import expanding_folds

    data = ml.assemble(expanding_folds(rows, 3), COLUMNS, label).select("features", "label", "fold").cache()
    sizes = {r["fold"]: r["count"] for r in data.groupBy("fold").count().collect()}
    return ml.Folds(data, sizes, sorted(f for f in sizes if f >= 0))


@pytest.mark.parametrize("kind, label, score", [("xgb", "target_dir_1d", ml._f1), ("xgbr", "target_return_1d", ml._neg_mse)])
def test_first_rounds_of_one_boosting_equal_separate_fits(rows, kind, label, score):
    score = score()
    spec = (ml.CLASSIFIERS | ml.REGRESSORS)[kind]
    folds, points = _folds(rows, label), ml._points({"rounds": [2, 5, 9], "depth": [2], "rate": [0.3]})
    assert spec.sweep(folds, points, score, 4) == ml._single_fits(spec)(folds, points, score, 4)


@pytest.mark.parametrize("kind, label, score", [("rf", "target_dir_1d", ml._f1), ("rfr", "target_return_1d", ml._neg_mse)])
def test_forests_grow_in_parts(rows, kind, label, score):
    score = score()
    spec = (ml.CLASSIFIERS | ml.REGRESSORS)[kind]
    folds, points = _folds(rows, label), ml._points({"trees": [4, 10], "depth": [3], "min_leaf": [1, 3]})
    grown, single = spec.sweep(folds, points, score, 4), ml._single_fits(spec)(folds, points, score, 4)
    assert [s for p, s in zip(points, grown) if p["trees"] == 4] == [s for p, s in zip(points, single) if p["trees"] == 4]
    assert all(abs(a[f] - b[f]) < 0.3 for a, b in zip(grown, single) for f in folds.tests)


def test_ridge_from_products_equals_fits_and_normal_equations(rows):
    far = rows.withColumn("x1", F.col("x1") * 1e-3 + 1e6)
    spec, points = ml.REGRESSORS["ridge"], [{"alpha": a} for a in (0.0, 0.5, 40.0)]
    for df in (rows, far):
        folds = _folds(df, "target_return_1d")
        swept = spec.sweep(folds, points, ml._neg_mse(), 1)
        single = ml._single_fits(spec)(folds, points, ml._neg_mse(), 4)
        for a, b in zip(swept, single, strict=True):
            assert a == pytest.approx(b, rel=1e-5)
    pdf = rows.toPandas()
    x = pdf[COLUMNS].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    y = pdf["target_return_1d"].to_numpy()
    want = np.linalg.solve(z.T @ z + 40.0 * np.eye(2), z.T @ (y - y.mean())) / x.std(0)
    scaler, linear = ml.fit_rows(rows, COLUMNS, "target_return_1d", spec, {"alpha": 40.0}).stages
    assert np.allclose(linear.coefficients.toArray() / scaler.std.toArray(), want, rtol=1e-9)
