"""Training, grid search over expanding windows, voting and scoring on Spark ML."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.functions.numeric import clip01, flag, signal
from barlight.operators.layout import KEY
from barlight.operators.splits import expanding_folds
from barlight.session import settle

SEED = 42
DEEPEST = 30  # Spark's limit, for grids that leave the depth open
FEATURES, LABEL, SCALED = "features", "label", "scaled"
MODEL_OUTPUTS = ["rawPrediction", "probability", "prediction", SCALED]

Params = dict[str, Any]


class Folds(NamedTuple):
    """Rows with features, label and fold, to be read often; ``sizes`` counts them by fold, ``tests`` are the folds to score."""

    data: DataFrame
    sizes: dict[int, int]
    tests: list[int]

    def train(self, fold: int) -> tuple[DataFrame, int]:
        return self.data.filter(F.col("fold") < fold), sum(n for f, n in self.sizes.items() if f < fold)

    def test(self, fold: int) -> DataFrame:
        return self.data.filter(F.col("fold") == fold)


Scores = dict[int, float]


class ModelSpec(NamedTuple):
    """``build(params, training_rows)`` gives an unfitted pipeline; ``grid`` lists values per parameter.

    ``sweep(folds, points, score)`` gives the score of every point in every test fold with fewer fits than one each; without
    it each is a fit of its own.
    """

    build: Callable[[Params, int], Pipeline]
    grid: dict[str, list]
    sweep: Callable[[Folds, list[Params], Column, int], list[Scores]] | None = None
    by_label: bool = False  # the penalty is divided by the label's deviation inside Spark, so ``build`` wants it as ``label_std``

    def fit(self, params: Params, count: int, rows: DataFrame) -> PipelineModel:
        if self.by_label:
            std = rows.agg(F.stddev_pop(LABEL)).first()[0]
            params = params | {"label_std": std or 1.0}
        return self.build(params, count).fit(rows)


class Trained(NamedTuple):
    """``model`` is the fitted pipeline; for an ensemble the list of its members."""

    model: PipelineModel | list[PipelineModel]
    best_score: float
    best_params: Params
    cv_results: list[dict] | None


def _scaled(estimator: Estimator) -> Pipeline:
    scaler = StandardScaler(inputCol=FEATURES, outputCol=SCALED, withMean=True, withStd=True)
    return Pipeline(stages=[scaler, estimator.setFeaturesCol(SCALED)])


def _depth(value: int | None) -> int:
    return DEEPEST if value is None else value


def _logistic(p: Params, rows: int) -> Pipeline:
    # the penalty counts weights of features scaled by the deviation of n, the scaler's is of n - 1; a close stop for weights of few rows
    penalty = (rows - 1) / (p["C"] * rows**2)
    lr = LogisticRegression(maxIter=200, tol=1e-12, regParam=penalty, elasticNetParam=0.0, standardization=False)
    return _scaled(lr)


def _ridge(p: Params, rows: int) -> Pipeline:
    # the sum of squared errors plus alpha times that of the weights of features scaled by their deviation (of n); the scaler's
    # is of n - 1, and Spark divides the penalty by the label's deviation
    penalty = p["alpha"] * (rows - 1) / rows**2 * p.get("label_std", 1.0)
    return _scaled(LinearRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal"))


def _forest(kind: type, subset: str) -> Callable[[Params, int], Pipeline]:
    def build(p: Params, rows: int) -> Pipeline:
        forest = kind(
            numTrees=p["trees"], maxDepth=_depth(p["depth"]), minInstancesPerNode=p["min_leaf"], seed=SEED,
            featureSubsetStrategy=subset,
        )
        return Pipeline(stages=[forest])

    return build


def _boosted(kind: type) -> Callable[[Params, int], Pipeline]:
    def build(p: Params, rows: int) -> Pipeline:
        trees = kind(
            maxIter=p["rounds"], maxDepth=p["depth"], stepSize=p["rate"], subsamplingRate=0.8,
            featureSubsetStrategy="0.8", seed=SEED,
        )
        return Pipeline(stages=[trees])

    return build


def _in_threads(spark: SparkSession, work: Callable, jobs: list, parallelism: int) -> list:
    """The driver only keeps the threads that submit fits, and what they return."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), jobs))


def _value(scored: DataFrame, score: Column) -> float:
    return float(scored.agg(score.alias("s")).first()["s"])


def _staged(counts: str, fit: Callable[[Params, list[int], DataFrame], dict[int, Callable[[DataFrame], DataFrame]]]):
    """A sweep in which points that differ only in ``counts`` (trees or rounds) share one fit of the largest.

    ``fit(params, counts, rows)`` gives, for every count, what scores rows with the first so many trees.
    """

    def sweep(folds: Folds, points: list[Params], score: Column, parallelism: int) -> list[Scores]:
        groups: dict[tuple, list[int]] = {}
        for i, p in enumerate(points):
            groups.setdefault(tuple((k, v) for k, v in p.items() if k != counts), []).append(i)

        def run(job: tuple[tuple, int]) -> list[tuple[int, int, float]]:
            rest, fold = job
            stages = fit(dict(rest), sorted({points[i][counts] for i in groups[rest]}), folds.train(fold)[0])
            return [(i, fold, _value(stages[points[i][counts]](folds.test(fold)), score)) for i in groups[rest]]

        out: list[Scores] = [{} for _ in points]
        for found in _in_threads(folds.data.sparkSession, run, list(itertools.product(groups, folds.tests)), parallelism):
            for i, fold, value in found:
                out[i][fold] = value
        return out

    return sweep


def _grown_forest(kind: type, subset: str):
    """Forests are grown in parts, one for each step between the wanted sizes, with seeds of their own; a size is answered by
    the mean of the parts up to it, weighted by their trees. The first part is the forest that a fit of that size gives."""

    def fit(p: Params, sizes: list[int], rows: DataFrame) -> dict[int, Callable[[DataFrame], DataFrame]]:
        parts: list[tuple[int, Any]] = []
        for i, (size, before) in enumerate(zip(sizes, [0, *sizes], strict=False)):
            grown = kind(numTrees=size - before, maxDepth=_depth(p["depth"]), minInstancesPerNode=p["min_leaf"], seed=SEED + i, featureSubsetStrategy=subset)
            parts.append((size - before, grown.fit(rows)))
        return {size: functools.partial(_mean_of_parts, parts[: i + 1]) for i, size in enumerate(sizes)}

    return fit


def _mean_of_parts(parts: list[tuple[int, Any]], rows: DataFrame) -> DataFrame:
    if len(parts) == 1:
        return parts[0][1].transform(rows)
    total = F.lit(0.0)
    for i, (trees, model) in enumerate(parts):
        rows = model.transform(rows)
        own = vector_to_array(F.col("probability"))[1] if "probability" in rows.columns else F.col("prediction")
        rows = rows.withColumn(f"_part{i}", own).drop(*MODEL_OUTPUTS)
        total += F.col(f"_part{i}") * trees
    mean = total / sum(trees for trees, _ in parts)
    return rows.withColumn("prediction", flag(mean > 0.5).cast("double") if hasattr(parts[0][1], "probabilityCol") else mean)


def first_trees(model: GBTClassificationModel | GBTRegressionModel, rounds: int) -> GBTClassificationModel | GBTRegressionModel:
    """The boosted model after its first ``rounds`` rounds, which is what a fit of so many rounds gives."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(kinds.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees(), java.treeWeights(), strict=True)):
        if i < rounds:
            trees[i], weights[i] = tree, weight
    kind = kinds.classification.GBTClassificationModel if isinstance(model, GBTClassificationModel) else kinds.regression.GBTRegressionModel
    return type(model)(kind(java.uid(), trees, weights))


def _grown_boosting(kind: type):
    def fit(p: Params, rounds: list[int], rows: DataFrame) -> dict[int, Callable[[DataFrame], DataFrame]]:
        grown = _boosted(kind)(p | {"rounds": rounds[-1]}, 0).getStages()[0].fit(rows)
        return {n: first_trees(grown, n).transform for n in rounds}

    return fit


def moments(folds: Folds) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """By fold the products Z'Z of Z = [1, features, label], shifted and scaled alike for all; and the shifts and scales.

    Two passes over the rows: means and deviations, by which columns are centred so that no digit is lost to an offset, then
    the products, summed by task before they are shuffled. What comes back has the features' square for each fold.
    """
    z = F.concat(vector_to_array(FEATURES), F.array(F.col(LABEL)))
    rows = folds.data.select("fold", z.alias("z"))
    cells = rows.select(F.posexplode("z").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    found = {r["i"]: (r["m"], r["s"] or 1.0) for r in cells.collect()}
    shift, scale = (np.array([found[i][k] for i in range(len(found))]) for k in (0, 1))

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            x = (np.array(b["z"].tolist()).reshape(len(b), len(shift)) - shift) / scale
            x = np.hstack([np.ones((len(x), 1)), x])
            for fold in np.unique(b["fold"]):
                own = x[b["fold"] == fold]
                sums[fold] = sums.get(fold, 0) + own.T @ own
        if sums:
            yield pd.DataFrame({"fold": list(sums), "p": [s.ravel().tolist() for s in sums.values()]})

    added = rows.mapInPandas(products, "fold int, p array<double>").select("fold", F.posexplode("p").alias("i", "x")).groupBy("fold", "i").agg(F.sum("x").alias("x"))
    side = len(shift) + 1
    out: dict[int, np.ndarray] = {}
    for r in added.collect():
        out.setdefault(r["fold"], np.zeros(side * side))[r["i"]] = r["x"]
    return {f: p.reshape(side, side) for f, p in out.items()}, shift, scale


def _ridge_sweep(folds: Folds, points: list[Params], score: Column, parallelism: int) -> list[Scores]:
    """Every alpha in every fold from one pass: training folds' products are added and solved, the test fold's give its error."""
    by_fold, _, scale = moments(folds)
    out: list[Scores] = [{} for _ in points]
    for fold in folds.tests:
        seen = sum(p for f, p in by_fold.items() if f < fold)
        n, mean = seen[0, 0], seen[0, 1:] / seen[0, 0]
        cov = seen[1:, 1:] / n - np.outer(mean, mean)
        spread = np.sqrt(np.clip(np.diag(cov)[:-1], 0, None))
        spread = np.where(spread > 1e-12, spread, 1.0)  # a constant feature has no weight
        xx, xy = cov[:-1, :-1] / np.outer(spread, spread), cov[:-1, -1] / spread
        for i, p in enumerate(points):
            b = np.linalg.solve(xx + np.eye(len(spread)) * p["alpha"] / n, xy) / spread
            residual = np.concatenate([[b @ mean[:-1] - mean[-1]], -b, [1.0]])  # label less prediction, on [1, x, y]
            test = by_fold[fold]
            out[i][fold] = -float(residual @ test @ residual / test[0, 0] * scale[-1] ** 2)
    return out


# Default hyper-parameter grids.
FOREST_GRID = {"trees": [100, 200], "depth": [None, 5, 10], "min_leaf": [1, 3]}
BOOST_GRID = {"rounds": [100, 200], "depth": [2, 3, 4], "rate": [0.05, 0.1]}

CLASSIFIERS = {
    "logreg": ModelSpec(_logistic, {"C": [0.1, 1.0, 5.0]}),
    "rf": ModelSpec(_forest(RandomForestClassifier, "sqrt"), FOREST_GRID, _staged("trees", _grown_forest(RandomForestClassifier, "sqrt"))),
    "xgb": ModelSpec(_boosted(GBTClassifier), BOOST_GRID, _staged("rounds", _grown_boosting(GBTClassifier))),
}
REGRESSORS = {
    "ridge": ModelSpec(_ridge, {"alpha": [0.1, 1.0, 5.0]}, _ridge_sweep, by_label=True),
    "rfr": ModelSpec(_forest(RandomForestRegressor, "all"), FOREST_GRID, _staged("trees", _grown_forest(RandomForestRegressor, "all"))),
    "xgbr": ModelSpec(_boosted(GBTRegressor), BOOST_GRID, _staged("rounds", _grown_boosting(GBTRegressor))),
}


def assemble(df: DataFrame, columns: list[str], label: str | None = None) -> DataFrame:
    """Feature vector from ``columns`` with missing values as 0.0; rows without a label are dropped."""
    out = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    if label is not None:
        out = out.withColumn(LABEL, F.col(label).cast("double")).filter(F.col(LABEL).isNotNull())
    return VectorAssembler(inputCols=columns, outputCol=FEATURES, handleInvalid="error").transform(out)


def _points(grid: dict[str, list]) -> list[Params]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _f1() -> Column:
    y, p = F.col(LABEL) == 1, F.col("prediction") == 1
    tp, wrong = F.sum(flag(y & p)), F.sum(flag(y != p))
    return F.coalesce(F.try_divide(tp * 2.0, tp * 2.0 + wrong), F.lit(0.0))


def _neg_mse() -> Column:
    err = F.col(LABEL) - F.col("prediction")
    return -F.avg(err * err)


def _single_fits(spec: ModelSpec):
    """A sweep without anything shared: one fit a point and fold."""

    def sweep(folds: Folds, points: list[Params], score: Column, parallelism: int) -> list[Scores]:
        def run(job: tuple[int, int]) -> float:
            i, fold = job
            rows, n = folds.train(fold)
            return _value(spec.fit(points[i], n, rows).transform(folds.test(fold)), score)

        jobs = list(itertools.product(range(len(points)), folds.tests))
        found = dict(zip(jobs, _in_threads(folds.data.sparkSession, run, jobs, parallelism), strict=True))
        return [{f: found[i, f] for f in folds.tests} for i in range(len(points))]

    return sweep


def grid_search(folded: DataFrame, spec: ModelSpec, score: Column, parallelism: int = 8) -> Trained:
    """Every grid point over every fold, trained on smaller fold numbers only; the best is refitted on all rows.

    ``folded`` carries features, label and fold and should be cached: every fit reads it. Points that one fit can answer
    share it (see ``ModelSpec.sweep``): forests and boosting by trees, ridge by its products. Fits are Spark jobs; the
    driver only keeps the threads that submit them and one score per point and fold.
    """
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    folds = Folds(folded, sizes, sorted(f for f in sizes if f >= 0))
    if not folds.tests:
        raise ValueError("no ticker is long enough for the requested number of folds")
    points = _points(spec.grid)
    scores = (spec.sweep or _single_fits(spec))(folds, points, score, parallelism)
    results = []
    for point, by_fold in zip(points, scores, strict=True):
        own = [by_fold[f] for f in folds.tests]
        results.append({"params": point, "mean_score": sum(own) / len(own), "fold_scores": own})
    best = max(results, key=lambda r: r["mean_score"])
    model = spec.fit(best["params"], sum(sizes.values()), folded)
    return Trained(model, best["mean_score"], best["params"], results)


def train_classifiers(
    df: DataFrame,
    columns: list[str],
    label: str = "target_dir_1d",
    models_config: dict[str, ModelSpec] | None = None,
    n_splits: int = 5,
    order: str = "date",
) -> dict[str, Trained]:
    """Best model per configured classifier by F1, plus the voting ensemble when there are two or more."""
    return _train(df, columns, label, models_config or CLASSIFIERS, n_splits, order, _f1(), vote_classifiers, _accuracy())


def train_regressors(
    df: DataFrame,
    columns: list[str],
    label: str = "target_return_1d",
    models_config: dict[str, ModelSpec] | None = None,
    n_splits: int = 5,
    order: str = "date",
) -> dict[str, Trained]:
    """Best model per configured regressor by negative MSE, plus the averaging ensemble."""
    return _train(df, columns, label, models_config or REGRESSORS, n_splits, order, _neg_mse(), vote_regressors, _r2())


def _accuracy() -> Column:
    return F.avg(flag(F.col(LABEL) == F.col("vote")))


def _r2() -> Column:
    err = F.col(LABEL) - F.col("vote")
    return 1.0 - F.try_divide(F.avg(err * err), F.var_pop(LABEL))


def _train(df, columns, label, config, n_splits, order, score, vote, vote_score) -> dict[str, Trained]:
    folded = expanding_folds(df.filter(F.col(label).isNotNull()), n_splits, order)
    data = assemble(folded, columns, label).select(FEATURES, LABEL, "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        results = {name: grid_search(data, spec, score) for name, spec in config.items()}
        if len(results) >= 2:
            members = [r.model for r in results.values()]
            voted = vote(data, members)
            value = voted.agg(vote_score.alias("s")).first()["s"]  # on the training rows
            results["ensemble"] = Trained(members, float("nan") if value is None else float(value), {}, None)
        return results
    finally:
        data.unpersist()


def fit_rows(df: DataFrame, columns: list[str], label: str, spec: ModelSpec, params: Params) -> PipelineModel:
    """One model on all rows with a label; the penalty knows their number."""
    data = assemble(df, columns, label).select(FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return spec.fit(params, data.count(), data)
    finally:
        data.unpersist()


def up_probability(scored: DataFrame) -> Column:
    """Probability of the up class, or the raw decision value of a model without probabilities."""
    for name in ("probability", "rawPrediction"):
        if name in scored.columns:
            return vector_to_array(F.col(name))[1]
    return F.col("prediction")


def score_rows(model: PipelineModel, assembled: DataFrame) -> DataFrame:
    """``prob_up`` and ``prediction`` (prob_up >= 0.5)."""
    scored = model.transform(assembled)
    scored = scored.withColumn("prob_up", up_probability(scored))
    scored = scored.drop(*MODEL_OUTPUTS, FEATURES)
    return scored.withColumn("prediction", flag(F.col("prob_up") >= 0.5))


def predict_values(model: PipelineModel, assembled: DataFrame) -> DataFrame:
    scored = model.transform(assembled)
    return scored.drop(*[c for c in MODEL_OUTPUTS if c != "prediction"], FEATURES)


def _votes(assembled: DataFrame, models: list[PipelineModel], kind: str) -> DataFrame:
    if len(models) < 2:
        raise ValueError("a vote needs at least two models")
    out = assembled
    for i, model in enumerate(models):
        out = model.transform(out)
        if kind == "probability":
            out = out.withColumn(f"_vote{i}", vector_to_array(F.col("probability"))[1])
        else:
            out = out.withColumn(f"_vote{i}", F.col("prediction"))
        out = out.drop(*MODEL_OUTPUTS)
    return out


def _mean_vote(models: list[PipelineModel]) -> Column:
    return sum((F.col(f"_vote{i}") for i in range(len(models))), F.lit(0.0)) / len(models)


def vote_classifiers(assembled: DataFrame, models: list[PipelineModel]) -> DataFrame:
    """``vote``: mean probability above one half if every model has probabilities, else hard majority."""
    soft = all(hasattr(m.stages[-1], "probabilityCol") for m in models)
    out = _votes(assembled, models, "probability" if soft else "prediction")
    mean = _mean_vote(models)
    out = out.withColumns({"prob_up": mean, "vote": flag(mean > 0.5).cast("double")})
    return out.drop(*[f"_vote{i}" for i in range(len(models))])


def vote_regressors(assembled: DataFrame, models: list[PipelineModel]) -> DataFrame:
    out = _votes(assembled, models, "prediction").withColumn("vote", _mean_vote(models))
    return out.drop(*[f"_vote{i}" for i in range(len(models))])


def out_of_fold(
    df: DataFrame, columns: list[str], label: str, spec: ModelSpec, params: Params, n_splits: int = 5, order: str = "date"
) -> DataFrame:
    """Rows of every test block scored by a model that saw earlier blocks only."""
    folded = expanding_folds(df, n_splits, order)
    data = settle(assemble(folded, columns, label))
    sizes = {r["fold"]: r["n"] for r in data.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for fold in sorted(f for f in sizes if f >= 0):
        rows = sum(n for f, n in sizes.items() if f < fold)
        model = spec.fit(params, rows, data.filter(F.col("fold") < fold))
        parts.append(score_rows(model, data.filter(F.col("fold") == fold)))
    if not parts:
        raise ValueError("no ticker is long enough for the requested number of folds")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def feature_importances(model: PipelineModel, columns: list[str], like: DataFrame) -> DataFrame:
    """(feature, importance) of a tree model; as many rows as features."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(columns, values)]
    return like.sparkSession.createDataFrame(rows, "feature string, importance double")


def trade_signal(scored: DataFrame) -> DataFrame:
    """Probability clipped to [0, 1] and the strict signal above one half."""
    out = scored.withColumn("probability_up", clip01("prob_up"))
    return out.withColumn("signal", signal("probability_up")).withColumn(KEY, F.upper(KEY))
