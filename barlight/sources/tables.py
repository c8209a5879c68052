"""Stored tables between stages: features, news, CSV stages, metrics, and reports.

Partitioned sinks are rebalanced on the partition columns first: few files per ticker, and a ticker
with a large share of the rows is split over several writers.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.operators.ml import Trained


def write_features(features: DataFrame, path: str) -> None:
    """One partition per upper-cased ticker; only the tickers present are replaced."""
    keyed = features.withColumn("ticker", F.upper("ticker"))
    keyed.hint("rebalance", "ticker").write.partitionBy("ticker").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_features(spark: SparkSession, path: str, ticker: str, schema: T.StructType | None = None) -> DataFrame:
    """One ticker's features by partition pruning; a ticker without any is an error."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(path).filter(F.col("ticker") == ticker.upper())
    if rows.isEmpty():
        raise FileNotFoundError(f"no features for {ticker.upper()} under {path}")
    return rows


def write_news(news: DataFrame, path: str) -> None:
    news.hint("rebalance", "source", "ticker").write.partitionBy("source", "ticker").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_records(news: DataFrame, path: str) -> None:
    """JSON lines with ISO dates."""
    news.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(path)


# A missing value is written as backslash N, which no text becomes, since its own backslashes are doubled.
_STAGE = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _texts_as(df: DataFrame, spelled) -> DataFrame:
    return df.select(*[spelled(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _escaped(c: Column) -> Column:
    """The text in one line: backslashes doubled, line ends spelled."""
    for plain, spelled in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(spelled))
    return c


def _plain(c: Column) -> Column:
    """What :func:`_escaped` spelled; between doubled backslashes a single one belongs to a line end."""
    parts = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(c.isNotNull(), F.array_join(parts, "\\"))


def write_stage(df: DataFrame, path: str) -> None:
    """CSV whose texts keep line ends, quotes, blanks and emptiness; quotes are doubled, a record is one line."""
    _texts_as(df, _escaped).write.mode("overwrite").options(**_STAGE, quoteAll=True).csv(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`write_stage` wrote. A record is one line, so large files are read by many tasks."""
    return _texts_as(spark.read.schema(schema).options(**_STAGE).csv(path), _plain)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON object per ticker."""
    metrics.write.mode("overwrite").json(path)


def write_report(table: DataFrame, path: str) -> None:
    """Correlation and causality tables as CSV."""
    table.write.mode("overwrite").option("header", True).csv(path)


def append_scores(fresh: DataFrame, path: str) -> None:
    fresh.write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str, features: list[str]) -> None:
    """The fitted pipeline and, beside it, the feature names in training order."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(features),)], "names string").coalesce(1).write.mode("overwrite").json(f"{path}_features")


def save_results(results: dict[str, Trained], folder: str, prefix: str, features: list[str]) -> list[str]:
    """Every fitted model under ``{folder}/{prefix}_{name}``; an ensemble has its members below that path, numbered."""
    paths = []
    for name, trained in results.items():
        paths.append(f"{folder}/{prefix}_{name}")
        if isinstance(trained.model, list):
            for i, member in enumerate(trained.model):
                save_model(member, f"{paths[-1]}/{i}", features)
        else:
            save_model(trained.model, paths[-1], features)
    return paths


def load_ensemble(path: str, members: int) -> list[PipelineModel]:
    """The members of a saved ensemble, in voting order."""
    return [load_model(f"{path}/{i}") for i in range(members)]


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_feature_names(path: str) -> list[str]:
    spark = SparkSession.getActiveSession()
    return json.loads(spark.read.schema("names string").json(f"{path}_features").first()["names"])


def load_first_model(paths: list[str]) -> tuple[str, PipelineModel] | None:
    """The first path that loads, in order of preference; None when none does."""
    for path in paths:
        try:
            return path, load_model(path)
        except Exception:  # a missing or unreadable model is passed over, whatever the storage raises
            continue
    return None


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count as a by-product of whatever action runs the frame next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def newest(df: DataFrame, n: int, order: str = "date", *ties: str) -> DataFrame:
    return df.orderBy(F.col(order).desc(), *ties).limit(n)
