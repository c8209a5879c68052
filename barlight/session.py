"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "barlight", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps mean UTC everywhere, so the session zone must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the checkpoint folder already set.

    Where neither is set, in local mode only, a folder beside the session's tables serves.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_barlight"


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint a frame that a plan reads more than once."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
