"""Time the headline queries and print one JSON line.

Prices are keyed by supplier, so that the window operators run over many tickers. Each query is
built anew and written to the no-op sink three times; the median counts.
"""

from __future__ import annotations

import functools
import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import Window as W  # noqa: E402

from barlight.functions.numeric import flag  # noqa: E402
from barlight.operators import daily as dl  # noqa: E402
from barlight.operators import indicators as ind  # noqa: E402
from barlight.operators import news as nw  # noqa: E402
from barlight.operators import sentiment as sm  # noqa: E402
from barlight.operators.backtest import backtest_metrics, run_backtest  # noqa: E402
from barlight.operators.evaluate import roc_auc  # noqa: E402
from barlight.session import get_session, settle  # noqa: E402
from catalog import articles, base  # noqa: E402, F401
from catalog.base import REGISTRY  # noqa: E402
from catalog.evaluation import intraday_preds  # noqa: E402

RUNS = 3


def supplier_bars(spark: SparkSession, sf: str) -> DataFrame:
    return base.bars(spark, sf, ticker="l_suppkey")


def supplier_preds(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("ticker").orderBy("date")
    b = base.with_returns(supplier_bars(spark, sf))
    prob = ((F.row_number().over(w) * 7919) % 1000).cast("double") / 1000
    up = flag(F.lead("close", 1).over(w) > F.col("close"))
    return b.select("ticker", "date", "return", prob.alias("prob_up"), up.alias("label"))


@functools.cache
def stored_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Finished bars, so that an operator is timed without the bars being built."""
    return settle(supplier_bars(spark, sf))


HEADLINE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "merge_targets": lambda s, d: dl.merge_with_stock(base.ebars(s, d), dl.daily_sentiment(base.sent(s, d))),
    "daily_sentiment": lambda s, d: dl.daily_sentiment(base.sent(s, d)),
    "tech_full": lambda s, d: ind.technical_indicators(supplier_bars(s, d)),
    "ewm_macd": lambda s, d: ind.macd(supplier_bars(s, d)),
    "backtest_equity": lambda s, d: run_backtest(supplier_preds(s, d)),
    "backtest_metrics": lambda s, d: backtest_metrics(run_backtest(supplier_preds(s, d))),
    "roc_auc": lambda s, d: roc_auc(supplier_preds(s, d)),
    "news_dedupe": lambda s, d: nw.dedupe_canonical(base.news(s, d)),
    "tech_full_stored": lambda s, d: ind.technical_indicators(stored_bars(s, d)),
    "ewm_macd_stored": lambda s, d: ind.macd(stored_bars(s, d)),
    "backtest_intraday": lambda s, d: run_backtest(intraday_preds(s, d)),
    "feed_newsapi": lambda s, d: REGISTRY["feed_newsapi"][0](s, d),
    "lexicon_sentiment": lambda s, d: sm.lexicon_scores(base.table(s, d, "documents", "text"), base.lexicon(s)),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name, build in HEADLINE.items():
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
