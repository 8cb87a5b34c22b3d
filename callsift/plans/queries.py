"""The query API over the three tables."""

from __future__ import annotations

import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.functions.skew import salted_join
from callsift.operators.compare import field_disagreement
from callsift.operators.runs import latest_runs

__all__ = ["compare_concurrency", "failed_calls", "field_disagreement", "list_runs", "recent_runs", "run_sql", "summarize_run"]


def list_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """Newest runs first."""
    return runs.orderBy(F.desc("started_at"), "run_id").limit(limit)


def recent_runs(updates: DataFrame, limit: int = 20) -> DataFrame:
    """``list_runs`` straight from the run log: the newest starts are found by a plain maximum per run, and only
    the runs among them are put together."""
    newest = updates.groupBy("run_id").agg(F.max("started_at").alias("started_at")).orderBy(F.desc("started_at"), "run_id").limit(limit)
    # ``limit`` rows.
    return list_runs(latest_runs(updates.join(F.broadcast(newest.select("run_id")), "run_id", "left_semi")), limit)


def summarize_run(rows: DataFrame, run_id: str) -> DataFrame:
    """Calls and mean token counts per status."""
    return (
        rows.filter(F.col("run_id") == run_id)
        .groupBy("extraction_status")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("prompt_token_count").alias("avg_prompt_tok"),
            F.avg("completion_token_count").alias("avg_completion_tok"),
        )
    )


def compare_concurrency(measurements: DataFrame, runs: DataFrame, test_name: str) -> DataFrame:
    """Mean measurements per concurrency level over the runs of one test.

    A run registered several times counts as often, as a plain join would have it.
    """
    metrics = {
        "req_per_sec": "req_per_sec",
        "error_rate": "error_rate",
        "hit_ratio": "prefix_cache_hit_ratio",
        "gpu_util": "gpu_util_mean",
    }
    needed = ["run_id", "concurrency", *metrics.values()]
    chosen = runs.filter(F.col("test_name") == test_name).groupBy("run_id").agg(F.count(F.lit(1)).alias("times"))
    matched = salted_join(measurements.select(*needed), chosen, ["run_id"], "inner", needed[1:])
    times = F.col("times")
    averages = [
        F.try_divide(F.sum(F.col(source) * times), F.sum(F.when(F.col(source).isNotNull(), times))).alias(out)
        for out, source in metrics.items()
    ]
    return matched.groupBy("concurrency").agg(*averages).orderBy("concurrency")


def failed_calls(rows: DataFrame, run_id: str, limit: int = 100) -> DataFrame:
    """Errors of a run, in call order so that the cut is repeatable."""
    return (
        rows.filter((F.col("run_id") == run_id) & (F.col("extraction_status") == "error"))
        .select("call_id", "error_message")
        .orderBy("call_id", "error_message")
        .limit(limit)
    )


#: Held while a text's names are those of its own views.
_NAMES = threading.RLock()


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame], args: dict[str, Any] | None = None) -> DataFrame:
    """Free-form SQL with named parameters over the given tables.

    The names hold for this text only: temporary views of the caller that have one of them are put back. Texts of several
    threads take turns, as names are resolved before this returns.
    """
    with _NAMES:
        return _run_sql(spark, text, views, args)


def _run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame], args: dict[str, Any] | None) -> DataFrame:
    before = {name: spark.table(name) for name in views if any(t.isTemporary for t in spark.catalog.listTables(pattern=name) if t.name == name)}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(text, args=args or {})
    finally:
        for name in views:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
