"""The batch run: calls -> features -> resume -> model -> validated rows -> table and registry."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.text import DEFAULT_MAX_CHARS
from callsift.operators import prepare
from callsift.operators.inference import BuildRequests, ModelFn, extract_batch
from callsift.operators.runs import final_status, marked
from callsift.sources.tables import Warehouse
from callsift.session import materialize, scratch


# What a skipped call is not staged with.
HEAVY = ("text", "words")


@dataclass
class RunSettings:
    """What stays the same for every call of a run."""

    model_id: str
    max_chars: int = DEFAULT_MAX_CHARS
    system_prompt: str | None = None
    enable_thinking: bool = False
    concurrency: int | None = None
    test_name: str = "inbox"
    #: Rows a written file holds at most (0: no limit), as in ``commit_policy``.
    commit_rows: int = 0
    model_options: dict = field(default_factory=dict)


def request_builder(settings: RunSettings) -> BuildRequests:
    def build(df: DataFrame) -> DataFrame:
        return prepare.build_requests(
            df, settings.model_id, settings.system_prompt, settings.enable_thinking
        )

    return build


def extract_rows(calls: DataFrame, model_fn: ModelFn, settings: RunSettings) -> DataFrame:
    """Calls with run_id -> rows of the extraction table, materialized."""
    judged = extract_batch(
        prepare.enrich(calls, settings.max_chars),
        request_builder(settings),
        model_fn,
        concurrency=settings.concurrency,
        **settings.model_options,
    )
    return prepare.assemble_rows(judged, settings.model_id)


def run_extraction(
    warehouse: Warehouse,
    calls: DataFrame,
    run_id: str,
    model_fn: ModelFn,
    settings: RunSettings,
    ingest_batch: str,
    skip_committed: bool = True,
    **run_info,
) -> DataFrame:
    """Runs one batch of calls under ``run_id`` and returns its statistics with the final status.

    The calls and the set of committed ids are read once each, before anything is written. The run is registered as
    running and always finished, also when resumed; a stopped or failed run is marked as such.
    """
    spark = warehouse.spark
    info = [F.lit(value).alias(name) for name, value in run_info.items()]
    warehouse.start_runs(spark.range(1).select(F.lit(run_id).alias("run_id"), *info))

    def finish(status: str) -> None:
        warehouse.finish_runs(spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(status).alias("status")))

    try:
        with scratch(spark) as keep:
            pending, skipped = calls.withColumn("run_id", F.lit(run_id)), 0
            if skip_committed:
                done = materialize(warehouse.committed_ids([run_id], but_not=[ingest_batch]), "committed")
                if not done.isEmpty():
                    # The input is read once: what is skipped is counted where it is found, without its text.
                    told = materialize(marked(pending, done, HEAVY), "marked")
                    pending, skipped = told.filter(~F.col("skipped")).drop("skipped"), told.filter("skipped").count()
            rows = extract_rows(pending, model_fn, settings)
            warehouse.append_extractions(rows, ingest_batch, max_records_per_file=settings.commit_rows)
            totals = keep(final_status(_batch_stats(rows, run_id, skipped)), "stats")
        warehouse.finish_runs(totals)
        return totals
    except KeyboardInterrupt:
        finish("interrupted")
        raise
    except Exception:
        finish("failed")
        raise


def _batch_stats(rows: DataFrame, run_id: str, skipped: int) -> DataFrame:
    """The counters of ``run_stats`` from the written rows, one per call that was not skipped."""
    done = rows.agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if(F.col("extraction_status") == "error").alias("errors"),
    )
    return done.select(
        F.lit(run_id).alias("run_id"),
        F.col("completed").alias("submitted"),
        F.lit(skipped).cast("bigint").alias("skipped"),
        "completed",
        "errors",
        (F.col("completed") - F.col("errors")).alias("succeeded"),
    )
