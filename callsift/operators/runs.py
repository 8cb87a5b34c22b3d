"""Resume, statistics and audits of extraction runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift import schemas
from callsift.functions.order import packed, whole_hash
from callsift.functions.skew import null_safe_match, salted_join


def _rows_with(status: str) -> Column:
    return F.count_if(F.col("extraction_status") == status)


def committed_ids(rows: DataFrame, run_id: str | None = None) -> DataFrame:
    """(run_id, call_id) pairs that already succeeded."""
    done = rows.filter(F.col("extraction_status") == "success")
    if run_id is not None:
        done = done.filter(F.col("run_id") == run_id)
    return done.select("run_id", "call_id").distinct()


def resume(calls: DataFrame, committed: DataFrame, hot_keys: bool = False) -> DataFrame:
    """Calls without a committed success; error rows do not count, repeated input ids all stay.

    Ids are nearly unique, so the join is a plain one: broadcast while Spark sizes the committed side small, else
    split by adaptive execution. ``hot_keys`` salts it for inputs that repeat single ids very often.
    """
    keys = ["run_id", "call_id"]
    done = committed.select(*keys).distinct()
    if hot_keys:
        return salted_join(calls, done, keys, "left_anti", keys + [c for c in ("source_path",) if c in calls.columns])
    renamed = done.withColumnsRenamed({name: f"_r_{name}" for name in keys})
    return calls.join(renamed, null_safe_match(keys, "_r_"), "left_anti")


def marked(calls: DataFrame, committed: DataFrame, heavy: tuple[str, ...] = ()) -> DataFrame:
    """All calls with ``skipped``: true where a success is committed. Skipped calls keep their ids but not their ``heavy`` columns."""
    keys = ["run_id", "call_id"]
    done = committed.select(*keys).distinct().withColumnsRenamed({name: f"_r_{name}" for name in keys}).withColumn("skipped", F.lit(True))
    told = calls.join(done, null_safe_match(keys, "_r_"), "left").drop(*[f"_r_{name}" for name in keys])
    told = told.withColumn("skipped", F.coalesce("skipped", F.lit(False)))
    return told.withColumns({name: F.when(~F.col("skipped"), F.col(name)) for name in heavy if name in calls.columns})


def run_stats(outcomes: DataFrame) -> DataFrame:
    """Counts per run from one row per input call: skipped, success, error, or raised.

    ``raised`` is a call that failed without leaving a row: an error, but not completed.
    """
    outcome = F.col("outcome")
    return outcomes.groupBy("run_id").agg(
        F.count_if(outcome != "skipped").alias("submitted"),
        F.count_if(outcome == "skipped").alias("skipped"),
        F.count_if(outcome.isin("success", "error")).alias("completed"),
        F.count_if(outcome.isin("error", "raised")).alias("errors"),
        F.count_if(outcome == "success").alias("succeeded"),
    )


def final_status(stats: DataFrame, interrupted: Column | None = None) -> DataFrame:
    """Adds ``status``: failed when nothing but errors came out, partial when some did."""
    stopped = F.lit(False) if interrupted is None else interrupted
    status = (
        F.when(stopped, "interrupted")
        .when((F.col("errors") > 0) & (F.col("succeeded") == 0), "failed")
        .when(F.col("errors") > 0, "partial")
        .otherwise("success")
    )
    return stats.withColumn("status", status)


def latest_rows(rows: DataFrame) -> DataFrame:
    """One row per (run_id, call_id): a success if there is one, then the newest; of rows written at the same time the one
    with the least error text, then by a hash of the whole row, so the order of rows never decides.

    The rank filter lets Spark drop all but the best row per key before the shuffle.
    """
    whole = F.xxhash64(*[F.to_json(F.struct(c)) if kind.startswith(("struct", "array", "map")) else F.col(c) for c, kind in rows.dtypes if kind != "variant"])
    best_first = Window.partitionBy("run_id", "call_id").orderBy(
        (F.col("extraction_status") == "success").desc(),
        F.col("extracted_at").desc(),
        F.coalesce(F.col("error_message"), F.lit("")),
        whole,
    )
    return rows.withColumn("_rank", F.row_number().over(best_first)).filter("_rank = 1").drop("_rank")


def latest_runs(updates: DataFrame) -> DataFrame:
    """Current state per run from its log of updates.

    Status and end come from the newest update, the description from the newest start, so finishing
    a run needs only its id. Of updates of one time an end comes after a start, then a hash of the update decides.
    """
    state = ["ended_at", "status"]
    order = packed(F.lit(False), F.col("updated_at"), whole_hash(*[F.col(c) for c in updates.columns]), F.col("status") != "running")
    described = [f.name for f in schemas.EXPERIMENT_RUNS.fields if f.name not in ("run_id", *state)]
    newest = updates.groupBy("run_id").agg(
        F.max_by(F.struct(*state), order).alias("state"),
        F.max_by(F.struct(*described), F.when(F.col("started_at").isNotNull(), order)).alias("start"),
    )
    return newest.select("run_id", "start.*", "state.*").select(*schemas.EXPERIMENT_RUNS.fieldNames())


def run_progress(rows: DataFrame) -> DataFrame:
    """Rows per run and status, for polling."""
    return rows.groupBy("run_id", "extraction_status").agg(F.count(F.lit(1)).alias("n"))


def audit_calls(expected: DataFrame, rows: DataFrame, run_id: str) -> DataFrame:
    """State of every call id that is in the input, in the run, or in both.

    Both sides are reduced to counts per id in one aggregation; there is no join.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    asked = expected.select("call_id", one.alias("asked"), zero.alias("stored"), zero.alias("succeeded"))
    done = rows.filter(F.col("run_id") == run_id).select(
        "call_id",
        zero.alias("asked"),
        one.alias("stored"),
        (F.col("extraction_status") == "success").cast("bigint").alias("succeeded"),
    )
    counts = asked.unionByName(done).groupBy("call_id").agg(
        F.sum("asked").alias("asked"), F.sum("stored").alias("stored"), F.sum("succeeded").alias("succeeded")
    )
    state = (
        F.when(F.col("asked") == 0, "extra")
        .when(F.col("stored") == 0, "missing")
        .when(F.col("succeeded") == 0, "incomplete")
        .when(F.col("succeeded") > F.col("asked"), "duplicated")
        .otherwise("complete")
    )
    return counts.withColumn("state", state)


def audit_run(expected: DataFrame, rows: DataFrame, run_id: str) -> DataFrame:
    """One row of totals for a run, with ``intact`` true when every call is complete."""
    state = F.col("state")
    totals = audit_calls(expected, rows, run_id).agg(
        F.coalesce(F.sum("asked"), F.lit(0)).alias("expected_calls"),
        F.coalesce(F.sum("stored"), F.lit(0)).alias("stored_rows"),
        F.count_if(state == "missing").alias("missing"),
        F.count_if(state == "extra").alias("extra"),
        F.count_if(state == "incomplete").alias("incomplete"),
        F.count_if(state == "duplicated").alias("duplicated"),
        F.count_if(state != "complete").alias("not_complete"),
    )
    return totals.select(
        F.lit(run_id).alias("run_id"), "*", (F.col("not_complete") == 0).alias("intact")
    ).drop("not_complete")


def run_collisions(keys: DataFrame) -> DataFrame:
    """Run ids that more than one object key maps to."""
    return (
        keys.select("run_id", "object_key")
        .distinct()
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("object_keys"))
        .filter("object_keys > 1")
    )
