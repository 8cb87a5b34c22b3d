"""The tables as Parquet folders with pinned schemas; the log of commits says which of their files count."""

from __future__ import annotations

import os
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift import schemas
from callsift.operators.runs import committed_ids, latest_runs
from callsift.sources.commits import CommitLog, Conflict, Snapshot

UPDATED_AT = T.StructField("updated_at", T.TimestampType())
INGEST_BATCH = T.StructField("ingest_batch", T.StringType())
ATTEMPT = T.StructField("attempt", T.StringType())
# In merged files: the attempt that first wrote the row.
ORIGIN = T.StructField("origin", T.StringType())
COMPACTED = "compacted-"

# Table names.
CALLS = "calls_extractions"
MEASUREMENTS = "bench_measurements"
RUNS = "experiment_runs"
QUARANTINE = "quarantine"

STORED = {
    CALLS: T.StructType([*schemas.CALLS_EXTRACTIONS.fields, INGEST_BATCH]),
    MEASUREMENTS: schemas.BENCH_MEASUREMENTS,
    RUNS: T.StructType([*schemas.EXPERIMENT_RUNS.fields, UPDATED_AT]),
    QUARANTINE: T.StructType(
        [
            *(T.StructField(name, T.StringType()) for name in ("run_id", "source_file", "item", "reason")),
            T.StructField("receives", T.IntegerType()),
            INGEST_BATCH,
        ]
    ),
}
#: Folders below the calls table, outermost first.
PARTITIONS = ("run_id", "ingest_batch", "attempt")
#: So many attempts or runs are named in a filter; more are joined.
LITERALS = 1000
# A file below this size is worth merging; groups of files merged by one commit.
SMALL_BYTES = 32 << 20
GROUPS_PER_COMMIT = 10_000
# Files that no commit names are left alone for so long: their writer may still be at work.
GRACE_SECONDS = 7 * 24 * 3600
# What a commit holds at most, in rows and seconds.
COMMIT_ROWS = 1000
COMMIT_SECONDS = 30


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns and types; absent nullable columns become null."""
    present = set(df.columns)
    required = {f.name for f in schema.fields if not f.nullable}
    if required - present:
        raise ValueError(f"missing columns {sorted(required - present)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


class Warehouse:
    """Reads and writes the tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = CommitLog(spark, os.path.join(root, "_commits"))

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def read(self, name: str, snapshot: Snapshot | None = None) -> DataFrame:
        """The committed rows as of one snapshot; an empty frame while there are none."""
        schema = STORED[name]
        state = snapshot or self.log.snapshot()
        return self._stored(name, state).select(*schema.fieldNames())

    def _stored(self, name: str, state: Snapshot) -> DataFrame:
        """Committed rows with ``attempt`` and, for the calls, ``origin``."""
        schema = T.StructType([*STORED[name].fields, *([ORIGIN] if name == CALLS else []), ATTEMPT])
        if not state.attempts(name):
            return self.spark.createDataFrame([], schema)
        rows = self._counted(self.spark.read.schema(schema).parquet(self.path(name)), F.col("attempt"), state, name)
        if name == CALLS and any(batch.startswith(COMPACTED) for batch in state.live[CALLS]):
            rows = self._counted(rows, F.coalesce("origin", "attempt"), state, name)
        merged = [(run, a) for run, own in state.merged.items() for a in own] if name == CALLS else []
        if not merged:
            return rows
        gone = self.spark.createDataFrame(merged, "_run string, _attempt string")
        return rows.join(F.broadcast(gone), (F.col("run_id") == F.col("_run")) & (F.col("attempt") == F.col("_attempt")), "left_anti")

    def _counted(self, rows: DataFrame, attempt: Column, state: Snapshot, name: str) -> DataFrame:
        """Rows whose ``attempt`` counts."""
        live = sorted(state.attempts(name))
        if len(live) <= LITERALS:
            return rows.filter(attempt.isin(live))
        # As long as the log, which this process holds already.
        return rows.join(F.broadcast(self.spark.createDataFrame([(a,) for a in live], "_live string")), attempt == F.col("_live"), "left_semi")

    def calls(self) -> DataFrame:
        return self.read(CALLS).drop("ingest_batch")

    def runs(self) -> DataFrame:
        return latest_runs(self.read(RUNS))

    def _folders(self, run_ids: list[str], state: Snapshot) -> list[str]:
        """Folders of the given runs whose attempts count; no other run's folder is listed."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        live, files = state.attempts(CALLS), self.log.files
        found = []
        for run in run_ids:
            own = live - set(state.merged.get(run, ()))
            base = f"{self.path(CALLS)}/run_id={escape(run)}"
            for batch in files.names(base):
                found += [f"{base}/{batch}/{name}" for name in files.names(f"{base}/{batch}") if name.removeprefix("attempt=") in own]
        return found

    def new_attempt(self) -> str:
        return uuid.uuid4().hex

    def write_extractions(self, rows: DataFrame, ingest_batch: str, attempt: str, many_runs: bool = False, max_records_per_file: int = 0) -> None:
        """Put rows below run_id / ingest_batch / attempt, where nobody reads them before the attempt is committed.

        With ``many_runs`` rows are first gathered by run; the rebalance splits a large run over
        several files instead of one task. ``max_records_per_file`` (0: no limit) is the row limit of ``commit_policy``.
        """
        schema = T.StructType([*STORED[CALLS].fields, *([ORIGIN] if "origin" in rows.columns else [])])
        out = conform(rows.withColumn("ingest_batch", F.lit(ingest_batch)), schema).withColumn("attempt", F.lit(attempt))
        if many_runs:
            out = out.hint("rebalance", "run_id")
        # Dynamic overwrite gives every write a staging folder of its own, so writers do not meet.
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*PARTITIONS)
            .parquet(self.path(CALLS))
        )

    def write_rows(self, df: DataFrame, name: str, attempt: str) -> None:
        """The same for the tables that are not divided by run."""
        conform(df, STORED[name]).write.mode("overwrite").parquet(f"{self.path(name)}/attempt={attempt}")

    def append_extractions(self, rows: DataFrame, ingest_batch: str, many_runs: bool = False, max_records_per_file: int = 0) -> None:
        """Write and commit a batch. Writing a batch again replaces it in one step, also in runs that it no longer
        fills: readers see all of its older rows or all of its newer ones."""
        attempt = self.new_attempt()
        self.write_extractions(rows, ingest_batch, attempt, many_runs, max_records_per_file)
        self.log.commit({"set": {CALLS: {ingest_batch: attempt}}})

    def _of_runs(self, run_ids: list[str], but_not: list[str] = ()) -> DataFrame:
        """Committed rows of some runs, without those of some batches; only the runs' folders are listed, whatever else the table holds."""
        schema = T.StructType([*STORED[CALLS].fields, ORIGIN, ATTEMPT])
        state = self.log.snapshot().without(CALLS, but_not)
        paths = self._folders(run_ids, state)
        if not paths:
            return self.spark.createDataFrame([], STORED[CALLS])
        rows = self.spark.read.schema(schema).option("basePath", self.path(CALLS)).parquet(*paths)
        if any(f"/ingest_batch={COMPACTED}" in path for path in paths):
            rows = self._counted(rows, F.coalesce("origin", "attempt"), state, CALLS)
        return rows.select(*STORED[CALLS].fieldNames())

    def _sizes(self, name: str) -> DataFrame:
        """run_id (null but for the calls), attempt, files, largest and newest of every group of files, from a listing that opens none."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.path(name))
        folder = F.regexp_extract("path", "/run_id=([^/]+)/", 1)
        run = F.try_url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))) if name == CALLS else F.lit(None).cast("string")
        named = files.select(run.alias("run_id"), F.regexp_extract("path", "/attempt=([^/]+)/", 1).alias("attempt"), "length", "modificationTime")
        return named.groupBy("run_id", "attempt").agg(F.count(F.lit(1)).alias("files"), F.max("length").alias("largest"), F.max("modificationTime").alias("newest"))

    def compact(self, name: str = CALLS, run_ids: list[str] | None = None, small_bytes: int = SMALL_BYTES) -> int:
        """Merge small files, all groups of files of a table (or of some runs) that hold nothing but small ones, and return how many groups went.

        The files' sizes decide, from a listing. Rows are rewritten in files of the session's usual size and replace
        the old ones by one commit; if a batch among them is written again meanwhile, the commit fails with ``Conflict``
        and nothing has changed. Merged calls keep the attempt that wrote them, so a batch that is written again later
        still replaces its rows. Old files stay for readers at work until ``vacuum``.
        """
        state = self.log.snapshot()
        if not state.attempts(name):
            return 0
        live = self.spark.createDataFrame([(a,) for a in state.attempts(name)], "attempt string")
        merged = self.spark.createDataFrame([(run, a) for run, own in state.merged.items() for a in own], "run_id string, attempt string")
        sizes = self._sizes(name).join(F.broadcast(live), "attempt", "left_semi").filter(F.col("largest") < small_bytes)
        sizes = sizes.join(F.broadcast(merged), ["run_id", "attempt"], "left_anti") if name == CALLS else sizes
        if run_ids is not None:
            sizes = sizes.filter(F.col("run_id").isin(list(run_ids)))
        # A run that is one small file has nothing to merge with.
        several = sizes.groupBy("run_id").agg(F.sum("files").alias("n")).filter("n > 1").withColumnRenamed("run_id", "_run")
        picked = sizes.join(several, F.col("run_id").eqNullSafe(F.col("_run")), "left_semi").orderBy("run_id", "attempt").limit(GROUPS_PER_COMMIT)
        groups = [(r.run_id, r.attempt) for r in picked.select("run_id", "attempt").collect()]
        if not groups:
            return 0
        chosen = F.broadcast(self.spark.createDataFrame(groups, "_run string, _attempt string"))
        same = F.col("attempt") == F.col("_attempt")
        rows = self._stored(name, state).join(chosen, same & (F.col("run_id") == F.col("_run")) if name == CALLS else same, "left_semi")
        attempt, batch = self.new_attempt(), f"{COMPACTED}{uuid.uuid4().hex}"
        record: dict = {"set": {name: {batch: attempt}}}
        if name == CALLS:
            self.write_extractions(rows.withColumn("origin", F.coalesce("origin", "attempt")), batch, attempt, many_runs=True)
            record["merged"] = {}
            for run, own in groups:
                record["merged"].setdefault(run, []).append(own)
        else:
            self.write_rows(rows.hint("rebalance"), name, attempt)
            gone = {own for _, own in groups}
            record["unset"] = {name: [b for b, own in state.live[name].items() if own in gone]}

        def unchanged(now: Snapshot) -> None:
            if not {own for _, own in groups} <= now.attempts(name):
                raise Conflict("a batch was written again while it was merged")

        self.log.commit(record, unchanged)
        return len(groups)

    def vacuum(self, older_than_seconds: float = GRACE_SECONDS) -> int:
        """Delete groups of files that no commit names and that are older than the grace period; returns how many."""
        state, files = self.log.snapshot(), self.log.files
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        deleted, forget = 0, {}
        for name in STORED:
            if not files.names(self.path(name)):
                continue
            old = self._sizes(name).filter(F.col("newest") < F.lit(datetime.fromtimestamp(time.time() - older_than_seconds, timezone.utc)))
            for row in old.toLocalIterator():
                if row.attempt in state.attempts(name) and not (name == CALLS and row.attempt in state.merged.get(row.run_id, ())):
                    continue
                if name == CALLS:
                    run = f"{self.path(name)}/run_id={escape(row.run_id)}"
                    for batch in files.names(run):
                        files.delete(f"{run}/{batch}/attempt={row.attempt}")
                    forget.setdefault(row.run_id, []).append(row.attempt)
                else:
                    files.delete(f"{self.path(name)}/attempt={row.attempt}")
                deleted += 1
        known = {run: own for run, own in forget.items() if set(own) & set(state.merged.get(run, ()))}
        if known:
            self.log.commit({"forget": known})
        return deleted

    def sql(self, text: str, args: dict | None = None) -> DataFrame:
        """Free-form SQL over the stored tables by their names."""
        from callsift.plans.queries import run_sql

        return run_sql(self.spark, text, {CALLS: self.calls(), MEASUREMENTS: self.read(MEASUREMENTS), RUNS: self.runs()}, args)

    def append(self, df: DataFrame, name: str) -> None:
        """One or many rows to the run log or the measurements, cast to the declared types and committed at once."""
        attempt = self.new_attempt()
        self.write_rows(df, name, attempt)
        self.log.commit({"set": {name: {attempt: attempt}}})

    def committed_ids(self, run_ids: list[str] | None = None, but_not: list[str] = ()) -> DataFrame:
        """Successful (run_id, call_id); ``run_ids`` reads only their folders, ``but_not`` names batches to
        leave out: what an earlier try of the same work committed."""
        if run_ids is not None:
            return committed_ids(self._of_runs(run_ids, but_not))
        return committed_ids(self.read(CALLS, self.log.snapshot().without(CALLS, but_not)))

    def start_runs(self, runs: DataFrame) -> None:
        """Log runs as started; ``runs`` has run_id and any of the descriptive columns."""
        self.append(
            runs.withColumns(
                {
                    "started_at": F.current_timestamp(),
                    "ended_at": F.lit(None).cast("timestamp"),
                    "status": F.lit("running"),
                    "updated_at": F.current_timestamp(),
                }
            ),
            RUNS,
        )

    def finish_runs(self, finished: DataFrame) -> None:
        """Log the end of runs; ``finished`` has run_id and status."""
        self.append(
            finished.select(
                "run_id",
                "status",
                F.current_timestamp().alias("ended_at"),
                F.current_timestamp().alias("updated_at"),
            ),
            RUNS,
        )

    def record_measurements(self, df: DataFrame) -> None:
        now = F.lit(datetime.now(timezone.utc))
        stamped = df if "measured_at" in df.columns else df.withColumn("measured_at", now)
        self.append(stamped, MEASUREMENTS)
