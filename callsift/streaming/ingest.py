"""Shards arriving in an inbox, each processed once, with a side table for what keeps failing."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callsift.functions.paths import derive_run_id
from callsift.operators.inference import ModelFn
from callsift.operators.runs import final_status, resume
from callsift.plans.pipeline import RunSettings, extract_rows
from callsift.session import materialize, scratch, spread
from callsift.sources.calls import SHARD_SUFFIX, decoded_path, parse_lines, usable_calls
from callsift.sources.notifications import parse_notifications
from callsift.sources.tables import CALLS, COMMIT_ROWS, COMMIT_SECONDS, QUARANTINE, Warehouse
from callsift.streaming.receives import DEAD_SCHEMA, dead_letters_stream

# Fixed value: tries per shard before what still fails is set aside.
MAX_RECEIVES = 2
RECEIVES = "receives"
DEAD_LETTERS = "dead_letters"
# Shards whose names the driver holds at once.
SHARDS_PER_ROUND = 1000


def commit_policy(rows: int = COMMIT_ROWS, seconds: int = COMMIT_SECONDS) -> dict[str, dict]:
    """Commit limits as Spark settings: a stream commits every ``seconds``; a file holds ``rows``."""
    return {
        "trigger": {"processingTime": f"{seconds} seconds"},
        "write": {"maxRecordsPerFile": rows},
    }


def dead_letters(receives: DataFrame, max_receives: int = MAX_RECEIVES) -> DataFrame:
    """Items received ``max_receives`` times or more without success, from a receive log.

    Input: item, kind, ok. Reachability pings are dropped; unknown messages never succeed.
    """
    succeeded = F.max(F.col("ok") & (F.col("kind") == "object"))
    return (
        receives.filter(F.col("kind") != "test")
        .groupBy("item", "kind")
        .agg(F.count(F.lit(1)).alias("receives"), succeeded.alias("succeeded"))
        .filter((F.col("receives") >= max_receives) & ~F.col("succeeded"))
        .select("item", "kind", "receives")
    )


def read_quarantine(warehouse: Warehouse) -> DataFrame:
    """What was set aside; an empty frame before anything was."""
    return warehouse.read(QUARANTINE)


def process_shards(
    warehouse: Warehouse,
    lines: DataFrame,
    model_fn: ModelFn,
    settings: RunSettings,
    batch: str,
    max_receives: int = MAX_RECEIVES,
) -> DataFrame:
    """One micro-batch of lines (value, source_file): one run per shard name. Returns the shards (source_file) that left something aside.

    A first pass handles all calls without a committed success, each further pass only the calls
    that ended in an error. What is left after ``max_receives`` passes, and unusable lines, go to
    the quarantine table. Rows and quarantine of all passes become visible by one commit under the batch's name, which
    replaces what an earlier try of the batch has committed, whatever the model answers now. ``batch`` must be unique among
    all batches of the warehouse. Only the folders of the batch's own runs are listed, and its outcome is taken from the
    rows it has just made, so the cost does not depend on the size of the table.
    """
    with scratch(warehouse.spark) as keep:
        return keep(_process(warehouse, lines, model_fn, settings, batch, max_receives), "failed")


def _process(warehouse: Warehouse, lines: DataFrame, model_fn: ModelFn, settings: RunSettings, batch: str, max_receives: int) -> DataFrame:
    spark = warehouse.spark
    tagged = parse_lines(lines).withColumn("run_id", derive_run_id(F.col("source_file")))
    parsed = materialize(tagged, "lines", spark)
    # One micro-batch holds at most maxFilesPerTrigger shards, so these names fit the driver.
    run_ids = [row.run_id for row in parsed.select("run_id").distinct().collect()]
    if not run_ids:
        return parsed.select("source_file").limit(0)
    warehouse.start_runs(parsed.select("run_id").distinct().withColumn("test_name", F.lit(settings.test_name)))

    passes = [f"{batch}-{receive}" for receive in range(1, max_receives + 1)]
    attempt = warehouse.new_attempt()
    done = materialize(warehouse.committed_ids(run_ids, but_not=[batch]), "committed")
    calls = usable_calls(parsed).withColumn("source_path", F.coalesce("source_path", "source_file"))
    pending = calls if done.isEmpty() else resume(calls, done)
    succeeded = []
    for name in passes:
        rows = extract_rows(pending, model_fn, settings)
        warehouse.write_extractions(rows, name, attempt, many_runs=True, max_records_per_file=settings.commit_rows)
        good = rows.filter(F.col("extraction_status") == "success").select("run_id", "call_id")
        in_error = rows.filter(F.col("extraction_status") == "error")
        succeeded.append(good)
        if in_error.isEmpty():
            break
        pending = resume(pending, good)

    in_error = in_error.select(
        "run_id",
        F.col("source_path").alias("source_file"),
        F.col("call_id").alias("item"),
        F.col("error_message").alias("reason"),
    )
    unusable = parsed.filter(F.col("line_error").isNotNull()).select(
        "run_id", "source_file", F.col("value").alias("item"), F.col("line_error").alias("reason")
    )
    aside = materialize(in_error.unionByName(unusable), "aside")
    # An error row names the path that its call gives for itself; the shard is the one that holds such a call.
    held = calls.select("run_id", F.col("call_id").alias("item"), "source_path", F.col("source_file").alias("_shard")).distinct()
    failing = in_error.select("run_id", "item", F.col("source_file").alias("source_path")).distinct().join(held, ["run_id", "item", "source_path"])
    failed = failing.select(F.col("_shard").alias("source_file")).union(unusable.select("source_file")).distinct()
    warehouse.write_rows(aside.withColumns({"receives": F.lit(max_receives), "ingest_batch": F.lit(batch)}), QUARANTINE, attempt)
    warehouse.log.commit({"set": {CALLS: {batch: attempt}, QUARANTINE: {batch: attempt}}})
    good = reduce(DataFrame.unionByName, succeeded).groupBy("run_id").agg(F.count(F.lit(1)).alias("succeeded"))
    bad = aside.groupBy("run_id").agg(F.count(F.lit(1)).alias("errors"))
    outcome = parsed.select("run_id").distinct().join(good, "run_id", "left").join(bad, "run_id", "left")
    warehouse.finish_runs(final_status(outcome.na.fill(0, ["succeeded", "errors"])))
    return failed


def _plain(path: Column) -> Column:
    """One form for local paths, which come with one or three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_key, path) of all files below ``root``, from a listing that Spark does; no file is opened."""
    from callsift.sources.commits import Files

    base = re.sub("^file:/+", "file:/", Files(spark).at(root)[1].toString()).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = _plain(decoded_path(F.col("_metadata.file_path")))
    return files.select(path.alias("path")).select(F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("object_key"), "path")


def read_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of exactly these files; characters with a meaning in patterns stand for themselves."""
    names = [re.sub(r"([{}\[\]*?\\])", r"\\\1", path) for path in paths]
    lines = spark.read.text(names).select("value", _plain(decoded_path(F.col("_metadata.file_path"))).alias("source_file"))
    return lines.filter(F.col("value").rlike(r"\S"))


def read_dead_letters(warehouse: Warehouse) -> DataFrame:
    try:
        return warehouse.spark.read.schema(DEAD_SCHEMA).parquet(warehouse.path(DEAD_LETTERS))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return warehouse.spark.createDataFrame([], DEAD_SCHEMA)


def ingest_notifications(
    warehouse: Warehouse,
    messages: DataFrame,
    root: str,
    model_fn: ModelFn,
    settings: RunSettings,
    batch: str,
    max_receives: int = MAX_RECEIVES,
    shards_per_round: int = SHARDS_PER_ROUND,
) -> DataFrame:
    """Process exactly the shards that a batch of messages names, and return the dead letters so far.

    ``messages(body)``. A message is received well when the object that it names is below ``root`` and leaves no error, told by
    the object's full path. A message that names no object or an absent one, or whose shard leaves errors, is a
    receive without success; so many receives make a dead letter (``count_receives``). Pings are dropped. A message
    that comes again processes its shard again, which touches only calls without a committed success.

    Keys meet a listing of the files in a join; the driver holds the names of about ``shards_per_round`` shards at a
    time, however many the messages name. A batch done again under its name replaces what it wrote and counts once.
    """
    spark = warehouse.spark
    with scratch(spark):
        parsed = materialize(parse_notifications(messages), "messages", spark)
        keys = parsed.filter("kind = 'object'").select("object_key").distinct()
        there = materialize(keys.join(list_objects(spark, root), "object_key"), "objects", spark)
        rounds = -(-there.count() // shards_per_round)
        failed = []
        for number in range(rounds):
            own = there.filter(F.pmod(F.xxhash64("object_key"), F.lit(rounds)) == number)
            if paths := [row.path for row in own.select("path").collect()]:
                failed.append(process_shards(warehouse, spread(read_shards(spark, paths)), model_fn, settings, f"{batch}-{number}", max_receives))
        bad = reduce(DataFrame.union, failed) if failed else there.select(F.col("path").alias("source_file")).limit(0)
        known = there.join(bad.select(F.col("source_file").alias("path"), F.lit(True).alias("_failed")).distinct(), "path", "left")
        received = (
            parsed.select("object_key", "body", "kind")
            .join(known, "object_key", "left")
            .select(F.coalesce("object_key", "body").alias("item"), "kind", (F.col("path").isNotNull() & F.col("_failed").isNull()).alias("ok"))
            .groupBy("item", "kind")
            .agg(F.max("ok").alias("ok"), F.count(F.lit(1)).alias("n"))
        )
        log = warehouse.path(RECEIVES)
        received.select("item", "kind", F.lit(batch).alias("ingest_batch"), "ok", "n").write.mode("overwrite").parquet(f"{log}/{batch}")
    dead_letters_stream(spark, log, warehouse.path(DEAD_LETTERS), f"{warehouse.path(DEAD_LETTERS)}-checkpoint", max_receives).awaitTermination()
    return read_dead_letters(warehouse)


def query_id(warehouse: Warehouse, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint, whatever it is called and however often it is started."""
    return json.loads(warehouse.spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def ingest_stream(
    warehouse: Warehouse,
    inbox: str,
    checkpoint: str,
    model_fn: ModelFn,
    settings: RunSettings,
    name: str = "inbox",
    max_files: int = 64,
    max_receives: int = MAX_RECEIVES,
    trigger: dict | None = None,
    glob: str = SHARD_SUFFIX,
) -> StreamingQuery:
    """Starts the stream. The default trigger takes what is there and stops, costing nothing while
    the inbox is idle; ``commit_policy()["trigger"]`` keeps it running."""
    # Gz shards are one split each: their lines are dealt out before the costly steps.
    slots = max(warehouse.spark.sparkContext.defaultParallelism, 1)
    lines = (
        warehouse.spark.readStream.format("text")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(inbox)
        .select("value", decoded_path(F.col("_metadata.file_path")).alias("source_file"))
        .filter(F.col("value").rlike(r"\S"))
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        unique = f"{name}-{query_id(warehouse, checkpoint)}-{batch_id:09d}"
        with scratch(warehouse.spark):
            process_shards(warehouse, batch.repartition(slots), model_fn, settings, unique, max_receives)

    return (
        lines.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
