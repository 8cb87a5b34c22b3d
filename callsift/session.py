"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; sizes are left to the cluster and to AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "callsift", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    Only a local-mode session, where driver and executors are one process, falls back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def ship(spark: SparkSession) -> None:
    """Give executors this package where they have no installed copy: one archive, sent by Spark, once per session.

    Needed for the operators of ``callsift.llm``; what the rest runs in Python travels with its tasks.
    """
    context = spark.sparkContext
    if getattr(context, "_has_callsift", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="callsift-"), "callsift"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    context._has_callsift = True


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="callsift-")


#: Folders written by the job at work in this thread, of which it is the owner.
_SCRATCH: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def materialize(df: DataFrame, purpose: str, reader: SparkSession | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors.

    Inside ``scratch`` the folder belongs to that block and goes at its end; elsewhere it stays as long as the caller wants.
    """
    spark = reader or df.sparkSession
    path = work_dir(spark, purpose)
    if (own := _SCRATCH.get()) is not None:
        own.append(path)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Owns what is materialized inside and deletes it at the end, also after a failure.

    The block gets a function that materializes a result for whoever is outside.
    """
    outer = _SCRATCH.get()
    token = _SCRATCH.set(own := [])

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        inside = _SCRATCH.set(outer)
        try:
            return materialize(df, purpose)
        finally:
            _SCRATCH.reset(inside)

    try:
        yield keep
    finally:
        _SCRATCH.reset(token)
        for path in own:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def at_most(spark: SparkSession, key: str, limit: int):
    """Holds a setting that is a count down to ``limit`` inside the block, then puts the session's own back."""
    before = spark.conf.get(key)
    own = int(before)
    spark.conf.set(key, str(min(own, limit) if own > 0 else limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has slots.

    Meant for plain scans feeding row-local work (a few large gz shards, one small file). Inputs
    that already have enough splits pass through without a shuffle.
    """
    want = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)
