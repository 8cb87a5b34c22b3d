"""Receives of messages as keyed state: an item that keeps failing becomes a dead letter, once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECEIVES_SCHEMA = "item string, kind string, ingest_batch string, ok boolean, n long"
DEAD_SCHEMA = "item string, kind string, receives long"
#: Into how many states items are dealt; a micro-batch reads and writes those of its own items whole.
BUCKETS = 1 << 16


class _Letters(StatefulProcessor):
    """A bucket of items. Per item: the receives of each batch until it succeeds or has been received too often; then only that
    it is settled.

    A batch that comes again replaces what it said before, so a repeated delivery of the log counts once. The bucket's state is
    read and written once per micro-batch; a settled item is the row that has no ``n``.
    """

    def __init__(self, max_receives: int):
        self.max_receives = max_receives

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getValueState("items", "item array<string>, kind array<string>, ingest_batch array<string>, n array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told: dict[tuple, dict[str, int]] = {}
        good = set()
        for frame in rows:
            for item, kind, batch, ok, n in zip(*(frame[name].tolist() for name in ("item", "kind", "ingest_batch", "ok", "n"))):
                counts = told.setdefault((item, kind), {})
                counts[batch] = counts.get(batch, 0) + int(n)
                if ok:
                    good.add((item, kind))
        known: dict[tuple, dict[str, int] | None] = {}
        for item, kind, batch, n in zip(*(self.items.get() or ((), (), (), ()))):
            if n is None:
                known[item, kind] = None
            else:
                known.setdefault((item, kind), {})[batch] = n
        dead, changed = [], False
        for who, counts in told.items():
            batches = known.setdefault(who, {})
            if batches is None:
                continue
            changed = True
            batches.update(counts)
            received = sum(batches.values())
            if who in good or received >= self.max_receives:
                known[who] = None
                if who not in good:
                    dead.append((*who, received))
        if changed:
            kept = [(*who, *entry) for who, batches in known.items() for entry in ([(None, None)] if batches is None else batches.items())]
            self.items.update(tuple(list(column) for column in zip(*kept)))
        if dead:
            yield pd.DataFrame(dead, columns=["item", "kind", "receives"])

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Receives of one item in one batch of messages as one row, before the shuffle: a hot item costs a row per task."""
    for batch in batches:
        frame = batch.to_pandas()
        grouped = frame.groupby(["item", "kind", "ingest_batch"], dropna=False, as_index=False).agg(ok=("ok", "max"), n=("n", "sum"))
        yield pa.RecordBatch.from_pandas(grouped.astype({"ok": bool, "n": "int64"}), schema=SCHEMA, preserve_index=False)


SCHEMA = pa.schema([("item", pa.string()), ("kind", pa.string()), ("ingest_batch", pa.string()), ("ok", pa.bool_()), ("n", pa.int64())])


def with_state_store(spark: SparkSession, start):
    """Start a query whose state lives in RocksDB; the session's own setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        return start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def count_receives(receives: DataFrame, max_receives: int, buckets: int = BUCKETS) -> DataFrame:
    """Streaming receives (item, kind, ingest_batch, ok, n) -> dead letters (item, kind, receives).

    An item is settled by the first batch in which a receive of it succeeds, or, without one, in which its receives reach
    ``max_receives``; in that case it comes out here, once. What is received of a settled item later changes nothing.
    Pings are dropped; unknown messages never succeed. State per item is at most ``max_receives`` small entries. Items share a
    call into Python and a state by a hash into ``buckets``, a number that stays for the life of a checkpoint.
    """
    told = receives.filter(F.coalesce(F.col("kind"), F.lit("unknown")) != "test").select(
        "item", "kind", "ingest_batch", (F.coalesce("ok", F.lit(False)) & (F.col("kind") == "object")).alias("ok"), F.coalesce("n", F.lit(1)).cast("long").alias("n")
    )
    bucket = F.pmod(F.xxhash64("item", "kind"), F.lit(buckets))
    keyed = told.mapInArrow(_combined, RECEIVES_SCHEMA).withColumn("bucket", bucket).groupBy("bucket")
    return keyed.transformWithStateInPandas(_Letters(max_receives), DEAD_SCHEMA, "Append", "None")


def dead_letters_stream(
    spark: SparkSession, receives_path: str, out: str, checkpoint: str, max_receives: int = 2, max_files: int = 1000, trigger: dict | None = None
) -> StreamingQuery:
    """Follow a log of receives and append dead letters to ``out``.

    What a batch of messages costs depends on its own receives and the items that share their buckets, not on the log: earlier
    receives are in the state, and files that are done with move to ``<receives_path>-done``. The default trigger takes what is there and stops.
    """
    source = (
        spark.readStream.schema(RECEIVES_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", f"{receives_path}-done")
        .parquet(f"{receives_path}/*")
    )
    writer = (
        count_receives(source, max_receives)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return with_state_store(spark, writer.start)
