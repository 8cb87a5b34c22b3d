"""Windowed metrics as streams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from callsift.operators.metrics import PERIOD_SECONDS, request_windows, scrape_metrics
from callsift.streaming.receives import with_state_store

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["run_id", "period_start"]


def metrics_stream(
    requests: DataFrame,
    out: str,
    checkpoint: str,
    period_seconds: int = PERIOD_SECONDS,
    watermark: str = "60 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Appends each window's request metrics to ``out`` once the watermark has passed it.

    The last open windows stay in state until later requests close them, or ``close_windows`` does at the end.
    """
    return (
        request_windows(requests, period_seconds, watermark)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def close_windows(requests: DataFrame, out: str, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """All windows of a stream that has ended, from ``out`` and the same log as a batch: (windows, late_requests).

    Windows that the stream has not written are computed from the log. ``late_requests`` is how many requests of a
    written window came after the watermark and so are not in it.
    """
    spark = requests.sparkSession
    every = request_windows(requests, period_seconds)
    try:
        written = spark.read.schema(every.schema).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        written = spark.createDataFrame([], every.schema)
    counts = every.select(*KEYS, F.col("requests").alias("_all"))
    kept = written.join(counts, KEYS, "left").withColumn("late_requests", F.coalesce(F.col("_all") - F.col("requests"), F.lit(0))).drop("_all")
    return kept.unionByName(every.join(written.select(*KEYS), KEYS, "left_anti").withColumn("late_requests", F.lit(0).cast("bigint")))


# --- all four metrics: windows in keyed state, closed by timers -----------------------------------

SUMS = ("n", "ok", "ratio", "ratios", "gpu", "gpus")
PARTS_SCHEMA = "run_id string, period_ms long, n long, ok long, ratio double, ratios long, gpu double, gpus long"
STATE_SCHEMA = "timer long, period_ms array<long>, n array<long>, ok array<long>, ratio array<double>, ratios array<long>, gpu array<double>, gpus array<long>"
#: Windows in a row that share a call into Python and a state.
BLOCK_WINDOWS = 64
WINDOWS_SCHEMA = "kind string, run_id string, period_ms long, requests long, req_per_sec double, error_rate double, prefix_cache_hit_ratio double, gpu_util double"


def _parts(period_ms: int):
    """Rows of one run and window as one row of sums, before the shuffle; heartbeats (no run) have moved the watermark and go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.filter(pc.is_valid(batch.column("run_id")))
            if not rows.num_rows:
                continue
            frame = pd.DataFrame({"run_id": rows.column("run_id").to_pylist()})
            frame["period_ms"] = rows.column("us").to_numpy(zero_copy_only=False) // 1000 // period_ms * period_ms
            for name, source in (("n", "ok"), ("ratios", "ratio"), ("gpus", "gpu")):
                frame[name] = pc.is_valid(rows.column(source)).to_numpy(zero_copy_only=False).astype("int64")
            frame["ok"] = pc.fill_null(rows.column("ok"), False).to_numpy(zero_copy_only=False).astype("int64")
            for name in ("ratio", "gpu"):
                frame[name] = pc.fill_null(rows.column(name), 0.0).to_numpy(zero_copy_only=False)
            sums = frame.groupby(["run_id", "period_ms"], as_index=False)[list(SUMS)].sum()
            yield pa.RecordBatch.from_pandas(sums, schema=PARTS, preserve_index=False)

    return run


PARTS = pa.schema(
    [("run_id", pa.string()), ("period_ms", pa.int64()), *((name, pa.float64() if name in ("ratio", "gpu") else pa.int64()) for name in SUMS)]
)


class _Windows(StatefulProcessor):
    """A block of one run's windows: sums of each until a timer at its end, then its metrics. What comes after the watermark
    has passed a window's end is told as late instead. The block's state is read and written once per call."""

    def __init__(self, period_ms: int):
        self.period_ms = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        windows, timer = self._read()
        late: dict[int, int] = {}
        for frame in rows:
            for period, *sums in zip(*(frame[name].tolist() for name in ("period_ms", *SUMS))):
                if period + self.period_ms <= watermark:
                    late[period] = late.get(period, 0) + sums[0]
                elif period in windows:
                    windows[period] = [a + b for a, b in zip(windows[period], sums)]
                else:
                    windows[period] = sums
        self._write(windows, timer)
        if late:
            yield self._rows("late", key[0], [(period, n, None, None, None, None) for period, n in late.items()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        windows, _ = self._read()
        last = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        over = [period for period in windows if period + self.period_ms <= last]
        closed = []
        for period in over:
            n, ok, ratio, ratios, gpu, gpus = windows.pop(period)
            rates = (ok / (self.period_ms / 1000), (n - ok) / n) if n else (None, None)
            closed.append((period, n, *rates, ratio / ratios if ratios else None, gpu / gpus if gpus else None))
        self._write(windows, None)
        if closed:
            yield self._rows("window", key[0], closed)

    def _read(self) -> tuple[dict[int, list], int | None]:
        """Sums by window, and the time of the block's timer."""
        state = self.open.get()
        if state is None:
            return {}, None
        timer, periods, *sums = state
        return {period: list(values) for period, *values in zip(periods, *sums)}, timer

    def _write(self, windows: dict[int, list], timer: int | None) -> None:
        """A block has one timer, at the end of its first open window; without open windows it has no state."""
        if not windows:
            self.open.clear()
            return
        first = min(windows) + self.period_ms
        if timer is None or first < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
            timer = first
        columns = zip(*windows.values())
        kinds = (float if name in ("ratio", "gpu") else int for name in SUMS)
        self.open.update((timer, list(windows), *([kind(x) for x in column] for kind, column in zip(kinds, columns))))

    def _rows(self, kind, run_id, rows) -> pd.DataFrame:
        names = ("req_per_sec", "error_rate", "prefix_cache_hit_ratio", "gpu_util")
        frame = pd.DataFrame(rows, columns=["period_ms", "requests", *names]).astype(dict.fromkeys(names, "float64"))
        frame.insert(0, "run_id", run_id)
        frame.insert(0, "kind", kind)
        return frame

    def close(self) -> None:
        pass


def four_metrics_stream(
    requests: DataFrame,
    scrapes: DataFrame,
    out: str,
    checkpoint: str,
    period_seconds: int = PERIOD_SECONDS,
    watermark: str = "60 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Follows a stream of requests (run_id, ts, ok) and one of scrapes (run_id, ts, scrape); each window's four metrics go to
    ``out`` once the watermark has passed its end, and so does, apart, a count of every late request.

    Rows of a run and window are summed before the shuffle, and each ``BLOCK_WINDOWS`` windows of a run in a row have a state of
    their own, so a run with most of the rows costs a row per task and window. A quiet stream is closed by a ``heartbeat`` in one of its sources.
    Read the result with ``read_windows``.
    """
    asked = requests.select("run_id", F.col("ts").cast("timestamp").alias("ts"), "ok")
    seen = scrape_metrics(scrapes).select("run_id", F.col("ts").cast("timestamp").alias("ts"), F.col("prefix_cache_hit_ratio").alias("ratio"), F.col("gpu_util").alias("gpu"))
    rows = asked.unionByName(seen, allowMissingColumns=True).withWatermark("ts", watermark)
    parts = rows.select("run_id", F.unix_micros("ts").alias("us"), "ok", "ratio", "gpu").mapInArrow(_parts(period_seconds * 1000), PARTS_SCHEMA)
    block = F.floor(F.col("period_ms") / (period_seconds * 1000 * BLOCK_WINDOWS))
    windows = parts.withColumn("block", block).groupBy("run_id", "block").transformWithStateInPandas(_Windows(period_seconds * 1000), WINDOWS_SCHEMA, "Append", "EventTime")
    writer = (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("kind")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return with_state_store(requests.sparkSession, writer.start)


def heartbeat(spark: SparkSession, ts: datetime) -> DataFrame:
    """A request of no run, for the source of requests: it moves the watermark, closes windows and counts nowhere."""
    return spark.createDataFrame([(None, ts, None)], "run_id string, ts timestamp, ok boolean")


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """Closed windows with ``late_requests``; a window of which only late requests came has no metrics."""
    rows = spark.read.schema(WINDOWS_SCHEMA).parquet(out).withColumn("period_start", F.timestamp_millis("period_ms"))
    late = rows.filter("kind = 'late'").groupBy(*KEYS).agg(F.sum("requests").alias("late_requests"))
    windows = rows.filter("kind = 'window'").drop("kind", "period_ms")
    return windows.join(late.filter("late_requests > 0"), KEYS, "full_outer").withColumn("late_requests", F.coalesce("late_requests", F.lit(0).cast("bigint")))
