"""Request and scrape metrics: windows, sweeps, alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsift.functions import scrape as sc
from callsift.functions.stages import settle

# Publishing period; alarm threshold and consecutive periods.
PERIOD_SECONDS = 60
ALARM_THRESHOLD = 1.0
ALARM_PERIODS = 70


def scrape_metrics(scrapes: DataFrame, column: str = "scrape") -> DataFrame:
    """Adds gpu_util, prefix_cache_hit_ratio (null if absent) and the gate flag."""
    found = F.col("_samples")
    values = {"gpu_util": sc.gpu_util(found), "prefix_cache_hit_ratio": sc.prefix_hit_ratio(found)}
    read = settle(scrapes, {"_samples": sc.samples(F.col(column))}).withColumns(values).drop("_samples")
    return read.withColumn("passes_gate", sc.passes_gate(F.col("prefix_cache_hit_ratio")))


def request_windows(
    requests: DataFrame, period_seconds: int = PERIOD_SECONDS, watermark: str | None = None
) -> DataFrame:
    """req_per_sec (successful calls) and error_rate per run and tumbling window.

    With ``watermark`` the same plan runs as a stream in append mode.
    """
    source = requests.withWatermark("ts", watermark) if watermark else requests
    return (
        source.groupBy("run_id", F.window("ts", f"{period_seconds} seconds").alias("period"))
        .agg(
            (F.count_if("ok") / float(period_seconds)).alias("req_per_sec"),
            (F.count_if(~F.col("ok")) / F.count(F.lit(1))).alias("error_rate"),
            F.count(F.lit(1)).alias("requests"),
        )
        .select("run_id", F.col("period.start").alias("period_start"), "req_per_sec", "error_rate", "requests")
    )


def metrics_60s(requests: DataFrame, scrapes: DataFrame, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """The four published metrics per run and period; both logs are aggregated before they meet."""
    scraped = (
        scrape_metrics(scrapes)
        .groupBy("run_id", F.window("ts", f"{period_seconds} seconds").alias("period"))
        .agg(
            F.avg("prefix_cache_hit_ratio").alias("prefix_cache_hit_ratio"),
            F.avg("gpu_util").alias("gpu_util"),
        )
        .select("run_id", F.col("period.start").alias("period_start"), "prefix_cache_hit_ratio", "gpu_util")
    )
    return request_windows(requests, period_seconds).join(scraped, ["run_id", "period_start"], "full_outer")


def sweep_measurements(requests: DataFrame, scrapes: DataFrame) -> DataFrame:
    """Rows for the measurement table: the sweep with the mean hit ratio and gpu use of the scrapes of each run and level.

    ``scrapes`` has run_id, concurrency and scrape. Both logs are aggregated before they meet.
    """
    gauges = scrape_metrics(scrapes).groupBy("run_id", "concurrency").agg(
        F.avg("prefix_cache_hit_ratio").alias("prefix_cache_hit_ratio"), F.avg("gpu_util").alias("gpu_util_mean")
    )
    return bench_sweep(requests).join(gauges, ["run_id", "concurrency"], "left")


def bench_sweep(requests: DataFrame) -> DataFrame:
    """Throughput and error rate per run and concurrency level.

    ``us`` is the request's start in microseconds; a level lasts from its first start until its last request is done.
    """
    seconds = F.col("duration_seconds")
    return (
        requests.groupBy("run_id", "concurrency")
        .agg(
            F.count_if("ok").alias("ok_calls"),
            F.count(F.lit(1)).alias("total_calls"),
            ((F.max(F.col("us") + F.col("latency_s") * 1e6) - F.min("us")) / 1e6).alias("duration_seconds"),
        )
        .withColumns(
            {
                "req_per_sec": F.when(seconds > 0, F.col("ok_calls") / seconds),
                "error_rate": (F.col("total_calls") - F.col("ok_calls")) / F.col("total_calls"),
            }
        )
    )


def sustained_alarm(
    samples: DataFrame,
    threshold: float = ALARM_THRESHOLD,
    periods: int = ALARM_PERIODS,
    period_seconds: int = PERIOD_SECONDS,
) -> DataFrame:
    """Stretches of at least ``periods`` consecutive periods whose maximum reaches ``threshold``.

    Input: series, ts, value. A period without samples does not breach and ends a stretch. Samples
    collapse to one row per period before the window, so a series costs its time span, not its rows.
    """
    peaks = (
        samples.groupBy("series", F.window("ts", f"{period_seconds} seconds").alias("period"))
        .agg(F.max("value").alias("peak"))
        .filter(F.col("peak") >= threshold)
        .select(
            "series",
            F.col("period.start").alias("period_start"),
            F.floor(F.unix_micros(F.col("period.start").cast("timestamp")) / (period_seconds * 1_000_000)).alias("no"),
        )
    )
    in_order = Window.partitionBy("series").orderBy("no")
    return (
        peaks.withColumn("stretch", F.col("no") - F.row_number().over(in_order))
        .groupBy("series", "stretch")
        .agg(
            F.min("period_start").alias("breach_start"),
            F.max("period_start").alias("breach_end"),
            F.count(F.lit(1)).alias("breaching_periods"),
        )
        .filter(F.col("breaching_periods") >= periods)
        .select(
            "series",
            "breach_start",
            "breach_end",
            "breaching_periods",
            (F.col("breach_start") + F.make_dt_interval(secs=F.lit((periods - 1) * period_seconds))).alias("fired_at"),
        )
    )
