"""Gauges and counters read from metrics scrapes (text exposition format).

A scrape is taken apart once, into the name and value of each sample line; everything else selects by name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric names and the gate.
GPU_GAUGES = ("vllm:gpu_cache_usage_perc", "vllm:gpu_cache_usage")
HIT_RATE_GAUGES = ("vllm:gpu_prefix_cache_hit_rate", "vllm:prefix_cache_hit_rate")
HIT_RATIO_GATE = 0.7

#: A sample line: name, labels in braces or none, white space, value; a timestamp may follow.
SAMPLE = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{.*\})?\s+([-+0-9.eE]+)(?:\s|$)"


def samples(scrape: Column) -> Column:
    """Array of (name, value) of the lines that carry a number, in their order."""
    lines = F.filter(F.split(scrape, "\n"), lambda line: line.rlike(SAMPLE))
    parsed = F.transform(
        lines, lambda line: F.struct(F.regexp_extract(line, SAMPLE, 1).alias("name"), F.regexp_extract(line, SAMPLE, 2).try_cast("double").alias("value"))
    )
    return F.filter(parsed, lambda s: s["value"].isNotNull())


def _first(found: Column, wanted) -> Column:
    return F.get(F.filter(found, lambda s: wanted(s["name"])), F.lit(0))["value"]


def _named(name: str):
    return lambda own: own == name


def gpu_util(found: Column) -> Column:
    """First gauge that is present and numeric, by name priority; 0.0 without one."""
    return F.coalesce(*[_first(found, _named(name)) for name in GPU_GAUGES], F.lit(0.0))


def _total(found: Column, parts: str) -> Column:
    """Sum over the samples whose name has the given parts, in this order; times of creation beside a counter are no counts."""
    own = F.filter(found, lambda s: s["name"].startswith("vllm:") & s["name"].rlike(parts) & ~s["name"].endswith("_created"))
    return F.aggregate(own, F.lit(0.0), lambda total, s: total + s["value"])


def prefix_hit_ratio(found: Column) -> Column:
    """The first hit rate gauge if one is exposed, else summed hits over summed queries; null when neither is there."""
    gauge = _first(found, lambda name: name.startswith(HIT_RATE_GAUGES[0]) | name.startswith(HIT_RATE_GAUGES[1]))
    queries = _total(found, "prefix.*quer(y|ies)")
    return F.coalesce(gauge, F.when(queries > 0, _total(found, "prefix.*hit") / queries))


def passes_gate(ratio: Column) -> Column:
    return F.coalesce(ratio > HIT_RATIO_GATE, F.lit(False))
