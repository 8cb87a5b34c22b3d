"""Word features from an exploded word table: one row per word instead of one array per call.

For calls too long for one row. Groups are cut into chunks of bounded size, so a call that owns a
large share of all words is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsift.functions.skew import rank_values
from callsift.functions.words import LOW_CONFIDENCE, ratio

# A fold sorts this many words of a call in one task; a longer call is folded chunk by chunk.
CHUNK_WORDS = 1 << 20
LEVELS = 1
# Confidences lie in [0, 1]: at most a million counts per call, and a millionth of its words inside each.
BUCKETS = (1 << 20,)


def _fold(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbouring parts of each group in ``pos`` order -> one part: inner silence plus the gaps
    between them, and the outer times."""
    zero = F.lit(0).cast("bigint")
    before = F.lag("end").over(Window.partitionBy(*keys).orderBy("pos"))
    return (
        parts.withColumn("gap", F.coalesce(F.greatest(F.col("start") - before, zero), zero))
        .groupBy(*keys)
        .agg(
            F.sum(F.col("total") + F.col("gap")).alias("total"),
            F.max(F.greatest("longest", "gap")).alias("longest"),
            F.min_by("start", "pos").alias("start"),
            F.max_by("end", "pos").alias("end"),
        )
    )


def silence_features(words: DataFrame, chunk_words: int = CHUNK_WORDS, levels: int = LEVELS) -> DataFrame:
    """silence_total_sec and silence_max_gap_sec per call.

    Words fold into chunks of positions, chunks into larger chunks, and those into the call; no
    fold but the last sees more than ``chunk_words`` parts of a call. ``pos`` orders the words and
    need not be contiguous.
    """
    zero = F.lit(0).cast("bigint")
    parts = words.filter(F.col("call_id").isNotNull()).select(
        "call_id",
        "pos",
        F.coalesce(F.col("start").cast("bigint"), zero).alias("start"),
        F.coalesce(F.col("end").cast("bigint"), zero).alias("end"),
        zero.alias("total"),
        zero.alias("longest"),
    )
    for _ in range(levels):
        chunk = F.floor(F.col("pos") / chunk_words)
        parts = _fold(parts.withColumn("chunk", chunk), ["call_id", "chunk"]).withColumnRenamed("chunk", "pos")
    return _fold(parts, ["call_id"]).select(
        "call_id",
        (F.col("total") / 1000.0).alias("silence_total_sec"),
        (F.col("longest") / 1000.0).alias("silence_max_gap_sec"),
    )


def confidence_features(words: DataFrame) -> DataFrame:
    """word_count, mean, min, p10 and low share of the confidences per call."""
    scored = words.filter(F.col("call_id").isNotNull()).select(
        "call_id", F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("confidence")
    )
    counts = scored.groupBy("call_id", "confidence").agg(F.count(F.lit(1)).alias("n"))
    low = F.when(F.col("confidence") < LOW_CONFIDENCE, F.col("n")).otherwise(0)
    simple = counts.groupBy("call_id").agg(
        F.sum("n").alias("word_count"),
        (F.sum(F.col("confidence") * F.col("n")) / F.sum("n")).alias("word_confidence_mean"),
        F.min("confidence").alias("word_confidence_min"),
        (F.sum(low) / F.sum("n")).alias("low_confidence_word_pct"),
    )
    span = (F.col("group_rows") - 1) * 10
    below = F.floor(span / 100)
    ranks = rank_values(
        counts,
        ["call_id"],
        "confidence",
        {"low": below, "high": F.least(below + 1, F.col("group_rows") - 1)},
        buckets=[F.floor(F.col("confidence") * n) for n in BUCKETS],
        weight="n",
    )
    part = (span % 100).cast("double")
    p10 = ranks.select(
        "call_id",
        ((F.col("low") * (100.0 - part) + F.col("high") * part) / 100.0).alias("word_confidence_p10"),
    )
    return simple.join(p10, "call_id")


def word_table_features(words: DataFrame, durations: DataFrame | None = None) -> DataFrame:
    """All word features per call; with ``durations`` (call_id, audio_duration) also the ratios."""
    features = confidence_features(words).join(silence_features(words), "call_id")
    if durations is None:
        return features
    seconds = F.coalesce(F.col("audio_duration"), F.lit(0.0))
    return (
        features.join(durations.select("call_id", "audio_duration"), "call_id", "left")
        .withColumn("words_per_minute", ratio(F.col("word_count"), seconds) * 60.0)
        .withColumn("silence_pct_of_call", ratio(F.col("silence_total_sec"), seconds))
        .drop("audio_duration")
    )
