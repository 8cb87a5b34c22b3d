"""From raw calls to model requests and table rows."""

from __future__ import annotations

import functools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import schemas
from callsift.functions import text as tx
from callsift.functions import words as wd
from callsift.functions.json_strict import variant_kind

# Sampling parameters and the label in front of each transcript.
MAX_TOKENS = 1200
TEMPERATURE = 0.2
TOP_P = 0.9
USER_PREFIX = "TRANSCRIPT:\n"

FEATURE_NAMES = tuple(field.name for field in schemas.FEATURES_TYPE.fields)


def mistyped_member(raw: Column) -> Column:
    """Name of the first member of a transcript object that is there, is not null and has the wrong type, else null."""

    def wrong(name: str, target: str) -> Column:
        there = F.try_variant_get(raw, f"$.{name}", "variant")
        known = F.coalesce(F.schema_of_variant(there), F.lit("VOID")) != "VOID"
        return F.when(known & F.try_variant_get(raw, f"$.{name}", target).isNull(), F.lit(name))

    fields = [f.name for f in schemas.WORDS_TYPE.elementType.fields]
    members = F.try_variant_get(raw, "$.words", f"array<struct<{', '.join(f'{f}: variant' for f in fields)}>>")

    def odd(word: Column) -> Column:
        """A word whose member is there, is not null and has the wrong type, which the cast of the whole array lets pass."""
        return reduce(lambda a, b: a | b, [(F.coalesce(F.schema_of_variant(word[f]), F.lit("VOID")) != "VOID") & F.try_variant_get(word[f], "$", "double").isNull() for f in fields])

    odd_word = F.when(F.exists(members, odd), F.lit("words"))
    return F.coalesce(wrong("text", "string"), wrong("words", schemas.WORDS_TYPE.simpleString()), odd_word, wrong("audio_duration", "double"), wrong("confidence", "double"))


def normalize_transcript(df: DataFrame, column: str = "transcript") -> DataFrame:
    """Variant transcript (a string or an object) -> text, words, audio_duration, confidence."""
    raw = F.col(column)
    kind = F.col("_kind")

    def member(path: str, target: str):
        return F.when(kind == "OBJECT", F.try_variant_get(raw, path, target))

    plain = F.when(kind == "STRING", F.try_variant_get(raw, "$", "string"))
    return df.withColumn("_kind", variant_kind(raw)).withColumns(
        {
            "text": F.coalesce(member("$.text", "string"), plain, F.lit("")),
            "words": member("$.words", schemas.WORDS_TYPE.simpleString()),
            "audio_duration": member("$.audio_duration", "double"),
            "confidence": member("$.confidence", "double"),
        }
    ).drop(column, "_kind")


def compute_features(df: DataFrame) -> DataFrame:
    """Adds the 14 features as double/bigint columns. Row-local: no shuffle.

    Expects text, words, audio_duration, confidence; null words, duration and confidence are the
    plain-text case, whose timing features are 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.coalesce(F.col("words"), F.array().cast(schemas.WORDS_TYPE))
    staged = df.withColumns(
        {
            "_conf": F.sort_array(wd.confidences(words)),
            "_gaps": wd.gaps_ms(words),
            "audio_duration_sec": F.coalesce(F.col("audio_duration").cast("double"), F.lit(0.0)),
            "asr_confidence_overall": F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)),
            "word_count": F.when(F.size(words) > 0, F.size(words).cast("bigint")).otherwise(tx.token_count(text)),
        }
    )
    conf, gaps, duration = F.col("_conf"), F.col("_gaps"), F.col("audio_duration_sec")
    n = F.size(conf)
    none = F.lit(0.0)
    silence = wd.total(gaps, F.lit(0).cast("bigint")).cast("double") / 1000.0
    longest = F.coalesce(F.array_max(gaps), F.lit(0)).cast("double") / 1000.0
    low = F.size(F.filter(conf, lambda c: c < wd.LOW_CONFIDENCE))
    return (
        staged.withColumns(
            {
                "char_count": tx.char_count(text),
                "turn_count_estimate": tx.turn_count(text),
                "redacted_token_count": tx.redaction_count(text),
                "word_confidence_mean": F.when(n > 0, wd.total(conf, F.lit(0.0)) / n).otherwise(none),
                "word_confidence_min": F.coalesce(F.get(conf, F.lit(0)), none),
                "word_confidence_p10": F.when(n > 0, wd.tenth_percentile(conf)).otherwise(none),
                "low_confidence_word_pct": F.when(n > 0, low / n).otherwise(none),
                "silence_total_sec": silence,
                "silence_max_gap_sec": longest,
                "words_per_minute": wd.ratio(F.col("word_count"), duration) * 60.0,
            }
        )
        .withColumn("silence_pct_of_call", wd.ratio(F.col("silence_total_sec"), duration))
        .drop("_conf", "_gaps")
    )


def features_from_text(df: DataFrame, column: str = "text") -> DataFrame:
    """The degraded variant: text features only, timing features 0."""
    plain = df.withColumns(
        {
            "text": F.col(column),
            "words": F.lit(None).cast(schemas.WORDS_TYPE),
            "audio_duration": F.lit(None).cast("double"),
            "confidence": F.lit(None).cast("double"),
        }
    )
    return compute_features(plain).drop("words", "audio_duration", "confidence")


def pack_features(df: DataFrame) -> DataFrame:
    """The feature columns as one struct in storage types (float32/int32; overflow raises)."""
    packed = F.struct(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FEATURES_TYPE.fields]
    )
    return df.withColumn("features", packed).drop(*FEATURE_NAMES)


def enrich(df: DataFrame, max_chars: int = tx.DEFAULT_MAX_CHARS) -> DataFrame:
    """Features over the full text, then truncation; paths and other columns pass through."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        pack_features(compute_features(df))
        .withColumns(
            {
                "transcript_text": tx.truncate_middle(text, max_chars),
                "transcript_length_chars": F.length(text),
                "was_truncated": tx.was_truncated(text, max_chars),
            }
        )
        .drop("text", "words", "audio_duration", "confidence")
    )


@functools.cache
def default_system_prompt() -> str:
    """Instructions generated from the rule table, so prompt and validator cannot drift apart.

    The bytes are the same for every request, which lets a server cache the prefix.
    """

    def accepted(leaf: schemas.Leaf) -> str:
        options = {
            "score": "integer from 1 to 5",
            "flag": "true or false",
            "text": "string",
            "choice": "one of " + ", ".join(leaf.choices),
            "texts": f"list of at most {leaf.cap} strings",
        }[leaf.kind]
        return options + (" or null" if leaf.nullable else "")

    lines = [
        "Assess one call-center transcript and answer with a single JSON object and nothing else.",
        "Bracketed upper-case tokens are redactions; do not guess what they hide.",
        "Judge only from what was said; prefer neutral values or null when it is unclear.",
        "",
    ]
    for section in schemas.SECTIONS:
        lines.append(f'Object "{section}":')
        lines += [f'  "{leaf.name}": {accepted(leaf)}' for leaf in schemas.section_leaves(section)]
    lines.append("Next to these objects:")
    lines += [f'  "{leaf.name}": {accepted(leaf)}' for leaf in schemas.section_leaves(None)]
    return "\n".join(lines)


def build_requests(
    df: DataFrame,
    model_id: str,
    system_prompt: str | None = None,
    enable_thinking: bool = False,
) -> DataFrame:
    """Adds ``request``, the JSON body of one chat call per row."""
    prompt = default_system_prompt() if system_prompt is None else system_prompt
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")),
        F.struct(
            F.lit("user").alias("role"),
            F.concat(F.lit(USER_PREFIX), F.col("transcript_text")).alias("content"),
        ),
    )
    body = F.struct(
        F.lit(model_id).alias("model"),
        messages.alias("messages"),
        F.struct(F.lit(enable_thinking).alias("enable_thinking")).alias("chat_template_kwargs"),
        F.lit(MAX_TOKENS).alias("max_tokens"),
        F.lit(TEMPERATURE).alias("temperature"),
        F.lit(TOP_P).alias("top_p"),
    )
    return df.withColumn("request", F.to_json(body))


def assemble_rows(df: DataFrame, model_id: str) -> DataFrame:
    """Judged calls in the layout of the extraction table."""
    ready = df.withColumns(
        {
            "model_id": F.lit(model_id),
            "schema_version": F.lit(schemas.SCHEMA_VERSION),
            "transcript_length_chars": F.coalesce(
                F.col("transcript_length_chars"), F.length("transcript_text")
            ),
            "was_truncated": F.coalesce(F.col("was_truncated"), F.lit(False)),
            "extracted_at": F.current_timestamp(),
        }
    )
    return ready.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CALLS_EXTRACTIONS.fields]
    )
