"""Table schemas and the rule table of the extraction document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed value: version written to every extraction row.
SCHEMA_VERSION = "2.0.0"

# Accepted categories.
SENTIMENTS = ("positive", "neutral", "negative")
EFFORTS = ("low", "medium", "high")
RESOLUTIONS = (
    "resolved",
    "unresolved",
    "escalated",
    "callback_scheduled",
    "transferred",
    "no_action_needed",
)


@dataclass(frozen=True)
class Leaf:
    """One leaf of the extraction document and how it is validated."""

    section: str | None
    name: str
    kind: str  # score | flag | text | choice | texts
    required: bool = False
    nullable: bool = False
    default: object = None
    choices: tuple[str, ...] = ()
    cap: int = 0

    @property
    def path(self) -> str:
        return f"{self.section}.{self.name}" if self.section else self.name

    @property
    def spark_type(self) -> T.DataType:
        if self.kind == "score":
            return T.ByteType()
        if self.kind == "flag":
            return T.BooleanType()
        if self.kind == "texts":
            return T.ArrayType(T.StringType())
        return T.StringType()


def _score(section, name):
    return Leaf(section, name, "score", required=True)


def _flag(section, name):
    return Leaf(section, name, "flag", default=False)


def _maybe_flag(section, name):
    return Leaf(section, name, "flag", nullable=True)


def _text(section, name):
    return Leaf(section, name, "text", required=True)


# Field names, kinds, defaults and caps, in storage order.
LEAVES = (
    Leaf("agent", "name", "text", nullable=True),
    _score("agent", "professionalism_score"),
    _score("agent", "empathy_score"),
    _score("agent", "knowledge_score"),
    _maybe_flag("agent", "greeting_compliant"),
    _maybe_flag("agent", "closing_compliant"),
    _flag("agent", "identified_themselves"),
    _flag("agent", "identified_company"),
    _flag("agent", "used_customer_name"),
    _maybe_flag("agent", "apologized_when_appropriate"),
    _flag("agent", "interrupted_customer"),
    _text("customer", "intent_primary"),
    Leaf("customer", "sentiment_start", "choice", default="neutral", choices=SENTIMENTS),
    Leaf("customer", "sentiment_end", "choice", default="neutral", choices=SENTIMENTS),
    _score("customer", "satisfaction_score"),
    Leaf("customer", "effort_score", "choice", required=True, choices=EFFORTS),
    _flag("customer", "explicitly_thanked"),
    _flag("customer", "explicitly_complained"),
    _flag("customer", "requested_supervisor"),
    Leaf("outcome", "resolution_status", "choice", default="no_action_needed", choices=RESOLUTIONS),
    _text("outcome", "resolution_summary"),
    _flag("outcome", "first_call_resolution"),
    _score("outcome", "complexity_score"),
    _maybe_flag("outcome", "authentication_completed"),
    _flag("events", "hold_time_mentioned"),
    _flag("events", "transfer_occurred"),
    _flag("events", "callback_scheduled"),
    _flag("events", "upsell_attempted"),
    _flag("events", "payment_collected"),
    _flag("events", "pii_disclosed_unnecessarily"),
    _flag("quality", "language_barrier_detected"),
    _flag("quality", "profanity_or_abuse"),
    _flag("quality", "information_accuracy_concerns"),
    _flag("quality", "audio_quality_issues_mentioned"),
    _text(None, "summary"),
    Leaf(None, "key_quotes", "texts", default=(), cap=3),
    Leaf(None, "coaching_opportunities", "texts", default=(), cap=5),
)

SECTIONS = tuple(dict.fromkeys(leaf.section for leaf in LEAVES if leaf.section))


def section_leaves(section: str | None) -> list[Leaf]:
    return [leaf for leaf in LEAVES if leaf.section == section]


def _extraction_type() -> T.StructType:
    fields = [
        T.StructField(s, T.StructType([T.StructField(x.name, x.spark_type) for x in section_leaves(s)]))
        for s in SECTIONS
    ]
    fields += [T.StructField(x.name, x.spark_type) for x in section_leaves(None)]
    return T.StructType(fields)


EXTRACTION_TYPE = _extraction_type()

# Feature names and storage types, in storage order.
FEATURES_TYPE = T.StructType(
    [
        T.StructField("char_count", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("turn_count_estimate", T.IntegerType()),
        T.StructField("audio_duration_sec", T.FloatType()),
        T.StructField("words_per_minute", T.FloatType()),
        T.StructField("asr_confidence_overall", T.FloatType()),
        T.StructField("word_confidence_mean", T.FloatType()),
        T.StructField("word_confidence_min", T.FloatType()),
        T.StructField("word_confidence_p10", T.FloatType()),
        T.StructField("low_confidence_word_pct", T.FloatType()),
        T.StructField("silence_total_sec", T.FloatType()),
        T.StructField("silence_max_gap_sec", T.FloatType()),
        T.StructField("silence_pct_of_call", T.FloatType()),
        T.StructField("redacted_token_count", T.IntegerType()),
    ]
)

# The three tables.
CALLS_EXTRACTIONS = T.StructType(
    [
        T.StructField("call_id", T.StringType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source_path", T.StringType()),
        T.StructField("category_path", T.StringType()),
        T.StructField("transcript_text", T.StringType()),
        T.StructField("features", FEATURES_TYPE),
        T.StructField("extraction", EXTRACTION_TYPE),
        T.StructField("extraction_status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("transcript_length_chars", T.IntegerType()),
        T.StructField("was_truncated", T.BooleanType()),
        T.StructField("prompt_token_count", T.IntegerType()),
        T.StructField("completion_token_count", T.IntegerType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)

BENCH_MEASUREMENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("concurrency", T.LongType()),
        T.StructField("req_per_sec", T.DoubleType()),
        T.StructField("error_rate", T.DoubleType()),
        T.StructField("prefix_cache_hit_ratio", T.DoubleType()),
        T.StructField("gpu_util_mean", T.DoubleType()),
        T.StructField("total_calls", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("measured_at", T.TimestampType()),
    ]
)

EXPERIMENT_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("test_name", T.StringType()),
        T.StructField("git_sha", T.StringType()),
        T.StructField("model_manifest_hash", T.StringType()),
        T.StructField("vllm_image_uri", T.StringType()),
        T.StructField("instance_type", T.StringType()),
        T.StructField("use_spot", T.BooleanType()),
        T.StructField("region", T.StringType()),
        T.StructField("enable_thinking", T.BooleanType()),
        T.StructField("max_model_len", T.LongType()),
        T.StructField("max_num_seqs", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)

WORDS_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.DoubleType()),
            T.StructField("end", T.DoubleType()),
            T.StructField("confidence", T.DoubleType()),
        ]
    )
)
