"""Features, truncation, requests, and the word table."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.checks import fixtures as fx
from callsift.checks.registry import check
from callsift.functions import text as tx
from callsift.operators import prepare, word_table
from callsift.session import spread

MARKER = "chr(10) || chr(10) || '[...transcript middle truncated for length...]' || chr(10) || chr(10)"
# Whitespace in the test texts is ASCII only.
TURNS_OF = r"case when text = '' then 0 else len(regexp_extract_all(text, '[.?!]\s+')) + 1 end"


def _truncated(limit: int) -> str:
    budget = limit - len(tx.TRUNCATION_MARKER)
    head = budget // 2
    return f"case when length(text) > {limit} then text[1:{head}] || {MARKER} || text[-{budget - head}:] else text end"


@check(
    rf"""select doc_id, length(text) char_count, len(regexp_extract_all(text, '\S+')) word_count, {TURNS_OF} turn_count_estimate,
    len(regexp_extract_all(text, '\[[A-Z_]+\]')) redacted_token_count, 0.0::double audio_duration_sec, 0.0::double words_per_minute,
    0.0::double word_confidence_p10, 0.0::double silence_total_sec
    from (select doc_id, regexp_replace(text, '[0-9]+', '[NUM]', 'g') as text from documents)"""
)
def text_features(spark, sf_dir):
    docs = spread(fx.table(spark, sf_dir, "documents").select("doc_id", "text"))
    masked = docs.withColumn("text", F.regexp_replace("text", "[0-9]+", "[NUM]"))
    return prepare.features_from_text(masked).select(
        "doc_id", "char_count", "word_count", "turn_count_estimate", "redacted_token_count",
        "audio_duration_sec", "words_per_minute", "word_confidence_p10", "silence_total_sec",
    )


@check(
    f"""select doc_id, {_truncated(5000)} transcript_text, length(text) transcript_length_chars, length(text) > 5000 was_truncated,
    length({_truncated(10000)}) chars_10000, length({_truncated(19000)}) chars_19000 from documents"""
)
def truncate_middle(spark, sf_dir):
    text = F.col("text")
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.truncate_middle(text, 5000).alias("transcript_text"),
        F.length(text).cast("bigint").alias("transcript_length_chars"),
        tx.was_truncated(text, 5000).alias("was_truncated"),
        F.length(tx.truncate_middle(text, 10000)).cast("bigint").alias("chars_10000"),
        F.length(tx.truncate_middle(text, 19000)).cast("bigint").alias("chars_19000"),
    )


FEATURE_SQL = rf"""
select c.call_id, c.source_path, c.category_path, length(text) char_count, coalesce(words, len(regexp_extract_all(text, '\S+'))) word_count,
  {TURNS_OF} turn_count_estimate, len(regexp_extract_all(text, '\[[A-Z_]+\]')) redacted_token_count,
  coalesce(audio_duration, 0) audio_duration_sec, coalesce(confidence, 0) asr_confidence_overall,
  case when coalesce(audio_duration, 0) > 0 then coalesce(words, 0) / audio_duration * 60 else 0 end words_per_minute,
  coalesce(mean_conf, 0) word_confidence_mean, coalesce(min_conf, 0) word_confidence_min, coalesce(p10_conf, 0) word_confidence_p10,
  coalesce(low_conf, 0) low_confidence_word_pct, coalesce(silence, 0) silence_total_sec, coalesce(longest, 0) silence_max_gap_sec,
  case when coalesce(audio_duration, 0) > 0 then coalesce(silence, 0) / audio_duration else 0 end silence_pct_of_call, text
from calls c left join call_word_stats s on c.call_id = s.call_id
"""
# Confidences in the test data are multiples of 1/128, so sums and quotients are exact in both
# engines; only the interpolated percentile needs rounding.
EXACT = (
    "word_count", "audio_duration_sec", "asr_confidence_overall", "word_confidence_min", "words_per_minute",
    "word_confidence_mean", "low_confidence_word_pct", "silence_total_sec", "silence_max_gap_sec", "silence_pct_of_call",
)
_CALL_VIEWS = {
    "calls": fx.CALLS,
    "call_words": fx.CALL_WORDS,
    "call_word_stats": fx.CALL_WORD_STATS,
}


@check(
    fx.with_views(
        f"select call_id, {', '.join(EXACT)}, round(word_confidence_p10, 10) word_confidence_p10 from ({FEATURE_SQL})",
        **_CALL_VIEWS,
    )
)
def word_features(spark, sf_dir):
    features = prepare.compute_features(fx.calls(spark, sf_dir))
    return features.select("call_id", *EXACT, F.round("word_confidence_p10", 10).alias("word_confidence_p10"))


@check(
    fx.with_views(
        """select call_id, words word_count, mean_conf word_confidence_mean, min_conf word_confidence_min,
        round(p10_conf, 10) word_confidence_p10, low_conf low_confidence_word_pct,
        silence silence_total_sec, longest silence_max_gap_sec from call_word_stats""",
        call_words=fx.WORDS,
        call_word_stats=fx.CALL_WORD_STATS,
    )
)
def word_features_exploded(spark, sf_dir):
    features = word_table.word_table_features(fx.words(spark, sf_dir))
    return features.select(
        "call_id", "word_count", "word_confidence_mean", "word_confidence_min",
        F.round("word_confidence_p10", 10).alias("word_confidence_p10"),
        "low_confidence_word_pct", "silence_total_sec", "silence_max_gap_sec",
    )


@check(
    fx.with_views(
        f"""select call_id, source_path, category_path, char_count, word_count, turn_count_estimate, redacted_token_count,
        round(cast(cast(word_confidence_mean as float) as double), 4) word_confidence_mean, round(cast(cast(silence_total_sec as float) as double), 1) silence_total_sec,
        {_truncated(5000)} transcript_text, char_count transcript_length_chars, char_count > 5000 was_truncated from ({FEATURE_SQL})""",
        **_CALL_VIEWS,
    )
)
def enrich(spark, sf_dir):
    rows = prepare.enrich(fx.calls(spark, sf_dir))
    f = "features."
    return rows.select(
        "call_id", "source_path", "category_path",
        *[F.col(f + n).cast("bigint").alias(n) for n in ("char_count", "word_count", "turn_count_estimate", "redacted_token_count")],
        F.round(F.col("features.word_confidence_mean").cast("double"), 4).alias("word_confidence_mean"),
        F.round(F.col("features.silence_total_sec").cast("double"), 1).alias("silence_total_sec"),
        "transcript_text",
        F.col("transcript_length_chars").cast("bigint").alias("transcript_length_chars"),
        "was_truncated",
    )


@check(
    f"""select conv_id, turn, 'checker' model, 'TRANSCRIPT:' || chr(10) || {_truncated(200)} user_content, true same_prompt,
    1200 max_tokens, 0.2::double temperature, 0.9::double top_p, false enable_thinking, 2 messages from conversations"""
)
def build_requests(spark, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.truncate_middle(F.col("text"), 200).alias("transcript_text")
    )
    body = F.try_parse_json("request")

    def at(path, kind):
        return F.try_variant_get(body, path, kind)

    return prepare.build_requests(turns, "checker").select(
        "conv_id",
        "turn",
        at("$.model", "string").alias("model"),
        at("$.messages[1].content", "string").alias("user_content"),
        (at("$.messages[0].content", "string") == prepare.default_system_prompt()).alias("same_prompt"),
        at("$.max_tokens", "bigint").alias("max_tokens"),
        at("$.temperature", "double").alias("temperature"),
        at("$.top_p", "double").alias("top_p"),
        at("$.chat_template_kwargs.enable_thinking", "boolean").alias("enable_thinking"),
        F.size(at("$.messages", "array<variant>")).cast("bigint").alias("messages"),
    )


@check(
    """select cast(conv_id as varchar) || '-' || cast(turn as varchar) call_id, 'run_x' run_id, role category_path, text transcript_text,
    case when turn % 2 = 0 then 'success' else 'error' end extraction_status, '2.0.0' schema_version, 'checker' model_id,
    case when turn % 3 = 0 then 7 else length(text) end transcript_length_chars, turn % 3 = 0 was_truncated, true stamped from conversations"""
)
def assemble_rows(spark, sf_dir):
    turn = F.col("turn")
    judged = fx.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string")).alias("call_id"),
        F.lit("run_x").alias("run_id"),
        F.lit(None).cast("string").alias("source_path"),
        F.col("role").alias("category_path"),
        F.col("text").alias("transcript_text"),
        F.lit(None).cast(prepare.schemas.FEATURES_TYPE).alias("features"),
        F.lit(None).cast(prepare.schemas.EXTRACTION_TYPE).alias("extraction"),
        F.when(turn % 2 == 0, "success").otherwise("error").alias("extraction_status"),
        F.lit(None).cast("string").alias("error_message"),
        F.when(turn % 3 == 0, 7).alias("transcript_length_chars"),
        F.when(turn % 3 == 0, True).alias("was_truncated"),
        F.lit(None).cast("int").alias("prompt_token_count"),
        F.lit(None).cast("int").alias("completion_token_count"),
    )
    return prepare.assemble_rows(judged, "checker").select(
        "call_id", "run_id", "category_path", "transcript_text", "extraction_status", "schema_version", "model_id",
        F.col("transcript_length_chars").cast("bigint").alias("transcript_length_chars"),
        "was_truncated", F.col("extracted_at").isNotNull().alias("stamped"),
    )
