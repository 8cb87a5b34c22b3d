"""JSON, validation, model calls, resume, and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.checks import fixtures as fx
from callsift.checks.registry import check
from callsift.checks.stub import stub_model
from callsift.functions.json_strict import parse_json_strict as parse_strict
from callsift.operators import inference, prepare, runs, validation
from callsift.plans.pipeline import RunSettings, request_builder
from callsift.session import spread

SETTINGS = RunSettings(model_id="stub")


def turn_calls(spark, sf_dir):
    """Conversation turns as plain-text calls."""
    turns = spread(fx.shared(spark, sf_dir, fx.TURNS))
    return turns.withColumns(
        {
            "run_id": F.lit("run_stub"),
            "source_path": F.lit(None).cast("string"),
            "category_path": F.lit(None).cast("string"),
            "words": F.lit(None).cast("array<struct<start: double, end: double, confidence: double>>"),
            "audio_duration": F.lit(None).cast("double"),
            "confidence": F.lit(None).cast("double"),
        }
    )


@check(
    fx.with_views(
        "select doc_id, expected <> 'json_parse_error' parsed, case when expected = 'json_parse_error' then 'json_parse_error' end error_class from responses",
        responses=fx.RESPONSES,
    )
)
def parse_json_strict(spark, sf_dir):
    parsed = parse_strict(fx.shared(spark, sf_dir, fx.RESPONSES, busy=("documents",)), "raw")
    return parsed.select(
        "doc_id",
        F.col("doc").isNotNull().alias("parsed"),
        F.split_part("parse_error", F.lit(":"), F.lit(1)).alias("error_class"),
    )


@check(
    fx.with_views(
        """select doc_id, case when expected = 'success' then 'success' else 'error' end extraction_status,
        case when expected <> 'success' then expected end error_class, summary,
        case when expected = 'success' then 3 else -1 end empathy_score, case when expected = 'success' then 'neutral' end sentiment_end,
        case when expected = 'success' then cast(doc_id % 16 = 1 as varchar) end profanity_or_abuse, case when expected = 'success' then 1 else -1 end quotes from responses""",
        responses=fx.RESPONSES,
    )
)
def validate_responses(spark, sf_dir):
    judged = validation.judge_responses(fx.shared(spark, sf_dir, fx.RESPONSES, busy=("documents",)).drop("summary"), "raw")
    quotes = F.col("extraction.key_quotes")
    return judged.select(
        "doc_id",
        "extraction_status",
        F.split_part("error_message", F.lit(":"), F.lit(1)).alias("error_class"),
        F.col("extraction.summary").alias("summary"),
        F.coalesce(F.col("extraction.agent.empathy_score").cast("int"), F.lit(-1)).alias("empathy_score"),
        F.col("extraction.customer.sentiment_end").alias("sentiment_end"),
        F.col("extraction.quality.profanity_or_abuse").cast("string").alias("profanity_or_abuse"),
        F.when(quotes.isNotNull(), F.size(quotes)).otherwise(-1).alias("quotes"),
    )


@check(
    fx.with_views(
        "select expected error_class, count(*) n from responses where expected <> 'success' group by expected",
        responses=fx.RESPONSES,
    )
)
def error_taxonomy(spark, sf_dir):
    return validation.error_taxonomy(validation.judge_responses(fx.shared(spark, sf_dir, fx.RESPONSES, busy=("documents",)), "raw"))


@check(
    fx.with_views(
        """select call_id, extraction_status, error_class, attempts, case when error_class in ('api_error', 'unexpected_error') and n % 12 <> 10 then -1 else n end prompt_token_count,
        case when error_class in ('api_error', 'unexpected_error') and n % 12 <> 10 then -1 else n % 50 + attempts end completion_token_count from expected""",
        turns=fx.TURNS,
        expected=fx.STUB_EXPECTED,
    )
)
def stub_extraction(spark, sf_dir):
    judged = inference.extract_batch(
        prepare.enrich(turn_calls(spark, sf_dir)), request_builder(SETTINGS), stub_model, backoff_seconds=0.0
    )
    return judged.select(
        "call_id",
        "extraction_status",
        F.split_part("error_message", F.lit(":"), F.lit(1)).alias("error_class"),
        "attempts",
        F.coalesce("prompt_token_count", F.lit(-1)).alias("prompt_token_count"),
        F.coalesce("completion_token_count", F.lit(-1)).alias("completion_token_count"),
    )


# Three documents share an id, so inputs repeat and a success of one covers the others.
@check(
    fx.with_views(
        """select d.doc_id, cast(d.doc_id - d.doc_id % 3 as varchar) call_id, d.lang from documents d
        where cast(d.doc_id - d.doc_id % 3 as varchar) not in (select call_id from r where run_id = 'run_a' and extraction_status = 'success')""",
        r=fx.ROWS,
    )
)
def resume_pending(spark, sf_dir):
    rows = fx.rows(spark, sf_dir)
    number = F.col("doc_id")
    calls = fx.table(spark, sf_dir, "documents").select(
        "doc_id", (number - number % 3).cast("string").alias("call_id"), "lang", F.lit("run_a").alias("run_id")
    )
    return runs.resume(calls, runs.committed_ids(rows, "run_a")).drop("run_id")


OUTCOMES = """
select concat('run_', cast(user_id as varchar(9))) run_id,
  case when user_id % 5 = 0 then (case when event_id % 3 = 0 then 'raised' else 'error' end) when user_id % 5 = 1 then 'skipped'
  when user_id % 5 = 2 then 'success' when event_type = 'error' then 'error' when event_type = 'view' then 'skipped' else 'success' end outcome
from events
"""
STATS_SQL = """
select run_id, count(*) filter (outcome <> 'skipped') submitted, count(*) filter (outcome = 'skipped') skipped,
  count(*) filter (outcome in ('success', 'error')) completed, count(*) filter (outcome in ('error', 'raised')) errors,
  count(*) filter (outcome = 'success') succeeded from outcomes group by run_id
"""


@check(fx.with_views(STATS_SQL, outcomes=OUTCOMES))
def run_stats(spark, sf_dir):
    return runs.run_stats(fx.shared(spark, sf_dir, OUTCOMES))


@check(
    fx.with_views(
        """select run_id, case when errors > 0 and succeeded = 0 then 'failed' when errors > 0 then 'partial' else 'success' end status from stats""",
        outcomes=OUTCOMES,
        stats=STATS_SQL,
    )
)
def final_status(spark, sf_dir):
    return runs.final_status(runs.run_stats(fx.shared(spark, sf_dir, OUTCOMES))).select("run_id", "status")


LATEST = """
select * from r qualify row_number() over (partition by run_id, call_id order by extraction_status desc, seq desc) = 1
"""


@check(
    fx.with_views(
        "select run_id, call_id, extraction_status, error_message, summary, coalesce(completion_token_count, -1) completion_token_count from latest",
        r=fx.ROWS,
        latest=LATEST,
    )
)
def latest_rows(spark, sf_dir):
    return runs.latest_rows(fx.rows(spark, sf_dir)).select(
        "run_id", "call_id", "extraction_status", "error_message", F.col("extraction.summary").alias("summary"),
        F.coalesce("completion_token_count", F.lit(-1)).alias("completion_token_count"),
    )
