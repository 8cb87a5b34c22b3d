"""Calls a user-supplied model for each request and retries what failed."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.operators.validation import judge_responses
from callsift.session import at_most, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Attempts per call, seconds before the first retry (doubled for each further one).
MAX_ATTEMPTS = 3
BACKOFF_SECONDS = 2.0
# Rows of a round that a task holds in Python at once (more if the model takes larger batches).
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 1024
# Failures of the connection, as opposed to anything else a model function may raise.
CONNECTION_ERRORS = (TimeoutError, ConnectionError, OSError)

REPLY = (
    "content string, call_error string, has_usage boolean, "
    "prompt_tokens int, completion_tokens int"
)

ModelFn = Callable[[list[dict]], list]
BuildRequests = Callable[[DataFrame], DataFrame]


def _count(value) -> int | None:
    return value if isinstance(value, int) and not isinstance(value, bool) and 0 <= value < 1 << 31 else None


def reply_row(reply) -> tuple:
    """One model reply (a dict or an exception) as the fields of ``REPLY``; what has no such form is that call's error."""
    if isinstance(reply, BaseException):
        kind = "api_error" if isinstance(reply, CONNECTION_ERRORS) else "unexpected_error"
        return None, f"{kind}: {type(reply).__name__}: {reply}", False, None, None
    usage = reply.get("usage") if isinstance(reply, dict) else None
    usage = usage if isinstance(usage, dict) else None
    tokens = (_count(usage.get("prompt_tokens")), _count(usage.get("completion_tokens"))) if usage else (None, None)
    if not isinstance(reply, dict) or "content" not in reply:
        return None, "missing_content: reply carries no content", bool(usage), *tokens
    content = reply["content"]
    if content is not None and not isinstance(content, str):
        return None, f"unexpected_error: content is a {type(content).__name__}", bool(usage), *tokens
    return content or "", None, bool(usage), *tokens


def call_batch(model_fn: ModelFn, requests: list[dict]) -> list[tuple]:
    """A raising model function fails its whole batch; it may also return exceptions per request."""
    try:
        replies = list(model_fn(requests))
    except Exception as error:  # noqa: BLE001 - whatever the user's function raises becomes rows
        replies = [error] * len(requests)
    rows = [reply_row(reply) for reply in replies[: len(requests)]]
    lacking = len(requests) - len(rows)
    return rows + [(None, "missing_content: no reply for this request", False, None, None)] * lacking


def call_model(
    df: DataFrame,
    model_fn: ModelFn,
    attempt: int = 1,
    batch_size: int = 64,
    backoff_seconds: float = BACKOFF_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Adds ``reply``. Only call_id and request travel to Python, in Arrow batches.

    ``model_fn`` gets up to ``batch_size`` dicts (call_id, body, attempt) and returns as many dicts
    (content, optional usage) or exceptions. It runs at least once per row: a lost task calls again.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        waited = attempt == 1
        for ids, bodies in batches:
            if not waited:
                sleep(backoff_seconds * 2 ** (attempt - 2))
                waited = True
            requests = [
                {"call_id": i, "body": b, "attempt": attempt} for i, b in zip(ids, bodies, strict=True)
            ]
            rows = []
            for start in range(0, len(requests), batch_size):
                rows += call_batch(model_fn, requests[start : start + batch_size])
            frame = pd.DataFrame(
                rows,
                columns=["content", "call_error", "has_usage", "prompt_tokens", "completion_tokens"],
                dtype="object",
            )
            for name in ("prompt_tokens", "completion_tokens"):
                frame[name] = frame[name].astype("Int32")
            frame["has_usage"] = frame["has_usage"].astype("bool")
            yield frame

    run.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]],
        "return": Iterator[pd.DataFrame],
    }
    model = F.pandas_udf(run, REPLY).asNondeterministic()
    return df.withColumn("reply", model("call_id", "request"))


def attempt_once(
    df: DataFrame, build_requests: BuildRequests, model_fn: ModelFn, attempt: int, **options
) -> DataFrame:
    """One call per row, parsed and validated; token counts of the last reply with usage are kept."""
    flat = call_model(build_requests(df), model_fn, attempt, **options).withColumns(
        {
            "content": F.col("reply.content"),
            "call_error": F.col("reply.call_error"),
            "prompt_token_count": F.when(F.col("reply.has_usage"), F.col("reply.prompt_tokens")).otherwise(
                F.col("prompt_token_count")
            ),
            "completion_token_count": F.when(
                F.col("reply.has_usage"), F.col("reply.completion_tokens")
            ).otherwise(F.col("completion_token_count")),
            "attempts": F.lit(attempt),
        }
    )
    return judge_responses(flat, "content", "call_error").drop("request", "reply", "content", "call_error")


def extract_batch(
    calls: DataFrame,
    build_requests: BuildRequests,
    model_fn: ModelFn,
    max_attempts: int = MAX_ATTEMPTS,
    concurrency: int | None = None,
    **options,
) -> DataFrame:
    """Runs up to ``max_attempts`` rounds; each round handles only the rows that failed before.

    A round is written to the shared work folder before anything reads it, so the model is not
    called again by later steps. ``build_requests`` adds the column ``request``; it is rebuilt per
    round rather than stored next to the transcript. ``concurrency`` caps the parallel calls by the
    partition count; without it the free task slots do. Requests reach Python at most ``ROWS_AT_ONCE`` at a time.
    """
    empty = F.lit(None).cast("int")
    pending = calls.withColumns({"prompt_token_count": empty, "completion_token_count": empty})
    finished = []
    for attempt in range(1, max_attempts + 1):
        if concurrency:
            pending = pending.repartition(concurrency)
        with at_most(calls.sparkSession, ARROW_ROWS, max(ROWS_AT_ONCE, options.get("batch_size", 0))):
            judged = materialize(attempt_once(pending, build_requests, model_fn, attempt, **options), f"attempt-{attempt}")
        failed = judged.filter(F.col("extraction_status") == "error")
        if attempt == max_attempts or failed.isEmpty():
            finished.append(judged)
            break
        finished.append(judged.filter(F.col("extraction_status") == "success"))
        pending = failed.drop("extraction", "extraction_status", "error_message", "attempts")
    rows = finished[0]
    for more in finished[1:]:
        rows = rows.unionByName(more)
    return rows
