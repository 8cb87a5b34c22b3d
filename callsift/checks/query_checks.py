"""The query API, run registry, metrics, and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.checks import fixtures as fx
from callsift.checks.extract_checks import LATEST
from callsift.checks.registry import check
from callsift.operators import compare, metrics, runs
from callsift.plans import queries as api
from callsift.session import work_dir
from callsift.sources.tables import MEASUREMENTS, Warehouse, latest_runs

LATEST_RUNS = """
select run_id, max(test_name) test_name, arg_max(status, updated_at) status, max(started_at) started_at,
  max(ended_at) ended_at from updates group by run_id
"""
_RUNS = {"updates": fx.RUN_UPDATES, "runs": LATEST_RUNS}


def _updates(spark, sf_dir):
    updates = fx.shared(spark, sf_dir, fx.RUN_UPDATES)
    absent = ["git_sha", "model_manifest_hash", "vllm_image_uri", "instance_type", "use_spot", "region",
              "enable_thinking", "max_model_len", "max_num_seqs", "notes"]
    return updates.withColumns({name: F.lit(None).cast("string") for name in absent})


def _latest_runs(spark, sf_dir):
    return latest_runs(_updates(spark, sf_dir))


@check(fx.with_views("select run_id, test_name, status, started_at, ended_at from runs", **_RUNS))
def run_registry_latest(spark, sf_dir):
    return _latest_runs(spark, sf_dir).select("run_id", "test_name", "status", "started_at", "ended_at")


@check(
    fx.with_views("select run_id, test_name, status, started_at from runs order by started_at desc, run_id limit 20", **_RUNS)
)
def list_runs(spark, sf_dir):
    return api.recent_runs(_updates(spark, sf_dir)).select("run_id", "test_name", "status", "started_at")


@check(
    fx.with_views(
        """select extraction_status, count(*) n, avg(prompt_token_count) avg_prompt_tok, avg(completion_token_count) avg_completion_tok
        from r where run_id = 'run_a' group by extraction_status""",
        r=fx.ROWS,
    )
)
def summarize_run(spark, sf_dir):
    return api.summarize_run(fx.rows(spark, sf_dir), "run_a")


@check(
    fx.with_views(
        """select concurrency, round(avg(req_per_sec), 9) req_per_sec, round(avg(error_rate), 9) error_rate,
        round(avg(prefix_cache_hit_ratio), 9) hit_ratio, round(avg(gpu_util_mean), 4) gpu_util
        from m join runs using (run_id) where test_name = '1-URGENT' group by concurrency order by concurrency""",
        m=fx.MEASUREMENTS,
        **_RUNS,
    )
)
def compare_concurrency(spark, sf_dir):
    means = api.compare_concurrency(
        fx.shared(spark, sf_dir, fx.MEASUREMENTS), _latest_runs(spark, sf_dir), "1-URGENT"
    )
    return means.select(
        "concurrency",
        *[F.round(name, 9).alias(name) for name in ("req_per_sec", "error_rate", "hit_ratio")],
        F.round("gpu_util", 4).alias("gpu_util"),
    )


@check(
    fx.with_views(
        """select call_id, error_message from r where run_id = 'run_a' and extraction_status = 'error'
        order by call_id, error_message limit 100""",
        r=fx.ROWS,
    )
)
def failed_calls(spark, sf_dir):
    return api.failed_calls(fx.rows(spark, sf_dir), "run_a")


@check(
    fx.with_views(
        """select a.call_id, a.summary run_a_value, b.summary run_b_value from (select * from r where run_id = 'run_b') a
        join (select * from r where run_id = 'run_c') b using (call_id) where a.summary is distinct from b.summary""",
        r=fx.ROWS,
    )
)
def field_disagreement(spark, sf_dir):
    return api.field_disagreement(fx.rows(spark, sf_dir), "run_b", "run_c", "extraction.summary")


@check(
    fx.with_views(
        """select a.call_id, cast(a.score as varchar) run_a_value, cast(b.score as varchar) run_b_value from (select * from latest where run_id = 'run_a') a
        join (select * from latest where run_id = 'run_b') b using (call_id) where a.score is distinct from b.score""",
        r=fx.ROWS,
        latest=LATEST,
    )
)
def field_disagreement_after_retries(spark, sf_dir):
    out = api.field_disagreement(fx.rows(spark, sf_dir), "run_a", "run_b", "extraction.agent.empathy_score")
    return out.withColumns({name: F.col(name).cast("string") for name in ("run_a_value", "run_b_value")})


@check(
    fx.with_views(
        """select intent, count(*) n, avg(score) mean_empathy from r where run_id = 'run_a' and extraction_status = 'success' and score >= 2 group by intent""",
        r=fx.ROWS,
    )
)
def nested_sql(spark, sf_dir):
    text = """
        SELECT extraction.customer.intent_primary AS intent, count(*) AS n, avg(extraction.agent.empathy_score) AS mean_empathy
        FROM calls_extractions
        WHERE run_id = :run_id AND extraction_status = 'success' AND extraction.agent.empathy_score >= :lowest
        GROUP BY extraction.customer.intent_primary"""
    return api.run_sql(
        spark, text, {"calls_extractions": fx.rows(spark, sf_dir)}, {"run_id": "run_a", "lowest": 2}
    )


@check(fx.with_views("select run_id, extraction_status, count(*) n from r group by all", r=fx.ROWS))
def run_progress(spark, sf_dir):
    return runs.run_progress(fx.rows(spark, sf_dir))


@check(
    fx.with_views(
        "select distinct run_id, call_id from r where extraction_status = 'success' and run_id = 'run_a'", r=fx.ROWS
    )
)
def committed_ids(spark, sf_dir):
    return runs.committed_ids(fx.rows(spark, sf_dir), "run_a")


@check(
    fx.with_views(
        "select event_id, gpu_util, ratio prefix_cache_hit_ratio, coalesce(ratio > 0.7, false) passes_gate from v",
        scrapes=fx.SCRAPES,
        v=fx.SCRAPE_VALUES,
    )
)
def metrics_scrape(spark, sf_dir):
    return metrics.scrape_metrics(fx.shared(spark, sf_dir, fx.SCRAPES, busy=("events",))).select(
        "event_id", "gpu_util", "prefix_cache_hit_ratio", "passes_gate"
    )


@check(
    fx.with_views(
        """select run_id, time_bucket(interval '60 seconds', ts) period_start, count(*) filter (ok) / 60.0::double req_per_sec,
        count(*) filter (not ok) / count(*) error_rate, count(*) requests, round(avg(ratio), 10) prefix_cache_hit_ratio, round(avg(gpu_util), 10) gpu_util
        from (select r.*, v.ratio, v.gpu_util from v join (select event_id, event_type <> 'error' ok from events) e using (event_id)
          join (select event_id, 'run_' || (user_id % 25) run_id, ts from events) r using (event_id)) group by run_id, period_start""",
        scrapes=fx.SCRAPES,
        v=fx.SCRAPE_VALUES,
    ).replace("select r.*, v.ratio, v.gpu_util from v", "select r.run_id, r.ts, e.ok, v.ratio, v.gpu_util from v")
)
def metrics_60s(spark, sf_dir):
    out = metrics.metrics_60s(fx.requests(spark, sf_dir), fx.shared(spark, sf_dir, fx.SCRAPES, busy=("events",)))
    return out.select(
        "run_id", "period_start", "req_per_sec", "error_rate", "requests",
        F.round("prefix_cache_hit_ratio", 10).alias("prefix_cache_hit_ratio"), F.round("gpu_util", 10).alias("gpu_util"),
    )


@check(
    fx.with_views(
        """select run_id, concurrency, ok_calls, total_calls, s duration_seconds, ok_calls / s req_per_sec,
        (total_calls - ok_calls) / total_calls error_rate from (select run_id, concurrency, count(*) filter (ok) ok_calls, count(*) total_calls,
        (max(us + latency_s * 1000000) - min(us)) / 1000000.0::double s from requests group by run_id, concurrency)""",
        requests=fx.REQUESTS,
    )
)
def bench_sweep(spark, sf_dir):
    return metrics.bench_sweep(fx.requests(spark, sf_dir))


@check(
    fx.with_views(
        """select run_id, concurrency, total_calls, round(ok_calls / s, 9) req_per_sec, (total_calls - ok_calls) / total_calls error_rate, round(s, 6) duration_seconds,
        round(ratio, 9) prefix_cache_hit_ratio, round(gpu, 9) gpu_util_mean, true measured
        from (select run_id, concurrency, count(*) filter (ok) ok_calls, count(*) total_calls, (max(us + latency_s * 1000000) - min(us)) / 1000000.0::double s from requests group by all)
        join (select run_id, event_id % 5 * 8 + 16 concurrency, avg(ratio) ratio, avg(gpu_util) gpu from v group by all) using (run_id, concurrency)""",
        requests=fx.REQUESTS,
        scrapes=fx.SCRAPES,
        v=fx.SCRAPE_VALUES,
    )
)
def sweep_measurements(spark, sf_dir):
    """A sweep with its scrapes, recorded as measurements and read back."""
    scrapes = fx.shared(spark, sf_dir, fx.SCRAPES, busy=("events",)).withColumn("concurrency", F.col("event_id") % 5 * 8 + 16)
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    warehouse.record_measurements(metrics.sweep_measurements(fx.requests(spark, sf_dir), scrapes))
    stored = warehouse.read(MEASUREMENTS)
    rounded = {"req_per_sec": 9, "duration_seconds": 6, "prefix_cache_hit_ratio": 9, "gpu_util_mean": 9}
    return stored.select(
        "run_id", "concurrency", "total_calls", "error_rate", *[F.round(name, digits).alias(name) for name, digits in rounded.items()],
        F.col("measured_at").isNotNull().alias("measured"),
    )


ALARM = """
with peaks as (select event_type series, time_bucket(interval '1 hour', ts) period_start, max(value) peak from events group by all),
breaches as (select *, epoch(period_start) // 3600 - row_number() over (partition by series order by period_start) stretch from peaks where peak >= 60)
select series, min(period_start) breach_start, max(period_start) breach_end, count(*) breaching_periods,
  min(period_start) + interval '2 hours' fired_at from breaches group by series, stretch having count(*) >= 3
"""


@check(ALARM)
def sustained_alarm(spark, sf_dir):
    samples = fx.table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), "ts", "value")
    return metrics.sustained_alarm(samples, threshold=60.0, periods=3, period_seconds=3600)


# Two reply formats; every 50th reply is padded far beyond the others.
REPLIES = """
select doc_id, concat(source, '/', cast(doc_id % 2 as varchar(9))) arm,
  case when doc_id % 50 = 7 then concat('not json ', repeat(concat(text, ' '), 12)) when doc_id % 9 = 4 then concat('{"choices":[]}', lang)
  when doc_id % 50 = 8 then concat('{"choices":[{"message":{"content":"', lang, '"}}]} ', source)
  when doc_id % 50 = 9 then concat('{"choices":1,"choices":[{"message":{"content":"', lang, source, '"}}]}')
  when doc_id % 50 = 10 then concat('{"choices":[{"message":{"content":', cast(doc_id as varchar(9)), '}}]}')
  else concat('{"choices":[{"message":{"content":"', repeat('é', cast(n_chars % 900 + 100 as int)), '"}}]}') end raw from documents
"""
REPLY_LENGTHS = """
select doc_id, arm, case when doc_id % 50 = 7 or doc_id % 9 = 4 or doc_id % 50 in (8, 10) then strlen(raw)
  when doc_id % 50 = 9 then strlen(lang || source) else 2 * (n_chars % 900 + 100) end as length
from replies join documents using (doc_id)
"""
_MEDIANS = """
select arm, length upper_median, n group_rows from (select *, row_number() over (partition by arm order by length) - 1 k, count(*) over (partition by arm) n from lengths) where k = n // 2
"""
_REPLY_VIEWS = {"replies": REPLIES, "lengths": REPLY_LENGTHS, "medians": _MEDIANS}


def _reply_lengths(spark, sf_dir):
    replies = fx.shared(spark, sf_dir, REPLIES, busy=("documents",))
    return compare.response_lengths(replies).select("doc_id", "arm", "length")


@check(fx.with_views("select doc_id, arm, length from lengths", **_REPLY_VIEWS))
def response_lengths(spark, sf_dir):
    return _reply_lengths(spark, sf_dir)


@check(fx.with_views("select arm, group_rows, upper_median from medians", **_REPLY_VIEWS))
def upper_median(spark, sf_dir):
    return compare.upper_median(_reply_lengths(spark, sf_dir), ["arm"], "length")


@check(
    fx.with_views(
        "select arm, doc_id, length, upper_median from lengths join medians using (arm) where upper_median > 0 and length > 10 * upper_median",
        **_REPLY_VIEWS,
    )
)
def runaway_outputs(spark, sf_dir):
    return compare.runaway_outputs(_reply_lengths(spark, sf_dir), ["arm"], "doc_id")


@check(
    fx.with_views(
        """select arm, any_value(upper_median) upper_median, max(length) longest, max(length) > 10 * any_value(upper_median) and any_value(upper_median) > 0 runaway
        from lengths join medians using (arm) group by arm""",
        **_REPLY_VIEWS,
    )
)
def runaway_verdict(spark, sf_dir):
    return compare.runaway_verdict(_reply_lengths(spark, sf_dir), ["arm"]).select(
        "arm", "upper_median", "longest", "runaway"
    )


@check(
    fx.with_views(
        """select concurrency arm, count(*) filter (ok) ok_calls, round(coalesce(avg(latency_s) filter (ok), 0), 8) mean_latency_s
        from requests group by concurrency""",
        requests=fx.REQUESTS,
    )
)
def ab_latency(spark, sf_dir):
    out = compare.ab_latency(fx.requests(spark, sf_dir).withColumnRenamed("concurrency", "arm"))
    return out.select("arm", "ok_calls", F.round("mean_latency_s", 8).alias("mean_latency_s"))


FIELDS = {
    "extraction.summary": "summary",
    "extraction.agent.empathy_score": "score",
    "extraction.customer.intent_primary": "intent",
    "extraction_status": "extraction_status",
}
MATRIX = " union all ".join(
    f"""select a.run_id run_a, b.run_id run_b, '{path}' field, count(*) compared, count(*) filter (a.{column} is distinct from b.{column}) differing
    from latest a join latest b on a.call_id = b.call_id and a.run_id < b.run_id group by a.run_id, b.run_id"""
    for path, column in FIELDS.items()
)


@check(
    fx.with_views(
        "select *, differing / compared disagreement_rate from matrix", r=fx.ROWS, latest=LATEST, matrix=MATRIX
    )
)
def disagreement_matrix(spark, sf_dir):
    return compare.disagreement_matrix(fx.rows(spark, sf_dir), ["run_a", "run_b", "run_c"], list(FIELDS))


@check(
    fx.with_views(
        """select run_b run_id, field, compared, 1 - differing / compared agreement_rate from matrix where run_a = 'run_a'""",
        r=fx.ROWS,
        latest=LATEST,
        matrix=MATRIX,
    )
)
def reference_agreement(spark, sf_dir):
    return compare.reference_agreement(fx.rows(spark, sf_dir), "run_a", ["run_b", "run_c"], list(FIELDS))


@check(
    fx.with_views(
        """select run_id, count(*) calls, count(*) filter (extraction_status = 'success') / count(*) validity_rate,
        count(*) filter (error_message like 'json_parse_error%' or error_message like 'validation_error%') / count(*) schema_error_rate
        from latest group by run_id""",
        r=fx.ROWS,
        latest=LATEST,
    )
)
def validity_rate(spark, sf_dir):
    return compare.schema_validity(runs.latest_rows(fx.rows(spark, sf_dir)))


# The audited input lacks a tenth of the stored calls and names some that were never stored.
EXPECTED_CALLS = """
select cast(doc_id as varchar(20)) call_id from documents where doc_id % 10 <> 3
union all select concat('lost-', cast(doc_id as varchar(20))) from documents where doc_id % 100 = 0
"""
AUDIT = """
select call_id, cast(asked as bigint) asked, cast(stored as bigint) stored, cast(succeeded as bigint) succeeded,
  case when asked = 0 then 'extra' when stored = 0 then 'missing' when succeeded = 0 then 'incomplete' when succeeded > asked then 'duplicated' else 'complete' end state
from (select coalesce(e.call_id, s.call_id) call_id, coalesce(e.n, 0) asked, coalesce(s.n, 0) stored, coalesce(s.good, 0) succeeded
  from (select call_id, count(*) n from expected group by call_id) e
  full outer join (select call_id, count(*) n, count(*) filter (extraction_status = 'success') good from r where run_id = 'run_a' group by call_id) s on e.call_id = s.call_id)
"""
_AUDIT_VIEWS = {"r": fx.ROWS, "expected": EXPECTED_CALLS, "audit": AUDIT}


@check(fx.with_views("select * from audit", **_AUDIT_VIEWS))
def audit_calls(spark, sf_dir):
    return runs.audit_calls(fx.shared(spark, sf_dir, EXPECTED_CALLS), fx.rows(spark, sf_dir), "run_a")


@check(
    fx.with_views(
        """select 'run_a' run_id, cast(sum(asked) as bigint) expected_calls, cast(sum(stored) as bigint) stored_rows, count(*) filter (state = 'missing') missing,
        count(*) filter (state = 'extra') extra, count(*) filter (state = 'incomplete') incomplete, count(*) filter (state = 'duplicated') duplicated,
        count(*) filter (state <> 'complete') = 0 intact from audit""",
        **_AUDIT_VIEWS,
    )
)
def audit_run(spark, sf_dir):
    return runs.audit_run(fx.shared(spark, sf_dir, EXPECTED_CALLS), fx.rows(spark, sf_dir), "run_a")
