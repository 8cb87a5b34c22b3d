"""Scrapes, alarms, medians, disagreement, and the query API."""

import datetime as dt
from random import Random

import pytest
from pyspark.sql import functions as F

from callsift import schemas
from callsift.functions import scrape as sc
from callsift.operators import compare, metrics
from callsift.operators.runs import latest_runs
from callsift.plans import queries as api

SCRAPES = {
    "": (0.0, None),
    "vllm:gpu_cache_usage_perc 0.5\nvllm:gpu_cache_usage 0.9": (0.5, None),
    "vllm:gpu_cache_usage{a=\"b\"} 1e-1  \n": (0.1, None),
    "vllm:gpu_cache_usage_perc x\nvllm:gpu_cache_usage 0.9": (0.9, None),
    "vllm:gpu_cache_usage_perc 1-2\nvllm:gpu_cache_usage 0.9": (0.9, None),
    "# vllm:gpu_cache_usage 0.9\n#vllm:prefix_cache_hit_rate 0.3": (0.0, None),
    "vllm:prefix_cache_hit_rate 0.8\nvllm:gpu_prefix_cache_hit_rate 0.3": (0.0, 0.8),
    "vllm:prefix_cache_hit_rate\nvllm:prefix_cache_hit_rate{x=\"1\"} 0.7": (0.0, 0.7),
    "vllm:prefix_cache_hits_total 30\nvllm:prefix_cache_queries_total 40": (0.0, 0.75),
    "vllm:prefix_cache_hits{a=\"1\"} 10\nvllm:prefix_cache_hits{a=\"2\"} 5\nvllm:prefix_query_total{a=\"1\"} 2e1": (0.0, 0.75),
    "vllm:prefix_cache_hits 1\nvllm:prefix_cache_queries 0": (0.0, None),
    "vllm:prefix_cache_hits_total{a=\"1\"} 100\nvllm:prefix_cache_hits_created{a=\"1\"} 1.7e9\nvllm:prefix_cache_queries_total{a=\"1\"} 1000\nvllm:prefix_cache_queries_created{a=\"1\"} 1.7e9": (0.0, 0.1),
}


def test_scrapes(spark):
    df = spark.createDataFrame([(t,) for t in SCRAPES], "scrape string")
    rows = metrics.scrape_metrics(df).collect()
    assert {r.scrape: (r.gpu_util, r.prefix_cache_hit_ratio) for r in rows} == SCRAPES
    assert {r.scrape for r in rows if r.passes_gate} == {t for t, (_, v) in SCRAPES.items() if v is not None and v > sc.HIT_RATIO_GATE}


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, minute // 60, minute % 60, second)


def test_alarm_needs_unbroken_periods(spark):
    data = [("exact", at(m, 30), 1.0) for m in range(10, 15)] + [("short", at(m), 2.0) for m in range(4)]
    data += [("gap", at(m), 1.0) for m in (0, 1, 2, 4, 5, 6)] + [("low", at(m), 0.5) for m in range(9)]
    data += [("peak", at(m, s), 1.0 if s == 59 else 0.0) for m in range(5) for s in (0, 59)]
    df = spark.createDataFrame(data, "series string, ts timestamp, value double")
    rows = {r.series: r for r in metrics.sustained_alarm(df, 1.0, 5).collect()}
    assert set(rows) == {"exact", "peak"}
    assert (rows["exact"].breach_start, rows["exact"].breach_end, rows["exact"].fired_at) == (at(10), at(14), at(14))


def test_sweep_and_arms(spark):
    data = [("r", 16, True, 1.0, 0), ("r", 16, False, 9.0, 2_000_000), ("r", 24, False, 5.0, 7)]
    df = spark.createDataFrame(data, "run_id string, concurrency int, ok boolean, latency_s double, us long")
    rows = {r.concurrency: r for r in metrics.bench_sweep(df).collect()}
    assert (rows[16].req_per_sec, rows[16].error_rate, rows[16].duration_seconds, rows[16].total_calls) == (1 / 11, 0.5, 11.0, 2)
    assert (rows[24].req_per_sec, rows[24].duration_seconds, rows[24].error_rate) == (0.0, 5.0, 1.0)
    arms = {r.concurrency: (r.ok_calls, r.mean_latency_s) for r in compare.ab_latency(df, "concurrency").collect()}
    assert arms == {16: (1, 1.0), 24: (0, 0.0)}


def test_windows_join_requests_and_scrapes(spark):
    requests = spark.createDataFrame([("r", True, at(0, 5)), ("r", False, at(0, 9)), ("q", True, at(3))], "run_id string, ok boolean, ts timestamp")
    scrapes = spark.createDataFrame([("r", "vllm:gpu_cache_usage 0.5\nvllm:prefix_cache_hit_rate 0.25", at(0)), ("s", "", at(1))], "run_id string, scrape string, ts timestamp")
    rows = {(r.run_id, r.period_start): r for r in metrics.metrics_60s(requests, scrapes).collect()}
    assert set(rows) == {("r", at(0)), ("q", at(3)), ("s", at(1))}
    r = rows[("r", at(0))]
    assert (r.req_per_sec, r.error_rate, r.prefix_cache_hit_ratio, r.gpu_util) == (1 / 60, 0.5, 0.25, 0.5)
    assert rows[("s", at(1))].requests is None and rows[("s", at(1))].gpu_util == 0.0


def test_runaway(spark):
    data = [("a", i, n) for i, n in enumerate([1, 3, 5, 9, 51])] + [("b", i, 0) for i in range(3)] + [("b", 9, 100), ("c", 0, 10), ("c", 1, 100)]
    df = spark.createDataFrame(data, "arm string, id int, length long")
    assert {r.arm: r.upper_median for r in compare.upper_median(df, ["arm"], "length").collect()} == {"a": 5, "b": 0, "c": 100}
    wide = spark.range(0, 2001).selectExpr("'w' arm", "id * id * 977 length")
    assert compare.upper_median(wide, ["arm"], "length").first().upper_median == 1000 * 1000 * 977
    assert [(r.arm, r.id) for r in compare.runaway_outputs(df, ["arm"], "id").collect()] == [("a", 4)]
    assert {r.arm: r.runaway for r in compare.runaway_verdict(df, ["arm"]).collect()} == {"a": True, "b": False, "c": False}


def test_medians_over_any_range(spark):
    random = Random(4)
    wide = [int(10 ** random.uniform(0, 18)) * random.choice([1, 1, 1, -1]) for _ in range(3001)]
    crowded = [5_000_000_000 + random.randrange(3000) for _ in range(2000)] + [7] * 1001
    parts = [random.choice([1e-9, 0.25, 3.5, 1e15]) * random.random() for _ in range(2000)]
    ends = [-(2**63), 2**63 - 1, 0, 1]
    whole = spark.createDataFrame([(k, v) for k, own in (("wide", wide), ("crowded", crowded), ("ends", ends)) for v in own], "k string, v long")
    got = {r.k: r.upper_median for r in compare.upper_median(whole, ["k"], "v").collect()}
    assert got == {k: sorted(own)[len(own) // 2] for k, own in (("wide", wide), ("crowded", crowded), ("ends", ends))}
    fractions = spark.createDataFrame([("p", v) for v in parts], "k string, v double")
    assert compare.upper_median(fractions, ["k"], "v").first().upper_median == sorted(parts)[1000]


def test_response_length_is_in_bytes(spark):
    replies = {'{"choices":[{"message":{"content":"éé"}}]}': 4, '{"choices":[{"message":{"content":null}}]}': 0, '{"choices":[{"message":{}}]}': 0, '{"choices":[]}': 14, "é": 2, "": 0}
    good = '{"choices":[{"message":{"content":"abc"}}]}'
    replies |= {good + " trailing": len(good) + 9, good[:-1] + ',"choices":[{"message":{"content":"xyzw"}}]}': 4, '{"choices":[{"message":{"content":5}}]}': 39}
    df = spark.createDataFrame([(r,) for r in replies], "raw string")
    assert {r.raw: r.n for r in compare.response_lengths(df, length="n").collect()} == replies


@pytest.fixture(scope="module")
def rows(spark):
    def made(run, call, status, score, second=0):
        return (run, call, status, None if status == "success" else "validation_error: x", (score,) if status == "success" else None, at(0, second))

    data = [made("a", "1", "success", 3), made("a", "2", "success", None), made("a", "3", "error", None), made("a", "3", "success", 1, 5), made("a", "3", "error", None, 9), made("a", "4", "success", 2)]
    data += [made("b", "1", "success", 3), made("b", "2", "success", None), made("b", "3", "success", 2), made("b", "5", "error", None)]
    data += [made("c", "1", "error", None), made("c", "2", "success", 4)]
    return spark.createDataFrame(data, "run_id string, call_id string, extraction_status string, error_message string, extraction struct<score: int>, extracted_at timestamp")


def test_disagreement(rows):
    out = compare.field_disagreement(rows, "a", "b", "extraction.score").collect()
    assert [tuple(r) for r in out] == [("3", 1, 2)]
    whole = compare.field_disagreement(rows, "a", "c", "extraction").collect()
    assert sorted(r.call_id for r in whole) == ["1", "2"]
    cells = {(r.run_a, r.run_b): (r.compared, r.differing, r.disagreement_rate) for r in compare.disagreement_matrix(rows, ["a", "b", "c"], ["extraction.score"]).collect()}
    assert cells == {("a", "b"): (3, 1, 1 / 3), ("a", "c"): (2, 2, 1.0), ("b", "c"): (2, 2, 1.0)}
    agreement = {r.run_id: r.agreement_rate for r in compare.reference_agreement(rows, "a", ["b", "c"], ["extraction.score"]).collect()}
    assert agreement == {"b": pytest.approx(2 / 3), "c": 0.0}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_disagreement_reads_the_table_once_and_does_not_grow_with_the_runs(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    few, many = (plan_of(compare.disagreement_matrix(stored, runs, ["extraction.score"])) for runs in (["a", "b", "c"], [f"run-{i}" for i in range(100)]))
    assert few.count("FileScan") == many.count("FileScan") == 1 and "SortAggregate" not in few
    assert many.count("\n") == few.count("\n") and len(many) < len(few) + 100 * 60


def test_disagreement_of_many_runs_and_fields(spark):
    runs, fields = [f"r{i}" for i in range(50)], [f"doc.f{j}" for j in range(37)]
    data = []
    for r in range(50):
        for call in range(12):
            if (r + call) % 5:
                values = tuple(None if (call + j) % 7 == 0 and r % 2 else (call * j + r // 10) % 3 for j in range(37))
                data.append((f"r{r}", f"{call}", "success", at(0), values))
    schema = f"run_id string, call_id string, extraction_status string, extracted_at timestamp, doc struct<{', '.join(f'f{j}: int' for j in range(37))}>"
    got = {(r.run_a, r.run_b, r.field): (r.compared, r.differing) for r in compare.disagreement_matrix(spark.createDataFrame(data, schema), runs, fields).collect()}
    held = {(r, c): v for r, c, _, _, v in data}
    want = {}
    for a in range(50):
        for b in range(a + 1, 50):
            both = [(held[f"r{a}", f"{c}"], held[f"r{b}", f"{c}"]) for c in range(12) if (f"r{a}", f"{c}") in held and (f"r{b}", f"{c}") in held]
            for j in range(37):
                want[f"r{a}", f"r{b}", fields[j]] = (len(both), sum(x[j] != y[j] for x, y in both))
    assert got == want


def test_ties_do_not_fall_to_chance(spark):
    data = [("a", "1", "success", None, (n,), at(0)) for n in range(20)] + [("b", "1", "success", None, (n,), at(0)) for n in range(5, 15)]
    schema = "run_id string, call_id string, extraction_status string, error_message string, extraction struct<score: int>, extracted_at timestamp"
    seen = set()
    for order in ("n", "-n", "n % 7"):
        df = spark.createDataFrame(data, schema).selectExpr("*", f"{order.replace('n', 'extraction.score')} k").repartition(3).sortWithinPartitions("k")
        seen.add(tuple(map(tuple, compare.field_disagreement(df, "a", "b", "extraction.score").collect())) + tuple(map(tuple, compare.disagreement_matrix(df, ["a", "b"], ["extraction.score"]).collect())))
    assert len(seen) == 1
    starts = [("r", f"test {n}", at(1), None, "running", at(1)) for n in range(9)] + [("r", None, None, at(1), "failed", at(1)), ("r", None, None, at(1), "partial", at(1))]
    log = spark.createDataFrame(starts, "run_id string, test_name string, started_at timestamp, ended_at timestamp, status string, updated_at timestamp")
    absent = [f.name for f in schemas.EXPERIMENT_RUNS.fields if f.name not in log.columns]
    log = log.withColumns({name: F.lit(None).cast("string") for name in absent})
    found = {(r.test_name, r.status) for order in (F.asc("test_name"), F.desc("test_name"), F.desc("status")) for r in latest_runs(log.orderBy(order)).collect()}
    assert len(found) == 1 and found.pop()[1] in ("failed", "partial")


def test_validity(rows):
    out = {r.run_id: (r.calls, r.validity_rate, r.schema_error_rate) for r in compare.schema_validity(rows).collect()}
    assert out == {"a": (6, 4 / 6, 2 / 6), "b": (4, 0.75, 0.25), "c": (2, 0.5, 0.5)}


def test_query_api(spark, rows):
    assert [r.call_id for r in api.failed_calls(rows, "a", 1).collect()] == ["3"]
    runs = spark.createDataFrame([("x", "t", at(1)), ("y", "t", at(2)), ("z", "u", at(3)), ("x", "t", at(1))], "run_id string, test_name string, started_at timestamp")
    assert [r.run_id for r in api.list_runs(runs, 2).collect()] == ["z", "y"]
    measured = spark.createDataFrame([("x", 16, 1.0, None), ("y", 16, 4.0, 0.5), ("z", 16, 100.0, 0.9), ("y", 32, 2.0, None)], "run_id string, concurrency long, req_per_sec double, prefix_cache_hit_ratio double").withColumns({"error_rate": F.lit(0.0), "gpu_util_mean": F.lit(None).cast("double")})
    out = [(r.concurrency, r.req_per_sec, r.hit_ratio, r.gpu_util) for r in api.compare_concurrency(measured, runs, "t").collect()]
    assert out == [(16, 2.0, 0.5, None), (32, 2.0, None, None)]
    sql = api.run_sql(spark, "WITH s AS (SELECT * FROM calls_extractions WHERE run_id = :r) SELECT max(extraction.score) AS top FROM s", {"calls_extractions": rows}, {"r": "a"})
    assert sql.first().top == 3
    summary = {r.extraction_status: r.n for r in api.summarize_run(rows.withColumns({"prompt_token_count": F.lit(1), "completion_token_count": F.lit(None).cast("int")}), "a").collect()}
    assert summary == {"success": 4, "error": 2}
