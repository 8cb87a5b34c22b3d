"""Resume, statistics, audits, tables, and the batch run."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from callsift import schemas
from callsift.checks.stub import document, stub_model
from callsift.functions.skew import rank_values, salted_join
from callsift.operators import inference, prepare, runs
from callsift.plans.pipeline import RunSettings, request_builder, run_extraction
from callsift.session import materialize, scratch, spread, work_dir
from callsift.sources.commits import RECORDS_PER_CHECKPOINT, CommitLog, Conflict
from callsift.sources.tables import CALLS, MEASUREMENTS, RUNS, Warehouse, conform, latest_runs

FAST = RunSettings("m", model_options={"backoff_seconds": 0.0})


def plain_calls(spark, texts):
    schema = f"call_id string, text string, words {schemas.WORDS_TYPE.simpleString()}, audio_duration double, confidence double, source_path string, category_path string"
    return spark.createDataFrame([(k, t, None, None, None, None, None) for k, t in texts], schema)


def extraction_rows(spark, rows):
    """(run, call, status, second) -> rows with the columns the operators look at."""
    data = [(r, c, s, None if s == "success" else "e: x", dt.datetime(2024, 1, 1, 0, 0, t)) for r, c, s, t in rows]
    return spark.createDataFrame(data, "run_id string, call_id string, extraction_status string, error_message string, extracted_at timestamp")


def test_resume_keeps_errors_and_repeated_inputs(spark):
    rows = extraction_rows(spark, [("r", "a", "success", 1), ("r", "b", "error", 1), ("r", "c", "error", 1), ("r", "c", "success", 2), ("q", "d", "success", 1)])
    calls = spark.createDataFrame([("r", c, i) for i, c in enumerate("abbcddee")], "run_id string, call_id string, n int")
    left = runs.resume(calls, runs.committed_ids(rows))
    assert sorted(r.call_id for r in left.collect()) == list("bbddee")


def test_resume_on_a_hot_key_is_cut_by_adaptive_execution(spark):
    """One id owns half of the rows and, as for identical copies, one salt: the partition is split."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        calls = spark.range(0, 40000, 1, 8).select(
            F.lit("r").alias("run_id"),
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("call_id"),
            F.sha2(F.col("id").cast("string"), 512).alias("text"),
        )
        done = spark.range(0, 40000, 1, 4).filter("id % 4 = 1").select(F.lit("r").alias("run_id"), F.col("id").cast("string").alias("call_id"))
        counted = runs.resume(calls, done).agg(F.count("text").alias("n"), F.max("text"))
        assert counted.collect()[0].n == 20000 + 10000
        plan = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "skew=true" in plan and "skewed" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_salted_join_matches_a_plain_join(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 7, 2)], "k long, v string")
    for how in ("inner", "left_semi", "left_anti"):
        got = salted_join(left, right, ["k"], how, ["id"], salts=5)
        want = left.join(right, "k", how)
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_salted_join_is_null_safe_and_checks_its_type(spark):
    left = spark.createDataFrame([(None, 1), (1, 2)], "k int, n int")
    right = spark.createDataFrame([(None, "x")], "k int, v string")
    assert [tuple(r) for r in salted_join(left, right, ["k"], "inner", ["n"]).collect()] == [(None, 1, "x")]
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], "full", ["n"])


@pytest.mark.parametrize("steps", [[], [1.0], [50.0], [10000.0], [10.0, 2.0], [100.0, 20.0, 5.0]])
def test_rank_values_any_buckets(spark, steps):
    data = [("a", v) for v in (5, 1, 9, 3)] + [("b", 7)] + [("c", i % 40) for i in range(1000)] + [(None, 2), (None, 4), ("a", None)]
    df = spark.createDataFrame(data, "k string, v int")
    ranks = {"mid": F.floor(F.col("group_rows") / 2), "first": F.lit(0)}
    got = {r.k: (r.group_rows, r.mid, r.first) for r in rank_values(df, ["k"], "v", ranks, [F.floor(F.col("v") / s) for s in steps]).collect()}
    assert got == {"a": (4, 5, 1), "b": (1, 7, 7), "c": (1000, 20, 0), None: (2, 4, 2)}


def test_stats_and_status(spark):
    data = [("none", None)]
    data = [("skip", "skipped")] * 3 + [("bad", "error")] * 2 + [("raised", "raised")] * 2 + [("mixed", "error"), ("mixed", "success")] + [("good", "success")]
    stats = runs.final_status(runs.run_stats(spark.createDataFrame(data, "run_id string, outcome string")))
    got = {r.run_id: (r.submitted, r.skipped, r.completed, r.errors, r.status) for r in stats.collect()}
    assert got == {
        "skip": (0, 3, 0, 0, "success"), "bad": (2, 0, 2, 2, "failed"), "raised": (2, 0, 0, 2, "failed"),
        "mixed": (2, 0, 2, 1, "partial"), "good": (1, 0, 1, 0, "success"),
    }
    stopped = runs.final_status(runs.run_stats(spark.createDataFrame(data, "run_id string, outcome string")), F.lit(True))
    assert {r.status for r in stopped.collect()} == {"interrupted"}


def test_latest_rows_prefers_success_and_limits_before_the_shuffle(spark):
    rows = extraction_rows(spark, [("r", "a", "success", 1), ("r", "a", "error", 9), ("r", "b", "error", 1), ("r", "b", "error", 2)])
    latest = runs.latest_rows(rows)
    assert {(r.call_id, r.extraction_status, r.extracted_at.second) for r in latest.collect()} == {("a", "success", 1), ("b", "error", 2)}
    assert latest._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_audit(spark):
    rows = extraction_rows(spark, [("r", "a", "success", 1), ("r", "b", "error", 1), ("r", "c", "success", 1), ("r", "c", "success", 2), ("r", "x", "success", 1), ("q", "m", "success", 1)])
    asked = spark.createDataFrame([(c,) for c in "abcm"], "call_id string")
    states = {r.call_id: r.state for r in runs.audit_calls(asked, rows, "r").collect()}
    assert states == {"a": "complete", "b": "incomplete", "c": "duplicated", "m": "missing", "x": "extra"}
    total = runs.audit_run(asked, rows, "r").first()
    assert (total.expected_calls, total.stored_rows, total.missing, total.extra, total.intact) == (4, 5, 1, 1, False)
    assert runs.audit_run(asked.limit(0), rows, "none").first().intact


def test_conform_pins_types_and_needs_required_columns(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1), schemas.CALLS_EXTRACTIONS)
    out = conform(spark.createDataFrame([("r", 3)], "run_id string, concurrency int"), schemas.BENCH_MEASUREMENTS)
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.BENCH_MEASUREMENTS]


def test_missing_table_reads_as_empty(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "none"))
    for name in (CALLS, MEASUREMENTS, RUNS):
        assert warehouse.read(name).isEmpty()
    assert warehouse.committed_ids(["r"]).isEmpty()


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    first = extraction_rows(spark, [("007", "a", "success", 1), ("007", "b", "error", 1)])
    warehouse.append_extractions(first, "b1")
    warehouse.append_extractions(first.limit(1), "b1", many_runs=True)
    warehouse.append_extractions(extraction_rows(spark, [("7", "c", "success", 1)]), "b2")
    assert sorted((r.run_id, r.call_id) for r in warehouse.calls().collect()) == [("007", "a"), ("7", "c")]
    assert [r.call_id for r in warehouse.committed_ids(["007"]).collect()] == ["a"]
    assert warehouse.committed_ids(["007"], but_not=["b1"]).isEmpty()


def test_run_filter_prunes_partitions_and_columns(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.append_extractions(extraction_rows(spark, [("r", "a", "success", 1), ("q", "b", "success", 1)]), "b1")
    for i in range(30):
        warehouse.append_extractions(extraction_rows(spark, [(f"old-{i}", "a", "success", 1)]), f"old-{i}")
    # Only the run's own folder is listed, however many others there are.
    rows = warehouse.committed_ids(["r", "absent"])
    assert [r.call_id for r in rows.collect()] == ["a"] and all("run_id=r/" in f for f in warehouse._of_runs(["r"]).inputFiles())
    assert "ReadSchema: struct<call_id:string,extraction_status:string>" in rows._jdf.queryExecution().executedPlan().toString()
    assert warehouse.compact(run_ids=["r", "q"]) == 0
    assert warehouse.calls().filter("run_id in ('r', 'q')").count() == 2
    assert warehouse.sql("select count(*) n from calls_extractions where run_id = :r", {"r": "q"}).first().n == 1


def test_rows_of_one_time_have_a_fixed_winner(spark):
    rows = extraction_rows(spark, [("r", "a", "success", 1)] * 3).withColumn("n", F.monotonically_increasing_id())
    shuffled = rows.orderBy(F.desc("n"))
    assert runs.latest_rows(rows).first().n == runs.latest_rows(shuffled).first().n


def test_run_log(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    runs_df = spark.createDataFrame([("a", "t1", 32), ("b", "t1", 16)], "run_id string, test_name string, max_num_seqs int")
    warehouse.start_runs(runs_df)
    warehouse.finish_runs(spark.createDataFrame([("a", "partial")], "run_id string, status string"))
    state = {r.run_id: r for r in warehouse.runs().collect()}
    assert (state["a"].status, state["a"].test_name, state["a"].max_num_seqs) == ("partial", "t1", 32)
    assert state["a"].ended_at is not None and state["b"].status == "running" and state["b"].ended_at is None
    assert warehouse.runs().columns == schemas.EXPERIMENT_RUNS.fieldNames()
    warehouse.start_runs(runs_df.filter("run_id = 'a'"))
    again = {r.run_id: r for r in warehouse.runs().collect()}["a"]
    assert again.status == "running" and again.ended_at is None


def test_unknown_run_in_the_log_has_no_description(spark):
    update = spark.createDataFrame([("z", "failed")], "run_id string, status string").withColumn("updated_at", F.current_timestamp())
    row = latest_runs(conform(update, Warehouse(spark, "/nowhere").read(RUNS).schema)).first()
    assert row.status == "failed" and row.test_name is None


def test_replies_become_rows():
    good = {"content": "x", "usage": {"prompt_tokens": 3, "completion_tokens": 4}}
    assert inference.reply_row(good) == ("x", None, True, 3, 4)
    assert inference.reply_row({"content": None})[0] == ""
    assert inference.reply_row({})[1].startswith("missing_content")
    assert inference.reply_row(TimeoutError("t"))[1] == "api_error: TimeoutError: t"
    assert inference.reply_row(ValueError("v"))[1] == "unexpected_error: ValueError: v"

    def broken(_):
        raise ConnectionError("down")

    assert [r[1] for r in inference.call_batch(broken, [{}, {}])] == ["api_error: ConnectionError: down"] * 2
    assert inference.call_batch(lambda r: [good], [{}, {}])[1][1].startswith("missing_content")


def test_attempts_and_backoff(spark, tmp_path):
    """Only failed calls are tried again, at most three times, waiting before each retry round."""
    log = tmp_path / "log"
    log.mkdir()

    def model(requests):
        for r in requests:
            (log / f"{r['call_id']}-{r['attempt']}").touch()
        return stub_model(requests)

    def sleep(seconds):
        (log / f"slept-{seconds}").touch()

    texts = [("ok", "x" * 12), ("second", "x" * 14), ("third", "x" * 17), ("never", "x" * 15)]
    judged = inference.extract_batch(prepare.enrich(plain_calls(spark, texts)), request_builder(FAST), model, concurrency=2, batch_size=1, backoff_seconds=2.0, sleep=sleep)
    rows = {r.call_id: r for r in judged.collect()}
    assert {k: (r.extraction_status, r.attempts) for k, r in rows.items()} == {"ok": ("success", 1), "second": ("success", 2), "third": ("success", 3), "never": ("error", 3)}
    calls = sorted(p.name for p in log.iterdir() if not p.name.startswith("slept"))
    assert calls == ["never-1", "never-2", "never-3", "ok-1", "second-1", "second-2", "third-1", "third-2", "third-3"]
    assert {p.name for p in log.iterdir() if p.name.startswith("slept")} == {"slept-2.0", "slept-4.0"}
    assert rows["never"].error_message.startswith("json_parse_error") and rows["third"].prompt_token_count == 17


def test_batch_run_then_resume(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    calls = plain_calls(spark, [("a", "x" * 12), ("b", "x" * 15), ("c", "x" * 24), ("c", "x" * 24)])
    first = run_extraction(warehouse, calls, "run1", stub_model, FAST, "b1", test_name="t").first()
    assert (first.submitted, first.skipped, first.completed, first.errors, first.status) == (4, 0, 4, 1, "partial")
    second = run_extraction(warehouse, calls, "run1", stub_model, FAST, "b2").first()
    assert (second.submitted, second.skipped, second.errors, second.status) == (1, 3, 1, "failed")
    stored = warehouse.calls()
    assert stored.count() == 5 and stored.columns == schemas.CALLS_EXTRACTIONS.fieldNames()
    row = stored.filter("call_id = 'a'").first()
    assert row.extraction.agent.empathy_score == document()["agent"]["empathy_score"]
    assert (row.model_id, row.schema_version, row.features.char_count) == ("m", "2.0.0", 12)
    state = warehouse.runs().first()
    assert (state.run_id, state.status) == ("run1", "failed") and state.ended_at is not None


def test_a_failing_run_is_marked(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    bad = plain_calls(spark, [("a", "x")]).withColumn("text", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        run_extraction(warehouse, bad, "r", stub_model, FAST, "b")
    assert warehouse.runs().first().status == "failed"


def test_prompt_follows_the_rules_and_can_be_replaced(spark):
    prompt = prepare.default_system_prompt()
    assert all(f'"{leaf.name}"' in prompt for leaf in schemas.LEAVES)
    df = spark.createDataFrame([("hello",)], "transcript_text string")
    body = prepare.build_requests(df, "m", system_prompt="P", enable_thinking=True).first().request
    assert '"content":"P"' in body and '"content":"TRANSCRIPT:\\nhello"' in body and '"enable_thinking":true' in body


def test_materialize_and_spread(spark):
    df = materialize(spark.range(10), "x")
    assert df.count() == 10 and work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spread(spark.range(0, 10, 1, 2), 6).rdd.getNumPartitions() == 6
    assert spread(spark.range(0, 10, 1, 8), 6).rdd.getNumPartitions() == 8


def committed(warehouse):
    return sorted((r.run_id, r.call_id) for r in warehouse.calls().collect())


def test_readers_see_old_or_new_rows_and_a_killed_writer_nothing(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    reader = Warehouse(spark, str(tmp_path))
    warehouse.append_extractions(extraction_rows(spark, [("r", "a", "success", 1), ("q", "b", "success", 1)]), "b1")
    before = reader.calls()
    seen = []

    def killed(record, check=None):
        seen.append(committed(reader))
        raise KeyboardInterrupt

    newer = extraction_rows(spark, [("r", "c", "success", 1)])
    with monkeypatch.context() as patch:
        patch.setattr(warehouse.log, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            warehouse.append_extractions(newer, "b1")
    # The files of the killed writer are there, and nobody reads them.
    assert seen == [[("q", "b"), ("r", "a")]] and committed(reader) == seen[0] and len(list(tmp_path.glob(f"{CALLS}/run_id=r/*/attempt=*"))) == 2
    warehouse.append_extractions(newer, "b1")
    assert committed(reader) == [("r", "c")]
    # A frame taken before the commit still reads its own snapshot.
    assert sorted(r.call_id for r in before.collect()) == ["a", "b"]
    assert warehouse.vacuum(3600) == 0 and warehouse.vacuum(0) == 3 and committed(reader) == [("r", "c")]


def test_commits_have_one_order_and_are_summed_up(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path / "log")), CommitLog(spark, str(tmp_path / "log"))
    assert one.snapshot().version == 0
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: (one, two)[i % 2].commit({"set": {"t": {f"b{i}": f"a{i}"}}}), range(24)))
    assert sorted(numbers) == list(range(1, 25)) and one.snapshot() == two.snapshot()
    for i in range(24, 130):
        one.commit({"set": {"t": {f"b{i % 40}": f"a{i}"}}, "unset": {"t": ["b3"]}})
    fresh = CommitLog(spark, str(tmp_path / "log"))
    assert fresh.snapshot() == one.snapshot() and fresh.snapshot().version == 130 and "a112" in fresh.snapshot().attempts("t") and "b3" not in fresh.snapshot().live["t"]
    assert len([p for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")]) <= 2 * (RECORDS_PER_CHECKPOINT + 1) + 1
    # A reader that has not looked for a while starts from the sum.
    assert two.snapshot() == one.snapshot()


def test_small_files_are_merged_by_their_sizes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    odd = "a%41+b c:d"
    for i in range(4):
        warehouse.append_extractions(extraction_rows(spark, [(odd, f"{i}", "success", 1), ("q", f"{i}", "error", 1)]), f"b {i}")
    warehouse.append_extractions(extraction_rows(spark, [("lone", "x", "success", 1)]), "lone")
    want = committed(warehouse)
    before = warehouse.calls()
    assert warehouse.compact(small_bytes=10) == 0
    assert warehouse.compact() == 8 and committed(warehouse) == want and before.count() == len(want)
    assert len(warehouse._of_runs([odd]).inputFiles()) == 1 and warehouse._of_runs([odd]).count() == 4
    # A batch that is written again after it was merged: its rows come from the newer try as well.
    assert warehouse.compact() == 0
    assert warehouse.vacuum(0) == 8 and committed(warehouse) == want and not warehouse.log.snapshot().merged
    for i in range(12):
        warehouse.finish_runs(spark.createDataFrame([(f"r{i % 5}", f"s{i}")], "run_id string, status string"))
    state = sorted(map(tuple, warehouse.runs().collect()), key=str)
    assert warehouse.compact(RUNS) == 12 and sorted(map(tuple, warehouse.runs().collect()), key=str) == state
    assert warehouse.vacuum(0) == 12 and len(list((tmp_path / RUNS).glob("attempt=*"))) == 1 and len(warehouse.log.snapshot().live[RUNS]) == 1
    assert warehouse.compact(MEASUREMENTS) == 0


def test_merging_gives_way_to_a_newer_batch(spark, tmp_path, monkeypatch):
    warehouse, other = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    for i in range(2):
        warehouse.append_extractions(extraction_rows(spark, [("r", f"{i}", "error", 1)]), f"b{i}")
    write = warehouse.write_extractions

    def meanwhile(*args, **options):
        write(*args, **options)
        other.append_extractions(extraction_rows(spark, [("r", "1", "success", 2)]), "b1")

    monkeypatch.setattr(warehouse, "write_extractions", meanwhile)
    with pytest.raises(Conflict):
        warehouse.compact()
    assert sorted((r.call_id, r.extraction_status) for r in warehouse.calls().collect()) == [("0", "error"), ("1", "success")]


def test_a_batch_written_again_after_merging_replaces_its_rows(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for i in range(2):
        warehouse.append_extractions(extraction_rows(spark, [("r", f"{i}", "error", 1)]), f"b{i}")
    assert warehouse.compact() == 2
    warehouse.append_extractions(extraction_rows(spark, [("r", "1", "success", 2)]), "b1")
    assert sorted((r.call_id, r.extraction_status) for r in warehouse.calls().collect()) == [("0", "error"), ("1", "success")]


def test_the_row_limit_of_commits_is_handed_on(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    calls = plain_calls(spark, [(f"{i}", "x" * 12) for i in range(25)]).coalesce(1)
    run_extraction(warehouse, calls, "r", stub_model, RunSettings("m", commit_rows=10, model_options={"backoff_seconds": 0.0}), "b1")
    files = warehouse.calls().groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in files) == 25 and max(r["count"] for r in files) <= 10


def test_work_folders_have_an_owner(spark, tmp_path):
    def folders():
        return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}

    before = folders()
    warehouse = Warehouse(spark, str(tmp_path))
    totals = run_extraction(warehouse, plain_calls(spark, [("a", "x" * 12), ("b", "x" * 15)]), "run1", stub_model, FAST, "b1")
    left = {name.rsplit("-", 1)[0] for name in folders() - before}
    assert left == {"stats"} and totals.first().errors == 1 and warehouse.calls().count() == 2
    with pytest.raises(ZeroDivisionError), scratch(spark) as keep:
        inner = materialize(spark.range(3), "inner")
        kept = keep(inner, "kept")
        raise ZeroDivisionError
    assert kept.count() == 3 and not any(name.startswith("inner") for name in folders())


def test_the_input_of_a_run_is_read_once(spark, tmp_path):
    warehouse, read = Warehouse(spark, str(tmp_path)), spark.sparkContext.accumulator(0)
    texts = [(f"{i}", "x" * (15 if i % 3 == 0 else 12)) for i in range(9)] + [("8", "x" * 12)]

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = plain_calls(spark, texts)
    calls = source.mapInArrow(told, source.schema)
    first = run_extraction(warehouse, calls, "run1", stub_model, FAST, "b1").first()
    assert read.value == 10 and (first.submitted, first.skipped, first.errors) == (10, 0, 3)
    second = run_extraction(warehouse, calls, "run1", stub_model, FAST, "b2").first()
    assert read.value == 20 and (second.submitted, second.skipped, second.errors, second.status) == (3, 7, 3, "failed")
    # Done again under its name, the second batch gives the same and replaces itself.
    again = run_extraction(warehouse, calls, "run1", stub_model, FAST, "b2").first()
    assert tuple(again) == tuple(second) and warehouse.calls().count() == 13
    empty = run_extraction(warehouse, calls.limit(0), "run2", stub_model, FAST, "b1").first()
    assert (empty.submitted, empty.skipped, empty.status) == (0, 0, "success")


def test_a_round_reaches_python_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(inference, "ROWS_AT_ONCE", 8)
    own = spark.conf.get(inference.ARROW_ROWS)

    def model(requests):
        return [{"content": "{}", "usage": {"prompt_tokens": len(requests), "completion_tokens": 1}} for _ in requests]

    def largest(**options):
        calls = prepare.enrich(plain_calls(spark, [(f"c{n}", "text") for n in range(100)]))
        rows = inference.extract_batch(calls, request_builder(FAST), model, max_attempts=1, concurrency=1, **options).collect()
        return len(rows), max(r.prompt_token_count for r in rows)

    assert largest() == (100, 8) and largest(batch_size=50) == (100, 50)
    assert spark.conf.get(inference.ARROW_ROWS) == own
