"""Shards, files, notifications, and the streams."""

import gzip
import json
import urllib.parse
from datetime import datetime, timedelta, timezone
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from callsift.checks import fixtures, source_checks
from callsift.checks.stub import stub_model
from callsift.functions import json_strict
from callsift.functions import paths as p
from callsift.plans.pipeline import RunSettings
from callsift.sources import calls as src
from callsift.sources.notifications import parse_notifications
from callsift.sources.tables import CALLS, Warehouse
from callsift.streaming import ingest, metrics, receives
from callsift.streaming.metrics import four_metrics_stream, heartbeat, metrics_stream, read_windows

FAST = RunSettings("m", model_options={"backoff_seconds": 0.0})


def write_shard(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def line(call_id, transcript, **more):
    return json.dumps({"call_id": call_id, "transcript": transcript, **more})


def test_shards_in_both_forms(spark, tmp_path):
    words = [{"start": 0, "end": 10, "confidence": 0.5}, {"start": 30}]
    write_shard(tmp_path / "in" / "s 1+x.jsonl.gz", [line("a", "hi"), "", "  ", line("b", {"text": "yo", "words": words, "audio_duration": 2, "confidence": 0.9}, source_path="p", category_path="c")])
    write_shard(tmp_path / "in" / "deep" / "s2.jsonl.gz", [line("c", None), line("d", '{"text": "no"}'), json.dumps({"call_id": "e"}), line("f", {"words": None})])
    write_shard(tmp_path / "in" / "other.txt.gz", ["{not ours"])
    rows = {r.call_id: r for r in src.read_calls(spark, str(tmp_path / "in")).collect()}
    assert {k: r.text for k, r in rows.items()} == {"a": "hi", "b": "yo", "c": "", "d": '{"text": "no"}', "e": "", "f": ""}
    assert rows["b"].audio_duration == 2.0 and len(rows["b"].words) == 2 and rows["b"].words[1].end is None
    assert rows["b"].source_path == "p" and rows["a"].source_file.endswith("/s 1+x.jsonl.gz")


def test_a_large_shard_is_dealt_out_and_even_ones_are_not(spark, tmp_path):
    for n in range(16):
        write_shard(tmp_path / "even" / f"s{n}.jsonl.gz", [line(f"{n}", "x")])
        write_shard(tmp_path / "odd" / f"s{n}.jsonl.gz", [line(f"{n}-{i}", f"text {i * 7919}") for i in range(1 if n else 3000)])

    def plan(name):
        lines = src.read_lines(spark, str(tmp_path / name))
        return src.even_out(lines, str(tmp_path / name), partitions=4)._jdf.queryExecution().executedPlan().toString()

    assert "RoundRobinPartitioning" not in plan("even") and "RoundRobinPartitioning" in plan("odd")
    assert src.read_calls(spark, str(tmp_path / "odd")).count() == 3015


def test_unusable_lines(spark, tmp_path):
    lines = [line("a", "ok"), "{broken", json.dumps({"transcript": "x"}), line("n", 3), json.dumps({"call_id": 5}), "[1]", '{"call_id":"d","call_id":"e"} ', '{"call_id":"z"} tail']
    write_shard(tmp_path / "s.jsonl.gz", lines)
    with pytest.raises(Exception, match="unusable line"):
        src.read_calls(spark, str(tmp_path)).collect()
    good = src.read_calls(spark, str(tmp_path), mode="quarantine").collect()
    assert sorted(r.call_id for r in good) == ["a", "e"]
    bad = {r.value: r.line_error for r in src.bad_lines(src.parse_lines(src.read_lines(spark, str(tmp_path)))).collect()}
    assert set(bad) == {"{broken", lines[2], lines[3], lines[4], "[1]", lines[7]}
    assert bad["[1]"] == "missing call_id" and bad[lines[3]] == "unusable transcript" and bad[lines[7]].startswith("json_parse_error: JSONDecodeError: Extra data")
    with pytest.raises(ValueError):
        src.read_calls(spark, str(tmp_path), mode="x")


def test_transcript_files(spark, tmp_path):
    root = tmp_path / "data set"
    for name, body in {"root.json": {"text": "r"}, "cat/sub/f%20x_transcript.json": {"text": "é\n2", "words": []}, "cat/bad.json": [1]}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(json.dumps(body), encoding="utf-8")
    rows = {r.call_id: r for r in src.read_transcript_files(spark, str(root)).collect()}
    assert {k: (r.category_path, r.text, r.document_error) for k, r in rows.items()} == {
        "root": ("root.json", "r", None), "f%20x": ("cat", "é\n2", None), "bad": ("cat", "", "transcript is not an object"),
    }


PATHS = ["/root/f.json", "/root/cat/sub/f_transcript.json", "/other/place/f.json", "/root/f.tar.json", "/root/a/.json", "/root/a/x_transcript", "/rootless/y.json", "/root/a/b_transcript_transcript.json"]


def test_ids_from_paths_match_pathlib(spark):
    def expected(text):
        path = Path(text)
        name = path.stem.removesuffix("_transcript")
        try:
            below = path.relative_to("/root")
        except ValueError:
            return name, path.parent.name
        return name, below.parts[0]

    df = spark.createDataFrame([(t,) for t in PATHS], "path string")
    rows = df.select("path", p.call_id_from_path(F.col("path")), p.category_from_path(F.col("path"), "/root")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {t: expected(t) for t in PATHS}


def test_run_ids(spark):
    keys = {"in/a b+c.jsonl.gz": "a-b-c", ".jsonl.gz": "unknown", "x/" + "y" * 200: "y" * 128, "x.json.jsonl": "x", "p/s.jsonl.gz": "s", "q/s.jsonl.gz": "s", "x.gz.gz": "x-gz", "é__-.json": "-__-", "": "unknown"}
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert {r[0]: r[1] for r in df.select("k", p.derive_run_id(F.col("k"))).collect()} == keys


def record(key, bucket="b"):
    return {"Records": [{"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}, {"s3": {}}]}


def test_notifications(spark):
    keys = ["in/a+b%2Bc.jsonl.gz", "50%", "%zz+x", "é%C3%A9"]
    ping = {"Event": "s3:TestEvent", "Service": "Amazon S3"}
    bodies = {json.dumps(record(k)): ("object", urllib.parse.unquote_plus(k)) for k in keys}
    bodies |= {
        json.dumps({"Type": "Notification", "Message": json.dumps(record("k"))}): ("object", "k"),
        json.dumps({"Type": "Notification", "Message": json.dumps(ping)}): ("test", None),
        json.dumps({"Type": "Notification", "Message": json.dumps({"Type": "Notification", "Message": json.dumps(record("k"))})}): ("unknown", None),
        json.dumps({"Type": "Notification"}): ("unknown", None),
        json.dumps(ping): ("test", None),
        json.dumps({**ping, "Service": "x"}): ("unknown", None),
        json.dumps(record("")): ("unknown", None), json.dumps(record("k", "")): ("unknown", None),
        '{"Records":[]}': ("unknown", None), "[1]": ("unknown", None), "nope": ("unknown", None), "": ("unknown", None),
    }
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {r.body: (r.kind, r.object_key) for r in parse_notifications(df).collect()} == bodies


def test_corpus_is_written_once_and_keeps_line_order(spark, tmp_path):
    for shard in (2, 1):
        write_shard(tmp_path / "in" / f"shard-{shard}.jsonl.gz", [line(f"{shard}-{9 - i}", "t") for i in range(9)])
    out = str(tmp_path / "corpus")
    corpus = src.build_corpus(spark, str(tmp_path / "in"), out)
    first = [json.loads(r.value)["call_id"] for r in src.smoke_set(corpus, 11).collect()]
    assert first == [f"1-{9 - i}" for i in range(9)] + ["2-9", "2-8"]
    write_shard(tmp_path / "in" / "shard-3.jsonl.gz", [line("z", "t")])
    assert src.build_corpus(spark, str(tmp_path / "in"), out).count() == 18


def run_stream(warehouse, tmp_path, **options):
    query = ingest.ingest_stream(warehouse, str(tmp_path / "inbox"), str(tmp_path / "checkpoint"), stub_model, FAST, **options)
    query.awaitTermination()
    return query


def test_each_shard_once_with_retries_and_quarantine(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_shard(inbox / "one.jsonl.gz", [line("a", "x" * 12), line("b", "x" * 15), "{broken"])
    write_shard(inbox / "two.jsonl.gz", [line("a", "x" * 24)])
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    run_stream(warehouse, tmp_path, max_files=1)
    rows = sorted((r.run_id, r.call_id, r.extraction_status) for r in warehouse.calls().collect())
    assert rows == [("one", "a", "success"), ("one", "b", "error"), ("one", "b", "error"), ("two", "a", "success")]
    aside = sorted((r.run_id, r.item, r.reason.split(":")[0], r.receives) for r in ingest.read_quarantine(warehouse).collect())
    assert aside == [("one", "b", "json_parse_error", 2), ("one", "{broken", "json_parse_error", 2)]
    assert {r.run_id: r.status for r in warehouse.runs().collect()} == {"one": "partial", "two": "success"}

    assert run_stream(warehouse, tmp_path).lastProgress is None or warehouse.calls().count() == 4
    write_shard(inbox / "later" / "one.jsonl.gz", [line("a", "x" * 12), line("n", "x" * 12)])
    run_stream(warehouse, tmp_path)
    assert sorted(r.call_id for r in warehouse.calls().filter("run_id = 'one'").collect()) == ["a", "b", "b", "n"]


def test_a_repeated_micro_batch_leaves_its_rows_once(spark, tmp_path):
    """A batch that died after writing is run again under the same name."""
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    lines = spark.createDataFrame([(line("a", "x" * 12), "in/s.jsonl.gz"), (line("b", "x" * 15), "in/s.jsonl.gz")], "value string, source_file string")
    for _ in range(2):
        ingest.process_shards(warehouse, lines, stub_model, FAST, "inbox-7")
    rows = sorted((r.call_id, r.ingest_batch) for r in warehouse.read(CALLS).collect())
    assert rows == [("a", "inbox-7-1"), ("b", "inbox-7-1"), ("b", "inbox-7-2")]
    assert ingest.read_quarantine(warehouse).count() == 1


def test_dead_letters(spark):
    log = [("a", "object", False)] * 2 + [("b", "object", False), ("b", "object", True), ("c", "unknown", True), ("c", "unknown", True), ("d", "test", False), ("d", "test", False), ("e", "object", False)]
    out = ingest.dead_letters(spark.createDataFrame(log, "item string, kind string, ok boolean"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", "object", 2), ("c", "unknown", 2)]


def test_commit_policy_is_a_trigger_and_a_file_limit(spark, tmp_path):
    policy = ingest.commit_policy(rows=10, seconds=5)
    assert policy["trigger"] == {"processingTime": "5 seconds"}
    spark.range(0, 25, 1, 1).write.options(**policy["write"]).parquet(str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3
    write_shard(tmp_path / "inbox" / "s.jsonl.gz", [line("a", "x" * 12)])
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    query = ingest.ingest_stream(warehouse, str(tmp_path / "inbox"), str(tmp_path / "checkpoint"), stub_model, FAST, trigger=policy["trigger"])
    query.processAllAvailable()
    query.stop()
    assert warehouse.calls().count() == 1


def test_metric_windows_close_with_the_watermark(spark, tmp_path):
    rows = [("r", True, f"2024-01-01 00:00:{s:02d}") for s in (1, 2)] + [("r", False, "2024-01-01 00:01:05"), ("r", True, "2024-01-01 00:10:00")]
    df = spark.createDataFrame(rows, "run_id string, ok boolean, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    metrics_stream(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("period_start").collect()
    assert [(r.requests, r.req_per_sec, r.error_rate) for r in out] == [(2, 2 / 60, 0.0), (1, 0.0, 1.0)]


def test_hard_json(spark):
    deep = "[" * 150 + "]" * 150
    cases = {
        deep: None, f'{{"x": {deep}, "y": NaN}}': None, "[" * 1200 + "]" * 1200: None, "[" * 1200 + "]" * 1199: "json_parse_error", '{"a":' * 30_000 + "NaN" + "}" * 30_000: None, '{"\\ud800": 1, "b": 2}': None,
        '{"a":1},"~end-of-document~"] garbage': "json_parse_error", '{"a":1},"~end-of-document~",null': "json_parse_error",
        '{"a":1},"\\u007eend-of-document~",null': "json_parse_error", '{"a":"~end-of-document~"}': None, '{"a":1} x': "json_parse_error", "": "json_parse_error",
    }
    df = json_strict.parse_json_strict(spark.createDataFrame([(t,) for t in cases], "value string"), "value")
    got = {r.value: (r.error, r.text) for r in df.selectExpr("value", "split_part(parse_error, ':', 1) error", "to_json(doc) text").collect()}
    assert {t: e for t, (e, _) in got.items()} == cases
    assert got[deep][1] == deep and deep in got[f'{{"x": {deep}, "y": NaN}}'][1] and "b" in got['{"\\ud800": 1, "b": 2}'][1]


def test_mistyped_members_are_told(spark):
    lines = {
        '{"call_id":"a","transcript":{"text":"t","words":{"x":1}}}': "words", '{"call_id":"b","transcript":{"text":"t","audio_duration":"n/a"}}': "audio_duration",
        '{"call_id":"c","transcript":{"words":[{"start":"x","end":2}]}}': "words", '{"call_id":"d","transcript":{"confidence":NaN}}': "confidence",
        '{"call_id":"e","transcript":[]}': None, '{"call_id":"f","transcript":0}': None, '{"call_id":"g","transcript":false}': None, '{"call_id":"h","transcript":7}': "",
        '{"call_id":"i","transcript":{"words":null,"audio_duration":null}}': None,
    }
    parsed = src.parse_lines(spark.createDataFrame([(t, "f") for t in lines], "value string, source_file string").withColumn("line", F.col("value")))
    want = {t: None if e is None else "unusable transcript" + (f": {e}" if e else "") for t, e in lines.items()}
    assert {r.line: r.line_error for r in parsed.collect()} == want


def test_leftover_of_a_dead_write_is_no_corpus(spark, tmp_path):
    (tmp_path / "corpus").mkdir()
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("{}",)], "value string").write.mode("overwrite").option("compression", "gzip").text(str(tmp_path / "in"))
    assert src.build_corpus(spark, str(tmp_path / "in"), str(tmp_path / "corpus"), glob="*.gz").count() == 1


def test_shards_are_told_apart_by_their_whole_path(spark, tmp_path):
    """Two folders with shards of one name, one of them with a line that is no call; names with pattern characters."""
    inbox = tmp_path / "in box"
    write_shard(inbox / "a" / "s[1]+x.jsonl.gz", [line("good", "x" * 12)])
    write_shard(inbox / "b" / "s[1]+x.jsonl.gz", [line("fine", "x" * 12), "{broken"])
    write_shard(inbox / "b" / "s1+x.jsonl.gz", [line("unasked", "x" * 12)])
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    keys = ["a/s[1]+x.jsonl.gz", "b/s[1]+x.jsonl.gz", "a/absent"]
    bodies = [json.dumps(record(urllib.parse.quote_plus(k))) for k in keys] + ["what"]
    messages = spark.createDataFrame([(b,) for b in bodies], "body string")
    letters = []
    for receive in (1, 1, 2, 3):
        dead = ingest.ingest_notifications(warehouse, messages, str(inbox), stub_model, FAST, f"m-{receive}", shards_per_round=1)
        letters.append(sorted(map(tuple, dead.collect())))
    after = [("a/absent", "object", 2), ("b/s[1]+x.jsonl.gz", "object", 2), ("what", "unknown", 2)]
    assert letters == [[], [], after, after]
    assert sorted(r.call_id for r in warehouse.calls().collect()) == ["fine", "good"]


def test_receives_are_counted_in_state(spark, tmp_path):
    def follow(batch, rows):
        df = spark.createDataFrame([(item, kind, batch, ok, n) for item, kind, ok, n in rows], receives.RECEIVES_SCHEMA)
        df.repartition(3).write.mode("overwrite").parquet(str(tmp_path / "log" / batch))
        receives.dead_letters_stream(spark, str(tmp_path / "log"), str(tmp_path / "dead"), str(tmp_path / "cp"), max_receives=3).awaitTermination()
        return sorted(((r.item, r.receives) for r in spark.read.schema(receives.DEAD_SCHEMA).parquet(str(tmp_path / "dead")).collect()), key=str)

    one = [("hot", "object", False, 1)] * 200 + [("late", "object", False, 2), ("good", "object", True, 1), ("ping", "test", False, 9), ("odd", "unknown", True, None), (None, "unknown", None, 1)]
    assert follow("b1", one) == [("hot", 200)]
    assert follow("b1", one) == [("hot", 200)]
    assert follow("b2", [("late", "object", True, 1), ("good", "object", False, 5), ("odd", "unknown", True, 1)]) == [("hot", 200)]
    assert follow("b3", [("late", "object", False, 9), ("hot", "object", False, 9), ("odd", "unknown", True, 1), (None, "unknown", False, 2)]) == [("hot", 200), ("odd", 3), (None, 3)]
    assert follow("b4", [("odd", "unknown", False, 1)]) == [("hot", 200), ("odd", 3), (None, 3)]


def test_a_micro_batch_becomes_visible_at_once(spark, tmp_path, monkeypatch):
    """A batch that dies before its commit has changed nothing; done again, all of its passes and its quarantine are there."""
    warehouse, reader = Warehouse(spark, str(tmp_path / "tables")), Warehouse(spark, str(tmp_path / "tables"))
    lines = spark.createDataFrame([(line("a", "x" * 12), "in/s.jsonl.gz"), (line("b", "x" * 15), "in/s.jsonl.gz")], "value string, source_file string")
    commit = warehouse.log.commit

    def killed(rec, check=None):
        if CALLS in rec.get("set", {}):
            raise KeyboardInterrupt
        return commit(rec, check)

    with monkeypatch.context() as patch:
        patch.setattr(warehouse.log, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            ingest.process_shards(warehouse, lines, stub_model, FAST, "inbox-1")
    assert reader.calls().count() == 0 and ingest.read_quarantine(reader).count() == 0
    failed = ingest.process_shards(warehouse, lines, stub_model, FAST, "inbox-1")
    assert [r.source_file for r in failed.collect()] == ["in/s.jsonl.gz"]
    assert reader.calls().count() == 3 and ingest.read_quarantine(reader).count() == 1


def test_four_metrics_with_late_rows_and_a_quiet_end(spark, tmp_path):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def at(minute, second=0):
        return start + timedelta(minutes=minute, seconds=second)

    def follow(requests, scrapes=()):
        spark.createDataFrame(requests, "run_id string, ts timestamp, ok boolean").write.mode("append").parquet(str(tmp_path / "requests"))
        spark.createDataFrame(list(scrapes), "run_id string, ts timestamp, scrape string").write.mode("append").parquet(str(tmp_path / "scrapes"))
        sources = [spark.readStream.schema(spark.read.parquet(str(tmp_path / n)).schema).parquet(str(tmp_path / n)) for n in ("requests", "scrapes")]
        four_metrics_stream(*sources, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        rows = read_windows(spark, str(tmp_path / "out")).collect()
        return {(r.run_id, (r.period_start.replace(tzinfo=None) - datetime(2024, 1, 1)) // timedelta(minutes=1)): (r.requests, r.req_per_sec, r.error_rate, r.prefix_cache_hit_ratio, r.gpu_util, r.late_requests) for r in rows}

    gauges = "vllm:gpu_cache_usage 0.5\nvllm:prefix_cache_hit_rate 0.25"
    first = follow([("r", at(0, 1), True), ("r", at(0, 59), False), ("q", at(4), True)], [("r", at(0, 30), gauges), ("s", at(1), gauges)])
    closed = {("r", 0): (2, 1 / 60, 0.5, 0.25, 0.5, 0), ("s", 1): (0, None, None, 0.25, 0.5, 0)}
    assert first == closed
    # Minute 0 is closed: late. Minute 3 is not.
    second = follow([("r", at(0, 20), True), ("late only", at(1), True), ("r", at(3, 1), True), ("r", at(5), True)])
    late = {("r", 0): (2, 1 / 60, 0.5, 0.25, 0.5, 1), ("late only", 1): (None, None, None, None, None, 1)}
    assert second == closed | late | {("r", 3): (1, 1 / 60, 0.0, None, None, 0)}
    beat = heartbeat(spark, at(60)).collect()
    third = follow([tuple(r) for r in beat])
    assert third == second | {("q", 4): (1, 1 / 60, 0.0, None, None, 0), ("r", 5): (1, 1 / 60, 0.0, None, None, 0)}


def test_more_rows_make_more_shards(spark, monkeypatch):
    monkeypatch.setattr(source_checks, "ROWS_PER_SHARD", 20)
    lines = spark.range(1000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("value"))
    shards = sorted(Path(source_checks.write_shards(lines, spark, "shards")).glob("*.gz"))
    texts = [[int(t) for t in gzip.open(s, "rt").read().split()] for s in shards]
    assert len(shards) == 50 and sum(texts, []) == list(range(1000)) and max(map(len, texts)) < 100


class FakeState:
    """A value state and its handle that count the calls."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_items_of_a_bucket_share_their_state_calls():
    letters, state = receives._Letters(3), FakeState()
    letters.init(state)
    rows = pd.DataFrame([(f"i{n}", "object", "b1", n % 4 == 0, 1 + n % 3) for n in range(1000)], columns=["item", "kind", "ingest_batch", "ok", "n"])
    dead = [frame for frame in letters.handleInputRows((0,), iter([rows[:400], rows[400:]]), None)]
    assert [len(f) for f in dead] == [sum(n % 4 > 0 and n % 3 == 2 for n in range(1000))] and state.calls == ["get", "update"]
    again = rows.assign(ingest_batch="b2", ok=False)
    dead = [frame for frame in letters.handleInputRows((0,), iter([again]), None)]
    assert sorted(dead[0]["receives"].unique()) == [4] and len(dead[0]) == sum(n % 4 > 0 and n % 3 == 1 for n in range(1000))


def test_windows_of_a_block_share_their_state_calls():
    windows, state = metrics._Windows(60_000), FakeState()
    windows.init(state)
    rows = pd.DataFrame([(60_000 * n, 2, 1, 0.5, 1, 0.25, 1) for n in range(64)], columns=["period_ms", *metrics.SUMS])
    clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 60_000 * 4)
    late = list(windows.handleInputRows(("r", 0), iter([rows, rows]), clock))
    assert late[0][["period_ms", "requests"]].values.tolist() == [[60_000 * n, 4] for n in range(4)]
    assert state.calls == ["get", "update"] and state.timers == [60_000 * 5]
    clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 60_000 * 60 + 1)
    state.timers.clear()
    closed = list(windows.handleExpiredTimer(("r", 0), clock, SimpleNamespace(getExpiryTimeInMs=lambda: 60_000 * 5)))
    assert closed[0]["period_ms"].tolist() == [60_000 * n for n in range(4, 60)] and set(closed[0]["requests"]) == {4} and set(closed[0]["error_rate"]) == {0.5}
    assert state.timers == [60_000 * 61]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for n in range(120):
        (tmp_path / f"c{n}").mkdir()
        (tmp_path / f"c{n}" / "f.json").write_text('{"text": "x"}')
    own = spark.conf.get(src.LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    files = src.read_transcript_files(spark, str(tmp_path))
    spark.sparkContext.setJobGroup("other", "other")
    told = spark.sparkContext.statusTracker()
    tasks = [told.getStageInfo(s).numTasks for j in told.getJobIdsForGroup("listing") for s in told.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= src.LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert files.count() == 120 and spark.conf.get(src.LISTING) == own


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for n in range(80):
        (tmp_path / f"{n}.json").write_text('{"text": "x"}')
    (tmp_path / "packed.json.gz").write_bytes(gzip.compress(b'{"text": "x"}\n'))
    own = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        for glob, want in {"*.json": 80, "*.json*": 81, "*.gz": 1}.items():
            files = src.read_transcript_files(spark, str(tmp_path), glob)
            assert files.rdd.getNumPartitions() <= src.READING_TASKS * spark.sparkContext.defaultParallelism
            assert [(r.text, r.document_error) for r in files.collect()] == [("x", None)] * want
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", own)


@pytest.mark.parametrize("glob", ["*.json", "*"])
def test_lines_of_files_are_those_of_the_text_reader(spark, tmp_path, glob):
    odd = [b"", b"\n", b"\r", b"a", b"a\n", b"a\n\n", b"\n\ra", b"a\r\nb\rc\n", b"\xef\xbb\xbfa\nb", b"\xef\xbb\xbf", b"\xef\xbb\xbf\n", "é\u2028\u0085x\x0b\x0c\n".encode(), b"a\x00b\n", "a\n\ufeffb".encode()]
    for n, body in enumerate(odd):
        (tmp_path / f"f{n}.json").write_bytes(body)
    want = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path)).select("value", F.col("_metadata.file_path").alias("file_path"))
    assert sorted(src.file_lines(spark, str(tmp_path), glob).collect()) == sorted(want.collect())


def test_pages_are_files_of_their_own(spark, tmp_path):
    pages = [(n, f"https://x/{n}", f"<p>{n}\né</p>" if n % 5 else None) for n in [*range(60), 7, 7, 10]]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = source_checks.transcript_files(spark, str(tmp_path)).collect()
    error = {4: "transcript is not an object", 5: "json_parse_error"}
    want = [(n, f"cat={n % 7}", True, (html or "") if n % 6 < 4 else "", error.get(n % 6)) for n, _, html in pages]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_written_files(spark, tmp_path):
    rows = [(1, 8, "b"), (1, 8, "a"), (1, 8, "a"), (2, 9, "é\nc"), (None, None, "n"), (0, 7, "")]
    df = spark.createDataFrame(rows, "cat long, page long, value string")
    own = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for root in (tmp_path / "a b", tmp_path / "again"):
        fixtures.write_files(df, str(root) if root.name == "a b" else root.as_uri())
        found = sorted((str(f.parent.relative_to(root)), f.read_text(encoding="utf-8")) for f in root.rglob("*.txt"))
        none = fixtures.NO_VALUE
        assert found == [("cat=0/page=7", "\n"), *[("cat=1/page=8", f"{v}\n") for v in "aab"], ("cat=2/page=9", "é\nc\n"), (f"cat={none}/page={none}", "n\n")]
        assert not [f for f in root.rglob("_*") if f.is_file()]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == own
    fixtures.write_files(df.limit(0), str(tmp_path / "none"))
    assert src.read_transcript_files(spark, str(tmp_path / "none"), "*.txt").count() == 0
