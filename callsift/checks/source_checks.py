"""Readers, notifications, tables, and streams. Inputs are files Spark derives from the tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from callsift.checks import fixtures as fx
from callsift.checks.extract_checks import SETTINGS, turn_calls
from callsift.checks.registry import check
from callsift.checks.stub import always_right, stub_model
from callsift.functions import paths
from callsift.operators import prepare
from callsift.operators.runs import run_collisions as collisions
from callsift.plans.pipeline import run_extraction
from callsift.session import work_dir
from callsift.sources import calls as src
from callsift.sources import notifications
from callsift.sources.tables import CALLS, MEASUREMENTS, Warehouse
from callsift.streaming import ingest, receives
from callsift.streaming.metrics import close_windows, four_metrics_stream, heartbeat, metrics_stream, read_windows

GZ = "*.gz"
SHARDS = 8
ROWS_PER_SHARD = 500


def in_doc_order(lines):
    """Lines sorted by document, a partition per shard: more rows make more shards, not larger ones."""
    shards = max(SHARDS, -(-lines.count() // ROWS_PER_SHARD))
    return lines.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")


def write_shards(lines, spark, purpose: str) -> str:
    """Lines as gz shards in doc order, each followed by a blank line."""
    path = work_dir(spark, purpose)
    ordered = in_doc_order(lines)
    ordered.select(F.concat("value", F.lit("\n  ")).alias("value")).write.option("compression", "gzip").text(path)
    return path


def _parsed_shards(spark, sf_dir, purpose):
    path = write_shards(fx.call_lines(spark, sf_dir), spark, purpose)
    return src.parse_lines(src.even_out(src.read_lines(spark, path, GZ), path, GZ))


@check(
    fx.with_views(
        """select call_id, category_path, text, coalesce(len(tokens), -1) words, audio_duration, confidence
        from calls where doc_id % 20 not in (17, 18)""",
        calls=fx.CALLS,
    )
)
def read_calls(spark, sf_dir):
    path = write_shards(fx.call_lines(spark, sf_dir), spark, "shards")
    usable = src.read_calls(spark, path, mode="quarantine", glob=GZ)
    return usable.select(
        "call_id", "category_path", "text",
        F.when(F.col("words").isNotNull(), F.size("words")).otherwise(-1).cast("bigint").alias("words"),
        "audio_duration", "confidence",
    )


@check(
    """select case when doc_id % 20 = 17 then 'missing call_id' else 'json_parse_error' end reason, count(*) n
    from documents where doc_id % 20 in (17, 18) group by 1"""
)
def read_calls_bad_lines(spark, sf_dir):
    bad = src.bad_lines(_parsed_shards(spark, sf_dir, "shards"))
    return bad.groupBy(F.split_part("line_error", F.lit(":"), F.lit(1)).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check(
    """select cast(conv_id as varchar) || '-' || cast(turn as varchar) call_id,
    case when turn % 4 = 2 then '' when turn % 4 = 3 then '{"text": 1}' else text end as text, case when turn % 4 = 1 then 2 else -1 end words,
    case when turn % 4 = 1 then 1.5::double end audio_duration from conversations"""
)
def transcripts(spark, sf_dir):
    turn = F.col("turn")
    words = F.lit('[{"start":0,"end":10,"confidence":null},{"start":20}]')
    text = F.to_json(F.struct("text"))
    raw = (
        F.when(turn % 4 == 1, F.concat(F.regexp_replace(text, r"\}\z", ""), F.lit(',"audio_duration":1.5,"words":'), words, F.lit("}")))
        .when(turn % 4 == 2, F.lit("null"))
        .when(turn % 4 == 3, F.lit('"{\\"text\\": 1}"'))
        .otherwise(F.regexp_extract(text, r'(?s)^\{"text":(.*)\}\z', 1))
    )
    calls = fx.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string")).alias("call_id"),
        F.try_parse_json(raw).alias("transcript"),
    )
    out = prepare.normalize_transcript(calls)
    return out.select(
        "call_id", "text", F.when(F.col("words").isNotNull(), F.size("words")).otherwise(-1).cast("bigint").alias("words"), "audio_duration"
    )


PAGE_PATHS = """
select page_id, concat(case when page_id % 5 = 0 then '/elsewhere' else '/data/calls' end,
  regexp_replace(regexp_replace(url, '^https?:/', ''), '/+$', ''),
  case page_id % 4 when 0 then '_transcript.json' when 1 then '.json' when 2 then '.tar.json' else '' end) path from pages
"""  # SHARED


@check(
    fx.with_views(
        """select page_id, case when stem like '%_transcript' then stem[1:length(stem) - 11] else stem end call_id,
        case when path like '/data/calls/%' then parts[4] else parts[-2] end category from (
          select *, case when strpos(name[2:], '.') > 0 and name[-1] <> '.' then array_to_string(string_split(name, '.')[1:-2], '.') else name end stem
          from (select page_id, path, string_split(path, '/') parts, string_split(path, '/')[-1] as name from p))""",
        p=PAGE_PATHS,
    )
)
def path_ids(spark, sf_dir):
    path = F.col("path")
    return fx.shared(spark, sf_dir, PAGE_PATHS).select(
        "page_id",
        paths.call_id_from_path(path).alias("call_id"),
        paths.category_from_path(path, "/data/calls").alias("category"),
    )


@check(
    """select page_id, 'cat=' || (page_id % 7) category_path, true named, case when page_id % 6 < 4 then html else '' end as text,
    case when page_id % 6 = 4 then 'transcript is not an object' when page_id % 6 = 5 then 'json_parse_error' end document_error from pages"""
)
def transcript_files(spark, sf_dir):
    """Every page as a file of its own, in folders by category and page."""
    number = F.col("page_id")
    body = F.to_json(F.struct(F.col("html").alias("text")))
    root = work_dir(spark, "files")
    documents = fx.table(spark, sf_dir, "pages").select(
        (number % 7).alias("cat"), number.alias("page"), F.when(number % 6 < 4, body).when(number % 6 == 4, F.lit("[]")).otherwise(F.concat(body, F.lit("}"))).alias("value")
    )
    fx.write_files(documents, root)
    out = src.read_transcript_files(spark, root, "*.txt")
    return out.select(
        F.regexp_extract("source_path", "/page=([0-9]+)/", 1).cast("bigint").alias("page_id"),
        "category_path",
        (F.col("call_id") == F.regexp_extract("source_path", r"([^/]+)\.txt$", 1)).alias("named"),
        "text",
        F.split_part("document_error", F.lit(":"), F.lit(1)).alias("document_error"),
    )


@check(
    fx.with_views(
        "select page_id, kind, case when kind = 'object' then 'inbox' end bucket, object_key, run_id from m", m=fx.MESSAGES
    )
)
def parse_notifications(spark, sf_dir):
    bodies = fx.shared(spark, sf_dir, fx.MESSAGES).select("page_id", "body")
    return notifications.parse_notifications(bodies).select("page_id", "kind", "bucket", "object_key", "run_id")


RUN_KEYS = """
select page_id, concat(regexp_replace(url, '/+$', ''), case page_id % 6 when 0 then '.jsonl.gz' when 1 then '.json.jsonl.gz'
  when 2 then ' b+c.jsonl' when 3 then repeat('x', 150) when 4 then '/.jsonl.gz' else '.gz.gz' end) object_key from pages
"""  # SHARED
RUN_IDS = r"""
select page_id, object_key, case when cleaned = '' then 'unknown' else cleaned end run_id from (
  select *, left(regexp_replace(base, '[^A-Za-z0-9_-]+', '-', 'g'), 128) cleaned from (
    select *, case when b2 like '%.json' then b2[1:length(b2) - 5] else b2 end base from (
      select *, case when b1 like '%.jsonl' then b1[1:length(b1) - 6] else b1 end b2 from (
        select *, case when name like '%.gz' then name[1:length(name) - 3] else name end b1 from (
          select *, string_split(object_key, '/')[-1] as name from k)))))
"""


@check(fx.with_views(f"select page_id, run_id from ({RUN_IDS})", k=RUN_KEYS))
def derive_run_id(spark, sf_dir):
    return fx.shared(spark, sf_dir, RUN_KEYS).select(
        "page_id", paths.derive_run_id(F.col("object_key")).alias("run_id")
    )


@check(
    fx.with_views(
        f"select run_id, count(distinct object_key) object_keys from ({RUN_IDS}) group by run_id having count(distinct object_key) > 1",
        k=RUN_KEYS,
    )
)
def run_collisions(spark, sf_dir):
    keys = fx.shared(spark, sf_dir, RUN_KEYS)
    return collisions(keys.withColumn("run_id", paths.derive_run_id(F.col("object_key"))))


@check(
    """select cast(doc_id as varchar) call_id, length(text) chars from documents where doc_id in (select doc_id from documents order by doc_id limit 25)"""
)
def smoke_sample(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.to_json(F.struct(F.col("doc_id").cast("string").alias("call_id"), F.col("text").alias("transcript"))).alias("value")
    )
    root = work_dir(spark, "corpus")
    ordered = in_doc_order(lines)
    ordered.select("value").write.option("compression", "gzip").text(f"{root}/shards")
    corpus = src.build_corpus(spark, f"{root}/shards", f"{root}/corpus", glob=GZ)
    calls = src.usable_calls(src.parse_lines(src.smoke_set(corpus)))
    return calls.select("call_id", F.length("text").cast("bigint").alias("chars"))


RECEIVES = """
select event_id, concat('shard-', cast(user_id as varchar(9)), '-', cast(event_id % 40 as varchar(9))) item,
  case when (user_id + event_id % 40) % 10 = 0 then 'test' when (user_id + event_id % 40) % 10 = 1 then 'unknown' else 'object' end kind,
  event_type in ('purchase', 'error') ok from events
"""  # SHARED


@check(
    fx.with_views(
        """select item, kind, count(*) receives from receives where kind <> 'test' group by item, kind
        having count(*) >= 2 and count(*) filter (ok and kind = 'object') = 0""",
        receives=RECEIVES,
    )
)
def quarantine(spark, sf_dir):
    return ingest.dead_letters(fx.shared(spark, sf_dir, RECEIVES))


@check(
    fx.with_views(
        """select item, kind, cast(received as bigint) receives from (
          select *, row_number() over (partition by item, kind order by slice) k from (
            select *, sum(n) over w received, bool_or(good) over w settled from (
              select item, kind, event_id % 3 slice, count(*) n, bool_or(ok and kind = 'object') good from receives where kind <> 'test' group by all)
            window w as (partition by item, kind order by slice)) where received >= 2 or settled) where k = 1 and not settled""",
        receives=RECEIVES,
    )
)
def dead_letters_stream(spark, sf_dir):
    """The log of receives in three batches, the first of them written and followed twice."""
    root = work_dir(spark, "receives")
    log = fx.shared(spark, sf_dir, RECEIVES).withColumns({"slice": F.col("event_id") % 3, "n": F.lit(1)})
    for batch in (0, 0, 1, 2):
        rows = log.filter(F.col("slice") == batch).withColumn("ingest_batch", F.lit(f"batch-{batch}"))
        rows.select("item", "kind", "ingest_batch", "ok", F.col("n").cast("long").alias("n")).write.mode("overwrite").parquet(f"{root}/log/batch-{batch}")
        receives.dead_letters_stream(spark, f"{root}/log", f"{root}/dead", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(receives.DEAD_SCHEMA).parquet(f"{root}/dead")


@check(
    fx.with_views(
        """select run_id, extraction_status, count(*) n, cast(sum(seq) as bigint) checksum from r where not (run_id = 'run_a' and seq >= 2000000) group by all""",
        r=fx.ROWS,
    )
)
def append_extractions(spark, sf_dir):
    """Writes the rows in two batches, the second one twice; a repeated batch counts once."""
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    base = F.unix_seconds("extracted_at") - 1704067200
    full = fx.rows(spark, sf_dir)
    rows = full.select(
        "run_id", "call_id", "extraction_status", "error_message", "prompt_token_count", "completion_token_count", "extracted_at"
    ).withColumn("seq", base)
    warehouse.append_extractions(rows.filter("seq < 1000000"), "b1", many_runs=True)
    warehouse.append_extractions(rows.filter("seq >= 1000000"), "b2", many_runs=True)
    warehouse.append_extractions(rows.filter("seq between 1000000 and 1999999"), "b2", many_runs=True)
    stored = warehouse.calls().withColumn("seq", base)
    return stored.groupBy("run_id", "extraction_status").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("checksum"))


@check(
    fx.with_views(
        """select concurrency, cast(2 * count(*) as bigint) n, round(avg(req_per_sec), 6) req_per_sec, count(*) filter (prefix_cache_hit_ratio is null) * 2 no_ratio, 0 measured_nulls
        from m group by concurrency""",
        m=fx.MEASUREMENTS,
    )
)
def append_measurements(spark, sf_dir):
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    rows = fx.shared(spark, sf_dir, fx.MEASUREMENTS)
    warehouse.record_measurements(rows)
    warehouse.record_measurements(rows)
    return warehouse.read(MEASUREMENTS).groupBy("concurrency").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("req_per_sec"), 6).alias("req_per_sec"),
        F.count_if(F.col("prefix_cache_hit_ratio").isNull()).alias("no_ratio"),
        F.count_if(F.col("measured_at").isNull()).alias("measured_nulls"),
    )


@check(
    fx.with_views(
        """select count(*) submitted, 0 skipped, count(*) completed, count(*) filter (extraction_status = 'error') errors,
        count(*) filter (extraction_status = 'success') succeeded, 'partial' status, 1 as step from expected
        union all select count(*) filter (extraction_status = 'error'), count(*) filter (extraction_status = 'success'), count(*) filter (extraction_status = 'error'),
        count(*) filter (extraction_status = 'error'), 0, 'failed', 2 from expected""",
        turns=fx.TURNS,
        expected=fx.STUB_EXPECTED,
    )
)
def run_and_resume(spark, sf_dir):
    """A batch run, then the same input again: only the failed calls are tried a second time."""
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    calls = turn_calls(spark, sf_dir).drop("run_id")
    settings = replace(SETTINGS, model_options={"backoff_seconds": 0.0})
    steps = [
        run_extraction(warehouse, calls, "run_stub", stub_model, settings, f"step-{step}").withColumn("step", F.lit(step))
        for step in (1, 2)
    ]
    return steps[0].unionByName(steps[1]).drop("run_id")


def _ingest(spark, sf_dir):
    root = work_dir(spark, "stream")
    lines = fx.shared(spark, sf_dir, fx.TURNS).select(
        F.concat(
            F.to_json(F.struct("call_id", F.col("text").alias("transcript"))),
            F.when((F.col("conv_id") % 10 == 0) & (F.col("turn") == 0), F.lit("\n{broken")).otherwise(F.lit("")),
        ).alias("value"),
        "conv_id",
    )
    shards = lines.repartitionByRange(4, "conv_id").select("value")
    shards.write.option("compression", "gzip").text(f"{root}/inbox")
    warehouse = Warehouse(spark, f"{root}/tables")
    settings = replace(SETTINGS, model_options={"backoff_seconds": 0.0})
    for _ in range(2):  # the second pass finds nothing new
        query = ingest.ingest_stream(
            warehouse, f"{root}/inbox", f"{root}/checkpoint", stub_model, settings, max_files=3, glob=GZ
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return warehouse


@check(
    fx.with_views(
        """select call_id, extraction_status, error_class, case when extraction_status = 'error' then 2 else 1 end receives from expected""",
        turns=fx.TURNS,
        expected=fx.STUB_EXPECTED,
    )
)
def ingest_stream(spark, sf_dir):
    rows = _ingest(spark, sf_dir).calls()
    return rows.groupBy("call_id", "extraction_status", F.split_part("error_message", F.lit(":"), F.lit(1)).alias("error_class")).agg(
        F.count(F.lit(1)).alias("receives")
    )


@check(
    fx.with_views(
        """select reason, count(*) n from (select error_class reason from expected where extraction_status = 'error'
        union all select 'json_parse_error' from conversations where conv_id % 10 = 0 and turn = 0) group by reason""",
        turns=fx.TURNS,
        expected=fx.STUB_EXPECTED,
    )
)
def ingest_quarantine(spark, sf_dir):
    aside = ingest.read_quarantine(_ingest(spark, sf_dir))
    return aside.groupBy(F.split_part("reason", F.lit(":"), F.lit(1)).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@check(
    fx.with_views(
        """select run_id, time_bucket(interval '60 seconds', ts) period_start, count(*) requests, count(*) filter (ok) / 60.0::double req_per_sec, 0::bigint late_requests
        from requests group by 1, 2""",
        requests=fx.REQUESTS,
    )
)
def metrics_stream_60s(spark, sf_dir):
    """All windows: those that the stream has closed, and the last ones from the closing pass."""
    root = work_dir(spark, "stream")
    fx.requests(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    source = spark.readStream.schema(schema).parquet(f"{root}/in")
    metrics_stream(source, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    out = close_windows(spark.read.parquet(f"{root}/in"), f"{root}/out")
    return out.select("run_id", "period_start", "requests", "req_per_sec", "late_requests")


_HALF = "(select min(ts) + (max(ts) - min(ts)) / 2 from events)"
FOUR_METRICS = f"""
with scrapes as ({fx.SCRAPES}), v as ({fx.SCRAPE_VALUES}),
told as (select v.run_id, time_bucket(interval '60 seconds', e.ts) period_start, e.event_type <> 'error' ok, v.ratio, v.gpu_util, e.event_id % 97 = 0 and e.ts < {_HALF} late
  from events e join v using (event_id)),
closed as (select run_id, period_start, count(*) requests, count(*) filter (ok) / 60.0::double req_per_sec, count(*) filter (not ok) / count(*) error_rate,
  round(avg(ratio), 10) prefix_cache_hit_ratio, round(avg(gpu_util), 10) gpu_util from told where not late group by all),
late as (select run_id, period_start, count(*) late_requests from told where late group by all)
select * replace (coalesce(late_requests, 0) as late_requests) from closed full outer join late using (run_id, period_start)
"""


@check(FOUR_METRICS)
def metrics_stream_four(spark, sf_dir):
    """Requests and scrapes in three steps: the first half, the second, and what of the first half comes late, with a heartbeat."""
    root = work_dir(spark, "stream")
    requests = fx.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("run_"), (F.col("user_id") % 25).cast("string")).alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok")
    )
    scrapes = fx.shared(spark, sf_dir, fx.SCRAPES, busy=("events",)).withColumn("ts", F.col("ts").cast("timestamp"))
    times = requests.agg(F.min(F.unix_micros("ts")).alias("first"), F.max(F.unix_micros("ts")).alias("last"), F.max("ts").alias("end")).first()
    early = F.unix_micros("ts") * 2 < F.lit(times.first + times.last)
    late = early & (F.col("event_id") % 97 == 0)
    for step, own in enumerate((early & ~late, ~early, late)):
        requests.filter(own).select("run_id", "ts", "ok").write.mode("append").parquet(f"{root}/requests")
        scrapes.filter(own).select("run_id", "ts", "scrape").write.mode("append").parquet(f"{root}/scrapes")
        if step == 2:
            heartbeat(spark, times.end + timedelta(days=1)).write.mode("append").parquet(f"{root}/requests")
        sources = [
            spark.readStream.schema(schema).parquet(f"{root}/{name}")
            for name, schema in (("requests", "run_id string, ts timestamp, ok boolean"), ("scrapes", "run_id string, ts timestamp, scrape string"))
        ]
        four_metrics_stream(*sources, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    out = read_windows(spark, f"{root}/out")
    return out.withColumns({name: F.round(name, 10) for name in ("prefix_cache_hit_ratio", "gpu_util")})


def _turn_lines(spark, sf_dir):
    return fx.shared(spark, sf_dir, fx.TURNS).select("conv_id", "turn", F.to_json(F.struct("call_id", F.col("text").alias("transcript"))).alias("value"))


@check(
    """select stream, count(*) n from (select * from conversations cross join (values ('one'), ('two')) s(stream)) group by stream
    union all select stream || ' aside', 1 from (values ('one'), ('two')) s(stream)"""
)
def ingest_two_streams(spark, sf_dir):
    """Two streams with checkpoints of their own and shards of the same names: rows and quarantine of both stay, each once."""
    root = work_dir(spark, "stream")
    warehouse = Warehouse(spark, f"{root}/tables")
    settings = replace(SETTINGS, model_options={"backoff_seconds": 0.0})
    bad = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.lit("{broken").alias("value"))
    lines = _turn_lines(spark, sf_dir).select("conv_id", "value").unionByName(bad)
    lines = lines.withColumn("stream", F.explode(F.array(F.lit("one"), F.lit("two"))))
    lines = lines.withColumn("value", F.regexp_replace("value", F.lit('"call_id":"'), F.concat(F.lit('"call_id":"'), "stream", F.lit("-"))))
    # A task writes its lines of both streams under one name.
    lines.repartition(3, "conv_id").select("stream", "value").write.partitionBy("stream").text(f"{root}/in")
    for stream in ("one", "two"):
        query = ingest.ingest_stream(warehouse, f"{root}/in/stream={stream}", f"{root}/checkpoint-{stream}", always_right, settings, glob="*.txt")
        query.awaitTermination()
    rows = warehouse.calls().groupBy(F.split_part("call_id", F.lit("-"), F.lit(1)).alias("stream")).agg(F.count(F.lit(1)).alias("n"))
    aside = ingest.read_quarantine(warehouse).filter("item = '{broken'").select(F.regexp_extract("source_file", "stream=(one|two)/", 1).alias("stream"))
    return rows.unionByName(aside.groupBy(F.concat("stream", F.lit(" aside")).alias("stream")).agg(F.count(F.lit(1)).alias("n")))


@check(
    fx.with_views(
        """select step, run_id, count(*) n from r, (values ('before'), ('written'), ('committed')) s(step) where step <> 'committed' or run_id = 'run_a' group by step, run_id""",
        r=fx.ROWS,
    )
)
def append_replaced(spark, sf_dir):
    """A batch written again without some of its runs: a reader sees its old rows until the commit, then its new ones."""
    root = work_dir(spark, "tables")
    warehouse, reader = Warehouse(spark, root), Warehouse(spark, root)
    rows = fx.rows(spark, sf_dir).select("run_id", "call_id", "extraction_status", "error_message", "extracted_at")

    def seen(step):
        return reader.calls().groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).withColumn("step", F.lit(step))

    warehouse.append_extractions(rows, "b1", many_runs=True)
    steps = [seen("before")]
    attempt = warehouse.new_attempt()
    warehouse.write_extractions(rows.filter("run_id = 'run_a'"), "b1", attempt, many_runs=True)
    steps.append(seen("written"))
    warehouse.log.commit({"set": {CALLS: {"b1": attempt}}})
    return steps[0].unionByName(steps[1]).unionByName(seen("committed"))


@check(fx.with_views("select run_id, extraction_status, count(*) n, true few_files from r where run_id <> 'run_a' or extraction_status <> 'error' group by all", r=fx.ROWS))
def compact_tables(spark, sf_dir):
    """Rows in five batches, merged by file size; then a batch that was merged is written again without some of its rows."""
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    rows = fx.rows(spark, sf_dir).select("run_id", "call_id", "extraction_status", "error_message", "extracted_at")
    dropped = (F.col("run_id") == "run_a") & (F.col("extraction_status") == "error")
    batch = F.when(dropped, 4).otherwise(F.pmod(F.xxhash64("call_id"), F.lit(4)))
    for number in range(5):
        warehouse.append_extractions(rows.filter(batch == number), f"b{number}", many_runs=True)
    before = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(warehouse.path(CALLS)).count()
    warehouse.compact()
    warehouse.vacuum(0)
    after = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(warehouse.path(CALLS)).count()
    warehouse.append_extractions(rows.limit(0), "b4")
    few = F.lit(after < before)
    return warehouse.calls().groupBy("run_id", "extraction_status").agg(F.count(F.lit(1)).alias("n")).withColumn("few_files", few)


@check("select 'success' extraction_status, count(*) n, 0::bigint set_aside from conversations")
def ingest_redone_batch(spark, sf_dir):
    """A micro-batch that is done again with a model that now succeeds: no error row and nothing set aside remains."""
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    settings = replace(SETTINGS, model_options={"backoff_seconds": 0.0})
    lines = _turn_lines(spark, sf_dir).select("value", F.concat(F.lit("shard-"), (F.col("conv_id") % 3).cast("string"), F.lit(".jsonl.gz")).alias("source_file"))
    for model in (stub_model, always_right):
        ingest.process_shards(warehouse, lines, model, settings, "batch-0")
    aside = ingest.read_quarantine(warehouse).count()
    return warehouse.calls().groupBy("extraction_status").agg(F.count(F.lit(1)).alias("n"), F.lit(aside).cast("bigint").alias("set_aside"))


@check(fx.with_views("select count(*) n, true within_limit from r", r=fx.ROWS))
def commit_limits(spark, sf_dir):
    """The row limit of the commit policy holds for every file that a batch writes."""
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    rows = fx.rows(spark, sf_dir).select("run_id", "call_id", "extraction_status", "error_message", "extracted_at")
    limit = ingest.commit_policy(rows=500)["write"]["maxRecordsPerFile"]
    warehouse.append_extractions(rows, "b1", max_records_per_file=limit)
    files = spark.read.parquet(warehouse.path("calls_extractions")).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n"), (F.max("n") <= limit).alias("within_limit"))


@check(
    """select 'rows' what, count(*) n from conversations where conv_id % 3 < 2
    union all select 'dead object', 1 + least(count(*), 1) from conversations where conv_id % 12 = 4 and turn = 0 union all select 'dead unknown', 1"""
)
def ingest_notifications(spark, sf_dir):
    """A message per shard of two of three folders, for an absent shard and an unknown one, each received twice; and a ping.

    Shards of different folders have the same names; one of them holds lines that are no calls.
    """
    root = work_dir(spark, "notified")
    warehouse = Warehouse(spark, f"{root}/tables")
    settings = replace(SETTINGS, model_options={"backoff_seconds": 0.0})
    conv = F.col("conv_id")
    broken = F.when((conv % 12 == 4) & (F.col("turn") == 0), F.lit("\n{broken")).otherwise(F.lit(""))
    lines = _turn_lines(spark, sf_dir).select((conv % 3).alias("folder"), (conv % 4).alias("piece"), F.concat("value", broken).alias("value"))
    lines.repartition(4, "piece").write.partitionBy("folder", "piece").text(f"{root}/inbox")
    key = F.col("object_key")
    shards = ingest.list_objects(spark, f"{root}/inbox").filter(key.endswith(".txt") & ~key.startswith("folder=2/"))
    body = [F.concat(F.lit('{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"'), F.replace(key, F.lit("="), F.lit("%3D")), F.lit('"}}}]}'))]
    messages = shards.select(*[b.alias("body") for b in body])
    others = ['{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"absent.jsonl"}}}]}', '{"hello": 1}', '{"Service":"Amazon S3","Event":"s3:TestEvent"}']
    messages = messages.union(spark.createDataFrame([(m,) for m in others], "body string"))
    for receive in (1, 2):
        dead = ingest.ingest_notifications(warehouse, messages, f"{root}/inbox", always_right, settings, f"messages-{receive}", shards_per_round=5)
    rows = warehouse.calls().groupBy(F.lit("rows").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(dead.groupBy(F.concat(F.lit("dead "), "kind").alias("what")).agg(F.count(F.lit(1)).alias("n")))
