"""Inputs derived from the test tables, as pairs of a Spark frame and the same rows in DuckDB SQL.

Texts marked SHARED run unchanged in both engines.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.operators.inference import ARROW_ROWS
from callsift.session import at_most, spread

TABLES = ("documents", "labels", "events", "pages", "conversations", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession, sf_dir: str, sql: str, busy: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a SHARED text; ``busy`` tables feed costly row-local work and are dealt out first."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", sql):
            df = table(spark, sf_dir, name)
            (spread(df) if name in busy else df).createOrReplaceTempView(name)
    return spark.sql(sql)


def with_views(query: str, **views: str) -> str:
    """DuckDB text of ``query`` with the named views inlined."""
    inlined = ", ".join(f"{name} as ({sql})" for name, sql in views.items())
    return f"with {inlined} {query}"


# --- calls: every document is a call; a quarter of them comes as plain text without words -------

def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    doc_id = F.col("doc_id")
    plain = doc_id % 4 == 0

    def word(token, i):
        start = i * 500 + (doc_id * 7 + i * 13) % 300
        conf = F.when((doc_id + i) % 50 != 0, ((doc_id * 31 + i * 37) % 129) / 128.0)
        return F.struct(
            start.cast("double").alias("start"),
            (start + F.length(token) * 40).cast("double").alias("end"),
            conf.cast("double").alias("confidence"),
        )

    text = F.regexp_replace("text", "[0-9]+", "[NUM]")
    tokens = F.regexp_extract_all(F.col("text"), F.lit(r"\S+"), F.lit(0))
    return (
        docs.withColumn("text", text)
        .withColumn("tokens", F.when(~plain, tokens))
        .select(
            doc_id.cast("string").alias("call_id"),
            F.concat(F.lit("corpus/"), "lang", F.lit("/"), doc_id.cast("string"), F.lit(".json")).alias("source_path"),
            F.col("lang").alias("category_path"),
            "text",
            F.transform("tokens", word).alias("words"),
            F.when(~plain & (doc_id % 10 != 1), F.size("tokens") * 0.5).cast("double").alias("audio_duration"),
            F.when(~plain & (doc_id % 9 != 1), (doc_id % 129) / 128.0).cast("double").alias("confidence"),
        )
    )


CALLS = r"""
select cast(doc_id as varchar) call_id, 'corpus/' || lang || '/' || doc_id || '.json' source_path, lang category_path,
  doc_id, text, tokens,
  case when doc_id % 4 <> 0 and doc_id % 10 <> 1 then len(tokens) * 0.5::double end audio_duration,
  case when doc_id % 4 <> 0 and doc_id % 9 <> 1 then (doc_id % 129) / 128.0::double end confidence
from (select doc_id, lang, text, case when doc_id % 4 <> 0 then regexp_extract_all(text, '\S+') end tokens
  from (select doc_id, lang, regexp_replace(text, '[0-9]+', '[NUM]', 'g') as text from documents))
"""

CALL_WORDS = r"""
select call_id, doc_id, i as pos, i * 500 + (doc_id * 7 + i * 13) % 300 as start_ms,
  i * 500 + (doc_id * 7 + i * 13) % 300 + 40 * length(tok) as end_ms,
  case when (doc_id + i) % 50 <> 0 then ((doc_id * 31 + i * 37) % 129) / 128.0::double else 0 end conf
from (select call_id, doc_id, unnest(tokens) tok, generate_subscripts(tokens, 1) - 1 as i from calls where tokens is not null)
"""

# Per call: the measures of its words.
CALL_WORD_STATS = """
select call_id, count(*) words, sum(conf) / count(*) mean_conf, min(conf) min_conf, quantile_cont(conf, 0.1) p10_conf,
  sum(case when conf < 0.7::double then 1 else 0 end) / count(*) low_conf,
  cast(sum(greatest(gap, 0)) as bigint) / 1000.0::double silence, max(greatest(gap, 0)) / 1000.0::double longest
from (select *, coalesce(start_ms - lag(end_ms) over (partition by call_id order by pos), 0) gap from call_words)
group by call_id
"""

# --- words as a table: every user is a call, every event a word in event order -----------------

def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    return events.select(
        F.col("user_id").cast("string").alias("call_id"),
        F.col("event_id").alias("pos"),
        start.alias("start"),
        (start + F.floor(F.col("value") * 20000)).alias("end"),
        (((F.col("event_id") * 37) % 129) / 128.0).cast("double").alias("confidence"),
    )


WORDS = """
select cast(user_id as varchar) call_id, event_id pos, epoch_us(ts) // 1000 start_ms,
  epoch_us(ts) // 1000 + cast(floor(value * 20000) as bigint) end_ms, ((event_id * 37) % 129) / 128.0::double conf
from events
"""

# --- extraction rows: three runs over all documents; run_a holds retries of its errors ---------
# run_b and run_c each lack some calls, so that comparisons and audits meet calls of one run only.

ROWS_FLAT = """
select run_id, call_id, extraction_status, error_message,
  case when extraction_status = 'success' then intent end intent,
  case when extraction_status = 'success' then score end score,
  case when extraction_status = 'success' then summary end summary,
  prompt_token_count,
  case when extraction_status = 'success' then completion_token_count end completion_token_count, seq
from (
  select 'run_a' run_id, call_id, case when bad = 1 then 'error' else 'success' end extraction_status,
    case when bad = 1 then case when doc_id % 2 = 0 then 'json_parse_error: x' else 'validation_error: y' end end error_message,
    case when quality = 1 then lang end intent, n_chars % 5 + 1 score, concat('About ', lang, ' ', cast(n_chars % 3 as varchar(9))) summary,
    n_chars prompt_token_count, n_chars % 97 completion_token_count, doc_id seq from base
  union all
  select 'run_a', call_id, 'success', cast(null as varchar(9)), lang, n_chars % 5 + 1, concat('About ', lang), n_chars, n_chars % 97, doc_id + 1000000
  from base where bad = 1 and doc_id % 2 = 0
  union all
  select 'run_a', call_id, 'error', 'api_error: z', cast(null as varchar(9)), cast(null as bigint), cast(null as varchar(9)), n_chars, cast(null as bigint), doc_id + 2000000
  from base where bad = 1 and doc_id % 3 = 0
  union all
  select 'run_b', call_id, case when doc_id % 11 = 0 then 'error' else 'success' end,
    case when doc_id % 11 = 0 then 'api_error: TimeoutError: z' end,
    case when doc_id % 7 <> 0 then lang end, n_chars % 4 + 1, concat('About ', lang, ' ', cast(n_chars % 2 as varchar(9))), n_chars, n_chars % 89, doc_id
  from base where doc_id % 13 <> 0
  union all
  select 'run_c', call_id, case when doc_id % 19 = 0 then 'error' else 'success' end,
    case when doc_id % 19 = 0 then 'missing_content: none' end,
    case when doc_id % 5 <> 0 then lang end, n_chars % 5 + 1, concat('About ', lang, ' ', cast(n_chars % 6 as varchar(9))), n_chars, n_chars % 83, doc_id
  from base where doc_id % 23 <> 0
) t
"""
ROWS_BASE = """
select d.doc_id, cast(d.doc_id as varchar(20)) call_id, d.lang, d.n_chars, coalesce(l.quality, 1) quality,
  case when l.toxic = 1 or d.doc_id % 17 = 0 then 1 else 0 end bad
from documents d left join labels l on d.doc_id = l.doc_id
"""
ROWS = with_views(ROWS_FLAT, base=ROWS_BASE)  # SHARED


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROWS with the nested document, as the table stores it."""
    flat = shared(spark, sf_dir, ROWS)
    extraction = F.struct(
        F.struct(F.col("score").cast("tinyint").alias("empathy_score")).alias("agent"),
        F.struct(F.col("intent").alias("intent_primary")).alias("customer"),
        F.col("summary").alias("summary"),
    )
    return flat.select(
        "run_id",
        "call_id",
        "extraction_status",
        "error_message",
        F.when(F.col("extraction_status") == "success", extraction).alias("extraction"),
        F.col("prompt_token_count").cast("int").alias("prompt_token_count"),
        F.col("completion_token_count").cast("int").alias("completion_token_count"),
        F.timestamp_seconds(F.col("seq") + 1704067200).alias("extracted_at"),
    )


# --- runs: every order is a run, every line item a measurement; a third of the runs has no end --

RUN_UPDATES = """
select concat('run_', cast(o_orderkey as varchar(20))) run_id, o_orderpriority test_name, 'running' status,
  cast(o_orderdate as timestamp) started_at, cast(null as timestamp) ended_at, cast(o_orderdate as timestamp) updated_at
from orders
union all
select concat('run_', cast(o_orderkey as varchar(20))), cast(null as varchar(9)), case when o_orderstatus = 'F' then 'success' else 'partial' end,
  cast(null as timestamp), cast(o_orderdate as timestamp) + interval '1' day, cast(o_orderdate as timestamp) + interval '1' day
from orders where o_orderkey % 3 <> 0
"""  # SHARED

MEASUREMENTS = """
select concat('run_', cast(l_orderkey as varchar(20))) run_id, cast(8 * (l_linenumber % 5) + 16 as bigint) concurrency,
  cast(l_quantity as double) req_per_sec, cast(l_discount as double) error_rate,
  case when l_partkey % 4 <> 0 then cast(l_tax as double) end prefix_cache_hit_ratio, cast(l_extendedprice as double) gpu_util_mean
from lineitem
"""  # SHARED

# --- requests and scrapes: every event is a request of one of 25 runs ---------------------------

def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), (F.col("user_id") % 25).cast("string")).alias("run_id"),
        (F.col("event_id") % 5 * 8 + 16).alias("concurrency"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("latency_s"),
        "ts",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )


REQUESTS = """
select 'run_' || (user_id % 25) run_id, event_id % 5 * 8 + 16 concurrency, event_type <> 'error' ok, value latency_s, ts, epoch_us(ts) us
from events
"""

# One scrape per event, in seven forms of text.
SCRAPES = """
select event_id, concat('run_', cast(user_id % 25 as varchar(9))) run_id, ts, hundredths,
  concat('# HELP x', nl, case event_id % 7
    when 0 then concat('vllm:gpu_cache_usage_perc{model="m"} 0.', hundredths, nl, 'vllm:prefix_cache_hit_rate{model="m"} 0.', hundredths)
    when 1 then concat('vllm:gpu_cache_usage 0.', hundredths, nl, 'vllm:gpu_prefix_cache_hit_rate 0.', hundredths)
    when 2 then concat('vllm:prefix_cache_hits_total ', hundredths, nl, 'vllm:prefix_cache_hits_created 1.7e9', nl, 'vllm:prefix_cache_queries_total 200', nl, 'vllm:prefix_cache_queries_created 1.7e9')
    when 3 then concat('vllm:gpu_cache_usage 0.99', nl, 'vllm:gpu_cache_usage_perc 0.', hundredths, nl, 'vllm:prefix_cache_hits{a="b"} ', hundredths, nl, 'vllm:prefix_cache_hits{a="c"} 50', nl, 'vllm:prefix_cache_queries{a="b"} 160')
    when 4 then concat('vllm:gpu_cache_usage_perc 2.5e-1', nl, '# vllm:prefix_cache_hit_rate 0.5')
    when 5 then concat('vllm:prefix_cache_hit_rate none', nl, 'vllm:gpu_prefix_cache_hit_rate 0.', hundredths)
    else concat('other 1', nl, 'vllm:prefix_cache_queries_total 0') end, nl) scrape
from (select *, case when event_id * 7 % 90 + 10 >= 10 then cast(event_id * 7 % 90 + 10 as varchar(9)) end hundredths, chr(10) nl from events) e
"""  # SHARED

SCRAPE_VALUES = """
select event_id, run_id, ts,
  case when event_id % 7 in (0, 1, 3) then cast('0.' || hundredths as double) when event_id % 7 = 4 then 0.25::double else 0.0::double end gpu_util,
  case event_id % 7 when 0 then cast('0.' || hundredths as double) when 1 then cast('0.' || hundredths as double) when 5 then cast('0.' || hundredths as double)
    when 2 then cast(hundredths as double) / 200 when 3 then (cast(hundredths as double) + 50) / 160 end ratio
from scrapes
"""

# --- model replies: 16 forms by document -------------------------------------------------------

RESPONSES = """
select doc_id, case doc_id % 16
    when 1 then replace(replace(j, '"empathy_score":3', '"empathy_score":" 3 "'), '"quality":{}', '"quality":{"profanity_or_abuse":"Yes"},"extra":1')
    when 2 then concat('```json', j, '```')
    when 3 then concat(j, ' trailing')
    when 4 then replace(j, '"summary":"ok",', '')
    when 5 then replace(j, '"empathy_score":3', '"empathy_score":6')
    when 6 then replace(j, '"low"', '"Low"')
    when 7 then replace(j, '["a"]', '["a","b","c","d"]')
    when 8 then '[1]'
    when 9 then ''
    when 10 then replace(j, '"empathy_score":3', '"empathy_score":9,"empathy_score":3')
    when 11 then replace(j, '"events":{}', '"events":{"upsell_attempted":null}')
    when 12 then replace(j, '"events":{}', concat('"events":{},"note":', case when doc_id % 64 = 12 then concat(repeat('[', 2000), repeat(']', 2000)) else 'NaN' end))
    when 13 then replace(j, '"empathy_score":3', '"empathy_score":NaN')
    when 14 then concat(j, ',', j)
    when 15 then concat(replace(j, '"ok"', concat('"', lang, '"')), ' ')
    else j end raw,
  case when doc_id % 16 in (0, 1, 10, 12, 15) then 'success' when doc_id % 16 in (2, 3, 9, 14) then 'json_parse_error' else 'validation_error' end expected,
  case when doc_id % 16 = 15 then lang when doc_id % 16 in (0, 1, 10, 12) then 'ok' end summary
from (select doc_id, lang, '{"agent":{"name":null,"professionalism_score":4,"empathy_score":3,"knowledge_score":5},"customer":{"intent_primary":"billing","satisfaction_score":3,"effort_score":"low"},"outcome":{"resolution_summary":"done","complexity_score":2},"events":{},"quality":{},"summary":"ok","key_quotes":["a"],"coaching_opportunities":[]}' j from documents) b
"""  # SHARED

# --- notifications: one message per page --------------------------------------------------------

MESSAGES = """
select page_id, case page_id % 7 when 3 then '{"Service":"Amazon S3","Event":"s3:TestEvent"}' when 4 then 'not json' when 5 then '{"Records":[]}'
  when 6 then concat('{"Type":"Notification","Message":"', replace(record, '"', concat(bs, '"')), '"}') else record end body,
  case page_id % 7 when 3 then 'test' when 4 then 'unknown' when 5 then 'unknown' else 'object' end kind,
  case when page_id % 7 in (0, 1, 2, 6) then object_key end object_key,
  case when page_id % 7 in (0, 1, 2, 6) then concat('shard-', cast(page_id as varchar(20))) end run_id
from (select page_id, object_key, chr(92) bs, concat('{"Records":[{"s3":{"bucket":{"name":"inbox"},"object":{"key":"', replace(replace(object_key, '/', '%2F'), ' ', '+'), '"}}},{"s3":{}}]}') record
  from (select page_id, concat('jobs/inbox/shard ', cast(page_id as varchar(20)), case page_id % 4 when 0 then '.jsonl.gz' when 1 then '.json.gz' when 2 then '.jsonl' else '.gz' end) object_key from pages) k) r
"""  # SHARED

# --- call lines: documents as JSON lines, some unusable -----------------------------------------

def call_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value per document: plain and object transcripts, no call_id (doc_id % 20 = 17), trailing
    text (18), a duplicate key (19)."""
    base = calls(spark, sf_dir)
    number = F.col("call_id").cast("bigint")
    obj = F.to_json(F.struct("text", "words", "audio_duration", "confidence"))
    string = F.get_json_object(F.to_json(F.struct("text")), "$")
    transcript = F.when(F.col("words").isNull(), F.regexp_extract(string, r'(?s)^\{"text":(.*)\}\z', 1)).otherwise(obj)
    head = F.when(number % 20 == 17, F.lit("{")).when(
        number % 20 == 19, F.concat(F.lit('{"call_id":"'), "call_id", F.lit('","transcript":"first",'))
    ).otherwise(F.concat(F.lit('{"call_id":"'), "call_id", F.lit('",')))
    tail = F.when(number % 20 == 18, F.lit(" trailing")).otherwise(F.lit(""))
    return base.select(
        number.alias("doc_id"),
        F.concat(
            head, F.lit('"category_path":"'), "category_path", F.lit('","transcript":'), transcript, F.lit("}"), tail
        ).alias("value"),
    )


# --- conversation lines for the stub model: one call per turn -----------------------------------

TURNS = """
select concat(cast(conv_id as varchar(20)), '-', cast(turn as varchar(20))) call_id, conv_id, turn, text from conversations
"""  # SHARED

STUB_EXPECTED = """
select call_id, conv_id, n,
  case when n % 12 in (3, 6, 7, 8, 9, 10) then 'error' else 'success' end extraction_status,
  case n % 12 when 3 then 'json_parse_error' when 6 then 'api_error' when 7 then 'validation_error' when 8 then 'unexpected_error' when 9 then 'missing_content' when 10 then 'unexpected_error' end error_class,
  case when n % 12 in (3, 5, 6, 7, 8, 9, 10) then 3 when n % 12 = 2 then 2 else 1 end attempts
from (select call_id, conv_id, least(length(text), 5000) n from turns)
"""


# --- many small text files ----------------------------------------------------------------------

FOLDERS = ("cat", "page")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ROWS_AT_ONCE = 256


def file_writer(root: str):
    """Function over the batches of a partition that is sorted by ``FOLDERS`` and value: a file per row, rows of one folder are numbered.

    A file appears under its name when it is whole, and a task that is done again puts the same one in its place.
    """

    def write(batches):
        task, last, number, files = TaskContext.get(), None, 0, 0
        for batch in batches:
            for *own, value in zip(*(batch.column(c).to_pylist() for c in FOLDERS), batch.column("value"), strict=True):
                folder = os.path.join(root, *(f"{c}={NO_VALUE if v is None else v}" for c, v in zip(FOLDERS, own, strict=True)))
                number = number + 1 if own == last else 0
                if own != last:
                    os.makedirs(folder, exist_ok=True)
                name = f"part-{task.partitionId():05d}.c{number:03d}.txt"
                unfinished = os.path.join(folder, f"_{name}.{task.taskAttemptId()}")
                with open(unfinished, "wb") as file:
                    file.write(value.as_buffer())
                    file.write(b"\n")
                os.replace(unfinished, os.path.join(folder, name))
                last, files = own, files + 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return write


def write_files(rows: DataFrame, root: str) -> None:
    """Rows (cat, page, value), whole numbers and text, as text files of one row each, in folders by category and page.

    On a local disk Spark's writer starts processes that set the mode of each file and folder, and its commit moves folders one by
    one, so there tasks write the files themselves. A store that only Spark reaches is left to its writer.
    """
    spark = rows.sparkSession
    dealt = rows.repartition("page")
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file":
        dealt.write.option("maxRecordsPerFile", 1).partitionBy(*FOLDERS).text(root)
        return
    store.mkdirs(top)
    ordered = dealt.sortWithinPartitions(*FOLDERS, "value").withColumn("value", F.col("value").cast("binary"))
    with at_most(spark, ARROW_ROWS, ROWS_AT_ONCE):
        ordered.mapInArrow(file_writer(top.toUri().getPath()), "files bigint").write.format("noop").mode("overwrite").save()
