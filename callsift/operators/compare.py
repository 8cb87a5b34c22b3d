"""Comparisons between runs: medians, runaway outputs, latency arms, disagreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.functions.json_strict import parse_json_strict
from callsift.functions.order import packed, whole_hash, wide_hash
from callsift.functions.skew import binary_levels, rank_values, salted_join
from callsift.functions.stages import settle

# Fixed value: an output longer than this many medians is a runaway.
RUNAWAY_FACTOR = 10


def _length_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    n = F.col("group_rows")
    ranks = {"upper_median": F.floor(n / 2), "longest": n - 1}
    return rank_values(df, keys, value, ranks, buckets=binary_levels(df, value))


def upper_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The middle value of each sorted group, the upper one for even sizes; nulls do not count. Exact for values of any range."""
    return _length_ranks(df, keys, value).drop("longest")


def response_lengths(df: DataFrame, raw: str = "raw", length: str = "length") -> DataFrame:
    """Adds the bytes of the first choice's content: 0 if that is null or missing, those of the whole reply if the reply is
    no single JSON document, has no choices, or holds something else than a text there."""
    parsed = parse_json_strict(df, raw, doc="_reply", error="_reply_error")
    reply = F.col("_reply")
    first = F.try_variant_get(reply, "$.choices[0]", "variant")
    content = F.try_variant_get(reply, "$.choices[0].message.content", "variant")
    kind = F.coalesce(F.schema_of_variant(content), F.lit("VOID"))
    usable = first.isNotNull() & kind.isin("STRING", "VOID")
    size = F.when(usable, F.octet_length(F.coalesce(F.try_variant_get(content, "$", "string"), F.lit("")))).otherwise(F.octet_length(raw))
    return settle(parsed, {length: size.cast("bigint")}, drop=["_reply", "_reply_error"])


def runaway_outputs(df: DataFrame, keys: list[str], id_column: str, factor: int = RUNAWAY_FACTOR) -> DataFrame:
    """Rows of (keys, id, length) longer than ``factor`` medians of their group; none if it is 0."""
    rows = df.select(*keys, id_column, "length")
    medians = upper_median(rows, keys, "length").filter("upper_median > 0").select(*keys, "upper_median")
    return salted_join(rows, medians, keys, "inner", [id_column]).filter(
        F.col("length") > F.col("upper_median") * factor
    )


def runaway_verdict(df: DataFrame, keys: list[str], factor: int = RUNAWAY_FACTOR) -> DataFrame:
    """Per group: median, longest output, and whether any output ran away."""
    over = (F.col("upper_median") > 0) & (F.col("longest") > F.col("upper_median") * factor)
    return _length_ranks(df, keys, "length").withColumn("runaway", over)


def ab_latency(requests: DataFrame, arm: str = "arm") -> DataFrame:
    """Successful calls and their mean latency per arm; 0 when none succeeded."""
    return requests.groupBy(arm).agg(
        F.count_if("ok").alias("ok_calls"),
        F.coalesce(F.avg(F.when(F.col("ok"), F.col("latency_s"))), F.lit(0.0)).alias("mean_latency_s"),
    )


def _best(values: list[Column]) -> Column:
    """The larger, the better a row: success, then time, then a hash of the values."""
    return packed(F.col("extraction_status") == "success", F.col("extracted_at"), whole_hash(*values))


def _one_row_per_call(rows: DataFrame, runs: list[str], values: list[Column]) -> DataFrame:
    """call_id and one struct per run, ``run_0`` ...: that run's best row, success first, then newest; of rows of one time the
    values decide by their hash, so the order of rows never does.

    One partial aggregation brings the runs side by side, instead of a self-join.
    """
    order = _best(values)
    picked = [
        F.max_by(F.struct(F.lit(True).alias("present"), *values), F.when(F.col("run_id") == run, order)).alias(
            f"run_{i}"
        )
        for i, run in enumerate(runs)
    ]
    return rows.filter(F.col("run_id").isin(runs)).groupBy("call_id").agg(*picked)


def field_disagreement(rows: DataFrame, run_a: str, run_b: str, field: str) -> DataFrame:
    """Calls present in both runs whose ``field`` differs; two nulls are equal. Dotted paths work.

    A call that a run holds several times (retries) counts with its best row.
    """
    sides = _one_row_per_call(rows, [run_a, run_b], [F.col(field).alias("value")])
    a, b = F.col("run_0.value"), F.col("run_1.value")
    return sides.filter(
        F.col("run_0.present") & F.col("run_1.present") & ~a.eqNullSafe(b)
    ).select("call_id", a.alias("run_a_value"), b.alias("run_b_value"))


def disagreement_matrix(rows: DataFrame, runs: list[str], fields: list[str], against_first: bool = False) -> DataFrame:
    """Every pair of runs and every field: calls compared, calls that differ, rate. With ``against_first`` only the pairs
    of the first run with each other one.

    A run's best row of a call counts, as in ``field_disagreement``. Values travel as hashes of fixed width (119 bits of
    their JSON text), so a maximum per run and call picks them in a hash aggregation. A call's runs then form one
    pattern per field: which runs hold it, and which of them agree. Calls with the same pattern are counted together and only the
    distinct patterns are unfolded into pairs of runs. The plan does not grow with the number of runs.
    """
    names, paths = F.array(*map(F.lit, runs)), F.array(*map(F.lit, fields))
    values = [F.col(field) for field in fields]
    hashes = [wide_hash(value).alias(f"field_{i}") for i, value in enumerate(values)]
    known = rows.filter(F.col("run_id").isin(runs)).select("call_id", (F.array_position(names, F.col("run_id")) - 1).cast("int").alias("place"), _best(values).alias("best"), *hashes)
    sides = known.groupBy("call_id", "place").agg(*[F.max_by(f"field_{i}", "best").alias(f"field_{i}") for i in range(len(fields))])
    held = sides.groupBy("call_id").agg(F.sort_array(F.collect_list(F.struct("place", F.array(*[f"field_{i}" for i in range(len(fields))]).alias("v")))).alias("held"))
    held = held.filter(F.size("held") > 1).select(F.col("held.place").alias("places"), "held", F.explode(F.sequence(F.lit(0), F.lit(len(fields) - 1))).alias("field_no"))
    own = held.select("field_no", "places", F.transform("held", lambda x: F.get(x["v"], F.col("field_no"))).alias("v")).withColumn("kinds", F.array_distinct("v"))
    patterns = own.select("field_no", "places", F.transform("v", lambda x: F.array_position("kinds", x)).alias("kinds")).groupBy("field_no", "places", "kinds").agg(F.count(F.lit(1)).alias("n"))
    ends = F.when(F.lit(against_first), F.when(F.get("places", F.lit(0)) == 0, F.array(F.lit(0)))).otherwise(F.sequence(F.lit(0), F.size("places") - 2))
    pairs = patterns.withColumn("i", F.explode(ends)).withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.size("places") - 1)))
    differs = F.get("kinds", F.col("i")) != F.get("kinds", F.col("j"))
    counted = pairs.groupBy("field_no", F.get("places", F.col("i")).alias("a"), F.get("places", F.col("j")).alias("b")).agg(
        F.sum("n").alias("compared"), F.sum(F.when(differs, F.col("n")).otherwise(0)).alias("differing")
    )
    # Pairs without a common call are told too.
    firsts = F.sequence(F.lit(0), F.lit(0 if against_first else len(runs) - 2))
    every = rows.sparkSession.range(1 if len(runs) > 1 else 0).select(F.explode(firsts).alias("a"))
    every = every.withColumn("b", F.explode(F.sequence(F.col("a") + 1, F.lit(len(runs) - 1)))).withColumn("field_no", F.explode(F.sequence(F.lit(0), F.lit(len(fields) - 1))))
    compared, differing = (F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in ("compared", "differing"))
    cells = every.join(counted, ["a", "b", "field_no"], "left").select(
        F.get(names, F.col("a")).alias("run_a"), F.get(names, F.col("b")).alias("run_b"), F.get(paths, F.col("field_no")).alias("field"), compared, differing
    )
    rate = F.when(F.col("compared") > 0, F.col("differing") / F.col("compared")).otherwise(0.0)
    return cells.withColumn("disagreement_rate", rate)


def schema_validity(rows: DataFrame) -> DataFrame:
    """Share of a run's calls whose output passed the schema, and of failures due to the schema."""
    invalid = F.coalesce(F.split_part("error_message", F.lit(":"), F.lit(1)), F.lit("")).isin(
        "json_parse_error", "validation_error"
    )
    total = F.count(F.lit(1))
    return rows.groupBy("run_id").agg(
        total.alias("calls"),
        (F.count_if(F.col("extraction_status") == "success") / total).alias("validity_rate"),
        (F.count_if(invalid) / total).alias("schema_error_rate"),
    )


def reference_agreement(rows: DataFrame, reference_run: str, runs: list[str], fields: list[str]) -> DataFrame:
    """Share of compared calls on which each run agrees with the reference run, per field."""
    return disagreement_matrix(rows, [reference_run, *runs], fields, against_first=True).select(
        F.col("run_b").alias("run_id"),
        "field",
        "compared",
        (1.0 - F.col("disagreement_rate")).alias("agreement_rate"),
    )
