"""Object-arrival notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.functions.json_strict import parse_json_strict
from callsift.functions.paths import derive_run_id
from callsift.functions.stages import settle


def _text(doc: Column, path: str) -> Column:
    value = F.try_variant_get(doc, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def decoded_key(key: Column) -> Column:
    """Plus signs are spaces; a percent sign without two hex digits stands for itself."""
    return F.try_url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def parse_notifications(messages: DataFrame, body: str = "body") -> DataFrame:
    """Adds kind (object, test, unknown), bucket, object_key and run_id.

    One envelope level is unwrapped; only the first record of a message counts; keys are decoded
    from their plus-and-percent form.
    """
    outer = parse_json_strict(messages, body, doc="_outer", error="_outer_error")
    inner = outer.withColumns(
        {
            "_wrapped": F.coalesce(_text(F.col("_outer"), "$.Type") == "Notification", F.lit(False)),
            "_message": _text(F.col("_outer"), "$.Message"),
        }
    )
    opened = parse_json_strict(inner, "_message", doc="_inner", error="_inner_error", required=False).withColumn(
        "_event", F.when(F.col("_wrapped"), F.col("_inner")).otherwise(F.col("_outer"))
    )
    event = F.col("_event")
    ping = (_text(event, "$.Event") == "s3:TestEvent") & (_text(event, "$.Service") == "Amazon S3")
    bucket = F.nullif(_text(event, "$.Records[0].s3.bucket.name"), F.lit(""))
    key = F.nullif(_text(event, "$.Records[0].s3.object.key"), F.lit(""))
    found = opened.withColumns({"_bucket": bucket, "_key": key}).withColumn(
        "kind",
        F.when(F.coalesce(ping, F.lit(False)), "test")
        .when(F.col("_bucket").isNotNull() & F.col("_key").isNotNull(), "object")
        .otherwise("unknown"),
    )
    is_object = F.col("kind") == "object"
    named = found.withColumn("object_key", F.when(is_object, decoded_key(F.col("_key"))))
    scratch = ["_outer", "_outer_error", "_inner", "_inner_error", "_wrapped", "_message", "_event", "_bucket", "_key"]
    return settle(
        named,
        {
            "kind": F.col("kind"),
            "bucket": F.when(is_object, F.col("_bucket")),
            "object_key": F.col("object_key"),
            "run_id": F.when(is_object, derive_run_id(F.col("object_key"))),
        },
        drop=scratch,
    )
