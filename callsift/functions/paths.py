"""Identifiers derived from file paths and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1)


def call_id_from_path(path: Column) -> Column:
    """File name without its last suffix and without one trailing ``_transcript``."""
    stem = F.regexp_replace(base_name(path), r"(?s)^(.+)\.[^.]+$", "$1")
    return F.regexp_replace(stem, r"_transcript\z", "")


def category_from_path(path: Column, root: str) -> Column:
    """First path part below ``root``; outside of it, the name of the parent folder."""
    prefix = root.rstrip("/") + "/"
    below = F.substring(path, len(prefix) + 1, 1 << 30)
    parent = F.regexp_extract(path, "([^/]*)/+[^/]*$", 1)
    return F.when(path.startswith(prefix), F.regexp_extract(below, "^/*([^/]*)", 1)).otherwise(parent)


def derive_run_id(key: Column) -> Column:
    """Shard name as a run id; equal names in different folders share one run."""
    name = base_name(key)
    for suffix in (r"\.gz\z", r"\.jsonl\z", r"\.json\z"):
        name = F.regexp_replace(name, suffix, "")
    name = F.substring(F.regexp_replace(name, "[^A-Za-z0-9_-]+", "-"), 1, 128)
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("unknown"))
