"""Joins and rank selection that hold when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 8


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread_by: list[str],
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join a large, possibly skewed ``left`` to a ``right`` holding one row per key.

    Left rows of one key go to ``salts`` partitions by a hash of ``spread_by``; right rows are
    repeated per salt. The extra key also puts an exchange right below each side of the join, where
    adaptive execution can cut a partition that is still too large (identical copies share a salt).
    Small right sides are broadcast by Spark's own size check. Keys match null-safe.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    renamed = repeated.withColumnsRenamed({name: f"_r_{name}" for name in [*on, "_salt"]})
    same = null_safe_match([*on, "_salt"], "_r_")
    return salted.join(renamed, same, how).drop("_salt", *[f"_r_{name}" for name in [*on, "_salt"]])


def null_safe_match(names: list[str], prefix: str) -> Column:
    """Equality on ``names`` and their prefixed counterparts; null equals null."""
    return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(prefix + name)) for name in names])


def rank_values(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Column],
    buckets: list[Column],
    weight: str | None = None,
) -> DataFrame:
    """Exact order statistics per group: ``keys``, ``group_rows`` and one column per rank.

    ``ranks`` maps a name to a 0-based rank written over the column ``group_rows``. Rows are first
    collapsed to (keys, value, count). ``buckets`` are ever finer monotone functions of ``value``;
    per level only the bucket that holds a wanted rank is looked into, so no task sees more of a
    group than one bucket of the last level. With ``weight``, ``df`` already has one row per
    (keys, value) and that column holds its count. Nulls in ``value`` do not count.
    """
    known = df.filter(F.col(value).isNotNull())
    if weight:
        rows = known.withColumnRenamed(weight, "_n")
    else:
        rows = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumns({f"_bucket_{i}": bucket for i, bucket in enumerate(buckets)})

    inside, carried = list(keys), ["_before", "group_rows", *[f"_rank_{name}" for name in ranks]]
    for level in range(len(buckets)):
        sized = rows.groupBy(*inside, f"_bucket_{level}").agg(
            F.sum("_n").alias("_in_bucket"), *[F.max(c).alias(c) for c in carried if level]
        )
        marked = _holding_a_rank(sized, inside, f"_bucket_{level}", "_in_bucket", ranks, first=not level)
        inside = [*inside, f"_bucket_{level}"]
        # Null-safe on all keys: groups with a null key count too, and no filter is inferred for one
        # side only, so both sides read the same exchange of collapsed counts.
        renamed = marked.select(*[F.col(c).alias(f"_m_{c}") for c in inside], *carried)
        rows = rows.drop(*carried).join(renamed, null_safe_match(inside, "_m_")).drop(*[f"_m_{c}" for c in inside])

    found = _holding_a_rank(rows, inside, value, "_n", ranks, first=not buckets)
    picks = []
    for name in ranks:
        place = F.col(f"_rank_{name}") - F.col("_before")
        picks.append(F.max(F.when((place >= 0) & (place < F.col("_n")), F.col(value))).alias(name))
    return found.groupBy(*keys).agg(F.max("group_rows").alias("group_rows"), *picks)


def binary_levels(df: DataFrame, value: str) -> list[Column]:
    """Buckets for ``rank_values`` over a numeric column of any range, by the leading bits of its whole part.

    Whatever the values are, a group has at most 2^24 buckets on the first level, 2^20 in one of them on the second, and 2^20
    distinct whole numbers in one of those, so no task ever orders more rows of a group. Fractions get a level more.
    """
    kind = df.schema[value].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        whole, more = F.col(value).cast("bigint"), []
    else:
        limit = F.lit(float(1 << 62))
        whole = F.floor(F.greatest(-limit, F.least(limit, F.col(value).cast("double")))).cast("bigint")
        more = [whole]
    return [F.shiftright(whole, 40), F.shiftright(whole, 20), *more]


def _holding_a_rank(
    df: DataFrame, inside: list[str], order: str, count: str, ranks: dict[str, Column], first: bool
) -> DataFrame:
    """Rows whose span of ranks, counted in ``order`` within ``inside``, holds a wanted rank."""
    group = Window.partitionBy(*inside)
    earlier = F.sum(count).over(group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast("bigint")
    if first:
        df = df.withColumns({"group_rows": F.sum(count).over(group), "_before": F.coalesce(earlier, zero)})
        df = df.withColumns({f"_rank_{name}": rank.cast("bigint") for name, rank in ranks.items()})
    else:
        df = df.withColumn("_before", F.col("_before") + F.coalesce(earlier, zero))
    wanted = F.lit(False)
    for name in ranks:
        place = F.col(f"_rank_{name}") - F.col("_before")
        wanted = wanted | ((place >= 0) & (place < F.col(count)))
    return df.filter(wanted)
