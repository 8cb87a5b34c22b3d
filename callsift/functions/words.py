"""Measures over a call's word array: row-local, no shuffle whatever the call sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word below this confidence counts as low.
LOW_CONFIDENCE = 0.7


def confidences(words: Column) -> Column:
    """Missing and null confidences count as 0.0."""
    return F.transform(words, lambda w: F.coalesce(w["confidence"].cast("double"), F.lit(0.0)))


def gaps_ms(words: Column) -> Column:
    """Positive gaps between neighbours in array order; missing times count as 0."""

    def gap(word: Column, i: Column) -> Column:
        start = F.coalesce(word["start"].cast("bigint"), F.lit(0).cast("bigint"))
        previous = F.coalesce(F.get(words, i - 1)["end"].cast("bigint"), F.lit(0).cast("bigint"))
        return F.when(i > 0, F.greatest(start - previous, F.lit(0).cast("bigint"))).otherwise(
            F.lit(0).cast("bigint")
        )

    return F.transform(words, gap)


def total(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda acc, x: acc + x)


def tenth_percentile(ordered: Column) -> Column:
    """Linear interpolation at 10 % between closest ranks of an ascending array."""
    span = (F.size(ordered) - 1) * 10
    low = F.floor(span / 100).cast("int")
    part = (span % 100).cast("double")
    return (
        F.get(ordered, low) * (F.lit(100.0) - part)
        + F.coalesce(F.get(ordered, low + 1), F.lit(0.0)) * part
    ) / F.lit(100.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """0.0 where there is nothing to divide by."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(0.0))
