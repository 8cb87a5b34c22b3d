"""Orders of rows as single numbers, so that a plain maximum picks a row and ties never fall to chance."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds from the year 1 to 1970: times become positive numbers of at most 18 digits.
SINCE_YEAR_ONE = 62_135_596_800_000_000
HASH_RANGE = 10**18
WIDE = "decimal(38,0)"


def _times(value: Column, factor: int) -> Column:
    return value.cast(WIDE) * F.lit(Decimal(factor)).cast(WIDE)


def whole_hash(*values: Column) -> Column:
    """A hash of some values by their JSON text, in which a null differs from an absent neighbour."""
    return F.xxhash64(F.to_json(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)]), {"ignoreNullFields": "false"}))


def wide_hash(value: Column) -> Column:
    """Two hashes of a value's JSON text with different seeds as one decimal (119 bits); null has one too."""
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    first, second = (F.pmod(h, F.lit(HASH_RANGE)) for h in (F.xxhash64(text), F.xxhash64(F.lit("second"), text)))
    return _times(first, HASH_RANGE) + second.cast(WIDE)


def packed(first: Column, at: Column, whole: Column, then: Column | None = None) -> Column:
    """``first``, then the time ``at`` (null before all), then ``then``, then a hash, in one decimal: 1, 18, 1 and 18 digits."""
    digit = [F.coalesce(flag.cast("int"), F.lit(0)) for flag in (first, F.lit(False) if then is None else then)]
    micros = F.coalesce(F.unix_micros(at) + SINCE_YEAR_ONE, F.lit(0))
    rest = F.pmod(whole, F.lit(HASH_RANGE)).cast(WIDE)
    return _times(digit[0], 10**37) + _times(micros, 10**19) + _times(digit[1], HASH_RANGE) + rest
