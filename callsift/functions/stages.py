"""Plan shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: dict[str, Column], drop: list[str] = ()) -> DataFrame:
    """``withColumns`` whose results later steps read instead of recomputing.

    The optimizer copies projected expressions into every filter above them, which for a parsed and
    validated document means parsing it once per mention. A one-row generator is where it stops.
    """
    kept = [name for name in df.columns if name not in columns and name not in drop]
    fresh = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(fresh)))
