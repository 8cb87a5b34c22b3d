"""Labelled rows: which may be learned from, and isotonic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves remainder 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learnable(labels: DataFrame, name: str) -> DataFrame:
    """``(doc_id, y)`` of the rows with a 0/1 label that are not held out; a document labelled twice gets its lowest label."""
    y = F.col(name).cast("double")
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), y.alias("y")).where("doc_id is not null and y in (0, 1)")
    return rows.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"))


def pool(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over points ascending in ``x``: knots of a non-decreasing curve through weighted means."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x.tolist(), y.tolist(), w.tolist()):
        blocks.append([yi * wi, wi, xi, xi])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, v, _, high = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += v
            blocks[-1][3] = high
    xs = [v for b in blocks for v in ((b[2], b[3]) if b[3] > b[2] else (b[2],))]
    ys = [b[0] / b[1] for b in blocks for _ in range(2 if b[3] > b[2] else 1)]
    return np.array(xs), np.array(ys)
