"""Vectors as integers: conversion, a byte form that sorts like the components, and exact sums by slot."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components are held within this bound, so that a squared distance over 64 of them fits a long.
HELD = 1 << 27
LONGEST = (1 << 63) - 1
SUMS = "slot int, at int, total long"


def matrix(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column of doubles with ``dimension`` components, none null or non-finite: which, and their components."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dimension)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dimension)
    finite = np.isfinite(values).all(axis=1)
    return rows[finite], values[finite]


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` held within ``HELD``."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -HELD, HELD).astype(np.int64)


def packed(vectors: np.ndarray) -> list[bytes]:
    """Each vector as bytes that sort like its components."""
    return [row.tobytes() for row in (vectors + (1 << 31)).astype(">u4")]


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u4").reshape(len(column), dimension).astype(np.int64) - (1 << 31)


class Totals:
    """Componentwise sums and counts of vectors by slot, as far as one task has seen them."""

    def __init__(self, slots: int, width: int):
        self.sums = np.zeros((slots, width + 1), np.int64)

    def add(self, slot: np.ndarray, vectors: np.ndarray) -> None:
        if not len(slot):
            return
        order = np.argsort(slot, kind="stable")
        ranked = slot[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        self.sums[ranked[starts], :-1] += np.add.reduceat(vectors[order], starts, axis=0)
        self.sums[ranked[starts], -1] += np.diff(np.r_[starts, len(ranked)])

    def rows(self) -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(self.sums[:, -1])
        width = self.sums.shape[1]
        slot, at = np.repeat(used, width).astype(np.int32), np.tile(np.arange(width, dtype=np.int32), len(used))
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(at), pa.array(self.sums[used].ravel())], names=["slot", "at", "total"])


def settled(partial: DataFrame, entries: np.ndarray) -> np.ndarray:
    """Entries replaced by the exact ``floor(sum / count)`` of what fell to them; unused ones stay.

    ``partial`` holds the rows of ``Totals`` of all tasks. The driver receives one number per component of the
    model, whatever the number of vectors.
    """
    total = partial.groupBy("slot", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = {(r.slot, r.at): int(r.total) for r in total.collect()}
    width = entries.shape[1]
    out = entries.copy()
    for slot in {slot for slot, _ in sums}:
        out[slot] = [sums[slot, at] // sums[slot, width] for at in range(width)]
    return out


def held_long(total):
    """A sum of longs as a long, held at the largest one."""
    return F.least(total, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
