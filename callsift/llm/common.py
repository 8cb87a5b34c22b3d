"""Staging, Arrow text access and grouping helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from callsift.session import work_dir

SLICE_BYTES = 4 << 20


#: Staged frames of the operators at work, innermost last.
_OPEN: list[list[DataFrame]] = []
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write below ``spark.checkpoint.dir`` and read back: computed once, and a lost executor loses nothing.

    The written table replaces the shuffles behind it, so their files go at the end of the write.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("error").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    if _OPEN:
        _OPEN[-1].append(back)
    return back


def cleaned(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose result is staged, so that everything it has staged on the way can be deleted."""

    @functools.wraps(operator)
    def run(*args, **options) -> DataFrame:
        _OPEN.append(frames := [])
        try:
            result = operator(*args, **options)
            _OPEN.append([])
            try:
                out = stage(result, operator.__name__)
            finally:
                _OPEN.pop()
        finally:
            _OPEN.pop()
            discard(*frames)
        if _OPEN:
            _OPEN[-1].append(out)
        return out

    return run


def discard(*frames: DataFrame) -> None:
    """Delete staged frames that nothing will read again."""
    for df in frames:
        if path := getattr(df, "staged_at", None):
            jvm = df.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column in one array, and where each row starts (one more than rows); null is empty."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks or [pa.array([], pa.binary())])
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def numbers(blob: bytes, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(blob, kind)


def ramp(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``counts``, in one array."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) - np.repeat(ends - counts, counts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges a-b, ascending, and for each the smallest node that it is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]
