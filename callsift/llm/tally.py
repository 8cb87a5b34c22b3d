"""How many documents hold each of many hashed features, asked and answered in blobs instead of rows.

Texts are staged once as compressed chunks, each a few MB with a number of its own. A chunk sends its distinct
feature hashes to the buckets of their leading bits; the task of a bucket sorts them and sends back, in the order they
came, how many documents have each. Nothing is broadcast or
collected; a feature that is everywhere is sent once by each chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import slices, stage

CHUNK_BYTES = 8 << 20
#: Keys (about) that the task of a bucket sorts, and the fewest buckets.
BUCKET_KEYS, LEAST_BUCKETS = 2 << 20, 128
#: Keys that are compared in full are few beside the others: their buckets are fewer by so many bits.
WHOLE_BITS = 4
#: The bit of a code that tells the first of the chunks that have a key.
FIRST = 1 << 15


def pickled(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def opened(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` (with a column text) staged as ``(chunk long, size long, payload binary)``; a longer text has a chunk of its own."""

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([pickled(pa.Table.from_batches(held))], pa.binary())], names=["chunk", "size", "payload"])

        for batch in slices(batches, limit=chunk_bytes // 4):
            more = batch.column("text").nbytes
            if held and size + more > chunk_bytes:
                yield made()
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += more
        if held:
            yield made()

    return stage(docs.mapInArrow(run, "chunk long, size long, payload binary"), "chunks")


def text_bytes(chunks: DataFrame) -> int:
    return chunks.agg(F.sum("size")).first()[0] or 0


def tally(chunks: DataFrame, keys_of: Callable[[pa.Table], np.ndarray | tuple[np.ndarray, np.ndarray]], keys_per_byte: float, firsts: bool = False) -> DataFrame:
    """``(chunk, bucket, codes binary)``: for the distinct keys of ``keys_of`` of a chunk, ascending, how many documents have them.

    ``keys_of`` gives the 64-bit keys of a chunk, one for each document that holds it. Counts are 16 bits wide and stop at
    65,535. Keys are compared by bucket and 32 more bits, so a count may be too high, in the same way for every
    holder, never too low. A second array of ``keys_of`` holds keys that are compared with one another only and in all their
    bits, so different ones are never counted together; their codes come after those of the first. With ``firsts`` their counts
    stop at 32,767, and the code of the smallest chunk that has a key carries FIRST as well.
    """
    total = int(text_bytes(chunks) * keys_per_byte)
    bits = max(LEAST_BUCKETS - 1, total // BUCKET_KEYS).bit_length()

    def asked(batches):
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload")):
                given = keys_of(opened(payload.as_py()))
                for whole, own in enumerate(given if isinstance(given, tuple) else (given,)):
                    keys, counts = np.unique(own, return_counts=True)
                    bucket = (keys >> np.uint64(64 - bits + WHOLE_BITS * whole)).astype(np.int64) + (whole << bits)
                    sent = keys if whole else (keys >> np.uint64(32 - bits)).astype(np.uint32)
                    counts = np.minimum(counts, 0xFFFF).astype(np.uint16)
                    numbers, at = np.unique(bucket, return_index=True)
                    to = np.append(at[1:], len(keys))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(numbers.astype(np.int32)),
                            pa.array(np.full(len(numbers), chunk, np.int64)),
                            pa.array([sent[a:b].tobytes() for a, b in zip(at, to)], pa.binary()),
                            pa.array([counts[a:b].tobytes() for a, b in zip(at, to)], pa.binary()),
                        ],
                        names=["bucket", "chunk", "keys", "counts"],
                    )

    def answered(bucket, rows):
        whole = bucket[0].as_py() >> bits
        if whole and firsts:
            rows = rows.sort_by("chunk")
        blobs = rows.column("keys").to_pylist()
        low = np.frombuffer(b"".join(blobs), np.uint64 if whole else np.uint32)
        sizes = [len(x) // low.itemsize for x in blobs]
        counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint16)
        if whole:
            order = np.argsort(low)
            ordered = low[order]
        else:
            ordered = np.sort(low.astype(np.uint64) << np.uint64(32) | np.arange(len(low), dtype=np.uint64))
            order = (ordered & np.uint64(0xFFFFFFFF)).astype(np.int64)
            ordered >>= np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        times = np.add.reduceat(counts[order], starts, dtype=np.int64)
        codes = np.empty(len(low), np.uint16)
        codes[order] = np.repeat(np.minimum(times, 0xFFFF).astype(np.uint16), np.diff(np.append(starts, len(low))))
        if whole and firsts:
            codes = np.minimum(codes, FIRST - 1)
            codes[np.minimum.reduceat(order, starts)] |= FIRST
        ends = np.cumsum(sizes)
        back = [codes[b - n : b].tobytes() for n, b in zip(sizes, ends)]
        return pa.table({"chunk": rows.column("chunk"), "bucket": pa.array([bucket[0].as_py()] * len(back), pa.int32()), "codes": pa.array(back, pa.binary())})

    questions = chunks.select("chunk", "payload").mapInArrow(asked, "bucket int, chunk long, keys binary, counts binary")
    return questions.groupBy("bucket").applyInArrow(answered, "chunk long, bucket int, codes binary")


def with_codes(chunks: DataFrame, codes: DataFrame, make: Callable, schema, rows: DataFrame | None = None, counts: bool = False) -> DataFrame:
    """``make(documents of a chunk, codes of its distinct keys, chunk)`` for every chunk.

    A code is the count (``counts``), or the bit length of n - 1 for a count n: 0 only for a key that no other document has.
    With ``rows(chunk, row)``, some of the chunks' documents by position, ``make`` also gets those positions.
    """
    placed = rows is not None
    if placed:
        codes = codes.unionByName(rows.groupBy("chunk").agg(F.collect_list("row").alias("rows")), allowMissingColumns=True)

    def run(left, right):
        blobs = right.filter(pc.is_valid(right.column("bucket"))).sort_by("bucket").column("codes").to_pylist()
        known = np.frombuffer(b"".join(blobs), np.uint16)
        known = known if counts else np.ceil(np.log2(known, dtype=np.float32)).astype(np.uint8)
        more = () if not placed else ([i for x in right.column("rows").to_pylist() if x is not None for i in x],)
        return make(opened(left.column("payload")[0].as_py()), known, left.column("chunk")[0].as_py(), *more)

    return chunks.select("chunk", "payload").groupBy("chunk").cogroup(codes.groupBy("chunk")).applyInArrow(run, schema)


def with_rows(chunks: DataFrame, rows: DataFrame, make: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``make(documents of a chunk, the rows that name it)`` for every chunk; no rows is an empty table."""

    def run(left, right):
        return make(opened(left.column("payload")[0].as_py()), right)

    return chunks.select("chunk", "payload").groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(run, schema)
