"""Exact dedup by content-defined chunk recipes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import flat, slices, stage, table
from callsift.llm.registry import query

SPACE = b" \t\n\x0b\x0c\r"
LEAST, MOST, CUT_BITS = 1 << 10, 1 << 16, 12
#: Bytes of a chunk hash; tests shorten it to provoke collisions.
HASH_BYTES = 16


def cut_points(data: np.ndarray, starts: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text. A cut depends on the 32 bytes before it, never on where a text lies."""
    gear = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
    rolled = gear[data]
    for step in (1, 2, 4, 8, 16):
        rolled[step:] += rolled[:-step] << np.uint32(step)
    marks = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends = []
    for at, to in zip(starts[:-1].tolist(), starts[1:].tolist()):
        own: list[int] = []
        if to - at > LEAST:
            last = at
            for mark in marks[np.searchsorted(marks, at + LEAST) : np.searchsorted(marks, to)].tolist():
                while mark - last > MOST:
                    last += MOST
                    own.append(last)
                if mark - last >= LEAST:
                    last = mark
                    own.append(last)
            while to - last > MOST:
                last += MOST
                own.append(last)
        if to > at and (not own or own[-1] < to):
            own.append(to)
        ends.append(own)
    return ends


def _normalized(column: pa.Array) -> tuple[bytes, np.ndarray]:
    data, starts = flat(column)
    keep = ~np.isin(data, np.frombuffer(SPACE, np.uint8))
    return data[keep].tobytes(), np.concatenate([[0], np.cumsum(keep)])[starts]


def _chunked(batch: pa.RecordBatch):
    """For each text its normalized bytes and its chunks."""
    whole, starts = _normalized(batch.column("text"))
    for at, to, ends in zip(starts[:-1].tolist(), starts[1:].tolist(), cut_points(np.frombuffer(whole, np.uint8), starts)):
        yield whole[at:to], [whole[x:y] for x, y in zip([at, *ends], ends)]


def _recipes(hash_bytes: int):
    def run(batches):
        for batch in slices(batches):
            rows = [(hashlib.sha256(text).hexdigest(), b"".join(xxhash.xxh3_128_digest(c)[:hash_bytes] for c in chunks)) for text, chunks in _chunked(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64()),
                    pa.array([x for x, _ in rows], pa.string()),
                    pa.array([x for _, x in rows], pa.binary()),
                ],
                names=["doc_id", "n_points", "text_sha256", "recipe"],
            )

    return run


def _chunks(hash_bytes: int):
    """Distinct chunks of each slice: a chunk that is everywhere leaves a task once per slice."""

    def run(batches):
        for batch in slices(batches):
            seen = {(xxhash.xxh3_128_digest(c)[:hash_bytes], c): None for _, chunks in _chunked(batch) for c in chunks}
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in seen], pa.binary()), pa.array([c for _, c in seen], pa.binary())], names=["hash", "content"])

    return run


def chunk_recipes(docs: DataFrame, hash_bytes: int = HASH_BYTES) -> DataFrame:
    """``(doc_id, n_points, text_sha256, recipe)``: the ordered list of verified chunk identifiers of each text.

    Every distinct chunk is moved once to the task of its hash and compared there byte by byte. A hash
    is an identifier where one content stands behind it. Where several do (never seen with 128 bits), the texts
    of that hash get recipes of hash and content.
    """
    texts = docs.select("doc_id", "text")
    recipes = stage(texts.mapInArrow(_recipes(hash_bytes), "doc_id long, n_points long, text_sha256 string, recipe binary"), "recipes")
    contents = texts.mapInArrow(_chunks(hash_bytes), "hash binary, content binary").repartition("hash").distinct()
    collided = stage(contents.groupBy("hash").count().where("count > 1").select("hash"), "collided")
    if collided.isEmpty():
        return recipes
    return _with_contents(texts, recipes, collided, hash_bytes)


def _with_contents(texts: DataFrame, recipes: DataFrame, collided: DataFrame, hash_bytes: int) -> DataFrame:
    """Identifiers of collided hashes become hash plus a second digest of the content, compared again below it."""

    def run(batches):
        for batch in slices(batches):
            rows = [b"".join(xxhash.xxh3_128_digest(c)[:hash_bytes] + hashlib.sha256(c).digest() for c in chunks) for _, chunks in _chunked(batch)]
            lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
            shas = [hashlib.sha256(text).hexdigest() for text, _ in _chunked(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lengths, pa.array(shas, pa.string()), pa.array(rows, pa.binary())], names=["doc_id", "n_points", "text_sha256", "recipe"])

    return stage(texts.mapInArrow(run, recipes.schema), "recipes")


def exact_dedup(docs: DataFrame, hash_bytes: int = HASH_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after removal of ASCII white space; null is empty, and all empty texts are
    equal. The longest original stays (code points), then the smallest doc_id; a null doc_id stays only where
    its group has no other. Rows that repeat an id and its text are all kept or all dropped, and all count.
    Other columns are ignored; an empty table gives no rows.
    """
    recipes = chunk_recipes(docs, hash_bytes)
    groups = stage(
        recipes.groupBy("recipe").agg(F.max(F.struct("n_points", (-F.col("doc_id")).alias("id"))).alias("best"), F.count(F.lit(1)).alias("group_size")).select("recipe", (-F.col("best.id")).alias("keep_id"), "group_size"),
        "groups",
    )
    return recipes.join(groups, "recipe").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


@query(
    r"""select doc_id, first(doc_id) over g keep_id, count(*) over (partition by norm) group_size, doc_id = first(doc_id) over g as kept, sha256(norm) text_sha256
    from (select doc_id, coalesce(text, '') t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') norm from documents)
    window g as (partition by norm order by length(t) desc, doc_id rows between unbounded preceding and unbounded following)"""
)
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
