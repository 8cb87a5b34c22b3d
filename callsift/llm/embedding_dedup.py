"""Embedding near-dedup: sign hashing in several tables, exact verification, connected components."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import discard, stage, table
from callsift.llm.components import components
from callsift.llm.registry import query

SEED = 11
#: Vectors that one task compares with one another at most.
BLOCK = 1024
#: Ids end here; what lies above stands for classes of vectors none of which has an id.
NAMELESS = (1 << 63) - (1 << 60)


def plan_tables(vectors: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits and tables for so many vectors: buckets of some 64 vectors if directions were even, and so many
    tables that a pair right at ``threshold`` meets in one of them with probability ``recall``."""
    bits = min(30, max(6, math.ceil(math.log2(max(vectors, 1) / 64 + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _planes(dimension: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, bits * tables))


def _unit(raw: list[bytes]) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no norm overflows or vanishes."""
    vectors = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _usable(batches):
    """Rows as (vec_id, raw): the components as doubles, null where the vector links with nothing."""
    for batch in batches:
        raw = []
        for x in batch.column("embedding").to_pylist():
            values = None if not x or None in x else np.array(x, np.float64)
            raw.append(values.tobytes() if values is not None and np.isfinite(values).all() and values.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], names=["vec_id", "raw"])


def _hashed(bits: int, tables: int, with_vectors: bool):
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for frame in batches:
            for at in range(0, len(frame), 2048):
                rows = frame.iloc[at : at + 2048]
                for size, own in rows.groupby(rows["raw"].str.len()):
                    signs = _unit(own["raw"].tolist()) @ _planes(size // 8, bits, tables) > 0
                    keys = (signs.reshape(len(own), tables, bits) * weights).sum(axis=2)
                    out = {"size": size, "tab": np.tile(np.arange(tables), len(own)), "key": keys.ravel(), "rep": np.repeat(own["rep"].to_numpy(), tables)}
                    if with_vectors:
                        every = np.repeat(np.arange(len(own)), tables)
                        packed = np.array([x.astype(np.int32).tobytes() for x in keys], dtype=object)
                        out |= {"copies": own["copies"].to_numpy()[every], "raw": own["raw"].to_numpy()[every], "signature": packed[every]}
                    yield pd.DataFrame(out)

    return run


def _verified(threshold: float):
    """Links within one block or between two of a bucket: for each vector the number of its partners
    (copies counted) that it meets in no earlier table, and the root of its partners as an edge."""
    from callsift.llm.common import local_roots

    def run(key, rows):
        _, tab, _, low, high = key
        own = rows["block"].to_numpy()
        left, right = (np.arange(len(rows)),) * 2 if low == high else (np.flatnonzero(own == low), np.flatnonzero(own == high))
        if not len(left) or not len(right) or len(rows) < 2:
            return pd.DataFrame({"node": [], "met": [], "peer": []}, dtype="int64")
        unit = _unit(rows["raw"].tolist())
        x, y = np.nonzero(unit[left] @ unit[right].T >= threshold)
        x, y = left[x], right[y]
        if low == high:
            x, y = x[x < y], y[x < y]
        signatures = np.frombuffer(b"".join(rows["signature"]), np.int32).reshape(len(rows), -1)[:, :tab]
        first = ~(signatures[x] == signatures[y]).any(axis=1)
        rep, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        met = np.zeros(len(rows), np.int64)
        np.add.at(met, x[first], copies[y[first]])
        np.add.at(met, y[first], copies[x[first]])
        nodes, roots = local_roots(rep[x], rep[y])
        linked = np.searchsorted(nodes, rep)
        known = linked < len(nodes)
        known[known] = nodes[linked[known]] == rep[known]
        return pd.DataFrame({"node": rep[known], "met": met[known], "peer": roots[linked[known]]})

    return run


def near_dedup(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.995, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with cosine >= ``threshold`` (in double precision) are linked. Equal vectors form one class first, so copies
    cost nothing and link with certainty. A pair of classes right at the threshold is found with probability
    ``recall``, closer pairs more often; no pair below it is linked. Null, empty, zero or non-finite vectors and
    those of another length link with nothing. Rows without ``vec_id`` are vectors like others, whose id comes after all others:
    their component is null only if no vector with an id is in it. Rows that repeat an id (or have none) count as
    vectors of their own. Buckets above ``block`` vectors are compared block by block in different tasks, in full.
    Each pair counts in the first table in which it meets, so tasks return sums and local trees, never pairs.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = stage(rows.mapInArrow(_usable, "vec_id long, raw binary"), "vectors")
    classes = rows.where("raw is not null").groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # A class without any id gets a number beyond the ids.
    classes = stage(classes.withColumn("rep", F.coalesce("rep", F.lit(NAMELESS) + F.monotonically_increasing_id())), "classes")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    key = ["size", "tab", "key"]
    counted = classes.mapInPandas(_hashed(bits, tables, False), "size int, tab int, key long, rep long")
    large = stage(counted.groupBy(*key).count().where(F.col("count") > block).select(*key, F.ceil(F.col("count") / block).cast("int").alias("blocks")), "large")
    hashed = classes.mapInPandas(_hashed(bits, tables, True), "size int, tab int, key long, rep long, copies long, raw binary, signature binary")
    dealt = hashed.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "copies", "raw", "signature")
    found = stage(dealt.groupBy(*key, "low", "high").applyInPandas(_verified(threshold), "node long, met long, peer long"), "links")
    met = found.groupBy("node").agg(F.sum("met").alias("met"))
    joined = components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    known = classes.join(met, classes.rep == met.node, "left").join(joined.withColumnRenamed("node", "member"), F.col("rep") == F.col("member"), "left")
    known = stage(
        known.select("raw", (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "known"
    )
    discard(large, found)
    out = rows.join(known, "raw", "left")
    component = F.when(F.col("component_id") < NAMELESS, F.col("component_id")).when(F.col("component_id").isNull(), F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


@query()
def op6_embedding_near_dedup(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "embeddings"))
