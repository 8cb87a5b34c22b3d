"""Centroid clustering with integer components; the nearest centroid is found by Orchard's search."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.common import cleaned, stage, table
from callsift.llm.fixed_point import LONGEST, SUMS, Totals, integers, matrix, packed, settled, unpacked
from callsift.llm.registry import query

#: Vectors that a search walks with at once.
SLICE = 4096


class Lists:
    """For every centroid all others, nearest first, and a quarter of their squared distance, rounded up.

    A search at squared distance d from its centroid may stop where the list is strictly beyond twice that distance:
    D > 4 d, which for integers is the same as ceil(D / 4) > d and needs no larger numbers.
    """

    def __init__(self, centroids: np.ndarray):
        k = len(centroids)
        self.centroids = centroids
        self.order = np.zeros((k, max(k - 1, 0)), np.int32)
        self.quarter = np.zeros(self.order.shape, np.int64)
        for c in range(k):
            gap = _squared(centroids, centroids[c])
            own = np.lexsort((np.arange(k), gap))
            own = own[own != c]
            self.order[c], self.quarter[c] = own, -(-gap[own] // 4)
        # The centroid with the shortest way to all others.
        self.middle = int(self.quarter.astype(np.float64).sum(axis=1).argmin()) if k else 0


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def nearest(vectors: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid (ties: the smaller number) and its squared distance.

    All vectors walk at once, each along the list of its current centroid. A closer one, or an equally close one with a
    smaller number, makes the vector jump to the head of that one's list; visited centroids are not compared again.
    A centroid that is as close as the current one lies at most twice the distance away, so ties are met before the stop.
    """
    n, last = len(vectors), lists.order.shape[1]
    current = np.full(n, lists.middle)
    best = _squared(vectors, lists.centroids[current])
    visited = np.zeros((n, last + 1), bool)
    visited[:, lists.middle] = True
    place = np.zeros(n, np.int64)
    walking = np.arange(n)
    while len(walking := walking[place[walking] < last]):
        here, at = current[walking], place[walking]
        near = lists.quarter[here, at] <= best[walking]
        walking, other = walking[near], lists.order[here[near], at[near]]
        place[walking] += 1
        new = ~visited[walking, other]
        row, other = walking[new], other[new]
        visited[row, other] = True
        gap = _squared(vectors[row], lists.centroids[other])
        closer = (gap < best[row]) | ((gap == best[row]) & (other < current[row]))
        row = row[closer]
        current[row], best[row], place[row] = other[closer], gap[closer], 0
    return current, best


def _converted(scale: int, dimension: int):
    def run(batches):
        for batch in batches:
            rows, values = matrix(batch.column("embedding"), dimension)
            ids = batch.column("vec_id").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(packed(integers(values, scale)), pa.binary())], names=["vec_id", "v"])

    return run


def _slices(batches, dimension: int):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, unpacked(part.column("v"), dimension)


def _summed(centroids: np.ndarray):
    def run(batches):
        lists, totals = Lists(centroids), Totals(*centroids.shape)
        for _, vectors in _slices(batches, centroids.shape[1]):
            totals.add(nearest(vectors, lists)[0], vectors)
        yield from totals.rows()

    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        lists = Lists(centroids)
        for part, vectors in _slices(batches, centroids.shape[1]):
            cluster, distance = nearest(vectors, lists)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def starts(vectors: DataFrame, k: int, seed: int, dimension: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest sha256 of ``seed:vec_id``, in that order."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(by.asc_nulls_last(), "v").limit(k).select("v").collect()
    return unpacked(pa.array([bytes(r.v) for r in rows], pa.binary()), dimension)


@cleaned
def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, dimension: int = 64) -> DataFrame:
    """One row per vector that counts: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A vector counts if it has exactly ``dimension`` components, none null or non-finite; others are left out, and an empty
    table gives no rows. Components become ``floor(scale * x)``, held within +-2^27. The first centroids are ``starts``;
    with fewer than ``k`` vectors there are as many clusters as vectors. Rows with a null id count as vectors but start no
    centroid before all others; rows that repeat an id count one by one, as do equal vectors (ties among the starts: smaller
    components first). Sums beyond a long are held at its end. Other columns are not read.

    Every round is one pass over the converted vectors in which each task returns at most k x (dimension + 1) sums, so a
    cluster that holds most rows is no larger group than any other. ``k`` and ``dimension`` bound what the driver holds.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kept = stage(rows.mapInArrow(_converted(scale, dimension), "vec_id long, v binary"), "integers")
    centroids = starts(kept, k, seed, dimension)
    for _ in range(rounds if len(centroids) else 0):
        centroids = settled(kept.mapInArrow(_summed(centroids), SUMS), centroids)
    found = stage(kept.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), "assigned")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    by_cluster = {r.cluster: int(r.d) for r in inertia.collect()}
    named = [(c, d, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, d in sorted(by_cluster.items())]
    # At most k rows.
    own = vectors.sparkSession.createDataFrame(
        [(c, min(d, LONGEST), min(sum(by_cluster.values()), LONGEST), digest) for c, d, digest in named],
        T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string"),
    )
    return found.join(F.broadcast(own), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int, rounds: int, seed: int, scale: int, dimension: int) -> str:
    steps = [
        f"""kept as materialized (
    select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
    from embeddings where len(embedding) = {dimension} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dimension})""",
        f"""c0 as materialized (
    select row_number() over (order by sha256('{seed}:' || vec_id), v) - 1 as c, v from kept qualify c < {k})""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} as materialized (
    select rid, min(struct_pack(d := list_sum(list_transform(range(1, {dimension + 1}),
        lambda i: (kept.v[i] - c{r}.v[i]) * (kept.v[i] - c{r}.v[i])))::bigint, c := c)) as near
    from kept, c{r} group by rid)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} as materialized (
    select c{r}.c, coalesce(m.v, c{r}.v) as v from c{r} left join (
        select c, list(x order by i) as v from (
            select near.c as c, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) as x
            from kept join a{r} using (rid), range(1, {dimension + 1}) as t(i) group by near.c, i) group by c) m using (c))"""
            )
    return f"""with {", ".join(steps)}
select vec_id, near.c::int as cluster, near.d as distance, (sum(near.d) over (partition by near.c))::bigint as cluster_inertia,
    (sum(near.d) over ())::bigint as inertia, sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256
from kept join a{rounds} using (rid) join c{rounds} on c{rounds}.c = near.c"""


@query(_oracle(8, 10, 3, 1024, 64))
def op11_centroid_clustering(spark, sf_dir):
    return clusters(table(spark, sf_dir, "embeddings"))
