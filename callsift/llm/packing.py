"""Best-fit packing by a grouping genetic algorithm on islands with elite migration."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.bpe import encoded, shared
from callsift.llm.common import stage, table
from callsift.llm.registry import query

CAPACITY = 2048
#: Pieces (about) that are packed with one another; a shard's rest costs less than one sequence.
SHARD = 12_000
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 5, 4
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Bins:
    """A packing under construction: the bin of each item, and the open bins by free space.

    A bit mask has the free spaces that occur, so the tightest bin that takes an item is one shift away.
    """

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bin = np.full(len(sizes), -1, np.int64)
        self.count, self.mask = 0, 0
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def keep(self, bins: np.ndarray) -> None:
        """Take over items that have a bin (not -1), under new numbers."""
        held = bins >= 0
        numbers, own = np.unique(bins[held], return_inverse=True)
        self.bin[held] = own
        self.count = len(numbers)
        space = self.capacity - np.bincount(own, self.sizes[held], minlength=self.count).astype(np.int64)
        for i, left in enumerate(space.tolist()):
            if left:
                self.free[left].append(i)
                self.mask |= 1 << left

    def best_fit(self, items: np.ndarray) -> None:
        """Each item in turn goes where least space remains, or into a new bin."""
        free, mask, placed = self.free, self.mask, []
        for size in self.sizes[items].tolist():
            fitting = mask >> size
            if fitting:
                space = size + (fitting & -fitting).bit_length() - 1
                number = free[space].pop()
                if not free[space]:
                    mask ^= 1 << space
            else:
                space, number = self.capacity, self.count
                self.count += 1
            placed.append(number)
            left = space - size
            if left:
                if not free[left]:
                    mask |= 1 << left
                free[left].append(number)
        self.mask = mask
        self.bin[items] = placed


def fitness(bins: np.ndarray, sizes: np.ndarray) -> tuple[int, float]:
    """Fewer bins are better; of equally many, unevenly filled ones, as they leave room that can be used."""
    fill = np.bincount(bins, sizes)
    return -len(fill), float((fill**2).sum())


def fresh(sizes: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    made = Bins(sizes, capacity)
    made.best_fit(np.argsort(-sizes * (1 - noise * rng.random(len(sizes))), kind="stable"))
    return made.bin


def cross(base: np.ndarray, donor: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Child of ``base`` with whole well-filled bins of ``donor``: bins of ``base`` that hold one of their items go, and
    the items displaced with them, as well as those of its emptiest bins, are best-fitted, largest first."""
    fill = np.bincount(donor, sizes)
    full = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    taken = np.zeros(len(fill), bool)
    taken[rng.choice(full, max(1, len(full) // 8), replace=False)] = True
    injected = taken[donor]
    own = np.bincount(base, sizes)
    broken = np.zeros(len(own), bool)
    broken[base[injected]] = True
    broken[np.argsort(own, kind="stable")[: max(1, len(own) // 50)]] = True
    kept = ~broken[base] & ~injected
    child = Bins(sizes, capacity)
    child.keep(np.where(injected, len(own) + donor, np.where(kept, base, -1)))
    displaced = np.flatnonzero(~injected & ~kept)
    child.best_fit(displaced[np.argsort(-sizes[displaced], kind="stable")])
    return child.bin


def evolve(sizes: np.ndarray, seeds: list[np.ndarray], capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Best packing after some generations of a population that starts from ``seeds`` and fresh packings."""
    ranked = lambda pool: sorted(pool, key=lambda x: fitness(x, sizes), reverse=True)
    population = [*seeds]
    while len(population) < POPULATION:
        population.append(fresh(sizes, capacity, rng, 0.0 if not population else 0.1 * len(population)))
    population = ranked(population)
    least = -(-int(sizes.sum()) // capacity)
    for _ in range(GENERATIONS):
        if -fitness(population[0], sizes)[0] == least:
            break
        pairs = [rng.choice(POPULATION, 2, replace=False) for _ in range(POPULATION // 2)]
        population = ranked([*population, *(cross(population[a], population[b], sizes, capacity, rng) for a, b in pairs)])[:POPULATION]
    return population[0]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens: the ids of the whole text, then id 0; of longer ones, the first
    piece takes what full pieces leave over."""
    model = shared(docs.sparkSession, path)

    def run(batches):
        for batch, ids, ends in encoded(batches, model.value):
            rows = []
            for i, (at, to) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                own = np.append(ids[at:to], 0).astype("<u4")
                start, n = 0, 0
                stop = (len(own) - 1) % capacity + 1
                while start < len(own):
                    rows.append((i, n, start, stop - start, zlib.crc32(own[start:stop].tobytes())))
                    start, stop, n = stop, stop + capacity, n + 1
            row, n, start, length, crc = (np.array(x, np.int64) for x in zip(*rows))
            doc_id = batch.column("doc_id").cast(pa.int64()).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(n.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _gathered(shard, rows):
    rows = rows.drop(["shard"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
    sizes = rows.column("length").to_numpy().astype(np.int64).tobytes()
    return pa.table({"shard": [shard[0].as_py()], "sizes": [sizes], "items": [_ipc(rows)]}, schema=pa.schema([("shard", pa.int64()), ("sizes", pa.binary()), ("items", pa.binary())]))


def _evolved(capacity: int, epoch: int):
    def run(key, rows):
        sizes = np.frombuffer(rows["sizes"].dropna().iloc[0], np.int64)
        seeds = [np.frombuffer(x, np.int64) for x in rows["packing"].dropna()]
        best = evolve(sizes, seeds, capacity, np.random.default_rng([*map(int, key), epoch]))
        return pd.DataFrame({"shard": [key[0]], "island": [key[1]], "packing": [best.tobytes()]})

    return run


def _assigned(shard, rows):
    """Rows of a shard with their place in the best packing of its islands."""
    whole = rows.to_pydict()
    sizes = np.frombuffer(next(x for x in whole["sizes"] if x is not None), np.int64)
    best = max((np.frombuffer(x, np.int64) for x in sorted(x for x in whole["packing"] if x is not None)), key=lambda x: fitness(x, sizes))
    items = pa.ipc.open_stream(next(x for x in whole["items"] if x is not None)).read_all()
    order = np.argsort(best, kind="stable")
    first = np.concatenate([[True], np.diff(best[order]) > 0])
    before = np.cumsum(sizes[order]) - sizes[order]
    offset = np.empty(len(best), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return items.append_column("sequence_id", pa.array((shard[0].as_py() << 32) + best)).append_column("offset", pa.array(offset))


def pack(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``items(doc_id, piece, start, length, ids_crc32)`` with sequence_id and offset.

    A full piece is a sequence of its own. The others are dealt evenly into shards of some ``shard`` pieces, whatever
    their source. Every shard is packed on ``ISLANDS`` islands, each a task with its own population; after an epoch the
    best packing of an island moves on to the next one. Only sizes and packings travel between tasks. A piece
    longer than ``capacity`` is an error.
    """
    items = stage(items, "pieces")
    total = items.where(F.col("length") < capacity).count()
    shards = max(1, -(-total // shard))
    part = items.where(F.col("length") < capacity).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))
    gathered = stage(part.groupBy("shard").applyInArrow(_gathered, "shard long, sizes binary, items binary"), "shards")
    none = F.lit(None).cast("binary")
    islands = gathered.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "sizes", none.alias("packing"))
    packed = None
    for epoch in range(EPOCHS):
        rows = islands
        if packed is not None:
            moved = packed.withColumn("island", (F.col("island") + 1) % ISLANDS)
            rows = islands.unionByName(packed.unionByName(moved).select("shard", "island", none.alias("sizes"), "packing"))
        packed = stage(rows.groupBy("shard", "island").applyInPandas(_evolved(capacity, epoch), "shard long, island int, packing binary"), "packings")
    last = gathered.select("shard", "sizes", "items", none.alias("packing")).unionByName(packed.select("shard", none.alias("sizes"), none.alias("items"), "packing"))
    placed = last.groupBy("shard").applyInArrow(_assigned, f"{PIECE}, sequence_id long, offset long")
    full = items.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(full)


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece of every row of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of the single id 0. Repeated rows and rows without an id are packed like any
    other. Other columns are ignored; an empty table gives no rows.
    """
    return pack(pieces(docs, capacity, path), capacity)


@query()
def op5_best_fit_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"))
