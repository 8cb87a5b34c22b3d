"""Jaccard join on word n-grams with an R-tree over count vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import SLICE_BYTES, cleaned, discard, flat, mix, stage, table
from callsift.llm.components import components
from callsift.llm.registry import query
from callsift.llm.rtree import CountTree
from callsift.llm.tally import chunked, opened, tally, with_codes

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
#: Groups that the members of a set are counted in: the coordinates of its point.
DIMENSIONS = 128
#: Sets that one task compares with one another at most, and sets of a group that all others are compared with first.
BLOCK, LEADERS = 2048, 4
MULTIPLIERS = np.random.default_rng(23).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Multiplier of the words' polynomial hash and its inverse modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Words of more bytes are hashed one by one: the polynomial is only trusted with short ones.
LONG_WORD = 256


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of some texts, A-Z lowered, and where each text's words begin (one more than texts).

    A word's hash is a difference of running sums of byte values times powers, divided by the power at its start.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    first[edges] = inside[edges]
    begin = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    values = np.random.default_rng(29).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER[data]]
    powers = np.full(len(data), BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(values * powers)])
    back = np.full(len(data), INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashes = mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(LOWER[data[begin[i] : end[i]]].tobytes())
    return hashes, np.searchsorted(begin, starts)


class Shingler:
    """Sets of hashed word n-grams."""

    def __init__(self, width: int = WORDS):
        self.width = width

    def sets(self, texts: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
        """Ascending distinct hashes per text: A-Z lowered, words between ASCII white space, ``width`` words each; a text of
        fewer words is one member, without words none."""
        data, starts = flat(texts)
        out: list[np.ndarray] = []
        at = 0
        while at < len(starts) - 1:
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE_BYTES, side="right")) - 1)
            hashes, edge = word_hashes(data[starts[at] : starts[to]], starts[at : to + 1] - starts[at])
            grams = np.zeros(max(0, len(hashes) - self.width + 1), np.uint64)
            for i in range(self.width):
                grams += hashes[i : i + len(grams)] * MULTIPLIERS[i]
            grams = mix(grams)
            for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if y - x >= self.width:
                    out.append(np.unique(grams[x : y - self.width + 1]))
                elif y > x:
                    out.append(mix((hashes[x:y] * MULTIPLIERS[8 : 8 + y - x]).sum(keepdims=True, dtype=np.uint64) + np.uint64(y - x)))
                else:
                    out.append(np.zeros(0, np.uint64))
            at = to
        return out


def _known(width: int):
    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload")):
                documents = opened(payload.as_py())
                sets = shingler.sets(documents.column("text"))
                signatures = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sets), chunk, np.int64)),
                        pa.array(np.arange(len(sets), dtype=np.int32)),
                        documents.column("doc_id").combine_chunks(),
                        pa.array(signatures, pa.binary()),
                        pa.array([len(x) for x in sets], pa.int64()),
                    ],
                    names=["chunk", "row", "doc_id", "signature", "n_shingles"],
                )

    return run


def _prefixes(width: int):
    """Documents that may have a partner: the features of the prefix that others have too, the point and the set.

    In any common order of features, two sets that are similar enough share one of the first n - ceil(share n) + 1. Rare ones
    come first, so a passage that is everywhere stays out of the prefix unless a text consists of little else.
    """
    shingler = Shingler(width)

    def make(documents, codes, _, first):
        first = set(first)
        sets = shingler.sets(documents.column("text"))
        ends = np.cumsum([0, *map(len, sets)])
        every = codes[np.unique(np.concatenate(sets), return_inverse=True)[1]] if ends[-1] else codes
        rows = []
        for i, (doc, own, at, to) in enumerate(zip(documents.column("doc_id").to_pylist(), sets, ends[:-1].tolist(), ends[1:].tolist())):
            if i not in first:
                continue
            code = every[at:to]
            need = len(own) - -(-NUMERATOR * len(own) // DENOMINATOR) + 1
            if int((code == 0).sum()) >= need:
                continue
            order = np.lexsort((own, code))[:need]
            prefix = own[order[code[order] > 0]]
            point = np.bincount((own % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)
            rows.append((doc, len(own), float(code.mean()), prefix.view(np.int64).tolist(), point.astype(np.uint32).tobytes(), own.tobytes()))
        columns = list(zip(*rows)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "size", "centrality", "prefix", "point", "members"])

    return make, "doc_id long, size long, centrality double, prefix array<long>, point binary, members binary"


def _first_common(prefixes: list[np.ndarray], token: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pairs whose smallest common prefix feature is ``token``: each pair is reported by one group only."""
    lengths = [len(p) for p in prefixes]
    row = np.repeat(np.arange(len(prefixes)), lengths)
    every = np.concatenate(prefixes)
    values, at, times = np.unique(every, return_inverse=True, return_counts=True)
    useful = (times > 1) & (values < token)
    number = np.cumsum(useful) - 1
    bits = np.zeros((len(prefixes), (int(useful.sum()) + 63) // 64), np.uint64)
    own = useful[at]
    bit = number[at[own]]
    np.bitwise_or.at(bits, (row[own], bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    first = np.ones(len(x), bool)
    for w in range(bits.shape[1]):
        first &= bits[x, w] & bits[y, w] == 0
    return first


def _grouped(share: float, leaders: int | None):
    """Pairs of one feature's sets that the R-tree can't rule out. With ``leaders``: only pairs with one of the sets that
    consist most of what others have too."""

    def run(key, rows):
        token, low, high = (k.as_py() for k in key)
        size = rows.column("size").to_numpy()
        docs = rows.column("doc_id").to_numpy()
        points = np.frombuffer(b"".join(rows.column("point").to_pylist()), np.uint32).reshape(len(size), -1)
        tree = CountTree(points, size, rows.column("class").to_numpy())
        if leaders is not None:
            lead = np.zeros(len(size), bool)
            lead[np.lexsort((docs, -rows.column("centrality").to_numpy()))[:leaders]] = True
            x, y = tree.pairs(share, lead, ~lead)
            one, other = tree.pairs(share, lead, lead)
            x, y = np.concatenate([x, one]), np.concatenate([y, other])
        elif low == high:
            x, y = tree.pairs(share)
        else:
            block = rows.column("block").to_numpy()
            x, y = tree.pairs(share, block == low, block == high)
        if len(x):
            first = _first_common([np.array(p) for p in rows.column("prefix").to_pylist()], token, x, y)
            x, y = x[first], y[first]
        a, b = np.minimum(docs[x], docs[y]), np.maximum(docs[x], docs[y])
        return pa.table({"a": a, "b": b})

    return run


def _verified(batches):
    """Pairs whose sets are similar enough, counted exactly."""
    for batch in batches:
        one, other = batch.column("one").to_pylist(), batch.column("other").to_pylist()
        keep = []
        for x, y in zip(one, other):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], names=["a", "b"])


def _links(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    pairs = stage(pairs.where("a != b").distinct(), "pairs")
    members = candidates.select("doc_id", "members")
    one = pairs.join(members.select(F.col("doc_id").alias("a"), F.col("members").alias("one")), "a")
    both = one.join(members.select(F.col("doc_id").alias("b"), F.col("members").alias("other")), "b")
    return stage(both.select("a", "b", "one", "other").mapInArrow(_verified, "a long, b long"), "links")


def _groups(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(candidates with the features that are to be compared by, pairs of groups of two)``.

    Features that the same documents have stand for one another: of each such class (by count and three sums of 32 bits of
    the documents' hashes, in which ids that are repeated don't cancel) one is kept. Most are had by two documents only,
    which are a pair as they are.
    """
    tokens = candidates.select("doc_id", F.explode("prefix").alias("token"))
    one, other = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))
    sums = (F.sum(F.shiftrightunsigned(one, 32)).alias("x"), F.sum(one.bitwiseAND(F.lit(0xFFFFFFFF))).alias("y"), F.sum(F.shiftrightunsigned(other, 32)).alias("z"))
    met = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *sums, F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    met = stage(met.where("n > 1").groupBy("n", "x", "y", "z").agg(F.min("token").alias("token"), F.min("a").alias("a"), F.max("b").alias("b")), "tokens")
    kept = tokens.join(met.where("n > 2").select("token", "n"), "token").groupBy("doc_id").agg(F.collect_list(F.struct("token", "n")).alias("groups"))
    rows = candidates.drop("members").join(kept, "doc_id")
    rows = rows.select("doc_id", "size", "centrality", "point", F.col("groups.token").alias("prefix"), "groups")
    return stage(rows, "groups"), met.where("n = 2").select("a", "b")


def near_links(chunks: DataFrame, firsts: DataFrame, width: int = WORDS) -> DataFrame:
    """``links(a, b)`` between documents, such that they connect exactly what all similar pairs connect: sets that an earlier
    link connects are not compared again.

    ``firsts(chunk, row)``: one document for each set. How often a feature occurs is counted over all documents, which
    saves moving the texts once more: a set with copies at most keeps some features that only its copies have.
    """
    share = NUMERATOR / DENOMINATOR
    codes = tally(chunks, lambda documents: np.concatenate([np.zeros(0, np.uint64), *Shingler(width).sets(documents.column("text"))]), 1 / 6)
    make, schema = _prefixes(width)
    candidates = stage(with_codes(chunks, codes, make, schema, firsts), "candidates")
    groups, twos = _groups(candidates)

    def dealt(classes: DataFrame, leaders: int | None) -> DataFrame:
        own = classes.select("doc_id", "size", "centrality", "prefix", "point", "class", F.explode("groups").alias("group"))
        own = own.withColumn("token", F.col("group.token"))
        blocks = F.ceil(F.col("group.n") / BLOCK).cast("int")
        own = own.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
        if leaders is None:
            closed = classes.select("class", F.explode("groups.token").alias("token")).groupBy("token").agg(F.min("class").alias("least"), F.max("class").alias("most"))
            own = own.join(stage(closed.where("least != most").select("token"), "open"), "token", "left_semi")
            own = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            own = own.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        else:
            own = own.withColumn("low", F.col("block")).withColumn("high", F.col("block"))
        own = own.select("token", "doc_id", "size", "centrality", "prefix", "point", "class", "block", "low", "high")
        return own.groupBy("token", "low", "high").applyInArrow(_grouped(share, leaders), "a long, b long")

    first = _links(dealt(groups.withColumn("class", F.col("doc_id")), LEADERS).unionByName(twos), candidates)
    found = components(first).withColumnRenamed("node", "doc_id")
    classes = stage(groups.join(found, "doc_id", "left").withColumn("class", F.coalesce("component", "doc_id")).drop("component"), "classes")
    second = _links(dealt(classes, None), candidates)
    discard(groups, classes)
    return first.unionByName(second)


@cleaned
def near_duplicates(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when their sets of ``width``-word shingles have a Jaccard index of 0.75 or more; equal sets are one from the
    start. component_id is the smallest id reachable by links. A null, empty or blank text has no shingles and links
    with nothing. Rows that repeat an id count as one node where their sets are equal; rows without an id are returned,
    and have the component of an equal set with an id, if there is one.
    """
    chunks = chunked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    places = stage(chunks.select("chunk", "payload").mapInArrow(_known(width), "chunk long, row int, doc_id long, signature binary, n_shingles long"), "known")
    known = places.select("doc_id", "signature", "n_shingles")
    classes = stage(known.where("signature is not null and doc_id is not null").groupBy("signature").agg(F.min("doc_id").alias("first")), "classes")
    firsts = places.join(classes.select("signature", F.col("first").alias("doc_id")), ["signature", "doc_id"]).groupBy("signature", "doc_id").agg(F.min(F.struct("chunk", "row")).alias("place"))
    links = near_links(chunks, stage(firsts.select("place.chunk", "place.row"), "firsts"), width)
    found = components(links)
    classes = stage(classes.join(found.withColumnRenamed("node", "first"), "first", "left").select("signature", F.coalesce("component", "first").alias("component")), "classes")
    out = known.join(classes, "signature", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


@cleaned
def keep_one(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """Of each component of similar documents the one with the smallest id, with all its columns. Rows that repeat that id
    are the same document and stay; rows without an id can't be told apart and stay."""
    kept = near_duplicates(docs, width).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))


@query()
def op1_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
