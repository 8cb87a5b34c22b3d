"""Vector code compression: codebooks per part, distances looked up in dictionaries of the values that each dimension takes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import cleaned, stage, table
from callsift.llm.fixed_point import SUMS, Totals, held_long, integers, matrix, packed, settled, unpacked
from callsift.llm.registry import query

#: Vectors that share one set of dictionaries; their codes fit 16 bits whatever the values are.
SLICE = 8192
HEX = np.array([f"{i:02x}".encode() for i in range(256)], dtype="S2")


class Slice:
    """Vectors of one slice as codes into the dictionaries of their dimensions."""

    def __init__(self, dimension: int, sizes: bytes, values: bytes, codes: bytes):
        ends = np.cumsum(np.frombuffer(sizes, np.int32))
        self.dictionaries = np.split(np.frombuffer(values, np.int32).astype(np.int64), ends[:-1])
        self.codes = np.frombuffer(codes, np.uint16).reshape(dimension, -1)

    def vectors(self) -> np.ndarray:
        return np.stack([d[c] for d, c in zip(self.dictionaries, self.codes)], axis=1)

    def nearest(self, part: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest of a part's ``entries`` (entries x width; ties: the lower index), and the squared distance.

        Per dimension, the squared differences of every dictionary value to all entries are tabulated once; a vector's
        distances are the sum of the rows that its codes name.
        """
        width = entries.shape[1]
        tables = [(d[:, None] - entries[None, :, j]) ** 2 for j, d in enumerate(self.dictionaries[part * width : (part + 1) * width])]
        if sum(int(t.max()) for t in tables) < 1 << 31:
            tables = [t.astype(np.int32) for t in tables]
        distance = tables[0][self.codes[part * width]]
        for j, t in enumerate(tables[1:], 1):
            distance += t[self.codes[part * width + j]]
        index = distance.argmin(axis=1)
        return index, distance[np.arange(len(index)), index].astype(np.int64)


def _dictionaries(scale: int):
    """One row per slice of vectors of one length: their ids, labels, dictionaries and codes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                column = part.column("embedding")
                for dimension in sorted(pc.unique(pc.drop_null(pc.list_value_length(column))).to_pylist()):
                    rows, values = matrix(column, dimension)
                    if not len(rows):
                        continue
                    coded = [np.unique(x, return_inverse=True) for x in integers(values, scale).T]
                    ids, labels = (pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), part.column(c).take(pa.array(rows))) for c in ("vec_id", "label"))
                    blobs = (
                        np.array([len(d) for d, _ in coded], np.int32).tobytes(),
                        b"".join(d.astype(np.int32).tobytes() for d, _ in coded),
                        b"".join(c.astype(np.uint16).tobytes() for _, c in coded),
                    )
                    counts = [pa.array([dimension], pa.int32()), pa.array([len(rows)], pa.int32())]
                    yield pa.RecordBatch.from_arrays(
                        [*counts, ids, labels, *(pa.array([b], pa.binary()) for b in blobs)], names=["dimension", "n", "ids", "labels", "sizes", "dictionary", "codes"]
                    )

    return run


def _each(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            blobs = (row.column(c)[0].as_py() for c in ("sizes", "dictionary", "codes"))
            yield row, Slice(row.column("dimension")[0].as_py(), *blobs)


def _smallest(count: int):
    """The ``count`` vectors of each slice that come first by id, then components; null ids last."""

    def run(batches):
        for row, own in _each(batches):
            ids, raw = row.column("ids").flatten(), pa.array(packed(own.vectors()), pa.binary())
            rows = pa.table({"vec_id": ids, "v": raw})
            rows = rows.take(pc.sort_indices(rows, [("vec_id", "ascending"), ("v", "ascending")])[:count])
            yield from rows.combine_chunks().to_batches()

    return run


def _summed(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches):
        totals = Totals(parts * entries, width)
        for _, own in _each(batches):
            vectors = own.vectors()
            for p in range(parts):
                totals.add(p * entries + own.nearest(p, books[p])[0], vectors[:, p * width : (p + 1) * width])
        yield from totals.rows()

    return run


def _encoded(books: np.ndarray):
    def run(batches):
        for row, own in _each(batches):
            found = [own.nearest(p, book) for p, book in enumerate(books)]
            text = HEX[np.stack([index for index, _ in found], axis=1)].view(f"S{2 * len(books)}").ravel().astype(str)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [row.column("ids").flatten(), row.column("labels").flatten(), pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    return run


@cleaned
def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """One row per vector that counts: vec_id, label, code, error, codebooks_sha256.

    Null vectors and those with null or non-finite components are left out. Components become ``floor(scale * x)``, held
    within +-2^27. The codebooks (``parts`` of ``entries``, at most 256) start as the parts of the first vectors by id (null ids last;
    repeated ids: smaller components first) and are moved ``rounds`` times. With fewer vectors there are as many entries as vectors. Codebooks
    exist for one length, the most frequent that ``parts`` divides (ties: the shortest); a vector of another length
    keeps its row with a null code and error. Without such a length the digest is that of the empty text. A missing label
    column counts as null labels; repeated ids and equal vectors count one by one; an empty table gives no rows.

    The vectors are written once, as codes into the dictionaries of their slice, whose size is bounded; each pass returns at
    most parts x entries x (width + 1) sums per task, so no label and no entry makes a large group.
    """
    if not 0 < entries <= len(HEX):
        raise ValueError(f"between 1 and {len(HEX)} entries")
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), label)
    kind = rows.schema["label"].dataType.simpleString()
    layout = f"dimension int, n int, ids array<bigint>, labels array<{kind}>, sizes binary, dictionary binary, codes binary"
    slices = stage(rows.mapInArrow(_dictionaries(scale), layout), "slices")
    usual = slices.where(F.col("dimension") % parts == 0).where("dimension > 0").groupBy("dimension").agg(F.sum("n").alias("n"))
    usual = usual.orderBy(F.desc("n"), "dimension").limit(1).collect()
    dimension = usual[0].dimension if usual else 0
    own = slices.where(F.col("dimension") == dimension) if dimension else slices.limit(0)
    first = own.mapInArrow(_smallest(entries), "vec_id long, v binary").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect() if dimension else []
    books = unpacked(pa.array([bytes(r.v) for r in first], pa.binary()), dimension).reshape(len(first), parts, -1).transpose(1, 0, 2) if dimension else np.zeros((parts, 0, 0), np.int64)
    for _ in range(rounds if dimension else 0):
        books = settled(own.mapInArrow(_summed(books), SUMS), books.reshape(-1, books.shape[2])).reshape(books.shape)
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    coded = own.mapInArrow(_encoded(books), f"vec_id long, label {kind}, code string, error long")
    others = slices.where(F.col("dimension") != dimension).select(F.explode(F.arrays_zip("ids", "labels")).alias("x"))
    others = others.select("x.ids", "x.labels", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.union(others).withColumn("codebooks_sha256", F.lit(digest))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds the errors summed over equal labels, null labels together.

    Sums form before the shuffle. The join back leaves one row per label on one side, so a label that holds most
    vectors is split by adaptive execution or, where the labels are few, not shuffled at all.
    """
    total = held_long(F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def _oracle(parts: int, entries: int, rounds: int, scale: int, dimension: int) -> str:
    width = dimension // parts
    steps = [
        f"""kept as materialized (
    select row_number() over (order by vec_id) as rid, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
    from embeddings where len(embedding) = len(list_filter(embedding, lambda x: x is not null and isfinite(x))))""",
        f"cut as materialized (select rid, p, list_slice(v, p * {width} + 1, (p + 1) * {width}) as v from kept, range({parts}) as t(p))",
        f"b0 as materialized (select p, rid - 1 as e, v from cut where rid <= {entries})",
    ]
    squares = " + ".join("(cut.v[{0}] - {1}.v[{0}]) ** 2".format(i, "{b}") for i in range(1, width + 1))
    for r in range(rounds + 1):
        near = f"min(struct_pack(d := ({squares.format(b=f'b{r}')})::bigint, e := e))"
        steps.append(f"a{r} as materialized (select rid, p, {near} as near from cut join b{r} using (p) group by rid, p)")
        if r < rounds:
            means = ", ".join(f"(sum(v[{i}]) - ((sum(v[{i}]) % count(*)) + count(*)) % count(*)) // count(*)" for i in range(1, width + 1))
            steps.append(
                f"""b{r + 1} as materialized (select p, e, coalesce(m.v, b{r}.v) as v from b{r} left join (
    select p, near.e as e, [{means}] as v from cut join a{r} using (rid, p) group by p, near.e) m using (p, e))"""
            )
    return f"""with {", ".join(steps)},
coded as (select rid, string_agg(printf('%02x', near.e), '' order by p) as code, sum(near.d)::bigint as error from a{rounds} group by rid)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
    (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from b{rounds}) as codebooks_sha256
from coded join kept using (rid)"""


@query(_oracle(16, 64, 2, 256, 64))
def op13_vector_code_compression(spark, sf_dir):
    coded = with_label_errors(compress(table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
