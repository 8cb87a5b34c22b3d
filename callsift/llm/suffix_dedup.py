"""Removal of repeated byte strings by suffix sorting.

Two equal strings of 50 bytes have the same smallest 24-byte gram at the same place (its hash decides, the leftmost of
equal ones). So strings are brought together by that gram: only grams that several documents have matter, and around each of
their places only the bytes that the strings through it span. The task of a bucket of grams puts the distinct
surroundings into one text, sorts its suffixes by the difference-cover algorithm and compares adjacent ones; each
class of equal strings has a smallest document, and one bit per string goes back to the chunk that asked.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import cleaned, flat, mix, ramp, stage, table
from callsift.llm.registry import query
from callsift.llm.suffix_array import suffix_order
from callsift.llm.tally import chunked, tally, text_bytes, with_codes, with_rows

LENGTH, GRAM = 50, 24
#: Grams in a string; a frame has as many bytes on either side of its gram as a string through it can span.
PLACES = LENGTH - GRAM + 1
SIDE = PLACES - 1
FRAME = GRAM + 2 * SIDE
#: Codes from which a gram's strings travel one by one to the buckets of their own hashes: some 2,000 documents.
HOT_CODE = 12
#: Bytes of text per bucket of frames, which come to some 16,000 frames where a quarter of the anchors matter.
BUCKET_BYTES = 900_000
#: Bytes of text whose grams are hashed at a time: their arrays stay in a core's cache.
PART = 1 << 16
PLACE_BITS = np.uint64(24)
BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x9E37))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at every place that has one."""
    rolled = BYTES[data]
    for width in (1, 2, 4):
        after, rolled = rolled[width:], rolled[:-width] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * width)
        rolled += after
        rolled ^= rolled >> np.uint64(31)
    out = rolled[:-16] * np.uint64(0x165667B19E3779F9) + rolled[8:-8] * np.uint64(0x27D4EB2F165667C5) + rolled[16:]
    return mix(out)


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the strings of some texts: (place of the gram, its hash, first and last string that it anchors).

    Strings are named by their first byte; those of one anchor follow one another. Texts are gone through
    a part at a time, so that a very long one takes no more memory than others.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, len(data) - LENGTH + 1), PART):
        own = data[at : at + PART + LENGTH - 1]
        hashes = _grams(own)
        value = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= PLACES:
            value = np.minimum(value[:-width], value[width:])
            width *= 2
        value = np.minimum(value[: len(value) - (PLACES - width)], value[PLACES - width :])
        gram = (value & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
        # Strings across the end of a text are none, which also sets those of different texts apart.
        inside = np.ones(len(gram), bool)
        for end in starts[np.searchsorted(starts, at + 1) : np.searchsorted(starts, at + len(own))].tolist():
            inside[max(0, end - at - LENGTH + 1) : end - at] = False
        string = np.flatnonzero(inside)
        if not len(string):
            continue
        gram = gram[string]
        first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (string[1:] != string[:-1] + 1)]))
        last = np.append(first[1:], len(string)) - 1
        found.append((gram[first] + at, hashes[gram[first]], string[first] + at, string[last] + at))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _texts(place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text of each of the ascending places."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(np.searchsorted(place, starts)))


def _keys(documents: pa.Table) -> np.ndarray:
    data, starts = flat(documents.column("text"))
    place, hashes, _, _ = anchors(data, starts)
    text = _texts(place, starts)
    order = np.argsort(hashes, kind="stable")
    hashes, text = hashes[order], text[order]
    fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]) if len(hashes) else np.zeros(0, bool)
    return hashes[fresh]


def _frames(data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rows of bytes around the grams, cut to what the strings span, then the bytes missing on the left and on the right."""
    left, right = SIDE - (place - first), SIDE - (last + LENGTH - place - GRAM)
    columns = np.arange(FRAME)
    at = place[:, None] - SIDE + columns
    inside = (columns >= left[:, None]) & (columns < FRAME - right[:, None])
    rows = np.where(inside, data[np.clip(at, 0, max(0, len(data) - 1))], 0).astype(np.uint8)
    return np.hstack([rows, left[:, None].astype(np.uint8), right[:, None].astype(np.uint8)])


def _numbered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the distinct rows' first occurrences, and for each row the number of its distinct row, in order of occurrence."""
    rows = np.ascontiguousarray(rows)
    own = pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)]).dictionary_encode().indices.to_numpy().astype(np.int64)
    return np.flatnonzero(np.diff(np.maximum.accumulate(own), prepend=-1)), own


SENT = "chunk long, bucket int, frames binary, docs binary, place binary, first binary, last binary, own binary, later binary"
KINDS = (pa.int64(), pa.int32(), *(pa.binary(),) * 7)


def _asked(bits: int, hot_code: int):
    """The chunk's distinct frames by bucket, each with the smallest document that has it; and, in a row without bucket,
    what the chunk needs in order to use the answers: its anchors, their frames, and whether they are in a later document."""

    def make(documents, codes, chunk):
        data, starts = flat(documents.column("text"))
        place, hashes, first, last = anchors(data, starts)
        order = np.argsort(hashes)
        fresh = np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0
        code = np.empty(len(hashes), np.uint8)
        code[order] = codes[np.cumsum(fresh) - 1]
        text = _texts(place, starts)
        alone, hot = (code > 0) & (code < hot_code), code >= hot_code
        # Strings of a hot gram go one by one.
        times = (last[hot] - first[hot] + 1).astype(np.int64)
        single = np.repeat(first[hot], times) + ramp(times)
        place = np.concatenate([place[alone], np.repeat(place[hot], times)])
        text = np.concatenate([text[alone], np.repeat(text[hot], times)])
        hashes = np.concatenate([hashes[alone], np.repeat(hashes[hot], times)])
        first, last = np.concatenate([first[alone], single]), np.concatenate([last[alone], single])
        rows = []
        if len(place):
            doc = documents.column("doc_id").to_numpy()[text]
            frames = np.concatenate([_frames(data, place[i : i + 65536], first[i : i + 65536], last[i : i + 65536]) for i in range(0, len(place), 65536)])
            sample, own = _numbered(frames)
            least = np.full(len(sample), np.iinfo(np.int64).max)
            np.minimum.at(least, own, doc)
            frames, key = frames[sample], hashes[sample]
            strings = np.flatnonzero(sample >= int(alone.sum()))
            if len(strings):
                words = np.zeros(len(strings), np.uint64)
                for i in range(FRAME):
                    words = mix(words + frames[strings, i]) if i % 8 == 7 else words * np.uint64(257) + frames[strings, i]
                key = key.copy()
                key[strings] = mix(words)
            bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            numbers, at = np.unique(bucket[order], return_index=True)
            for b, i, j in zip(numbers.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
                rows.append((chunk, b, frames[order[i:j]].tobytes(), least[order[i:j]].tobytes(), *(None,) * 5))
            rows.append((chunk, None, None, None, place.astype("<i4").tobytes(), (place - first).astype(np.uint8).tobytes(), (last - place + SIDE).astype(np.uint8).tobytes(), number[own].astype("<i4").tobytes(), (doc > least[own]).tobytes()))
        columns = list(zip(*rows)) or [[]] * len(KINDS)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], names=[x.split(" ")[0] for x in SENT.split(", ")])

    return make


def repeated(frames: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each frame the bits of its strings, from the left, that also start in a document smaller than ``docs``."""
    left = frames[:, FRAME].astype(np.int64)
    count = FRAME - left - frames[:, FRAME + 1] - LENGTH + 1
    # One text of all frames; a byte is a symbol from 2, and 1 ends each frame.
    columns = np.arange(FRAME + 1)
    size = FRAME - left - frames[:, FRAME + 1]
    used = (columns >= left[:, None]) & (columns <= (left + size)[:, None])
    symbols = np.hstack([frames[:, :FRAME].astype(np.int64) + 2, np.ones((len(frames), 1), np.int64)])
    symbols[columns[None, :] == (left + size)[:, None]] = 1
    text = symbols[used]
    begin = np.cumsum(size + 1) - size - 1
    start = np.repeat(begin, count) + ramp(count)
    owner = np.full(len(text), -1, np.int64)
    owner[start] = np.repeat(np.arange(len(frames)), count)
    order = suffix_order(text)
    order = order[owner[order] >= 0]
    strings = np.zeros((len(order), -(-LENGTH // 8) * 8), np.uint8)
    for i in range(LENGTH):
        strings[:, i] = text[order + i]
    words = strings.view(np.uint64)
    group = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)]))
    least = np.repeat(np.minimum.reduceat(docs[owner[order]], group), np.diff(np.append(group, len(order))))
    earlier = np.zeros(len(text), bool)
    earlier[order] = least < docs[owner[order]]
    bits = np.zeros(len(frames), np.uint32)
    np.bitwise_or.at(bits, owner[start], earlier[start].astype(np.uint32) << ramp(count).astype(np.uint32))
    return bits


def _answered(bucket, rows):
    blobs = rows.column("frames").to_pylist()
    sizes = [len(x) // (FRAME + 2) for x in blobs]
    frames = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, FRAME + 2)
    docs = np.frombuffer(b"".join(rows.column("docs").to_pylist()), np.int64)
    sample, own = _numbered(frames)
    least = np.full(len(sample), np.iinfo(np.int64).max)
    np.minimum.at(least, own, docs)
    distinct = frames[sample]
    # A gram with one distinct frame needs no sorting: its strings differ from one another by their place.
    gram = _numbered(distinct[:, SIDE : SIDE + GRAM])[1]
    several = np.flatnonzero(np.bincount(gram)[gram] > 1)
    bits = np.zeros(len(distinct), np.uint32)
    if len(several):
        bits[several] = repeated(distinct[several], least[several])
    full = np.uint32((1 << PLACES) - 1)
    back = np.where(least[own] < docs, full, bits[own])
    ends = np.cumsum(sizes)
    return pa.table({"chunk": rows.column("chunk"), "bucket": pa.array([bucket[0].as_py()] * len(sizes), pa.int32()), "bits": pa.array([back[e - n : e].astype("<u4").tobytes() for n, e in zip(sizes, ends)], pa.binary())})


def _removed(documents: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a chunk's texts, where each text starts, and which bytes go."""
    data, starts = flat(documents.column("text"))
    cover = np.zeros(len(data) + 1, np.int32)
    local = [r for r in rows.to_pylist() if r["bucket"] is None]
    if local:
        local = local[0]
        place, own = np.frombuffer(local["place"], "<i4").astype(np.int64), np.frombuffer(local["own"], "<i4")
        first = place - np.frombuffer(local["first"], np.uint8)
        count = place - SIDE + np.frombuffer(local["last"], np.uint8) - first + 1
        answers = rows.filter(pc.is_valid(rows.column("bits"))).sort_by("bucket").column("bits").to_pylist()
        bits = np.frombuffer(b"".join(answers), "<u4")[own]
        later = np.frombuffer(local["later"], bool)
        step = ramp(count)
        go = np.repeat(later, count) | ((np.repeat(bits, count) >> step.astype(np.uint32)) & 1).astype(bool)
        string = (np.repeat(first, count) + step)[go]
        starting = np.zeros(len(data) + 1, bool)
        starting[string] = True
        cover[:] = np.cumsum(starting)
        cover[LENGTH:] -= np.cumsum(starting[: max(0, len(cover) - LENGTH)])
    return data, starts, cover[:-1] > 0


def _digests(documents, rows):
    data, starts, gone = _removed(documents, rows)
    ends = np.concatenate([[0], np.cumsum(gone)])
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    at = starts[:-1][starts[:-1] < len(gone)]
    begins[at] = gone[at]
    spans = np.concatenate([[0], np.cumsum(begins)])
    kept = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    return pa.table(
        {"doc_id": documents.column("doc_id").cast(pa.int64()), "n_bytes": np.diff(starts), "n_removed": ends[starts[1:]] - ends[starts[:-1]], "n_spans": spans[starts[1:]] - spans[starts[:-1]], "kept_sha256": pa.array(kept, pa.string())}
    )


def _cut(documents, rows):
    data, starts, gone = _removed(documents, rows)
    texts = [data[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    return documents.set_column(documents.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def _answers(docs: DataFrame, hot_code: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(chunks of first copies, answers for them, ids and digests of all rows)``."""
    fresh = "digest_"
    while fresh in docs.columns:
        fresh += "_"
    named = docs.withColumn(fresh, F.sha2(F.coalesce("text", F.lit("")), 256))
    known = stage(named.select("doc_id", F.col(fresh).alias("digest_"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), "known")
    firsts = stage(known.where("doc_id is not null").groupBy("digest_").agg(F.min("doc_id").alias("doc_id")), "firsts")
    chunks = chunked(named.where("octet_length(text) > 0").join(firsts.withColumnRenamed("digest_", fresh), [fresh, "doc_id"], "left_semi").select(*docs.columns))
    codes = tally(chunks, _keys, 2 / (PLACES + 1))
    bits = max(127, text_bytes(chunks) // BUCKET_BYTES).bit_length()
    asked = stage(with_codes(chunks, codes, _asked(bits, hot_code), SENT), "frames")
    answered = asked.where("bucket is not null").select("chunk", "bucket", "frames", "docs").groupBy("bucket").applyInArrow(_answered, "chunk long, bucket int, bits binary")
    none = F.lit(None).cast("binary")
    own = asked.where("bucket is null").select("chunk", "bucket", none.alias("bits"), "place", "first", "last", "own", "later")
    rows = own.unionByName(answered, allowMissingColumns=True)
    others = known.join(firsts.select("digest_", F.col("doc_id").alias("first_")), "digest_", "left").where("doc_id is null or first_ is null or doc_id != first_ or n_bytes = 0")
    return chunks, rows, others


@cleaned
def repeats(docs: DataFrame, hot_code: int = HOT_CODE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of 50 bytes covers it that also starts in a document with a smaller id. Texts are UTF-8; null is
    empty; strings lie within one text and are judged on the input. Texts equal to that of a smaller id go whole (from 50
    bytes on). Rows that repeat an id are judged on their own and don't count as earlier for one another. A row without id
    loses nothing and takes nothing from others. An empty table gives no rows.
    """
    chunks, rows, others = _answers(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), hot_code)
    first = with_rows(chunks, rows, _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    whole = (F.col("doc_id") > F.col("first_")) & (F.col("n_bytes") >= LENGTH)
    whole = F.coalesce(whole, F.lit(False))
    rest = others.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"), whole.cast("long").alias("n_spans"), F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("digest_")).alias("kept_sha256")
    )
    return first.unionByName(rest)


@cleaned
def remove_repeats(docs: DataFrame, hot_code: int = HOT_CODE) -> DataFrame:
    """``docs`` without the bytes that ``repeats`` counts as removed; a character that loses some of its bytes goes whole.

    Texts equal to that of a smaller id lose everything and are left out, as are others with nothing left. Empty texts,
    texts below 50 bytes and rows without an id stay as they are.
    """
    chunks, rows, _ = _answers(docs, hot_code)
    cut = with_rows(chunks, rows, _cut, docs.schema).where("octet_length(text) > 0")
    firsts = docs.where(f"octet_length(text) > 0 and octet_length(text) < {LENGTH} and doc_id is not null").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    short = docs.where(f"octet_length(text) > 0 and octet_length(text) < {LENGTH} and doc_id is not null").join(firsts, ["text", "doc_id"], "left_anti").select(*docs.columns)
    return cut.unionByName(short).unionByName(docs.where("doc_id is null or text is null or octet_length(text) = 0"))


@query()
def op8_suffix_array_dedup(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents"))
