"""Fuzzy line dedup: MinHash over character shingles, banding, exact verification, distributed union-find."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from callsift.llm.common import cleaned, discard, flat, mix, ramp, stage, table
from callsift.llm.components import components
from callsift.llm.registry import query
from callsift.llm.tally import FIRST, chunked, tally, with_codes, with_rows

SHINGLE, SHARE = 8, 0.75
#: 128 bins of one permutation; 25 bands of 5: lines right at 0.75 meet in one with a probability above 0.998, unrelated ones
#: (below 0.1) with one below 3 in ten thousand.
BINS, BANDS, ROWS = 128, 25, 5
MULTIPLIERS = np.random.default_rng(31).integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bands of so many lines at most are settled at once; in larger ones one task compares this many lines with one another at most.
SMALL, BLOCK = 128, 1024
#: Bits of the map of a line's shingles, and pairs of maps that a task holds at a time.
BITS, PAIRS = 512, 1 << 18
#: Bits of a shingle's hash beside the number of its pair, and how near to the threshold counts of hashes are not trusted.
HASHED, SLACK = 52, 4
#: Characters hashed at a time, and shingles that a task numbers at a time.
PART, HELD = 1 << 17, 1 << 20
SEED = np.uint64(0x51ED270B9F3A7C15)
EMPTY = np.uint32(0xFFFFFFFF)
#: White space other than the space and the line feed, as str.split() takes it.
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingles(line: str) -> frozenset[str]:
    return frozenset(line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1)))


def _normal_lines(text: str) -> list[str]:
    """``normal`` of every line; a text without double or unusual white space needs no word split."""
    if "  " in text or any(c in text for c in WHITE):
        return [normal(line) for line in text.split("\n")]
    return [line.strip() for line in text.lower().split("\n")]


def _parts(lines: list[str], of) -> list[np.ndarray]:
    """``of`` the lines, a part of them at a time."""
    out, at, size = [], 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= PART or i == len(lines) - 1:
            out.append(of(lines[at : i + 1]))
            at, size = i + 1, 0
    return out


def band_keys(lines: list[str]) -> np.ndarray:
    """One 64-bit key per line and band."""
    return np.concatenate([np.zeros((0, BANDS), np.uint64), *_parts(lines, _band_keys)])


def bit_maps(lines: list[str]) -> np.ndarray:
    """One map of BITS bits per line, in which each of its shingles sets one."""
    return np.concatenate([np.zeros((0, BITS // 8), np.uint8), *_parts(lines, _bit_maps)])


def _mix32(x: np.ndarray) -> np.ndarray:
    moved = np.empty_like(x)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        x ^= np.right_shift(x, np.uint32(shift), out=moved)
        if factor > 1:
            x *= np.uint32(factor)
    return x


def _rolled(points: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the shingle that starts at each character."""
    rolled = _mix32(points + np.uint32(0x9F3A7C15))
    for width in (1, 2, 4):
        later = rolled[width:]
        rolled = rolled[: len(later)] * np.uint32(0x7F4A7C15 + 2 * width)
        rolled += later
        rolled ^= rolled >> np.uint32(15)
    return _mix32(rolled)


def _rolled_wide(points: np.ndarray) -> np.ndarray:
    """The same with 64 bits, a sum of products of the characters that is mixed at the end."""
    rolled = points.astype(np.uint64)
    for i, width in enumerate((1, 2, 4)):
        later = rolled[width:]
        rolled = rolled[: len(later)] * MULTIPLIERS[i]
        rolled += later
    return mix(rolled)


def _hashed(lines: list[str], rolled=_rolled, short_hash=xxhash.xxh32_intdigest) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each shingle at each place, and the line it lies in. Lines shorter than a shingle have one."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    long, short = np.flatnonzero(lengths >= SHINGLE), np.flatnonzero(lengths < SHINGLE)
    lengths = lengths[long]
    points = np.frombuffer("".join(lines if not len(short) else [lines[i] for i in long]).encode("utf-32-le", "surrogatepass"), np.uint32)
    every = rolled(points)
    inside = np.ones(len(points), bool)
    for back in range(1, SHINGLE):
        inside[np.cumsum(lengths) - back] = False
    hashes = every[inside[: len(every)]]
    row = np.repeat(long, lengths - SHINGLE + 1)
    if len(short):
        hashes = np.concatenate([hashes, np.array([short_hash(lines[i].encode("utf-8", "surrogatepass")) for i in short], every.dtype)])
        row = np.concatenate([row, short])
    return hashes, row


def _band_keys(lines: list[str]) -> np.ndarray:
    """Each shingle is hashed once and competes in one bin; an empty bin borrows from the next one that isn't, along with
    the distance, so short lines have whole signatures as well. A hash is turned so that its bin comes first: the least of
    a bin and all later ones is then that of the next bin that isn't empty."""
    n = len(lines)
    hashes, row = _hashed(lines)
    least = np.full((BINS, n), EMPTY)
    places = (hashes & np.uint32(BINS - 1)).astype(np.int64)
    places *= n
    places += row
    np.minimum.at(least.reshape(-1), places, hashes >> np.uint32(7) | hashes << np.uint32(25))
    for i in range(BINS - 2, -1, -1):
        np.minimum(least[i], least[i + 1], out=least[i])
    # Past the last bin of a line its first ones follow.
    least = np.where(least == EMPTY, least[0], least)
    values = (least & np.uint32((1 << 25) - 1)).astype(np.uint64) * np.uint64(2 * BINS + 1)
    values += ((least >> np.uint32(25)) - np.arange(BINS, dtype=np.uint32)[:, None]) & np.uint32(BINS - 1)
    keys = np.zeros((BANDS, n), np.uint64)
    for i in range(ROWS):
        keys += values[i : BANDS * ROWS : ROWS] * MULTIPLIERS[i]
    return np.ascontiguousarray(mix(keys + np.arange(BANDS, dtype=np.uint64)[:, None] * SEED).T)


def _bit_maps(lines: list[str]) -> np.ndarray:
    hashes, row = _hashed(lines)
    bits = np.zeros(len(lines) * BITS, bool)
    bits[row * BITS + (hashes >> np.uint32(7)) % np.uint32(BITS)] = True
    return np.packbits(bits.reshape(-1, BITS), axis=1)


def possible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Which pairs may be similar, by their maps (as 64-bit words) and places of shingles: a bit of one line that the other
    lacks is a shingle that the other lacks, so the bound never rules out a similar pair."""
    more, less = (np.bitwise_count(x & ~y).sum(axis=-1, dtype=np.int64) for x, y in ((a, b), (b, a)))
    common = np.minimum(size_a - more, size_b - less)
    return common >= SHARE * (common + more + less)


def _lines(documents: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Row, line number and form (its number) of the lines that are not blank, and the distinct normal forms."""
    texts = [_normal_lines(text or "") for text in documents.column("text").to_pylist()]
    counts, every = np.array([len(x) for x in texts], np.int64), list(chain.from_iterable(texts))
    numbers = dict.fromkeys(every)
    numbers.pop("", None)
    numbers = {form: n for n, form in enumerate(numbers)}
    form = np.array([numbers.get(x, -1) for x in every], np.int64)
    kept = np.flatnonzero(form >= 0)
    return np.repeat(np.arange(len(texts)), counts)[kept], ramp(counts)[kept], form[kept], list(numbers)


def _digests(forms) -> list[bytes]:
    return [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in forms]


def _exact_keys(digests: list[bytes]) -> np.ndarray:
    return mix(np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)[:, 0] ^ SEED)


def _keys(documents: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the bands, and of the forms themselves: counts of bands may be too high, a form's own count must not be, as
    bands are held against it."""
    *_, forms = _lines(documents)
    return band_keys(forms).ravel(), _exact_keys(_digests(forms))


COUNTS = StructType([StructField("n_lines", LongType()), StructField("n_removed", LongType()), StructField("removed", ArrayType(IntegerType()))])
LINE = "chunk long, row int, line int, doc_id long, key binary, copied boolean, form string, size int, bits binary, bands array<long>, wide array<long>"


def _answers(keys: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, int]:
    """The code of each key, given the codes of the distinct keys in ascending order, and how many these are."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), codes.dtype)
    out[order] = codes[np.cumsum(new) - 1]
    return out, int(new.sum())


def _marked(documents: pa.Table, codes: np.ndarray, chunk: int) -> pa.Table:
    """Lines that occur elsewhere too (copied) or share a band with another form; the first of such a form in the first
    chunk that has it carries text, bit map, bands and those that may have more than SMALL lines. Keys are counted once for each form and
    chunk, so a band that more chunks have than the form is another's too, and none has more lines than its count."""
    row, line, form, lines = _lines(documents)
    n = len(lines)
    digests, bands = _digests(lines), band_keys(lines)
    exact = _exact_keys(digests)
    sharers, known = _answers(bands.ravel(), codes)
    sharers = sharers.reshape(bands.shape)
    told, _ = _answers(exact, codes[known:])
    chunks = told & np.uint16(FIRST - 1)
    copied = (chunks > 1) | (np.bincount(form, minlength=n) > 1)
    met = (sharers > chunks[:, None]) | (sharers == 0xFFFF)
    similar = met.any(axis=1)
    first = np.zeros(len(form), bool)
    first[np.unique(form, return_index=True)[1]] = True
    kept = np.flatnonzero(copied[form] | similar[form])
    row, line, form, first = row[kept], line[kept], form[kept], (first & (similar & (told >= FIRST))[form])[kept]
    texts = [lines[i] if x else None for i, x in zip(form.tolist(), first.tolist())]
    maps = iter(bit_maps([x for x in texts if x is not None]))
    met[~similar] = False

    def listed(which: np.ndarray) -> pa.Array:
        ends = np.cumsum(np.where(first, which.sum(axis=1)[form], 0))
        values = bands[form[first]][which[form[first]]].view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))

    columns = {
        "chunk": pa.array(np.full(len(kept), chunk)),
        "row": pa.array(row.astype(np.int32)),
        "line": pa.array(line.astype(np.int32)),
        "doc_id": documents.column("doc_id").cast(pa.int64()).take(pa.array(row)),
        "key": pa.array([digests[i] for i in form.tolist()], pa.binary()),
        "copied": pa.array(copied[form]),
        "form": pa.array(texts, pa.string()),
        "size": pa.array([None if x is None else max(1, len(x) - SHINGLE + 1) for x in texts], pa.int32()),
        "bits": pa.array([None if x is None else next(maps).tobytes() for x in texts], pa.binary()),
        "bands": listed(met),
        "wide": listed(met & (sharers > SMALL)),
    }
    return pa.table(columns)


def alike(a: frozenset[str], b: frozenset[str]) -> bool:
    if min(len(a), len(b)) < SHARE * max(len(a), len(b)):
        return False
    common = len(a & b)
    return common >= SHARE * (len(a) + len(b) - common)


def _members(lines: list[str]) -> np.ndarray:
    """The distinct shingles of every line as ascending numbers: the line in the upper bits, a hash in the lower ones."""
    hashes, row = _hashed(lines, _rolled_wide, xxhash.xxh3_64_intdigest)
    every = np.sort(row.astype(np.uint64) << np.uint64(HASHED) | hashes >> np.uint64(64 - HASHED))
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    return every[new]


def _same(one: str, other: str) -> bool:
    """``alike`` of the lines' shingles; those of eight one-byte characters are compared as 64-bit words."""
    try:
        lines = [x.encode("latin-1") for x in (one, other)]
    except UnicodeEncodeError:
        lines = []
    if not lines or min(map(len, lines)) < SHINGLE:
        return alike(shingles(one), shingles(other))
    a, b = (np.unique(np.ndarray(len(x) - SHINGLE + 1, np.uint64, x, strides=(1,))) for x in lines)
    both = np.sort(np.concatenate([a, b]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common >= SHARE * (len(a) + len(b) - common)


def similar(one: list[str], other: list[str]) -> np.ndarray:
    """Which pairs of lines are similar.

    Shingles are counted by hashes, once for a line of several pairs, which tells pairs that are clearly similar or not: a
    collision moves the difference of both sides by less than two. Whatever lies within SLACK of the threshold is decided by
    the shingles themselves.
    """
    keep, at, size, paired, own = np.zeros(len(one), bool), 0, 0, 0, {}
    for to in range(1, len(one) + 1):
        for line in (one[to - 1], other[to - 1]):
            paired += len(line)
            if line not in own:
                own[line] = len(own)
                size += len(line)
        if size < PART and paired < 4 * PART and len(own) < (1 << (64 - HASHED)) - 1 and to - at < 1 << (64 - HASHED) and to < len(one):
            continue
        members = _members(list(own))
        counts = np.bincount((members >> np.uint64(HASHED)).astype(np.int64), minlength=len(own))
        starts, members = np.cumsum(counts) - counts, members & np.uint64((1 << HASHED) - 1)
        sides, sizes = [], []
        for lines in (one, other):
            line = np.array([own[x] for x in lines[at:to]])
            n = counts[line]
            pair = np.repeat(np.arange(to - at, dtype=np.uint64) << np.uint64(HASHED), n)
            sides.append(pair | members[np.repeat(starts[line], n) + ramp(n)])
            sizes.append(n)
        # Two ascending runs: a stable sort merges them.
        both = np.sort(np.concatenate(sides), kind="stable")
        common = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(HASHED)).astype(np.int64), minlength=to - at)
        over = common - SHARE * (sizes[0] + sizes[1] - common)
        keep[at:to] = over >= 0
        for i in (at + np.flatnonzero(np.abs(over) <= SLACK)).tolist():
            keep[i] = _same(one[i], other[i])
        at, size, paired, own = to, 0, 0, {}
    return keep


def _verified(batches):
    for batch in batches:
        keep = pa.array(similar(batch.column("one").to_pylist(), batch.column("other").to_pylist()))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def _words(column) -> np.ndarray:
    return flat(column)[0].view(np.uint64).reshape(-1, BITS // 64)


def _met(batches):
    """Possible pairs of the lines of each band, sorted by band, as ``(a, b, band)``.

    Without classes each line is paired with the first possible one before it only (no band); lines that have further
    possible pairs come out as ``(node, node, band)``. With classes all possible pairs of different classes come out.
    """

    def pairs(rows: pa.Table):
        band, node, size = (rows.column(c).to_numpy() for c in ("band", "node", "size"))
        classes = rows.column("class").to_numpy() if "class" in rows.column_names else None
        maps = _words(rows.column("bits"))
        starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
        widths = np.diff(np.append(starts, len(band)))
        later = np.repeat(starts + widths, widths) - np.arange(len(band)) - 1
        done, at = np.concatenate([[0], np.cumsum(later)]), 0
        paired, more = np.zeros(len(band), bool), np.zeros(len(band), bool)
        while at < len(band):
            to = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
            x = np.repeat(np.arange(at, to), later[at:to])
            y = x + 1 + ramp(later[at:to])
            apart = np.flatnonzero(node[x] != node[y] if classes is None else classes[x] != classes[y])
            x, y = x[apart], y[apart]
            kept = possible(maps[x], maps[y], size[x], size[y])
            x, y = x[kept], y[kept]
            if classes is None:
                first = np.zeros(len(y), bool)
                first[np.unique(y, return_index=True)[1]] = True
                first &= ~paired[y]
                paired[y] = True
                more[x[~first]] = more[y[~first]] = True
                x, y = x[first], y[first]
            yield made(np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), pa.nulls(len(x), pa.int64()))
            at = to
        yield made(node[more], node[more], pa.array(band[more]))

    def made(a, b, band):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), band], names=["a", "b", "band"])

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
        if rows.num_rows:
            band = rows.column("band").to_numpy()
            cut = int(np.searchsorted(band, band[-1]))
            yield from pairs(rows.slice(0, cut))
            held = rows.slice(cut)
    if held is not None:
        yield from pairs(held)


def _compared(leaders: bool):
    """Verified links of one band's lines: with the longest line only, or between all of different classes.

    The lines of two tiles are numbered by their shingles at a time, so that a line is held against all others by one gather
    of their shingles, or of the lines that have its own; as in ``similar``, the shingles themselves decide near the threshold.
    """

    def run(key: tuple[int, ...], rows: pa.Table) -> list[tuple[int, int]]:
        nodes, classes, block = (rows.column(c).to_numpy() for c in ("node", "class", "block"))
        forms, size, maps = rows.column("form").to_pylist(), rows.column("size").to_numpy(), _words(rows.column("bits"))
        if leaders:
            lead = max(range(len(forms)), key=lambda i: (len(forms[i]), -nodes[i]))
            near = np.flatnonzero(possible(maps[lead], maps, size[lead], size) & (np.arange(len(forms)) != lead))
            near = near[similar([forms[lead]] * len(near), [forms[i] for i in near])]
            return [(int(nodes[lead]), int(nodes[i])) for i in near]
        _, low, high = key
        _, root = np.unique(classes, return_inverse=True)
        links = []
        order = np.argsort(block, kind="stable")
        tile = np.maximum(np.cumsum(size[order]) // (HELD // 2), np.arange(len(order)) // (1 << (63 - HASHED)))
        tiles = np.split(order, np.flatnonzero(np.diff(tile)) + 1)
        for i, xs in enumerate(tiles):
            for ys in tiles[i:]:
                one = ys is xs
                own = xs if one else np.concatenate([xs, ys])
                if (root[own] == root[own[0]]).all():
                    continue
                members = _members([forms[k] for k in own])
                starts = np.searchsorted(members, np.arange(len(own), dtype=np.uint64) << np.uint64(HASHED))
                starts, every = np.append(starts, len(members)), np.unique(members & np.uint64((1 << HASHED) - 1), return_inverse=True)[1]
                mark = np.zeros(every.max() + 1, bool)
                # The lines of each shingle, ascending, and where each line stands among them.
                holders, ends = np.argsort(every, kind="stable"), np.cumsum(np.bincount(every))
                stands, after = np.empty(len(every), np.int64), ends[every]
                stands[holders] = np.arange(len(every))
                holders = np.repeat(np.arange(len(own)), np.diff(starts))[holders]
                for at, x in enumerate(xs):
                    places = np.arange(at + 1 if one else len(xs), len(own))
                    y = own[places]
                    met = (root[y] != root[x]) & ((block[y] != block[x]) | (low == high))
                    places, y = places[met], y[met]
                    places = places[possible(maps[x], maps[y], size[x], size[y])]
                    if not len(places):
                        continue
                    n, lengths = starts[at + 1] - starts[at], starts[places + 1] - starts[places]
                    within = slice(starts[at], starts[at + 1])
                    later = after[within] - stands[within] - 1
                    # Of the shingles of the other lines and the other lines of its shingles, the fewer are gone through.
                    if later.sum() < lengths.sum():
                        common = np.bincount(holders[np.repeat(stands[within] + 1, later) + ramp(later)], minlength=len(own))[places]
                    else:
                        mark[every[within]] = True
                        common = np.add.reduceat(mark[every[np.repeat(starts[places], lengths) + ramp(lengths)]], np.cumsum(lengths) - lengths, dtype=np.int64)
                        mark[every[within]] = False
                    over = common - SHARE * (n + lengths - common)
                    for k in np.flatnonzero(over >= -SLACK):
                        other = own[places[k]]
                        if root[x] != root[other] and (over[k] > SLACK or _same(forms[x], forms[other])):
                            links.append((int(nodes[x]), int(nodes[other])))
                            root[root == root[other]] = root[x]
        return links

    return run


def _by_group(rows: DataFrame, keys: list[str], links_of) -> DataFrame:
    """``links_of(key, rows)`` of every group, as ``(a, b)``. Groups are many and small, so a task walks through its sorted
    rows instead of being handed group by group."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        current, links = None, []

        def made():
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys])
            bounds = [0, *(np.flatnonzero((own[:, 1:] != own[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for at, to in zip(bounds, bounds[1:]):
                key = tuple(own[:, at].tolist())
                if held and key != current:
                    links += links_of(current, pa.Table.from_batches(held))
                    held = []
                current = key
                held.append(batch.slice(at, to - at))
            yield made()
            links = []
        if held:
            links += links_of(current, pa.Table.from_batches(held))
            yield made()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _line_components(lines: DataFrame) -> DataFrame:
    """``lines(node, form, size, bits, bands, wide)``, one row per distinct form -> ``(node, component)`` of what similar pairs connect.

    Bands that are not in ``wide`` have up to SMALL lines. In bands of up to SMALL lines, bit maps tell the possible pairs: each line and the first possible one before it go on as ids
    and are verified once, by their texts; the other pairs follow where these left lines of a band in several components.
    Larger bands that the same lines have stand for one another: of each such class (by count and two 64-bit sums of the lines)
    one is kept. There every line is first held against the longest; then bands that still hold several components are
    compared in full, block by block, skipping pairs that are connected already. Links found then join whole classes.
    """
    maps, forms = lines.select("node", "size", "bits"), lines.where(F.size("wide") > 0).select("node", "form", "size", "bits")
    bands = lines.select("node", F.explode("wide").alias("band"))
    sums = (F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    large = stage(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") > SMALL), "large")
    small = lines.select("node", "size", "bits", F.explode("bands").alias("band")).join(large.select("band"), "band", "left_anti")
    text = lines.select(F.col("node").alias("a"), F.col("form").alias("one")), lines.select(F.col("node").alias("b"), F.col("form").alias("other"))

    def met_in(rows: DataFrame) -> DataFrame:
        return rows.repartition("band").sortWithinPartitions("band").mapInArrow(_met, "a long, b long, band long")

    def verified(pairs: DataFrame) -> DataFrame:
        return pairs.join(text[0], "a").join(text[1], "b").select("a", "b", "one", "other").mapInArrow(_verified, "a long, b long")

    def still_open(rows: DataFrame) -> DataFrame:
        """``rows`` of the bands that hold several classes."""
        several = rows.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least != most").select("band")
        return rows.join(stage(several, "open"), "band", "left_semi")

    pairs = stage(met_in(small).distinct(), "pairs")
    near = verified(pairs.where("band is null").select("a", "b"))
    rest = pairs.where("band is not null").select("band", F.col("a").alias("node"))
    met = large.groupBy("n", "x", "y").agg(F.min("band").alias("band"))
    groups = stage(bands.join(met.select("band", "n"), "band"), "groups")

    def dealt(classes: DataFrame | None) -> DataFrame:
        rows, blocks = groups.withColumn("class", F.col("node")), F.ceil(F.col("n") / BLOCK).cast("int")
        if classes is not None:
            rows = stage(still_open(groups.join(classes, "node")), "unsettled")
        rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        if classes is None:
            rows = rows.withColumn("low", F.col("block")).withColumn("high", F.col("block"))
        else:
            rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        rows = rows.select("band", "low", "high", "node", "class", "block").join(forms, "node")
        return _by_group(rows.select("band", "low", "high", "node", "class", "form", "size", "bits", "block"), ["band", "low", "high"], _compared(classes is None))

    first = stage(dealt(None).unionByName(near), "links")
    found = components(first)
    nodes = groups.select("node").unionByName(rest.select("node")).distinct()
    classes = stage(nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("class")), "classes")
    others = still_open(rest.join(classes, "node")).join(maps, "node")
    # Few are left: staged, their size is known, so that Spark need not shuffle all texts for them.
    later = verified(stage(met_in(others).select("a", "b").distinct(), "later"))
    links = stage(dealt(classes).unionByName(later), "links")
    for end in ("a", "b"):
        own = found.select(F.col("node").alias(end), F.col("component").alias("class"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce("class", end)).drop("class")
    joined = components(links)
    alone = joined.select("node").join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    top = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
    return found.unionByName(alone).join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))


@cleaned
def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text cut to the lines that stay, plus n_lines and n_removed (long) and removed (line numbers).

    Lines are similar when the sets of 8-character shingles of their normal forms (lower case, white space as single
    spaces) have a Jaccard index of 0.75 or more; of each component of similar lines the first one in order of (doc_id,
    line) stays, rows without an id coming last. Blank lines always stay and are not counted. Lines shorter than a shingle
    are similar to equal ones only. A null text stays null. Rows that repeat an id are documents of their own; columns
    named n_lines, n_removed or removed are replaced, others pass through.
    """
    docs = docs.drop("n_lines", "n_removed", "removed")
    chunks = chunked(docs)
    codes = tally(chunks, _keys, BANDS / 300, firsts=True)
    lines = stage(with_codes(chunks, codes, _marked, LINE, counts=True).withColumn("node", F.monotonically_increasing_id()), "lines")
    forms = lines.where("form is not null").select("key", "node", "form", "size", "bits", "bands", "wide")
    found = _line_components(forms)
    classes = stage(forms.select("key", "node").join(found, "node").select("key", "component"), "classes")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line", "chunk", "row")
    placed = lines.select("key", "copied", "chunk", "row", "line", place.alias("place")).join(classes, "key", "left").where("copied or component is not null")
    placed = stage(placed.withColumn("class", F.coalesce(F.col("component").cast("string"), F.hex("key"))).drop("component", "key", "copied"), "places")
    discard(lines)
    first = stage(placed.groupBy("class").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("class", "first"), "firsts")
    gone = placed.join(first, "class").where("place != first").select("chunk", "row", "line")

    def cut(documents, rows):
        removed: dict[int, set[int]] = {}
        for i, j in zip(rows.column("row").to_pylist(), rows.column("line").to_pylist()):
            removed.setdefault(i, set()).add(j)
        texts, counts, lists = [], [], []
        for i, text in enumerate(documents.column("text").to_pylist()):
            own = removed.get(i, ())
            split = (text or "").split("\n")
            texts.append(text if not own else "\n".join(x for j, x in enumerate(split) if j not in own))
            counts.append(sum(1 for x in split if x.strip()))
            lists.append(sorted(own))
        out = documents.set_column(documents.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
        for name, values in (("n_lines", pa.array(counts, pa.int64())), ("n_removed", pa.array(list(map(len, lists)), pa.int64())), ("removed", pa.array(lists, pa.list_(pa.int32())))):
            out = out.append_column(name, values)
        return out

    return with_rows(chunks, gone, cut, StructType([*docs.schema.fields, *COUNTS.fields]))


@query()
def op10_line_dedup(spark, sf_dir):
    """Per document: how many lines it has, which go, and the digest of the text that stays."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
