"""Exact, near, line and passage dedup against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from callsift.llm import line_dedup, ngram_join, quality, suffix_dedup
from callsift.llm.common import stage
from callsift.llm.components import components
from callsift.llm.exact_dedup import cut_points, exact_dedup
from callsift.llm.rtree import CountTree
from callsift.llm.suffix_array import suffix_order
from callsift.llm.tally import FIRST, chunked, tally, with_codes


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- components

def test_components_of_chain_star_and_cycle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- exact dedup

def plain_exact(rows):
    delete = {ord(c): None for c in " \t\n\x0b\x0c\r"}
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(delete)].append((i, len(t or "")))
    out = []
    for form, own in groups.items():
        most = max(n for _, n in own)
        ids = [i for i, n in own if n == most and i is not None]
        known = [(n, -i) for i, n in own if i is not None]
        best = max((n, -i if i is not None else float("-inf")) for i, n in own)
        keep = None if best[1] == float("-inf") else -best[1]
        assert keep is None or keep == min(ids) and known
        out += [(i, keep, len(own), i == keep, hashlib.sha256(form.encode()).hexdigest()) for i, _ in own]
    return Counter(out)


@pytest.mark.parametrize("hash_bytes", [16, 1])
def test_exact_dedup(odd, documents, hash_bytes):
    for docs in (odd, documents):
        got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs, hash_bytes).collect())
        assert got == plain_exact(rows_of(docs))


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup(nothing).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert exact_dedup(nothing).count() == 0


def test_cuts_follow_content_and_stay_bounded():
    rng = np.random.default_rng(0)
    body = rng.integers(0, 256, 300_000, dtype=np.uint8)
    alone = cut_points(body, np.array([0, len(body)]))[0]
    lead = rng.integers(0, 256, 777, dtype=np.uint8)
    second = cut_points(np.concatenate([lead, body]), np.array([0, 777, 777 + len(body)]))[1]
    assert [x - 777 for x in second] == alone and len(alone) > 20
    flat = cut_points(np.zeros(200_000, np.uint8), np.array([0, 200_000]))[0]
    assert max(np.diff([0, *flat])) <= 1 << 16 and flat[-1] == 200_000


# --- n-gram join

def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain_near(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    # Rows of one id are one node only where their sets are equal.
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return Counter((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, root))


def test_near_duplicates(odd, documents):
    for docs in (odd, documents):
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())
        assert got == plain_near(rows_of(docs))


def test_near_duplicates_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents).collect())
    assert got == plain_near(rows_of(documents))


def test_near_duplicates_of_repeated_ids_with_differing_texts(spark):
    rows = [(i, f"{text} end{i} of{n}") for text, ids in ((" ".join(f"{w}{k}" for k in range(200)), ids) for w, ids in (("one", (1, 2)), ("other", (3, 4)))) for i in ids for n in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()) == plain_near(rows)
    assert {(i, c) for i, _, c in plain_near(rows)} == {(1, 1), (2, 1), (3, 3), (4, 3)}


def test_near_duplicates_of_nothing(nothing, odd):
    assert ngram_join.near_duplicates(nothing).count() == 0
    assert ngram_join.keep_one(odd).columns == odd.columns


def test_tree_finds_every_pair_that_may_overlap():
    rng = np.random.default_rng(3)
    sets = [set(rng.integers(0, 300, rng.integers(1, 60)).tolist()) for _ in range(150)]
    sets += [set(list(s)[:-2]) | {1000 + i} for i, s in enumerate(sets) if len(s) > 20]
    points = np.zeros((len(sets), 16), np.uint32)
    for i, s in enumerate(sets):
        for x in s:
            points[i, x % 16] += 1
    classes = np.arange(len(sets)) // 2
    x, y = CountTree(points, np.array([len(s) for s in sets]), classes).pairs(0.75)
    got = [tuple(sorted(p)) for p in zip(x.tolist(), y.tolist())]
    assert len(got) == len(set(got)) and all(classes[a] != classes[b] for a, b in got)
    need = {(i, j) for j in range(len(sets)) for i in range(j) if classes[i] != classes[j] and len(sets[i] & sets[j]) >= 0.75 * len(sets[i] | sets[j])}
    assert need <= set(got) and len(need) > 30 and len(got) < len(sets) ** 2 / 4


# --- lines

def plain_lines(rows):
    lines = [(i is None, i if i is not None else 0, j, n, form) for n, (i, t) in enumerate(rows) for j, x in enumerate((t or "").split("\n")) if (form := line_dedup.normal(x))]
    forms = list(dict.fromkeys(x[4] for x in lines))
    sets = [line_dedup.shingles(f) for f in forms]
    root = dict(zip(forms, roots(len(forms), [(a, b) for a in range(len(forms)) for b in range(a) if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])])))
    first, gone = {}, defaultdict(list)
    for last, i, j, n, form in sorted(lines, key=lambda x: x[:4]):
        if first.setdefault(root[form], (n, j)) != (n, j):
            gone[n].append(j)
    return Counter((i, tuple(gone[n]), sum(1 for x in (t or "").split("\n") if x.strip()), None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[n])) for n, (i, t) in enumerate(rows))


def test_line_dedup(odd, documents):
    # Rows that repeat an id and a line are ordered by where they lie, which the plain version can't know: compare without them.
    for docs in (odd.where("doc_id is not null and doc_id not in (19, 20, 22)"), documents):
        got = line_dedup.dedup_lines(docs)
        assert got.columns[: len(docs.columns)] == [c for c in docs.columns if c != "removed"] + got.columns[len(docs.columns) - ("removed" in docs.columns) : len(docs.columns)]
        assert Counter((r.doc_id, tuple(r.removed), r.n_lines, r.text) for r in got.collect()) == plain_lines(rows_of(docs))


def test_line_dedup_keeps_one_of_repeated_rows(odd, nothing):
    got = line_dedup.dedup_lines(odd).where("doc_id = 19").collect()
    assert sorted(r.n_removed for r in got) == [0, 1]
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    text = "a common line of some length with a number in it {} and more of it behind"
    docs = spark.createDataFrame([(i, text.format(i)) for i in range(40)], "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_removed = 0").collect()} == {0}


def test_lines_whose_key_collides_in_its_first_39_bits(spark):
    lines = {i: hashlib.sha256(b"%d" % i).hexdigest() for i in (265402, 1736327)}
    one, other = line_dedup._exact_keys(line_dedup._digests(lines.values())).tolist()
    assert one != other and one >> 25 == other >> 25
    for i in lines:
        near = lines[i][:-1] + "x"
        docs = spark.createDataFrame([(1, lines[i]), (2, near), (3, lines[265402 + 1736327 - i])], "doc_id long, text string").repartition(3)
        assert Counter((r.doc_id, tuple(r.removed), r.n_lines, r.text) for r in line_dedup.dedup_lines(docs).collect()) == plain_lines(rows_of(docs))


def test_bands_bring_long_lines_right_at_the_threshold_together():
    rng = np.random.default_rng(5)
    tail, n = 400, 3000
    one = rng.integers(97, 123, (n, 7 * tail + 7), dtype=np.uint8)
    other = one.copy()
    other[:, 6 * tail + 7 :] = (one[:, 6 * tail + 7 :] - 96 + rng.integers(0, 25, (n, tail), dtype=np.uint8)) % 26 + 97
    one, other = ([x.tobytes().decode() for x in lines] for lines in (one, other))
    a, b = line_dedup.shingles(one[0]), line_dedup.shingles(other[0])
    assert len(a & b) == 0.75 * len(a | b)
    met = (line_dedup.band_keys(one) == line_dedup.band_keys(other)).any(axis=1)
    assert met.mean() >= 0.998


def test_bit_maps_never_rule_out_similar_lines():
    rng = random.Random(8)
    lines = []
    for n in (1, 5, 8, 9, 12, 30, 80, 300, 900, 4000):
        for _ in range(12):
            line = "".join(rng.choice("abc d") for _ in range(n)).strip() or "a"
            lines += [line, *(line[:at] + rng.choice(["", "x", "yz"]) + line[at:] for at in (0, len(line) // 3, len(line)))]
    maps = line_dedup.bit_maps(lines).view(np.uint64)
    size = np.array([max(1, len(x) - line_dedup.SHINGLE + 1) for x in lines])
    sets = [line_dedup.shingles(x) for x in lines]
    ruled_out = 0
    for i in range(len(lines)):
        possible = line_dedup.possible(maps[i], maps, size[i], size)
        assert all(possible[j] for j in range(len(lines)) if line_dedup.alike(sets[i], sets[j]))
        ruled_out += (~possible).sum()
    assert ruled_out > 0.8 * len(lines) ** 2


@pytest.mark.parametrize("hashed, slack", [(52, 4), (52, 0), (20, 4)])
def test_similar_lines_are_those_with_similar_sets(monkeypatch, hashed, slack):
    # Few bits make hashes collide, which must only matter where the slack is too small for it.
    monkeypatch.setattr(line_dedup, "HASHED", hashed)
    monkeypatch.setattr(line_dedup, "SLACK", slack)
    monkeypatch.setattr(line_dedup, "PART", 2000)
    rng = random.Random(12)
    one, other = [], []
    for n in (1, 3, 7, 8, 9, 20, 60, 61, 350, 900):
        for edits in range(30):
            line = "".join(rng.choice("abcde \u00e9\u65e5\U0001f469") for _ in range(n)).strip() or "a"
            near = list(line)
            for _ in range(edits * n // 300):
                near[rng.randrange(len(near))] = rng.choice("xyz")
            one.append(line)
            other.append("".join(near) if edits else line[: n // 2] or "b")
    wanted = [line_dedup.alike(line_dedup.shingles(x), line_dedup.shingles(y)) for x, y in zip(one, other)]
    assert line_dedup.similar(one, other).tolist() == wanted and 30 < sum(wanted) < len(wanted) - 30
    assert line_dedup.similar([], []).tolist() == []


@pytest.mark.parametrize("held", [line_dedup.HELD, 600])
def test_groups_of_lines_connect_what_all_their_pairs_connect(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD", held)
    rng = random.Random(4)
    forms = []
    for _ in range(6):
        base = "".join(rng.choice("abcdefg ") for _ in range(90)).strip() + "."
        for _ in range(8):
            base = base[: (at := rng.randrange(len(base)))] + rng.choice("xyz") + base[at + 1 :]
            forms.append(base)
    forms = list(dict.fromkeys([*forms, "short", "shorter", "a"]))
    sets = [line_dedup.shingles(x) for x in forms]
    pairs = [(a, b) for a in range(len(forms)) for b in range(a) if line_dedup.alike(sets[a], sets[b])]
    maps = line_dedup.bit_maps(forms)

    def links(block, low, high, of=line_dedup._compared(False)):
        rows = {"node": pa.array(range(len(forms))), "class": pa.array(range(len(forms))), "block": pa.array(block), "form": pa.array(forms)}
        rows |= {"size": pa.array([max(1, len(x) - 7) for x in forms], pa.int32()), "bits": pa.array([x.tobytes() for x in maps], pa.binary())}
        return of((1, low, high), pa.table(rows).combine_chunks())

    block = [i % 2 for i in range(len(forms))]
    wanted = [p for p in pairs if block[p[0]] != block[p[1]]]
    assert roots(len(forms), links([0] * len(forms), 0, 0)) == roots(len(forms), pairs) and len(pairs) > 20
    assert roots(len(forms), links(block, 0, 1)) == roots(len(forms), wanted) and 5 < len(wanted) < len(pairs)
    lead = max(range(len(forms)), key=lambda i: (len(forms[i]), -i))
    found = links([0] * len(forms), 0, 0, line_dedup._compared(True))
    assert {tuple(sorted(p)) for p in found} == {tuple(sorted(p)) for p in pairs if lead in p}


def test_lines_of_a_text_equal_lines_normalized_one_by_one(odd, documents):
    texts = ["", " ", "A  b\n c\td \n", "\u00a0x\u2003Y z\n", "\u039f\u03a3\n\u03a3 \u03a3a\n  ", " a b \nC"]
    texts += [r.text for r in [*odd.collect(), *documents.collect()] if r.text]
    for text in texts:
        assert line_dedup._normal_lines(text) == [line_dedup.normal(x) for x in text.split("\n")]


def test_lines_in_large_and_small_bands(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    rng = random.Random(3)
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (70, 90, 200)]
    texts = ["\n".join(b[:at] + str(rng.randint(0, 9)) + b[at:] for b in bases for at in (rng.randrange(len(b)), rng.randrange(len(b)))) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert Counter((r.doc_id, tuple(r.removed), r.n_lines, r.text) for r in line_dedup.dedup_lines(docs).collect()) == plain_lines(rows_of(docs))


def test_tally_compares_whole_keys_in_full(spark):
    def keys_of(documents):
        n = np.array([int(x) for x in documents.column("text").to_pylist()], np.uint64)
        return n, n

    chunks = chunked(spark.createDataFrame([(t,) for t in ("0", "1", "1", str(1 << 63))], "text string").repartition(1))
    made = with_codes(chunks, tally(chunks, keys_of, 1), lambda documents, codes, chunk: pa.table({"codes": pa.array([codes.tolist()], pa.list_(pa.int32()))}), "codes array<int>", counts=True)
    # 0 and 1 differ in their last 25 bits only: the loose counts can't tell them apart.
    assert [r.codes for r in made.collect()] == [[3, 3, 1, 1, 2, 1]]


# --- suffixes

def plain_repeats(rows):
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for k in range(len(data) - 49):
                first[data[k : k + 50]] = min(first.get(data[k : k + 50], i), i)
    out = []
    for i, t in rows:
        data = np.frombuffer((t or "").encode(), np.uint8)
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if i is not None and first[data[k : k + 50].tobytes()] < i:
                gone[k : k + 50] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot_code", [suffix_dedup.HOT_CODE, 2])
def test_suffix_dedup(odd, documents, hot_code):
    for docs in (odd, documents):
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeats(docs, hot_code).collect())
        assert got == plain_repeats(rows_of(docs))


def test_suffix_dedup_texts(odd, nothing):
    assert suffix_dedup.repeats(nothing).count() == 0
    got = suffix_dedup.remove_repeats(odd)
    assert got.columns == odd.columns
    ids = Counter(r.doc_id for r in got.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[6] == ids[7] == 1 and ids[None] == 2


def plain_removed(rows):
    first, least, out = {}, {}, []
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            least[t] = min(least.get(t, i), i)
            for k in range(len(data) - 49):
                first[data[k : k + 50]] = min(first.get(data[k : k + 50], i), i)
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        if i is not None and t:
            for k in range(len(data) - 49):
                if first[data[k : k + 50]] < i:
                    gone[k : k + 50] = b"\1" * 50
            ends = np.cumsum([len(c.encode()) for c in t]).tolist()
            left = "".join(c for c, x, y in zip(t, [0, *ends], ends) if not any(gone[x:y]))
            if not left or len(data) < 50 and least[t] < i:
                continue
            t = left
        out.append((i, t))
    return out


def plain_kept(rows):
    kept = {i for i, _, component in plain_near(rows) if i == component}
    return [x for x in rows if x[0] in kept]


def test_pipeline_stages_row_by_row(spark, documents):
    sf = "/root/testdata/sf0.001"
    scored = {r.doc_id: r.predicted for r in quality.score(documents, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    plain = {
        "quality classifier": lambda rows: [x for x in rows if scored[x[0]]],
        "line dedup": lambda rows: [(i, t) for i, gone, _, t in plain_lines(rows).elements() if not gone or t.strip()],
        "n-gram Jaccard join": lambda rows: plain_kept(rows),
        "suffix-array dedup": plain_removed,
    }
    docs = documents
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, docs, sf), "test")
        assert Counter(rows_of(out)) == Counter(plain[name](rows_of(docs))), name
        docs = out


def test_suffix_order():
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 4, 5, *rng.integers(6, 80, 200)]:
        text = rng.integers(1, rng.integers(2, 5), n)
        assert suffix_order(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_anchors_of_long_texts_do_not_depend_on_parts(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 5000, dtype=np.uint8)
    starts = np.array([0, 1200, 1220, 5000])
    whole = suffix_dedup.anchors(data, starts)
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    parts = suffix_dedup.anchors(data, starts)

    def strings(found):
        return {(s, p) for p, _, a, b in zip(*(x.tolist() for x in found)) for s in range(a, b + 1)}

    assert strings(whole) == strings(parts)


def test_frames_and_grams_are_numbered():
    rng = np.random.default_rng(8)
    rows = rng.integers(0, 2, (300, 5)).astype(np.uint8)
    first, own = suffix_dedup._numbered(rows[:, 1:4])
    seen = list(dict.fromkeys(r.tobytes() for r in rows[:, 1:4]))
    assert [rows[i, 1:4].tobytes() for i in first] == seen and [seen[i] for i in own] == [r.tobytes() for r in rows[:, 1:4]]
    assert all(own[i] not in own[:i] for i in first)
    texts = ["", "x" * 49, "ab" * 40, "y" * 200, "", "z" * 50, "ab" * 41]
    data, starts = suffix_dedup.flat(pa.array(texts))
    place, hashes, _, _ = suffix_dedup.anchors(data, starts)
    text = suffix_dedup._texts(place, starts)
    assert all(starts[i] <= at < starts[i + 1] for i, at in zip(text, place))
    assert sorted(suffix_dedup._keys(pa.table({"text": texts})).tolist()) == sorted(h for _, h in set(zip(text.tolist(), hashes.tolist())))


def test_lines_of_several_pairs_are_hashed_once(monkeypatch):
    rng = np.random.default_rng(9)
    lines = ["".join(rng.choice(list("abcé漢 "), rng.integers(1, 60))) for _ in range(40)]
    one = [lines[i] for i in rng.integers(0, 40, 400)]
    other = [x[: rng.integers(1, len(x) + 1)] for x in one]
    plain = [line_dedup.alike(line_dedup.shingles(a), line_dedup.shingles(b)) for a, b in zip(one, other)]
    assert [line_dedup._same(a, b) for a, b in zip(one, other)] == plain
    for part in (1 << 17, 300):
        hashed, members = [], line_dedup._members
        monkeypatch.setattr(line_dedup, "PART", part)
        with monkeypatch.context() as patch:
            patch.setattr(line_dedup, "_members", lambda x: hashed.append(x) or members(x))
            assert line_dedup.similar(one, other).tolist() == plain
        assert all(len(x) == len(set(x)) for x in hashed)
    assert len(hashed) > 1


def test_later_links_join_whole_classes(spark):
    base = "".join(np.random.default_rng(10).choice(list("abcdefgh"), 400))
    chain = [base[i : i + 400 - 40] + "x" * i for i in (0, 12, 24, 36)] + ["lone line of its own", base[::-1]]
    docs = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    near = [(a, b) for a in range(len(chain)) for b in range(a) if line_dedup.alike(line_dedup.shingles(chain[a]), line_dedup.shingles(chain[b]))]
    root = roots(len(chain), near)
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {i: int(root[i] != i) for i in range(len(chain))} and sum(got.values()) >= 2


def test_first_chunk_of_a_key_is_told(spark):
    def keys_of(documents):
        n = np.array([int(x) for x in documents.column("text").to_pylist()], np.uint64)
        return n, n

    def counted(documents, codes, chunk):
        return pa.table({"chunk": pa.array([chunk]), "texts": pa.array([documents.column("text").to_pylist()]), "codes": pa.array([codes.tolist()], pa.list_(pa.int32()))})

    rows = [("1",), ("2",), ("2",), ("3",), ("1",), ("3",)]
    chunks = chunked(spark.createDataFrame(rows, "text string").repartition(3))
    made = with_codes(chunks, tally(chunks, keys_of, 1, firsts=True), counted, "chunk long, texts array<string>, codes array<int>", counts=True).collect()
    seen = {}
    for r in sorted(made, key=lambda r: r.chunk):
        own = sorted({int(x) for x in r.texts})
        for key, code in zip(own, r.codes[len(own) :]):
            assert code == 2 + (0 if key in seen else FIRST)
            seen[key] = r.chunk
    assert set(seen) == {1, 2, 3}


def test_a_form_is_told_once(spark):
    """Only the first chunk that has a form carries its text, and only bands that may be large are told as wide."""
    one = "a line that many documents of several chunks have in common"
    texts = [one, one + " and more", "x" * 70 + one]
    chunks = chunked(spark.createDataFrame([(i, texts[i % 3]) for i in range(12)], "doc_id long, text string").repartition(4))
    codes = tally(chunks, line_dedup._keys, 1, firsts=True)
    rows = with_codes(chunks, codes, line_dedup._marked, line_dedup.LINE, counts=True).collect()
    told = [r.form for r in rows if r.form is not None]
    assert len(told) == len(set(told)) and set(told) >= set(texts[:2]) and len(rows) == 12
    assert all(r.bands and not r.wide for r in rows if r.form is not None)


def test_long_lines_of_a_block_are_counted_by_shingle(monkeypatch):
    rng = np.random.default_rng(12)
    bases = ["".join(rng.choice(list("abcdefgh é漢"), 900)) for _ in range(6)]
    forms = [b[:at] + "#" * int(n) + b[at:] for b in bases for at, n in zip(rng.integers(0, 900, 5), (1, 60, 120, 200, 300))]
    near = [(i, j) for i in range(len(forms)) for j in range(i) if line_dedup.alike(line_dedup.shingles(forms[i]), line_dedup.shingles(forms[j]))]
    maps = line_dedup.bit_maps(forms)
    rows = pa.table(
        {
            "node": pa.array(range(len(forms)), pa.int64()),
            "class": pa.array(range(len(forms)), pa.int64()),
            "form": forms,
            "size": pa.array([len(x) - line_dedup.SHINGLE + 1 for x in forms], pa.int32()),
            "bits": pa.array([x.tobytes() for x in maps], pa.binary()),
            "block": pa.array([0] * len(forms), pa.int32()),
        }
    )
    gathered, line_dedup_ramp = [], line_dedup.ramp
    for held in (line_dedup.HELD, 8000):
        monkeypatch.setattr(line_dedup, "HELD", held)
        links = line_dedup._compared(False)((0, 0, 0), rows)
        assert roots(len(forms), links) == roots(len(forms), near)
    monkeypatch.setattr(line_dedup, "possible", lambda a, b, *sizes: np.ones(len(b), bool))
    with monkeypatch.context() as patch:
        patch.setattr(line_dedup, "ramp", lambda counts: gathered.append(int(np.sum(counts))) or line_dedup_ramp(counts))
        assert roots(len(forms), line_dedup._compared(False)((0, 0, 0), rows)) == roots(len(forms), near)
    # 375 pairs of unrelated lines have 900 shingles or more each.
    assert sum(gathered) < 200_000
