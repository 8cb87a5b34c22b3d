"""BPE against the library, packing against its bounds, embeddings against brute force, and the pipeline."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from callsift.llm import bpe, embedding_dedup, packing
from callsift.llm.common import local_roots, stage

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD_TEXTS = ["", " ", "a" * 5000, "ab" * 3000, "\n\n  x", "<|endoftext|>a<|endoftext|><|endoftext|> b", "it's I'LL we'll", "日本語 123456 ١٢٣   x　y", "𝔘𝔫𝔦 👩‍👩‍👧 é", "\x00\x01\x7f", "_a_b__c ½ ² Ⅷ"]


def test_encoder_is_the_library():
    rng = np.random.default_rng(2)
    texts = ODD_TEXTS + ["".join(rng.choice(list("ab \n.'!é1"), rng.integers(0, 200))) for _ in range(200)]
    encoder = bpe.Encoder(bpe.load(), remembered=50)
    for part in (texts[:100], texts[100:], texts):
        ids, ends = encoder.encode(part)
        for text, at, to in zip(part, ends, ends[1:]):
            assert ids[at:to].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
            assert encoder.model.decode(ids[at:to]) == text


def test_both_splits_are_the_same():
    encoder = bpe.Encoder(bpe.load())
    for c in map(chr, [*range(0x300), *range(0x1FF0, 0x2080)]):
        for text in (c, f"a{c}b 1{c}2", f" {c}{c}  x{c}", f"'{c}s's {c}\n\n{c}"):
            assert encoder._split(text) == encoder.words(text)
    rng = np.random.default_rng(3)
    for _ in range(500):
        text = "".join(rng.choice(list("abé²1 \n\t'.!\x85\xa0\u2009—ž÷s"), 60))
        assert not encoder.not_plain(text) and encoder.plain(text) == encoder.words(text)


def test_words_of_many_texts_at_once():
    encoder = bpe.Encoder(bpe.load())
    rng = np.random.default_rng(4)
    signs = [*"abstrevmldLé²1 \n\t'.!\x1c\x00\x85\xa0\u2009—漢😀", "'s", " 's", "'re", "'ll", "  ", "\r\n", "<|endoftext|>"]
    for _ in range(300):
        texts = ["".join(rng.choice(signs, rng.integers(0, 25))) for _ in range(rng.integers(0, 9))]
        words, begins = encoder._words(texts)
        every = [x.decode() for x in words.to_pylist()]
        assert [every[a:b] for a, b in zip(begins, begins[1:])] == [[w for w in encoder._split(x) if w] for x in texts]


def test_tasks_of_a_worker_share_their_words():
    model, merged = bpe.load(), []
    encode_words = model.encode_words
    model.encode_words = lambda words: merged.extend(words) or encode_words(words)
    batch = pa.RecordBatch.from_pydict({"text": ["one two two", None, "two three"]})
    first, second = ([(ids.tolist(), ends.tolist()) for _, ids, ends in bpe.encoded(iter([batch]), model)] for _ in range(2))
    assert first == second and sorted(merged) == [b" three", b" two", b"one", b"two"]


def test_encode_and_decode_tables(spark, odd, nothing):
    rows = bpe.decode(bpe.encode(odd))
    assert set(rows.columns) == {*odd.columns, "decoded"}
    for r in rows.collect():
        assert r.decoded == (r.text or "") and r.ids == LIBRARY.encode(r.text or "", add_special_tokens=False).ids
    broken = spark.createDataFrame([([161],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(broken).collect()] == [LIBRARY.decode([161], skip_special_tokens=False), ""]
    assert bpe.digests(nothing).count() == 0 and bpe.encode(nothing).count() == 0


def test_digests(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in bpe.digests(documents).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize(("capacity", "shard"), [(2048, 12_000), (64, 50)])
def test_packing(odd, documents, capacity, shard):
    for docs in (odd, documents):
        rows = packing.pack(packing.pieces(docs, capacity), capacity, shard).collect()
        used = defaultdict(list)
        for r in rows:
            used[r.sequence_id].append((r.offset, r.length))
        for own in used.values():
            own.sort()
            assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= capacity
        least = -(-sum(r.length for r in rows) // capacity)
        assert len(used) <= least * 1.1 + 2
        want = []
        for d in docs.collect():
            ids = np.array([*LIBRARY.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
            first = (len(ids) - 1) % capacity + 1
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            want += [(d.doc_id or 0, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)


def test_crossing_keeps_every_item_within_capacity(nothing):
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 100, 400)
    a, b = (packing.fresh(sizes, 100, rng, x) for x in (0.0, 0.5))
    for _ in range(20):
        child = packing.cross(a, b, sizes, 100, rng)
        assert (child >= 0).all() and np.bincount(child, sizes).max() <= 100
    best = packing.evolve(sizes, [b], 100, rng)
    assert packing.fitness(best, sizes) >= packing.fitness(b, sizes)
    assert packing.best_fit_packing(nothing).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 24))
    rows = [base[i % 60] + rng.standard_normal(24) * rng.choice([0, 0.05, 0.2]) for i in range(400)] + [base[3]] * 50 + [base[3] * 2.0]
    n = len(rows)
    # Vectors without an id: copies, near ones, and a class of two that is alone.
    lone = rng.standard_normal(24)
    rows += [base[3], base[3] * 3.0, base[7] + 0.01, lone, lone]
    data = [(i if i < n else None, x.tolist(), i) for i, x in enumerate(rows)]
    odd = [None, [0.0] * 24, [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [], base[3][:12].tolist()]
    data += [(n + i, x, -1) for i, x in enumerate(odd)] + [(None, None, -1)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, kept int").repartition(5)
    rows_out = embedding_dedup.near_dedup(frame, block=7).collect()
    got = {r.vec_id: r for r in rows_out if r.vec_id is not None}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    a, b = np.nonzero(close)
    nodes, roots = local_roots(a, b)
    component = np.arange(len(rows))
    component[nodes] = roots
    assert len(rows_out) == len(data) and len(got) == n + 6
    links = np.array([got[i].n_links for i in range(n)])
    assert (links <= close[:n].sum(axis=1)).all() and links.sum() >= 0.98 * close[:n].sum()
    assert np.mean([got[i].component_id == component[i] for i in range(n)]) >= 0.99
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i in range(n, n + 6))
    nameless = [(r.n_links, r.component_id, r.kept) for r in rows_out if r.vec_id is None]
    want = [(int(close[i].sum()), int(component[i]) if component[i] < n else None, component[i] >= n) for i in range(n, len(rows))] + [(0, None, True)]
    assert sorted(nameless, key=str) == sorted(want, key=str)
    assert embedding_dedup.near_dedup(frame.limit(0)).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, docs, sf), "test")
        assert out.columns == columns, name
        ids, kept = {r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()}
        assert kept <= ids and len(kept) > 0.6 * len(ids)
        assert out.where("n_chars != length(text)").count() == (0 if name != "quality classifier" else docs.where("n_chars != length(text)").count())
        before, docs = docs, out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, sf).count() == pieces.count()
