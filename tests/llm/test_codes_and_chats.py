"""Centroid clustering, vector codes and chat formatting against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from callsift.llm import centroid_clustering, chat_formatting, vector_codes

EXTRA = "cluster int, code string, error long, v binary, part int, text string"
BOUND = 1 << 27


def vectors(dimension: int) -> list[tuple]:
    rng = np.random.default_rng(4)
    base = rng.standard_normal((9, dimension)) * 0.3
    rows = [(i, (base[i % 9] + rng.standard_normal(dimension) * rng.choice([0, 0.02, 0.2])).tolist(), i % 4 or None) for i in range(240)]
    # A third of all rows is one vector; ids repeat, one is missing; some components are beyond what is held.
    rows += [(1000 + i, base[2].tolist(), 7) for i in range(140)]
    rows += [(3, base[1].tolist(), 1), (3, base[4].tolist(), 1), (None, base[5].tolist(), 2), (900, [1e300] + [-1e300] * (dimension - 1), 2), (901, [0.0] * dimension, 3)]
    return rows


def odd_vectors(dimension: int) -> list[tuple]:
    full = [0.5] * dimension
    return [(-9, None, 1), (-8, [], 1), (-7, full[:-1], 1), (-6, [*full[:-1], None], None), (-5, [*full[:-1], float("nan")], 1), (-4, [float("-inf"), *full[1:]], 1), (-3, full + full, 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "c", 1, b"v", 2, "t") for r in rows], f"vec_id long, embedding array<double>, label int, {EXTRA}").repartition(5)


def floors(values, scale):
    return [max(-BOUND, min(BOUND, math.floor(x * scale) if abs(x) < 1e290 else int(math.copysign(BOUND, x)))) for x in values]


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def closest(v, entries):
    return min((squared(v, e), i) for i, e in enumerate(entries))


def moved(entries, members):
    return [[sum(x) // len(own) for x in zip(*own)] if (own := members.get(i)) else e for i, e in enumerate(entries)]


def plain_clusters(rows, k, rounds, seed, scale, dimension):
    kept = [(i, floors(v, scale)) for i, v, _ in rows if v and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    by = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in by[:k]]
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(closest(v, centroids)[1], []).append(v)
        centroids = moved(centroids, members)
    found = [(i, *closest(v, centroids)[::-1]) for i, v in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for _, c, d in found if c == own) for own in range(len(centroids))]
    return sorted(((i, c, d, min(inertia[c], 2**63 - 1), min(sum(inertia), 2**63 - 1), names[c]) for i, c, d in found), key=str)


@pytest.mark.parametrize(("k", "dimension"), [(8, 64), (40, 12), (1, 12)])
def test_clusters(spark, k, dimension):
    rows = vectors(dimension) + odd_vectors(dimension)
    got = centroid_clustering.clusters(frame(spark, rows), k=k, rounds=3, dimension=dimension)
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, k, 3, 3, 1024, dimension)


def test_few_or_no_vectors(spark):
    rows = vectors(12)[:3]
    assert sorted(map(tuple, centroid_clustering.clusters(frame(spark, rows), rounds=2, dimension=12).collect()), key=str) == plain_clusters(rows, 8, 2, 3, 1024, 12)
    none = frame(spark, odd_vectors(12))
    assert centroid_clustering.clusters(none, dimension=12).count() == 0 and centroid_clustering.clusters(none.limit(0)).count() == 0


def test_search_equals_comparison_with_all():
    rng = np.random.default_rng(1)
    for k, width, spread in ((1, 3, 5), (30, 2, 4), (60, 3, 50), (25, 5, 1 << 27)):
        centroids = rng.integers(-spread, spread, (k, width))
        points = np.concatenate([rng.integers(-spread, spread, (800, width)), centroids, (centroids[:1] + centroids) // 2])
        cluster, distance = centroid_clustering.nearest(points, centroid_clustering.Lists(centroids))
        every = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_search_skips_far_centroids(monkeypatch):
    rng = np.random.default_rng(1)
    centroids = rng.integers(0, 10_000, (200, 2))
    lists = centroid_clustering.Lists(centroids)
    compared = []
    plain = centroid_clustering._squared
    monkeypatch.setattr(centroid_clustering, "_squared", lambda a, b: compared.append(len(a)) or plain(a, b))
    centroid_clustering.nearest(centroids[rng.integers(0, 200, 2000)] + rng.integers(-30, 30, (2000, 2)), lists)
    assert sum(compared) < 0.5 * 2000 * 200


def plain_codes(rows, parts, entries, rounds, scale, dimension):
    kept = [(i, label, floors(v, scale)) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    own = [r for r in kept if len(r[2]) == dimension]
    width = dimension // parts

    def cut(v):
        return [v[p * width : (p + 1) * width] for p in range(parts)]

    first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v)[p] for _, _, v in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, _, v in own:
                members.setdefault(closest(cut(v)[p], books[p])[1], []).append(cut(v)[p])
            books[p] = moved(books[p], members)
    found = [(i, label, [closest(x, book) for x, book in zip(cut(v), books)]) for i, label, v in own]
    coded = [(i, label, "".join(f"{e:02x}" for _, e in x), sum(d for d, _ in x)) for i, label, x in found]
    coded += [(i, label, None, None) for i, label, v in kept if len(v) != dimension]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    sums = {}
    for _, label, _, error in coded:
        sums[label] = sums.get(label, 0) + (error or 0)
    has = {label for _, label, _, error in coded if error is not None}
    return sorted(((i, label, code, error, digest, min(sums[label], 2**63 - 1) if label in has else None) for i, label, code, error in coded), key=str)


@pytest.mark.parametrize(("parts", "entries", "dimension"), [(16, 64, 64), (4, 10, 12), (2, 256, 12)])
def test_codes(spark, monkeypatch, parts, entries, dimension):
    monkeypatch.setattr(vector_codes, "SLICE", 50)
    rows = vectors(dimension) + odd_vectors(dimension)
    got = vector_codes.with_label_errors(vector_codes.compress(frame(spark, rows), parts, entries))
    assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows, parts, entries, 2, 256, dimension)


def test_codes_without_vectors_or_labels(spark):
    empty = frame(spark, odd_vectors(64)[:1])
    assert vector_codes.with_label_errors(vector_codes.compress(empty)).count() == 0
    assert vector_codes.compress(frame(spark, []).drop("label")).count() == 0
    lone = vector_codes.compress(frame(spark, [(1, [1.0, 2.0, 3.0], 4)]).drop("label")).collect()
    assert [tuple(r)[:4] for r in lone] == [(1, None, None, None)]
    with pytest.raises(ValueError):
        vector_codes.compress(empty, entries=257)


CHATS = [
    (1, 0, "system", "be\nkind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello ### Assistant: \\### </turn>\n</turn>"), (1, 3, "user", "é 日本 👩‍👩‍👧"), (1, 4, "assistant", "\\"), (1, 5, "user", "open end"),
    (2, 0, "user", None), (2, 1, "assistant", None), (2, 2, "assistant", "twice"), (3, 0, "user", "no reply"), (4, 0, "assistant", ""), (5, None, None, "x"), (5, 7, "ro: le### ", "<"), (5, 7, "ro: le### ", "<"), (5, 7, "assistant", "b"), (5, 7, "assistant", "a"),
    (None, 1, "assistant", "lost"), (None, 0, "user", "id"), *((6, t, "assistant" if t % 2 else "user", f"turn {t} " * (t % 7)) for t in range(60)), (7, 0, "user", "long " * 20_000), (7, 1, "assistant", "</turn>" * 9_000),
]


def chats(spark, rows):
    rows = random.Random(3).sample(rows, len(rows))
    return spark.createDataFrame([(*r, 1, 2, "c", 3) for r in rows], "conv_id long, turn long, role string, text string, block int, example int, loss string, part int").repartition(6)


def in_order(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {conv: [(role, text) for *_, role, _, text in sorted(own)] for conv, own in convs.items()}


def formatted(turns):
    return "".join(f"### {chat_formatting.escape(role, chat_formatting.IN_ROLE)}: {chat_formatting.escape(text)}</turn>\n" for role, text in turns)


@pytest.mark.parametrize("block", [1, 90, 1 << 18])
def test_examples_and_digests(spark, block):
    df = chats(spark, CHATS)
    parts = {}
    for r in chat_formatting.prefix_examples(df, block).collect():
        parts.setdefault((r.conv_id, r.example), []).append(r)
    want, digests = {}, []
    for conv, own in in_order(CHATS).items():
        ends = [i for i, (role, _) in enumerate(own) if role == "assistant"]
        closing = [] if ends and ends[-1] == len(own) - 1 else [len(own) - 1]
        texts = [formatted(own[: i + 1]) for i in ends + closing]
        replies = [own[i][1] for i in ends] + [None] * len(closing)
        want |= {(conv, n): (text, reply) for n, (text, reply) in enumerate(zip(texts, replies))}
        said, loss = "".join(f"{r}\n{t}\n" for r, t in own), "".join(own[i][1] for i in ends)
        digests.append((conv, len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(map(len, texts))))
    assert parts.keys() == want.keys()
    for key, own in parts.items():
        own.sort(key=lambda r: r.part)
        assert [r.part for r in own] == list(range(len(own))) and "".join(r.text for r in own) == want[key][0]
        spans = [chat_formatting.unescape(r.text[r.loss_start : r.loss_end]) for r in own if r.loss_start is not None]
        assert spans == ([] if want[key][1] is None else [want[key][1]])
    assert sorted(map(tuple, chat_formatting.digests(df, block).collect()), key=str) == sorted(digests, key=str)


def test_no_chats(spark):
    df = chats(spark, CHATS).limit(0)
    assert chat_formatting.prefix_examples(df).count() == 0 and chat_formatting.digests(df).count() == 0


@given(st.lists(st.tuples(st.text("\\ #:</turn>\n a", max_size=20), st.text("\\ #:</turn>\n a", max_size=30))))
def test_formatting_is_reversible(turns):
    assert list(chat_formatting.turns(formatted(turns))) == turns
    for _, text in turns:
        assert not any(control in chat_formatting.escape(text) for control in chat_formatting.CONTROL)
