"""Toxicity: boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import slices, stage, table
from callsift.llm.labels import held_out, learnable
from callsift.llm.registry import query

#: Labelled rows (about) that are learned from, for each of the two labels.
SAMPLE = {1.0: 6000, 0.0: 12000}
#: Terms kept in a lexicon at most, by weight of evidence.
LEXICON = 4000
TREES, DEPTH, STEP = 30, 4, 0.2
NEAR = 6
CACHE = 200_000

LETTERS = re.compile(r"[^\W\d_]+")
#: Words as they stand, for marks and disguises.
TOKEN = re.compile(r"\S+")
DISGUISED = re.compile(r"[^\W\d_](?:[\d@$*!#|+]+)[^\W\d_]")
SPACED = re.compile(r"(?:\b\w[ .*_-]){3,}\w\b")
#: Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur thou thee tu toi te vous ton ta tes votre vos du dich dir dein deine deinen ihr euch euer eure sie tú ti usted ustedes vosotros vosotras vuestro tuyo contigo".split()
)
#: Digits and signs written for letters.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
PREFIXES = (4, 5, 6)

FEATURES = (
    "log_words", "hit_density", "weight_density", "top_weight", "log_hits", "distinct_hits", "hit_share_long", "second_person", "near_second_person", "capitals", "capital_words", "exclaimed", "asked", "marks",
    "mark_runs", "disguised", "disguised_hits", "spaced_out", "digits", "word_length",
)


def _terms(word: str) -> list[str]:
    return [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]


def _counted(batches):
    """Documents of each fold and label that hold a term, summed over a slice."""
    for batch in slices(batches):
        sums: dict[str, list[int]] = {}
        for text, y, fold in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), batch.column("fold").to_pylist()):
            at = 2 * fold + int(y)
            for term in {t for w in set(LETTERS.findall((text or "").lower())) for t in _terms(w)}:
                sums.setdefault(term, [0, 0, 0, 0])[at] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(4))], names=["term", "c0", "t0", "c1", "t1"])


def _weights(rows, sizes: list[int], folds: tuple[int, ...]) -> dict[str, float]:
    """Log odds of terms that the labelled rows of ``folds`` speak for; the rest is no part of the lexicon."""
    clean, toxic = sum(sizes[2 * f] for f in folds), sum(sizes[2 * f + 1] for f in folds)
    found = {}
    for row in rows:
        c, t = sum(row[2 * f + 1] for f in folds), sum(row[2 * f + 2] for f in folds)
        weight = math.log((t + 0.1) / (toxic + 1)) - math.log((c + 0.4) / (clean + 1))
        if t >= 2 and weight > 1.5:
            found[row[0]] = weight * math.log1p(t)
    best = sorted(found, key=lambda x: (-found[x], x))[:LEXICON]
    return {x: found[x] for x in best}


class Reader:
    """Features of texts under a lexicon; words looked up once are remembered, up to ``CACHE`` of them."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[word] = max((self.lexicon.get(t, 0.0) for t in _terms(word)), default=0.0)
        return found

    def features(self, text: str) -> tuple[float, ...]:
        lower = text.lower()
        words = LETTERS.findall(lower)
        if not words:
            return (0.0,) * len(FEATURES)
        count = len(words)
        weights = [self.weight(w) for w in words]
        hits = [i for i, w in enumerate(weights) if w]
        second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = 0
        if hits and second:
            at = np.searchsorted(second, hits)
            pairs = np.array(second)
            gap = np.minimum(np.abs(pairs[np.minimum(at, len(pairs) - 1)] - hits), np.abs(pairs[np.maximum(at - 1, 0)] - hits))
            near = int((gap <= NEAR).sum())
        size = len(text)
        disguised = [x for x in TOKEN.findall(lower) if DISGUISED.search(x)] if DISGUISED.search(lower) else []
        letters = sum(map(len, words))
        upper = sum(map(str.isupper, text))
        marks = text.count("!") + text.count("?")
        tokens = text.split()
        return (
            math.log1p(count),
            len(hits) / count,
            sum(weights) / count,
            max(weights),
            math.log1p(len(hits)),
            math.log1p(len({words[i] for i in hits})),
            sum(len(words[i]) > 6 for i in hits) / max(1, len(hits)),
            len(second) / count,
            near / max(1, len(hits)),
            upper / max(1, letters),
            sum(map(str.isupper, tokens)) / max(1, len(tokens)),
            text.count("!") / count,
            text.count("?") / count,
            marks / size,
            (text.count("!!") + text.count("??")) / count,
            len(disguised) / count,
            sum(1 for x in disguised if any(self.weight(w) for w in LETTERS.findall(x.translate(DISGUISE)))) / count,
            len(SPACED.findall(lower)) / count,
            sum(map(text.count, "0123456789")) / size,
            letters / count,
        )


def _featured(lexicons: list[dict[str, float]], carried: tuple[str, ...]):
    """Rows with their features, under the lexicon of their fold or the only one."""

    def run(batches):
        readers = [Reader(x) for x in lexicons]
        for batch in slices(batches):
            folds = batch.column("fold").to_pylist() if len(readers) > 1 else [0] * batch.num_rows
            rows = [readers[f].features(text or "") for text, f in zip(batch.column("text").to_pylist(), folds)]
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(np.array(rows, np.float64).ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), x], names=[*carried, "x"])

    return run


def sample(labels: DataFrame) -> tuple[DataFrame, dict[float, int]]:
    """About ``SAMPLE`` learnable rows of each label by a hash of their id, with weights that restore the labels' shares;
    and how many learnable rows there are."""
    rows = learnable(labels, "toxic")
    there = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    share = {y: min(1.0, SAMPLE[y] / n) for y, n in there.items()}
    picked = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.when(F.col("y") == 1, int(share.get(1.0, 1) * (1 << 20))).otherwise(int(share.get(0.0, 1) * (1 << 20)))
    weight = F.when(F.col("y") == 1, 1 / share.get(1.0, 1)).otherwise(1 / share.get(0.0, 1))
    return rows.where(picked).withColumn("weight", weight).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(2)).cast("int")), there


def fit(docs: DataFrame, labels: DataFrame):
    """``(lexicon, trees, calibration)``, or the only label there is, or null without labels.

    Lexicons are learned from the sampled rows: terms are whole words and their beginnings. For the trees, each half of
    the sample is read with the lexicon of the other half, so that densities mean there what they mean on new texts.
    A fifth of the sample calibrates and grows no trees.
    """
    rows, there = sample(labels)
    if len(there) < 2:
        return next(iter(there), None)
    # Bounded by SAMPLE: some 18,000 ids.
    rows = stage(rows, "labelled")
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(rows), "doc_id").repartition(32), "labelled")
    sizes = [0, 0, 0, 0]
    for r in texts.groupBy("fold", "y").count().collect():
        sizes[2 * r.fold + int(r.y)] = r["count"]
    if not sizes[0] + sizes[2] or not sizes[1] + sizes[3]:
        return 0.0 if sizes[0] + sizes[2] else 1.0 if sizes[1] + sizes[3] else None
    sums = texts.mapInArrow(_counted, "term string, c0 long, t0 long, c1 long, t1 long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")))
    odds = (F.col("t0") + F.col("t1") + 0.1) / (F.col("c0") + F.col("c1") + 0.4)
    best = sums.where("t0 + t1 >= 2").orderBy((F.log(odds) * F.log1p(F.col("t0") + F.col("t1"))).desc(), "term").limit(3 * LEXICON).select("term", "c0", "t0", "c1", "t1").collect()
    crossed = [_weights(best, sizes, (1,)), _weights(best, sizes, (0,))]
    lexicon = _weights(best, sizes, (0, 1))
    carried = ("doc_id", "y", "weight")
    read = texts.mapInArrow(_featured(crossed, carried), "doc_id long, y double, weight double, x array<double>")
    read = stage(read.select(*carried, array_to_vector("x").alias("features")), "features").coalesce(8)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0
    grown = read.where(~calibrates)
    if grown.select("y").distinct().count() < 2:
        grown = read
    trees = GBTClassifier(labelCol="y", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5, maxBins=64, cacheNodeIds=False).fit(grown)
    checked = read.where(calibrates) if grown is not read and read.where(calibrates).select("y").distinct().count() == 2 else read
    raw = trees.transform(checked).select("y", "weight", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="y", weightCol="weight").fit(raw)
    return lexicon, trees, calibration


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Whole texts are read; nothing but the text enters a score, so equal texts get equal scores, also without an id.
    Texts without a letter (null, empty) have all features 0. Without labelled rows every score is 0.5; with
    one label only it is that label. A document that is labelled twice counts with its lower label.
    """
    model = fit(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not isinstance(model, tuple):
        scored = texts.select("doc_id", F.lit(0.5 if model is None else float(model)).alias("score"))
    else:
        lexicon, trees, calibration = model
        read = texts.mapInArrow(_featured([lexicon], ("doc_id",)), "doc_id long, x array<double>").select("doc_id", array_to_vector("x").alias("features"))
        raw = trees.transform(read).select("doc_id", vector_to_array("probability")[1].alias("raw"))
        scored = calibration.transform(raw).select("doc_id", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query()
def op3_toxicity(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
