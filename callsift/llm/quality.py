"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import flat, slices, stage, table
from callsift.llm.labels import held_out, learnable, pool
from callsift.llm.registry import query

FOURIER = 256
RIDGE = 1.0
#: Raw scores are summed in so many equal bins before the calibration curve is fitted.
BINS = 2048
#: One in so many learnable rows calibrates and takes no part in the fit.
CALIBRATION = 5

KINDS = ("lower", "upper", "digit", "space", "newline", "end", "comma", "quote", "bracket", "symbol", "bar", "high")


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, KINDS.index("symbol"), np.uint8)
    for name, chars in {"digit": b"0123456789", "space": b" \t", "newline": b"\n\r\x0b\x0c", "end": b".!?", "comma": b",;:", "quote": b"'\"-", "bracket": b"()[]{}<>", "bar": b"|"}.items():
        kinds[np.frombuffer(chars, np.uint8)] = KINDS.index(name)
    kinds[ord("a") : ord("z") + 1] = KINDS.index("lower")
    kinds[ord("A") : ord("Z") + 1] = KINDS.index("upper")
    kinds[128:] = KINDS.index("high")
    return kinds


STATISTICS = (*(f"share_{k}" for k in KINDS), "log_bytes", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "word_repeats", "pair_repeats", "tail_marks", "capital_words", "lines", "distinct_lines", "line_length", "exclaimed", "distinct_tails")


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; an empty or null text has its own constant row."""
    data, starts = flat(texts)
    n = len(starts) - 1
    lengths = np.diff(starts)
    kinds = np.bincount(np.repeat(np.arange(n) * len(KINDS), lengths) + _byte_kinds()[data], minlength=n * len(KINDS)).reshape(n, -1)
    out = np.zeros((n, len(STATISTICS)))
    out[:, : len(KINDS)] = kinds / np.maximum(lengths, 1)[:, None]
    out[:, len(KINDS)] = np.log1p(lengths)
    for i, text in enumerate(texts.to_pylist()):
        words = (text or "").split()
        if not words:
            continue
        count = len(words)
        sizes = np.fromiter(map(len, words), np.float64, count)
        seen = Counter(words)
        lines = [x for x in text.split("\n") if x.strip()]
        tails = Counter(w[-1] for w in words)
        marked = sum(v for k, v in tails.items() if not k.isalnum() and k not in ".,;:!?'\")")
        out[i, len(KINDS) + 1 :] = (
            np.log1p(count),
            np.minimum(sizes.mean(), 50),
            np.minimum(sizes.std(), 50),
            len(seen) / count**0.8,
            max(seen.values()) / count,
            sum(map(str.__eq__, words, words[1:])) / count,
            1 - len(set(zip(words, words[1:]))) / max(1, count - 1),
            marked / count,
            sum(map(str.isupper, words)) / count,
            np.log1p(len(lines)),
            len(set(lines)) / len(lines),
            np.log1p(len(text) / len(lines)),
            tails["!"] / count,
            len(tails) / min(count, 60),
        )
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the statistics of each whole text."""

    def run(batches):
        for batch in slices(batches):
            x = statistics(batch.column("text"))
            flat_x = pa.array(x.ravel())
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat_x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), rows], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of a Gaussian kernel, and a constant."""
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.frequencies + self.phases)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return np.clip(raw if self.knots is None else np.interp(raw, *self.knots), 0, 1)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.concatenate(column.to_list()).reshape(-1, width) if len(column) else np.zeros((0, width))


def _sum_blobs(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x) for x in rows["sums"])
    return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // 16], "sums": [total.tobytes()]})


def _equations(rows: DataFrame, model: QualityModel) -> DataFrame:
    """``(part, sums)``: the normal equations of each partition. A task that is done again gives its row the same part, so
    the row goes to the same sum again."""
    width, size = len(STATISTICS), len(model.weights)

    def run(batches):
        total = np.zeros((size, size + 1))
        for frame in batches:
            z = model.fourier(_matrix(frame["x"], width))
            total += z.T @ np.hstack([z, frame["y"].to_numpy()[:, None]])
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "sums": [total.tobytes()]})

    return rows.mapInPandas(run, "part long, sums binary")


def fit(rows: DataFrame, features: int = FOURIER, ridge: float = RIDGE, gamma: float | None = None) -> QualityModel | None:
    """Model from ``(doc_id, x, y)``, null without rows.

    Mean and spread of the statistics, then the normal equations, are sums that each partition takes over its
    own rows; the second, ``features``-square whatever the input, are added sixteen at a time on the executors.
    The driver solves one system of that size and fits a curve through at most ``BINS`` points.
    """
    width = len(STATISTICS)
    moments = rows.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("j").collect()
    if not moments:
        return None
    rng = np.random.default_rng(17)
    # Kernel width by the usual rule: mean squared distance of standardized rows is twice their width.
    gamma = gamma or 1 / width
    model = QualityModel(
        np.array([r.m for r in moments]), np.array([r.s if r.s > 1e-9 else 1.0 for r in moments]), rng.standard_normal((width, features)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1)
    )
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0

    parts = max(1, min(rows.rdd.getNumPartitions(), moments[0].n // 4096 + 1))
    sums = _equations(rows.where(~calibrates).coalesce(parts), model)
    while parts > 1:
        parts = -(-parts // 16)
        sums = sums.withColumn("part", F.pmod("part", F.lit(parts))).groupBy("part").applyInPandas(_sum_blobs, "part long, sums binary")
    total = sum(np.frombuffer(r.sums) for r in sums.collect()).reshape(features + 1, features + 2)
    penalty = ridge * np.eye(features + 1)
    penalty[-1, -1] = 1e-6
    model.weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def raw(batches):
        for frame in batches:
            yield pd.DataFrame({"bin": np.clip(model.raw(_matrix(frame["x"], width)) * BINS / 3 + BINS / 3, 0, BINS).astype(np.int64), "y": frame["y"]})

    points = rows.where(calibrates).mapInPandas(raw, "bin long, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count("y").alias("n")).orderBy("bin").collect()
    if points:
        x = np.array([(p.bin - BINS / 3 + 0.5) * 3 / BINS for p in points])
        model.knots = pool(x, np.array([p.y for p in points]), np.array([float(p.n) for p in points]))
    return model


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    The statistics of each whole text are taken once; labels join them by id, only rows that are not held out. Neither
    labels nor other columns enter a score, so rows with the same text get the same score, also without an id.
    Without labelled rows every score is 0.5; with one class only it is that class's.
    """
    known = stage(with_statistics(docs), "statistics")
    rows = stage(known.join(learnable(labels, "quality"), "doc_id").select("doc_id", "x", "y"), "labelled")
    model = fit(rows)
    width = len(STATISTICS)

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, width)
            scores = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = known.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose text scores ``threshold`` or more, with all their columns; scored where they are read."""
    rows = stage(with_statistics(docs).join(learnable(labels, "quality"), "doc_id").select("doc_id", "x", "y"), "labelled")
    model = fit(rows)
    if model is None:
        return docs

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(model.score(statistics(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


@query()
def op9_quality_classifier(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
