"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics are mapped to cosines of random projections, which approximate a
Gaussian kernel. Each task sums its share of the normal equations; Spark adds the sums
in levels of fixed width, so no task and not the driver holds more than SUMS matrices. The ridge score is then
calibrated on rows that the fit did not see, from a histogram of fixed size.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_BYTES, bounded_batches, crc_fold, fresh, size_in_bytes, staged

#: Random features, kernel width (in standard deviations of a statistic), ridge and seed.
FEATURES, WIDTH, RIDGE, SEED = 256, 3.0, 1e-2, 20240229
#: Sums of tasks that one task adds up (and that reach the driver in the end), and bins of the calibration histogram.
SUMS, BINS = 16, 2_000
#: Fold of the labelled rows that calibrates; 0 is held out, the others fit.
FOLDS, HELD_OUT, CALIBRATES = 5, 0, 4
THRESHOLD = 0.3

STATISTICS = (
    "log_chars log_words word_length unique_words repeated_words letters upper digits space sentence_marks "
    "hashes bars exclamations other_marks line_words unique_lines long_bytes pair_variety"
).split()


def _slots(chars: str) -> np.ndarray:
    return np.array([ord(c) for c in chars])


_UPPER, _LOWER = np.arange(65, 91), np.arange(97, 123)
_DIGITS, _SPACE = np.arange(48, 58), _slots(" \t\n\r\v\f")
_STOPS, _SIGNS = _slots(".,;:?"), _slots("#$%&*@^~+=<>")
_OTHER = _slots("\"'()[]{}/\\_-`")


def statistics(text: str) -> list[float]:
    """Numbers about the whole text, each of moderate size; an empty text has all 0."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    bytes_ = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = len(text)
    words = text.split()
    n = max(1, len(words))
    lines = text.split("\n")
    ascii_letters = int(bytes_[_UPPER].sum() + bytes_[_LOWER].sum())
    wide = int(bytes_[128:].sum())
    same_next = sum(map(operator.eq, words, words[1:]))
    return [
        float(np.log1p(chars)),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        same_next / n,
        ascii_letters / chars,
        int(bytes_[_UPPER].sum()) / max(1, ascii_letters),
        int(bytes_[_DIGITS].sum()) / chars,
        int(bytes_[_SPACE].sum()) / chars,
        int(bytes_[_STOPS].sum()) / n,
        int(bytes_[_SIGNS].sum()) / n,
        int(bytes_[124]) / n,
        int(bytes_[33]) / n,
        int(bytes_[_OTHER].sum()) / n,
        float(np.log1p(len(words) / len(lines))),
        len(set(lines)) / len(lines),
        wide / len(raw),
        len(set(zip(words, words[1:]))) / n,
    ]


@dataclass(frozen=True)
class Model:
    """Standardisation, projection, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return cosines((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def cosines(z: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, 1.0 / WIDTH, (z.shape[1], FEATURES))
    b = rng.uniform(0.0, 2 * np.pi, FEATURES)
    out = np.cos(np.clip(z, -8, 8) @ w + b) * np.sqrt(2.0 / FEATURES)
    return np.hstack([out, np.ones((len(z), 1))])


def with_statistics(docs: DataFrame, label: str | None = None) -> DataFrame:
    """doc_id and x, the array of statistics, for every row; with ``label``, this column too."""
    names = ["doc_id", "x", *([label] if label else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float64())
        for batch in batches:
            x = [statistics(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, kind), *batch.columns[2:]], names)

    bounded_batches(docs.sparkSession)
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), *([docs[label].cast("double")] if label else []))
    return chosen.mapInArrow(run, "doc_id long, x array<double>" + (f", {label} double" if label else ""))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _summed(frame: DataFrame) -> np.ndarray | None:
    """The sum of all rows' arrays, one row a task: SUMS of them at a time, until so few are left for the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column(0):
                part = np.frombuffer(blob.as_py())
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = staged(frame.sparkSession, frame, "quality-sums")
    n = parts.count()
    while n > SUMS:
        n = -(-n // SUMS)
        parts = staged(frame.sparkSession, parts.repartition(n).mapInArrow(add, "part binary"), "quality-sums")
    return sum(np.frombuffer(r.part) for r in parts.collect()) if n else None


def fit(spark: SparkSession, labelled: DataFrame) -> Model:
    """Fit from rows (doc_id, x, label); every row counts. Without any, the score is 0.5 everywhere."""
    width = len(STATISTICS)
    fold = crc_fold("doc_id", FOLDS)
    training = labelled.where((fold != HELD_OUT) & (fold != CALIBRATES)).select("x", F.col("label").cast("double").alias("y"))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * width)
        for batch in batches:
            x = _matrix(batch.column(0))
            total += np.concatenate(([len(x)], x.sum(axis=0), (x * x).sum(axis=0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    sums = _summed(training.mapInArrow(moments, "part binary"))
    if sums is None or not sums[0]:
        flat = np.zeros(FEATURES + 1)
        return Model(np.zeros(width), np.ones(width), flat, np.array([0.0]), np.array([0.5]))
    mean = sums[1 : 1 + width] / sums[0]
    scale = np.sqrt(np.maximum(sums[1 + width :] / sums[0] - mean**2, 0.0))
    scale = np.where(scale < 1e-9, 1.0, scale)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = cosines((_matrix(batch.column(0)) - mean) / scale)
            total += z.T @ np.hstack([z, np.asarray(batch.column(1))[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = _summed(training.mapInArrow(normal, "part binary")).reshape(FEATURES + 1, FEATURES + 2)
    ridge = RIDGE * np.eye(FEATURES + 1) * sums[0] / FEATURES
    ridge[-1, -1] = 0.0
    weights = np.linalg.solve(total[:, :-1] + ridge + 1e-9 * np.eye(FEATURES + 1), total[:, -1])
    model = Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    held = labelled.where(fold == CALIBRATES).select("x", F.col("label").cast("double").alias("y"))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((2, BINS))
        for batch in batches:
            raw = np.clip((model.raw(_matrix(batch.column(0))) + 0.5) / 2.0, 0.0, 1.0)
            at = np.minimum((raw * BINS).astype(int), BINS - 1)
            hist[0] += np.bincount(at, minlength=BINS)
            hist[1] += np.bincount(at, np.asarray(batch.column(1)), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array([hist.tobytes()], pa.binary())], ["part"])

    hist = _summed(held.mapInArrow(binned, "part binary"))
    if hist is None or not hist[:BINS].sum():
        return model
    knots, values = isotonic(*hist.reshape(2, BINS))
    return Model(mean, scale, weights, knots * 2.0 - 0.5, values)


def isotonic(n: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over histogram bins: block centres (0 to 1) and rates."""
    blocks: list[list[float]] = []  # weight, ones, sum of centres
    for i in np.flatnonzero(n):
        blocks.append([n[i], ones[i], n[i] * (i + 0.5) / len(n)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality", stats: DataFrame | None = None) -> Model:
    """The model from rows of ``labels`` (doc_id, label) and the statistics of the documents they name.

    ``stats``: the statistics of all rows of ``docs``, if they are there already. Without, they are computed for
    labelled rows alone if the labels can be broadcast (their size is measured), else for all, so that no text is shuffled.
    Rows without a label or with a null one do not train; a label that comes twice counts twice.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("l_id"), labels[label].cast("double").alias("label")).dropna()
    known = staged(spark, known, "quality-labels")
    if stats is None and size_in_bytes(known) <= BROADCAST_BYTES:
        texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
        labelled = with_statistics(texts.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "label"), "label")
    else:
        stats = with_statistics(docs) if stats is None else stats
        labelled = stats.join(known, F.col("doc_id") == F.col("l_id")).select("doc_id", "x", "label")
    return fit(spark, staged(spark, labelled, "quality-labelled"))


def score(spark: SparkSession, stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``stats``."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.score(_matrix(batch.column(1))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of a text column; null text scores as empty text."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t or "") for t in texts]).reshape(len(texts), -1)
        return pd.Series(shared.value.score(x) if len(x) else np.zeros(0))

    return scored(text.cast("string"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``; all columns stay, repeated rows are judged alike."""
    model = train(spark, docs, labels)
    name = fresh(docs, "tm_score")
    scored = docs.withColumn(name, score_column(spark, model, docs["text"]))
    return scored.where(F.col(name) >= threshold).drop(name)
