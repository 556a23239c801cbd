"""Language identification by rank-order n-gram profiles.

Training counts the letter n-grams (one to three letters, words padded with a blank) of
every training text per language: each task sums its batches, Spark adds the sums up.
A language's profile is its most frequent n-grams in order. A document gets the language
whose profile has the smallest out-of-place distance from the document's own ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import bounded_batches, staged

#: N-grams of a profile, of a document and of a language.
PROFILE = 300
#: Languages up to which the profiles are shipped to the tasks (PROFILE numbers each).
MOST_LANGUAGES = 2_000
#: A symbol is the letter's code point, or BLANK, which is no letter; three symbols fill 63 bits.
BLANK, _BITS = 1, 21
#: Distinct n-grams that a task holds before it sends their sums on.
HELD_GRAMS = 1 << 20
#: Characters that are encoded at a time; a longer text goes in overlapping parts.
PART = 1 << 20
UNDETERMINED = "und"


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(cp).isalpha() for cp in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def symbols(text: str) -> np.ndarray:
    """The lower-cased text's letters, each run of other characters as one BLANK, BLANK at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.concatenate(([BLANK], np.where(letters()[points], points, BLANK), [BLANK])).astype(np.int64)
    word = codes != BLANK
    return codes[np.concatenate(([True], word[1:] | word[:-1]))]


def grams(s: np.ndarray) -> np.ndarray:
    """Codes of all n-grams, n = 1 to 3, that have a letter and no blank inside; no two n-grams share a code."""
    word = s != BLANK
    one = s[word]
    two = (s[:-1] << _BITS | s[1:])[word[:-1] | word[1:]]
    three = (s[:-2] << 2 * _BITS | s[1:-1] << _BITS | s[2:])[word[1:-1]]
    return np.concatenate((one, two, three))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes in order, and their counts. Of a very long text part by part."""
    if len(text) <= PART:
        return np.unique(grams(symbols(text)), return_counts=True)
    parts = []
    start = 0
    while start < len(text):  # cut at a non-letter, so that no n-gram is lost
        end = min(len(text), start + PART)
        while end < len(text) and text[end].isalpha():
            end += 1
        parts.append(np.unique(grams(symbols(text[start:end])), return_counts=True))
        start = end
    codes = np.concatenate([p[0] for p in parts])
    distinct, where = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes in order; ties by code."""
    if len(codes) > most:  # all that reach the count of the last place, then the exact order
        floor = np.partition(counts, len(counts) - most)[len(counts) - most]
        codes, counts = codes[counts >= floor], counts[counts >= floor]
    return codes[np.lexsort((codes, -counts))][:most]


def train(spark: SparkSession, labelled: DataFrame, profile: int = PROFILE) -> DataFrame:
    """Profiles (lang, gram, rank) from labelled rows (text, lang); null text or lang is skipped.

    Counts cover every row. Each task sends the sums of its batches, one row per
    language and n-gram, which Spark adds up; it ranks them within tasks before a
    language's best meet in one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([p[0] for p in sums[lang]])
            distinct, where = np.unique(codes, return_inverse=True)
            return distinct, np.bincount(where, np.concatenate([p[1] for p in sums[lang]])).astype(np.int64)

        def sent(lang: str) -> Iterator[pa.RecordBatch]:
            codes, counts = merged(lang)
            for i in range(0, len(codes), 50_000):
                part = codes[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part, pa.int64()), pa.array(counts[i : i + 50_000])],
                    ["lang", "gram", "n"],
                )

        waiting = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                sums.setdefault(lang, []).append(gram_counts(text.as_py()))
                waiting += 1
                if waiting >= 400:
                    waiting = 0
                    for name in sums:
                        sums[name] = [merged(name)]
                    if sum(len(parts[0][0]) for parts in sums.values()) >= HELD_GRAMS:
                        for name in sums:
                            yield from sent(name)
                        sums.clear()
        for name in sums:
            yield from sent(name)

    bounded_batches(spark)
    rows = labelled.select(labelled["text"].cast("string").alias("text"), labelled["lang"].cast("string").alias("lang"))
    counted = rows.dropna().mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= profile).select("lang", "gram", (F.col("place") - 1).alias("rank"))


class Profiles:
    """All languages' profiles as a table of ranks: n-gram by language, PROFILE where one is missing."""

    def __init__(self, rows: list[tuple[str, int, int]], profile: int = PROFILE):
        self.profile = profile
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), dtype=np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, dtype=np.int32)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank

    def distances(self, codes: np.ndarray) -> np.ndarray:
        """Out-of-place distance of the ranked codes from every language; a missing n-gram costs PROFILE."""
        at = np.searchsorted(self.grams, codes)
        hit = self.ranks[np.where((at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == codes), at, len(self.grams))]
        return np.where(hit < 0, self.profile, np.abs(hit - np.arange(len(codes))[:, None])).sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score (0 to 1): how much nearer it is than the next. Ties go to the first by name."""
        if not text or not self.langs:
            return UNDETERMINED, 0.0
        codes = ranked(*gram_counts(text), self.profile)
        if not len(codes):
            return UNDETERMINED, 0.0
        d = self.distances(codes).astype(float)
        best = int(np.argmin(d))
        worst = self.profile * len(codes)
        similar = np.exp(8.0 * (1.0 - d / worst) - 8.0 * (1.0 - d[best] / worst))
        return self.langs[best], float(1.0 / similar.sum())


def predict(spark: SparkSession, docs: DataFrame, profiles: DataFrame, profile: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text).

    Null text and text without a letter give ``und`` and 0, as does an empty training set.
    Repeated rows give repeated rows. Ids are passed on as they are, other columns are not read.
    """
    rows = [tuple(r) for r in profiles.select("lang", "gram", "rank").collect()]  # PROFILE rows a language
    if len(rows) > MOST_LANGUAGES * profile:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    shared = spark.sparkContext.broadcast(Profiles(rows, profile))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [shared.value.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    bounded_batches(spark)
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, lang_pred string, score double")


def train_and_predict(spark: SparkSession, docs: DataFrame, training: Column) -> DataFrame:
    """Learn from the rows where ``training`` holds, predict all."""
    return predict(spark, docs, staged(spark, train(spark, docs.where(training)), "language-profiles"))
