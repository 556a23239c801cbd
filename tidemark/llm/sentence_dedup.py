"""Substring deduplication by sliding sentence spans.

Every run of consecutive sentences of every document that has LEAST_WORDS words is hashed; equal
hashes are brought together globally, and the sentences covered by a run that an earlier document
(by doc_id) has too are removed. A sentence of more than LONG words is cut further after words
that their own hash chooses, about one in BREAK, so a passage inside longer sentences is cut alike
wherever it stands. First occurrences are a partially aggregated minimum, so a passage that a
third of all documents share costs one row a task before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, staged

#: Words of a run at least (it goes on until it has them; shorter ones repeat by chance), words from which a
#: sentence is cut further, and how rarely.
LEAST_WORDS, LONG, BREAK = 20, 16, 8
#: A sentence ends after . ! or ? and white space, or at a line's end.
_END = re.compile(r"[.!?]+[\"')\]]*\s+|\s*\n\s*")
_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2 to the 64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


class Units:
    """A text's sentences, or parts of long ones, as they tile it; only those with a word count.

    ``at`` has the place in the text where each starts and where the last ends, ``words`` the same as numbers of words.
    """

    def __init__(self, text: str):
        spans = [m.span() for m in _WORD.finditer(text)]
        n = len(spans)
        self.hashes = word_hashes([text[a:b].lower() for a, b in spans]) if n else np.zeros(0, np.uint64)
        if not n:
            self.words, self.at = np.zeros(1, int), np.zeros(1, int)
            return
        starts = np.array([a for a, _ in spans])
        ends = np.array([m.end() for m in _END.finditer(text)], dtype=int)
        place = dict(zip(np.searchsorted(starts, ends).tolist(), ends.tolist()))  # first word of a sentence: where it starts
        first = np.array(sorted({0, *place} - {n}))
        sizes = np.diff(np.append(first, n))
        begins = np.zeros(n, dtype=bool)
        begins[first] = True
        begins[1:] |= (self.hashes[:-1] % np.uint64(BREAK) == 0) & np.repeat(sizes > LONG, sizes)[:-1]
        units = np.flatnonzero(begins)
        self.words = np.append(units, n)
        self.at = np.array([0, *(place.get(u, int(starts[u])) for u in units[1:].tolist()), len(text)])


def runs_of(units: Units, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (first unit, units, hash) of the runs, in order.

    From each unit the shortest run with ``least`` words that starts there, and the shortest that ends
    there: together they cover a repeated passage up to its first and its last unit.
    """
    b = units.words
    n = len(b) - 1
    if n <= 0 or b[-1] < least:
        return np.zeros((0, 3), dtype=np.int64)
    all_ = np.arange(n)
    ends = np.searchsorted(b, b[:-1] + least)
    begins = np.searchsorted(b, b[1:] - least, "right") - 1
    forward = all_[ends <= n] * (n + 1) + ends[ends <= n]
    backward = begins[begins >= 0] * (n + 1) + all_[begins >= 0] + 1
    s, e = np.divmod(np.unique(np.concatenate((forward, backward))), n + 1)
    with np.errstate(over="ignore"):
        power, back = powers(_BASE, int(b[-1])), powers(_INVERSE, int(b[-1]))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(units.hashes * power, dtype=np.uint64)))
        h = (sums[b[e]] - sums[b[s]]) * back[b[s]]  # the words' polynomial, whatever stands before
        h += (b[e] - b[s]).astype(np.uint64) * np.uint64(_BASE)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return np.stack((s, e - s, h.view(np.int64)), axis=1)


def without_runs(text: str, found: set[tuple[int, int, int]], least: int = LEAST_WORDS) -> tuple[str, int]:
    """The text without the units that these of its runs (first unit, units, hash) cover, and how many those are."""
    units = Units(text)
    gone = np.zeros(len(units.at) - 1, dtype=bool)
    for s, n, h in runs_of(units, least).tolist():
        if (s, n, h) in found:
            gone[s : s + n] = True
    if not gone.any():
        return text, 0
    at = units.at.tolist()
    return "".join([text[a:b] for a, b, g in zip(at, at[1:], gone.tolist()) if not g]).strip(), int(gone.sum())


def _identified(docs: DataFrame) -> DataFrame:
    """d, doc_id, text. d stands for the document and its place in order: its id, or for a null one a number above all ids."""
    text, doc_id = docs["text"].cast("string"), docs["doc_id"].cast("long")
    late = F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return docs.select(F.coalesce(doc_id, late).alias("d"), doc_id.alias("doc_id"), text.alias("text"))


def runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """d, run (first unit and units, as one number), h: a row for every run of every document."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, max(1, len(batch)), 200):
                part = batch.slice(start, 200)
                found = [runs_of(Units(t.as_py() or ""), least) for t in part.column(1)]
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                flat = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), pa.array(flat[:, 0] << 16 | flat[:, 1]), pa.array(flat[:, 2])], ["d", "run", "h"])

    if least >= 1 << 16:
        raise ValueError("a run of so many words has too many units")
    return _identified(docs).select("d", "text").mapInArrow(hashed, "d long, run long, h long")


def repeated_runs(docs: DataFrame, spark: SparkSession, least: int = LEAST_WORDS, within: bool = False) -> DataFrame:
    """d, run, h of every run whose words an earlier document has, or with ``within`` an earlier place."""
    bounded_batches(spark)
    every = staged(spark, runs(docs, least), "sentence-runs")
    place = F.struct("d", "run") if within else F.col("d")
    first = every.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    repeated = staged(spark, first.where("times > 1").select("h", "first"), "repeated-runs")
    return every.join(repeated, "h").where(place != F.col("first")).select("d", "run", "h")


def remove_repeats(spark: SparkSession, docs: DataFrame, least: int = LEAST_WORDS, within: bool = False) -> DataFrame:
    """doc_id, text, n_removed for every row of ``docs``: the text without repeated spans.

    Of a run that several documents have, the one with the smallest doc_id keeps it; what repeats inside one
    document alone stays, unless ``within`` is set: then only its first place stays. Rows that share a doc_id are one
    document, and so are rows without one that share their text; these come after all others. Null text stays null,
    a text without a repeated run stays as it is, one that repeats wholly becomes empty. Fewer than ``least`` words
    are no run. Other columns are not read; an empty table gives none.
    """
    gone = repeated_runs(docs, spark, least, within).groupBy("d").agg(F.collect_set(F.struct("run", "h")).alias("found"))  # of one document
    base = _identified(docs).join(gone, "d", "left")

    @F.pandas_udf("text string, n_removed long")
    def cleaned(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, runs_ in zip(texts, found):
            own = set() if runs_ is None else {(x["run"] >> 16, x["run"] & 0xFFFF, x["h"]) for x in runs_}
            out.append(without_runs(text, own, least) if text is not None and own else (text, 0))
        return pd.DataFrame(out, columns=["text", "n_removed"])

    return base.withColumn("out", cleaned("text", "found")).select("doc_id", "out.text", "out.n_removed")
