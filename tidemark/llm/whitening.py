"""Embedding whitening by principal components of a distributed covariance.

Entries become whole numbers (``floor(scale * c) + offset``), so counts, sums and products are exact: tasks
multiply centred blocks split into limbs that float64 matrix products hold without rounding, and Spark adds
what they found. The covariance, a matrix of the dimension's square, is then an exact fraction.

Its eigenvectors start from float32 and are corrected by Ogita-Aishima iterations, which are matrix products
only, in pairs of doubles (each product is made of exact slices). Eigenvalues closer than what an
iteration can tell apart form clusters; each is solved on its own, shifted by its mean, and
goes on in the next iteration, until every pair is told apart or equal to the pairs' precision.

Edge cases: a vector that is null or empty, or holds null, NaN, an infinity or an entry of 2^46 or more (which has
no exact whole number here) is left out, and so are vectors of another length than the most frequent one (of
equally frequent ones the longest). Without vectors the result is empty. Components of no variance (constant
dimensions, fewer vectors than dimensions) can't be whitened and are not returned. Repeated rows count each
time; a null id stays; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Entries from here on have no exact whole number in the arithmetic below.
TOO_LARGE = float(1 << 46)
#: Bits of a limb and rows of a block: products of limbs summed over a block are exact in float64.
LIMB_BITS, BLOCK_ROWS = 21, 1_024
#: Blocks whose sums fit into a long.
BLOCKS_PER_FLUSH = 256
#: Low bits of a sum that travel apart from the high ones, so that both are longs.
LOW_BITS = 60
#: Lengths of vectors whose sums a task holds at once.
LENGTHS_HELD = 16
#: Slices of a pair of doubles, and the rounds that the refinement may take.
SLICES, MOST_ROUNDS = 5, 20
#: Corrections below this are below double precision; gaps below the other one are no gaps in pairs of doubles.
SMALL, NO_GAP = 2.0**-60, 2.0**-92
#: The share of all variance under which a component has none.
NO_VARIANCE = 2.0**-70


def whole(entry: Column) -> Column:
    return F.floor(entry.cast("double") * SCALE) + F.lit(OFFSET).cast("long")


def usable_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x, the whole numbers of each vector that has all its entries."""
    chosen = table.select(table[vec_id].cast("long").alias("vec_id"), table[vector].alias("v"))
    good = chosen.where((F.size("v") > 0) & F.forall("v", lambda c: F.abs(c.cast("double")) < TOO_LARGE))
    return good.select("vec_id", F.transform("v", whole).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


# ---- exact sums and products ----


def _halves(values: np.ndarray) -> tuple[list[int], list[int]]:
    """High and low parts of Python integers, as longs that can be summed apart."""
    return [int(v) >> LOW_BITS for v in values], [int(v) & ((1 << LOW_BITS) - 1) for v in values]


def _entries(parts: DataFrame, *keys: str) -> DataFrame:
    """Sums of all tasks' parts (``high``, ``low`` arrays) by the keys and the place in the arrays."""
    each = parts.select(*keys, *[c for c in ("n", "least", "most") if c in parts.columns], F.posexplode(F.arrays_zip("high", "low")).alias("pos", "part"))
    total = [F.sum(F.col(f"part.{h}").cast("decimal(38,0)")).alias(h) for h in ("high", "low")]
    rest = [F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")] if "n" in parts.columns else []
    return each.groupBy(*keys, "pos").agg(*total, *rest)


def _joined(row) -> int:
    return (int(row.high) << LOW_BITS) + int(row.low)


def column_sums(vectors: DataFrame) -> DataFrame:
    """length, n, least, most, high, low: sums of all vectors of a length, a row a task and length."""
    names = ["length", "n", "least", "most", "high", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for length, (n, least, most, total) in held.items():
                high, low = _halves(total)
                yield pa.RecordBatch.from_pylist([dict(zip(names, (length, n, least, most, high, low)))], schema)
            held.clear()

        schema = pa.schema([("length", pa.int32()), ("n", pa.int64()), ("least", pa.int64()), ("most", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])
        for batch in batches:
            x = batch.column(0)
            lengths = np.asarray(pa.compute.list_value_length(x))
            for length in np.unique(lengths).tolist():
                rows = _matrix(x.filter(pa.array(lengths == length)))
                # a long would not hold the sum of large entries: high and low bits apart
                sums = (rows >> 26).sum(axis=0).astype(object) * (1 << 26) + (rows & ((1 << 26) - 1)).sum(axis=0).astype(object)
                if length in held:
                    n, least, most, total = held[length]
                    held[length] = [n + len(rows), min(least, int(rows.min())), max(most, int(rows.max())), total + sums]
                else:
                    if len(held) == LENGTHS_HELD:
                        yield from flushed()
                    held[length] = [len(rows), int(rows.min()), int(rows.max()), sums]
        yield from flushed()

    return vectors.select("x").mapInArrow(run, "length int, n long, least long, most long, high array<long>, low array<long>")


def limbs_of(y: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as float64 limbs, the lowest first; all but the last are not negative."""
    count = max(1, -(-bits // LIMB_BITS))
    return [(((y >> (LIMB_BITS * k)) & ((1 << LIMB_BITS) - 1)) if k < count - 1 else y >> (LIMB_BITS * k)).astype(np.float64) for k in range(count)]


def products(vectors: DataFrame, centre: list[int], bits: int) -> DataFrame:
    """i, high, low: for each row of the matrix of sums of products of centred entries, its entries from i on; a row a task and i."""
    d, middle = len(centre), np.array(centre, dtype=np.int64)
    names = ["i", "high", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, blocks = None, None, 0

        def flushed() -> np.ndarray:
            out = sum(held[a, b].astype(np.int64).astype(object) * (1 << (LIMB_BITS * (a + b))) for a, b in held)
            return out if total is None else total + out

        for batch in batches:
            x = batch.column(0)
            x = x.filter(pa.compute.equal(pa.compute.list_value_length(x), d))
            y = _matrix(x) - middle if len(x) else np.zeros((0, d), dtype=np.int64)
            for at in range(0, len(y), BLOCK_ROWS):
                parts = limbs_of(y[at : at + BLOCK_ROWS], bits)
                if held is None:
                    held = {(a, b): np.zeros((d, d), dtype=np.int64) for a in range(len(parts)) for b in range(len(parts))}
                for a, b in held:
                    held[a, b] += (parts[a].T @ parts[b]).astype(np.int64)
                blocks += 1
                if blocks == BLOCKS_PER_FLUSH:
                    total, held, blocks = flushed(), None, 0
        if held is not None:
            total = flushed()
        if total is not None:
            for i in range(d):
                high, low = _halves(total[i, i:])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([high], pa.list_(pa.int64())), pa.array([low], pa.list_(pa.int64()))], names)

    return vectors.select("x").mapInArrow(run, "i int, high array<long>, low array<long>")


# ---- pairs of doubles ----


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


@dataclass(frozen=True)
class Pair:
    """Unevaluated sums hi + lo: matrices with about 106 bits."""

    hi: np.ndarray
    lo: np.ndarray

    @staticmethod
    def of(a: np.ndarray) -> Pair:
        a = np.asarray(a, dtype=np.float64)
        return Pair(a, np.zeros_like(a))

    @property
    def T(self) -> Pair:
        return Pair(self.hi.T, self.lo.T)

    def __getitem__(self, at) -> Pair:
        return Pair(self.hi[at], self.lo[at])

    def __add__(self, other: Pair | np.ndarray) -> Pair:
        other = other if isinstance(other, Pair) else Pair.of(other)
        s, e = _two_sum(self.hi, other.hi)
        return Pair(*_two_sum(s, e + (self.lo + other.lo)))

    def __neg__(self) -> Pair:
        return Pair(-self.hi, -self.lo)

    def __matmul__(self, other: Pair) -> Pair:
        """A product from exact ones: slices of so few bits that float64 sums of their products don't round."""
        bits = (52 - int(np.ceil(np.log2(max(2, self.hi.shape[1]))))) // 2
        left, right = self.slices(bits, 1), other.slices(bits, 0)
        out = Pair.of(np.zeros((self.hi.shape[0], other.hi.shape[1])))
        for order in reversed(range(SLICES)):  # small ones first
            for i in range(order + 1):
                out = out + left[i] @ right[order - i]
        return out

    def slices(self, bits: int, axis: int) -> list[np.ndarray]:
        hi, lo, out = self.hi, self.lo, []
        for _ in range(SLICES):
            exponent = np.frexp(np.abs(hi).max(axis=axis, keepdims=True))[1]
            unit = np.ldexp(1.0, exponent - bits)
            out.append(np.rint(hi / unit) * unit)
            hi, lo = _two_sum(hi - out[-1], lo)
        return out


def clusters_of(values: Pair, delta: float) -> list[np.ndarray]:
    """Runs of sorted eigenvalues in which neighbours are at most ``delta`` apart."""
    gaps = np.abs((values[:-1] + -values[1:]).hi)
    return np.split(np.arange(len(values.hi)), np.flatnonzero(gaps > delta) + 1)


def refined(a: Pair, start: np.ndarray) -> tuple[Pair, Pair]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix, from approximate eigenvectors.

    A round estimates the errors of orthogonality and of the diagonal form and corrects both; each squares the
    error. Between eigenvalues that the round can't tell apart only orthogonality is corrected; the
    vectors of such a cluster are then rotated by the eigenvectors of the small problem they span.
    """
    x, one = Pair.of(start), np.eye(len(start))
    norm = float(np.linalg.norm(a.hi)) or 1.0
    for _ in range(MOST_ROUNDS):
        r = -(x.T @ x) + one
        s = x.T @ (a @ x)
        own = np.diagonal(r.hi)
        values = s[np.diag_indices(len(start))] + np.diagonal(s.hi) * (own / (1 - own))
        order = np.argsort(-values.hi, kind="stable")
        values, x, r, s = values[order], x[:, order], r[order][:, order], s[order][:, order]
        off = s.hi - np.diag(np.diagonal(s.hi))
        delta = max(2 * (float(np.linalg.norm(off)) + norm * float(np.linalg.norm(r.hi))), norm * NO_GAP)
        groups = clusters_of(values, delta)
        label = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        apart = label[:, None] != label[None, :]
        gap = (values[None, :] + -values[:, None]).hi
        error = (s + values.hi[None, :] * r.hi).hi
        correction = np.where(apart, error / np.where(apart, gap, 1.0), r.hi / 2)
        x = x + x.hi @ correction
        turned = False
        for g in (g for g in groups if len(g) > 1):
            shifted = a + -float(values.hi[g].mean()) * one
            small = (x[:, g].T @ (shifted @ x[:, g])).hi
            if float(np.abs(small - np.diag(np.diagonal(small))).max()) <= norm * NO_GAP:
                continue  # equal, or told apart already
            _, turn = np.linalg.eigh((small + small.T) / 2)
            x = Pair(*_placed(x, g, x[:, g] @ Pair.of(turn[:, ::-1])))
            turned = True
        if float(np.abs(correction).max()) < SMALL and not turned:
            break
    return values, x


def _placed(x: Pair, columns: np.ndarray, new: Pair) -> tuple[np.ndarray, np.ndarray]:
    hi, lo = x.hi.copy(), x.lo.copy()
    hi[:, columns], lo[:, columns] = new.hi, new.lo
    return hi, lo


# ---- the model ----


@dataclass(frozen=True)
class Whitening:
    """n vectors of the fit list; the mean is ``centre`` + ``rest`` / n; eigenvalues and unit eigenvectors (columns), falling; the trace."""

    n: int
    centre: list[int]
    rest: list[int]
    bits: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Rows centred by ``centre`` -> their components in units of their deviation."""
        return (y - np.array(self.rest, dtype=np.float64) / self.n) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - sum)^2, exact; null where it is no long."""
        most = self.n * ((1 << self.bits) + 1)
        kind = np.int64 if len(self.centre) * most * most < 1 << 63 else object
        t = self.n * y.astype(kind) - np.array(self.rest, dtype=kind)
        return [int(v) if v < 1 << 63 else None for v in (t * t).sum(axis=1)]


def _pair_of(numerator: int, denominator: int) -> tuple[float, float]:
    hi = numerator / denominator
    return hi, float(Fraction(numerator, denominator) - Fraction(hi))


def eigen(numerators: list[list[int]], denominator: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of the symmetric matrix of fractions, in double precision."""
    pairs = np.array([[_pair_of(v, denominator) for v in row] for row in numerators])
    a = Pair(pairs[:, :, 0].copy(), pairs[:, :, 1].copy())
    scale = np.abs(a.hi).max() or 1.0
    _, rough = np.linalg.eigh((a.hi / scale).astype(np.float32))
    values, x = refined(a, rough[:, ::-1].astype(np.float64))
    vectors = x.hi + x.lo
    # either sign is right: the largest entry is positive
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(vectors))])
    return values.hi + values.lo, vectors


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``usable_vectors``; none if there are none. Two passes: sums, then products of centred entries."""
    bounded_batches(vectors.sparkSession)
    sums = _entries(column_sums(vectors), "length").persist()
    try:
        found = sums.where("pos = 0").orderBy(F.desc("n"), F.desc("length")).select("length").first()
        if found is None:
            return None
        columns = sums.where(F.col("length") == found.length).orderBy("pos").collect()  # one a dimension
    finally:
        sums.unpersist()
    n, totals = columns[0].n, [_joined(r) for r in columns]
    centre = [t // n for t in totals]
    rest = [t - n * c for t, c in zip(totals, centre)]
    bits = max(max(abs(r.least - c), abs(r.most - c)) for r, c in zip(columns, centre)).bit_length() + 1
    d = len(centre)
    matrix = [[0] * d for _ in range(d)]
    for r in _entries(products(vectors, centre, bits), "i").collect():  # one an entry of the covariance
        i, j = r.i, r.i + r.pos
        matrix[i][j] = matrix[j][i] = n * _joined(r) - rest[i] * rest[j]
    trace = Fraction(sum(matrix[i][i] for i in range(d)), n * n)
    if not trace:
        return Whitening(n, centre, rest, bits, np.zeros(0), np.zeros((d, 0)), 0.0)
    values, axes = eigen(matrix, n * n)
    kept = min(components, int((values > float(trace) * NO_VARIANCE).sum()))
    return Whitening(n, centre, rest, bits, values[:kept], axes[:, :kept], float(trace))


def _blocks(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and centred rows of the vectors of the model's length."""
    for batch in batches:
        same = pa.compute.equal(pa.compute.list_value_length(batch.column("x")), len(model.centre))
        batch = batch.filter(same)
        if batch.num_rows:
            yield batch.column("vec_id"), _matrix(batch.column("x")) - np.array(model.centre, dtype=np.int64)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened values' covariance minus the identity, measured on all of them."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for _, y in _blocks(batches, model):
            w = model.whitened(y)
            total, square = total + w.sum(axis=0), square + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([[*total, *square.ravel()]], pa.list_(pa.float64()))], ["part"])

    parts = vectors.select("vec_id", "x").mapInArrow(run, "part array<double>")
    sums = parts.select(F.posexplode("part").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v")).orderBy("pos").collect()  # one an entry
    flat = np.array([r.v for r in sums]) / model.n
    mean, square = flat[:k], flat[k:].reshape(k, k)  # rows are centred already: the mean is rounding alone
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, whitened (array, a value a component) of each vector of the model's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _blocks(batches, model):
            w = model.whitened(y)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(model.deviation(y), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whiten(spark: SparkSession, table: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    vectors = usable_vectors(table, vec_id, vector)
    model = fit(vectors, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(vectors, model)
    each = transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.get(F.array(*[F.lit(float(v)) for v in model.explained]), F.col("at"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )
