"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

Texts with the same set of word shingles form one class. Each class has a MinHash signature, cut
into TREES strings of DEPTH values. Each tree is the prefix trie of its strings: a node at a depth is
the set of classes that share a prefix of this length. The join starts at full depth: classes below one
node are candidates, and every candidate pair is verified on the full shingle sets. From the
similarities of the verified links follows how many links such prefixes miss; while the estimated recall
is below RECALL, the prefixes are made one value shorter, and only pairs that no longer prefix
brought together are verified. So data with close copies stop early, and data with links
at the threshold go on.

A node with the members of a deeper one or of another tree's is dropped. Verification works in blocks of
bounded size: a large node is dealt over pairs of blocks, and a block returns only how many documents each
class is linked with and edges that span what it found. Spark then contracts the edges to groups. No
pair list, group or component is ever collected.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, fresh, maybe_broadcast, staged

WORDS, THRESHOLD = 5, 0.8
#: Trees, full depth of their prefixes and the least one, estimated share of all links to find.
TREES, DEPTH, LEAST_DEPTH, RECALL = 20, 6, 3, 0.9999
#: Bytes of one value of a signature.
_VALUE = 2
#: Classes and shingles of a block: bounds of one task's group.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 2_000_000
_COLUMNS = 8_192
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def found_share(similarity: np.ndarray | float, depth: int, trees: int = TREES) -> np.ndarray | float:
    """How likely a pair of this similarity shares a prefix of this depth in some tree."""
    return 1.0 - (1.0 - similarity**depth) ** trees


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of fewer words, one run of all."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = pd.util.hash_array(np.array(found, dtype=object), categorize=False)
    runs = max(1, len(hashes) - words + 1)
    total = np.zeros(runs, dtype=np.uint64)
    for k in range(min(words, len(hashes))):
        total = (total + hashes[k : k + runs]) * _MIX
        total ^= total >> np.uint64(29)
    return np.unique(_mixed(total))


class Sketcher:
    """MinHash signatures: for each tree a string of ``depth`` values, two bytes of a minimum each."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH):
        rng = np.random.default_rng(7)
        self.odd = (rng.integers(0, 1 << 63, (trees, depth), dtype=np.uint64) * np.uint64(2) + np.uint64(1)).reshape(-1, 1)
        self.add = rng.integers(0, 1 << 63, (trees, depth), dtype=np.uint64).reshape(-1, 1)

    def signature(self, s: np.ndarray) -> bytes:
        least = np.full(len(self.odd), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(s), 2048):
            part = s[None, i : i + 2048] * self.odd + self.add
            least = np.minimum(least, (part >> np.uint64(20)).min(axis=1))
        return _mixed(least).astype(np.uint16).tobytes()


def class_key(s: np.ndarray) -> bytes | None:
    """128-bit key of a shingle set; None for a text without a word."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _identified(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), text.alias("text"))


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, tk (hash of the text), cls, n (its shingles) and signature for every row."""
    sketcher = Sketcher()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, signatures = [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py() or "", words)
                keys.append(class_key(s))
                sizes.append(len(s))
                signatures.append(sketcher.signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())],
                ["doc_id", "tk", "cls", "n", "signature"],
            )

    return _identified(docs).mapInArrow(run, "doc_id long, tk long, cls binary, n long, signature binary")


def prefixes(classes: DataFrame, depth: int) -> DataFrame:
    """cls, n, tree, prefix: the node at this depth in every tree that a class is below."""
    start = lambda t: t * DEPTH * _VALUE + 1
    every = F.array(*[F.substring("signature", start(t), depth * _VALUE) for t in range(TREES)])
    return classes.select("cls", "n", F.posexplode(every).alias("tree", "prefix"))


def _shingle_rows(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls, shingles of the documents that stand for the ``wanted`` classes (cls, rep)."""
    chosen = _identified(docs).join(maybe_broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("rep"))).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingles(text.as_py() or "", words)
                if class_key(s) == key:  # rows that share the id of a representative may have other texts
                    keys.append(key)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["cls", "shingles"])

    return chosen.mapInArrow(run, "cls binary, shingles binary").dropDuplicates(["cls"])


def _similarity(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard similarities of the left sets with the right ones."""
    sizes = np.array([len(s) for s in sets])
    distinct, where, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = n[where] > 1  # a shingle that only one set has is in no intersection
    column, row = (np.cumsum(n > 1) - 1)[where[shared]], row[shared]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (start, start + _COLUMNS))
        part = np.zeros((len(sets), min(_COLUMNS, int(column[-1]) + 1 - start)), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1.0
        common += part[left] @ part[right].T
    common = common.astype(np.float64)
    return common / (sizes[left][:, None] + sizes[right][None, :] - common)


def _nodes(rows: list[tuple], depth: int) -> np.ndarray:
    """rows x trees: numbers that are equal where the prefixes of this depth are."""
    values = np.frombuffer(b"".join([r[4] for r in rows]), dtype=np.uint16).reshape(len(rows), TREES, DEPTH)[:, :, :depth].astype(np.uint64)
    out = np.zeros(values.shape[:2], dtype=np.uint64)
    for level in range(depth):
        out = _mixed((out + values[:, :, level] + np.uint64(1)) * _MIX)
    return out


def _verify_group(rows: list[tuple], tree: int, depth: int, crossing: bool, threshold: float) -> list[tuple]:
    """Links of one pair of blocks: (class, its rep, class that stands for what it is linked with here, its rep, linked
    documents, halves of the links, and of the links that they stand for at each depth from LEAST_DEPTH) for each
    class with a link.

    ``crossing``: the rows of side 0 against those of side 1; else one block against itself. Pairs that share a node of
    an earlier tree, or a deeper one, are verified there.
    """
    side = np.array([r[0] for r in rows])
    left = np.flatnonzero(side == 0) if crossing else np.arange(len(rows))
    right = np.flatnonzero(side == 1) if crossing else np.arange(len(rows))
    open_ = np.ones((len(left), len(right)), dtype=bool) if crossing else np.triu(np.ones((len(rows), len(rows)), dtype=bool), 1)
    at = _nodes(rows, depth)
    for earlier in range(tree):
        open_ &= at[left, earlier][:, None] != at[right, earlier][None, :]
    if depth < DEPTH:
        deeper = _nodes(rows, depth + 1)
        for t in range(TREES):
            open_ &= deeper[left, t][:, None] != deeper[right, t][None, :]
    keep_left, keep_right = open_.any(axis=1), open_.any(axis=0)
    if not keep_left.any():
        return []
    left, right, open_ = left[keep_left], right[keep_right], open_[keep_left][:, keep_right]
    similar = _similarity([np.frombuffer(r[5], dtype=np.uint64) for r in rows], left, right)
    linked = open_ & (similar >= threshold - 1e-9)
    weight = np.array([r[3] for r in rows], dtype=np.int64)
    depths = np.arange(LEAST_DEPTH, DEPTH + 1)
    total, links_, expected = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows)), np.zeros((len(rows), len(depths)))
    np.add.at(total, left, linked @ weight[right])
    np.add.at(total, right, linked.T @ weight[left])
    x, y = np.nonzero(linked)
    stood = 0.5 / found_share(similar[x, y][:, None], depths)
    for own in (left[x], right[y]):
        np.add.at(links_, own, 0.5)
        np.add.at(expected, own, stood)
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(x.tolist(), y.tolist()):
        a, b = find(int(left[i])), find(int(right[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
    stands = [rows[find(i)] for i in range(len(rows))]
    return [(r[1], r[2], s[1], s[2], int(total[i]), float(links_[i]), expected[i].tolist()) for i, (r, s) in enumerate(zip(rows, stands)) if total[i]]


_LINKS = "a binary, a_rep long, b binary, b_rep long, w long, links double, expected array<double>"


def _verifier(depth: int, threshold: float):
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flushed() -> None:
            if len(rows) > 1:
                out.extend(_verify_group(rows, key[0], depth, key[2] != key[3], threshold))
            rows.clear()

        def emit() -> pa.RecordBatch:
            columns = zip(*out) if out else [[]] * len(kinds)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in _LINKS.split(", ")])
            out.clear()
            return batch

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(4)))
            rest = zip(*(batch.column(i).to_pylist() for i in range(4, 10)))  # side, cls, rep, size, signature, shingles
            for this, row in zip(keys, rest):
                if this != key:
                    flushed()
                    key = this
                rows.append(row)
            if len(out) >= 10_000:
                yield emit()
        flushed()
        yield emit()

    return run


def forest_nodes(spark: SparkSession, classes: DataFrame, depth: int, deeper: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(tree, prefix, blocks) of the nodes to verify at this depth, and (m, total, x, y) of the members of all of them.

    A node with the members of a node in ``deeper`` is done; of nodes with the same members the first tree's is enough.
    """
    groups = (
        prefixes(classes, depth).groupBy("tree", "prefix")
        .agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("y"))
        .where("m > 1")
    )
    groups = groups.groupBy("m", "total", "x", "y").agg(F.min(F.struct("tree", "prefix")).alias("node"))
    groups = staged(spark, groups, "forest-nodes")
    members = groups.select("m", "total", "x", "y")
    if deeper is not None:
        groups = groups.join(maybe_broadcast(deeper), ["m", "total", "x", "y"], "left_anti")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    return groups.select("node.tree", "node.prefix", blocks.alias("blocks")), members


def links_at(spark: SparkSession, docs: DataFrame, classes: DataFrame, depth: int, groups: DataFrame, words: int, threshold: float) -> DataFrame:
    """The links of classes that share one of the nodes ``groups`` at this depth, and none verified before; see ``_verify_group``."""
    nodes = prefixes(classes, depth)
    members = staged(spark, nodes.join(maybe_broadcast(groups), ["tree", "prefix"]).select("tree", "prefix", "blocks", "cls"), "forest-members")
    wanted = members.select("cls").distinct().join(classes.select("cls", "rep", "size", "signature"), "cls")
    full = _shingle_rows(docs, wanted.select("cls", "rep"), words).join(wanted, "cls")
    own = F.pmod(F.xxhash64("cls"), "blocks").cast("int")
    dealt = (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "tree", "prefix", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "cls",
        )
    )
    ready = dealt.join(full, "cls").select("tree", "prefix", "i", "j", "side", "cls", "rep", "size", "signature", "shingles")
    sorted_ = ready.repartition("tree", "prefix", "i", "j").sortWithinPartitions("tree", "prefix", "i", "j")
    return sorted_.mapInArrow(_verifier(depth, threshold), _LINKS)


def links(spark: SparkSession, docs: DataFrame, classes: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, int]:
    """All links found, from full depth on, and the depth at which their estimated recall was reached."""
    found, deeper, depth = None, None, DEPTH
    while True:
        groups, members = forest_nodes(spark, classes, depth, deeper)
        groups = staged(spark, groups, "forest-groups")
        if not groups.isEmpty():  # without one no shorter prefix is of use: no link was found, or all nodes are done
            more = staged(spark, links_at(spark, docs, classes, depth, groups, words, threshold), "links")
            found = more if found is None else staged(spark, found.union(more), "links")
        if found is None:
            return spark.createDataFrame([], _LINKS), depth
        # a link that is found at this depth with probability p stands for 1 / p links
        sums = found.agg(F.sum("links").alias("n"), F.sum(F.get("expected", F.lit(depth - LEAST_DEPTH))).alias("of")).first()
        if not sums.n or sums.n >= recall * sums.of or depth == LEAST_DEPTH:
            return found, depth
        depth, deeper = depth - 1, members


def contracted(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): each round merges every node into its least neighbour."""
    edges = staged(spark, edges.where("a != b").distinct(), "edges")
    kind = edges.schema["a"].dataType.simpleString()
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        step = staged(spark, both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("root")), "step")
        if roots is None:
            roots = step
        else:
            moved = maybe_broadcast(step.select(F.col("node").alias("root"), F.col("root").alias("next")))
            roots = staged(spark, roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        left = maybe_broadcast(step.select(F.col("node").alias("a"), F.col("root").alias("ra")))
        right = maybe_broadcast(step.select(F.col("node").alias("b"), F.col("root").alias("rb")))
        merged = edges.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        edges = staged(spark, merged.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return roots if roots is not None else spark.createDataFrame([], f"node {kind}, root {kind}")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, tk, class_id, n_links for every row of ``docs`` (doc_id, text).

    Two rows are linked if the Jaccard similarity of their shingle sets (``words`` lower-cased
    words; a shorter text is one shingle) is at least ``threshold``; class_id is the smallest
    doc_id of all rows connected by links, n_links the number of rows linked directly. A text
    without a word (null, empty) is linked with nothing and is its own class. Repeated
    rows are linked with each other like all copies. A null doc_id stays null and names no class
    that has another id. Of all links a share of ``recall`` is found by estimate; no link below the
    threshold is reported. An empty table gives none.
    """
    bounded_batches(spark)
    sketched = staged(spark, sketches(docs, words), "sketches")
    worded = sketched.where(F.col("cls").isNotNull())
    classes = staged(
        spark,
        worded.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("signature").alias("signature")),
        "classes",
    )
    found, _ = links(spark, docs, classes, words, threshold, recall)
    # a class goes by its smallest doc_id, so the least of a group names it: no join by group
    node = lambda rep, cls: F.struct(F.col(rep).isNull().alias("no_id"), F.col(rep).alias("rep"), F.col(cls).alias("cls"))
    roots = contracted(spark, found.select(node("a_rep", "a").alias("a"), node("b_rep", "b").alias("b")))
    roots = roots.select(F.col("node.cls").alias("cls"), F.col("root.rep").alias("class_id"))
    direct = found.groupBy(F.col("a").alias("cls")).agg(F.sum("w").alias("w"))
    # only classes with a link or copies are joined; every other document is its own class
    linked = roots.join(direct, "cls", "left")
    related = classes.select("cls", "rep", "size").join(linked, "cls", "left").where(F.col("w").isNotNull() | (F.col("size") > 1))
    n_links = F.coalesce("w", F.lit(0)) + F.col("size") - 1
    info = related.select("cls", F.when(F.col("w").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"), n_links.alias("n_links"))
    alone = sketched.select("doc_id", "tk", "cls").join(maybe_broadcast(staged(spark, info, "class-info")), "cls", "left")
    return alone.select("doc_id", "tk", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id; all columns stay.

    Rows that share doc_id and text count as one document.
    """
    found = near_duplicates(spark, docs, words, threshold)
    doc_id, tk = fresh(docs, "tm_doc_id"), fresh(docs, "tm_tk")
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(doc_id), F.col("tk").alias(tk))
    gone = maybe_broadcast(staged(spark, gone.distinct(), "near-gone"))
    own = docs["doc_id"].cast("long").eqNullSafe(gone[doc_id]) & (F.xxhash64(docs["text"].cast("string")) == gone[tk])
    return docs.join(gone, own, "left_anti")
