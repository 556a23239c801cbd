"""The prefix trie of conversations rebuilt from another's head and their own rest.

A sequence of turns has a fingerprint in a monoid: a turn maps a number s to ``s * BASE + digest`` modulo a prime, and
a sequence to the composition of its turns' maps, which is a pair (power, sum). Four primes are used at once.
Prefix pairs are made once for the conversations as they are, by a scan over ranges of the sorted turns: each task composes the turns
it has, and what the tasks before it hold of its first conversation is one more pair (``carried``). A rebuilt
conversation is never made: behind a head with sum H, the own turns after the h-th have the prefix sums
``s * power_i + sum_i`` with one number s = (H - sum_h) / power_h a conversation.

Prefixes of one depth and fingerprint are a node. Each rebuilt turn keeps a reference to the stored turn it is, by whose SHA-256
over role and text every node is verified: its members' last turns are equal, and so are their parents, hence all
their turns. If a node fails, fingerprints are made again with other bases.

Sums over subtrees need no walk along the depth: what a node knows of its descendants nearer than 2^k is doubled by
what its descendants at exactly that distance know of theirs. Only nodes of several members take part, as below
all others there is one chain.

Edge cases: null role or text count as empty; turns of equal number are ordered by role and then by the SHA-256 of role and
text, so repeated rows are turns of their own; rows without conv_id belong to no conversation; ``c - c % 5`` takes the sign of c, as in
SQL; a conversation whose head and rest are empty is a member of the root alone; an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, staged

#: Primes under 2^31 (products fit into a long) and their bases; a second set of bases for the case that a node fails.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = ((1103515245, 1664525913, 1220703125, 1597334677), (1812433253, 1566083941, 1406932606, 1852349183))
#: A conversation takes over at most so many turns.
MOST_HEAD = 8
#: Characters of joined ids that travel as one row to where a node's ids are hashed.
CHUNK_CHARS = 1 << 16
LANES = range(len(PRIMES))


class FingerprintCollision(Exception):
    """Different prefixes had equal fingerprints under every set of bases."""


# ---- the conversations as they are ----


def turn_digest() -> Column:
    """SHA-256 over role and text; a length keeps the two apart."""
    return F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)


def stored_turns(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, bytes of each turn: the texts stay where they are."""
    text = lambda c: F.coalesce(table[c].cast("string"), F.lit(""))
    rows = table.select(table["conv_id"].cast("long").alias("conv_id"), table["turn"].cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    rows = rows.where(F.col("conv_id").isNotNull())
    return rows.select("conv_id", "turn", "role", turn_digest().alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


def _lanes(what: str) -> list[str]:
    return [f"{what}{i}" for i in LANES]


def scanned(spark: SparkSession, turns: DataFrame, bases: tuple[int, ...]) -> DataFrame:
    """conv_id, pos (from 1), digest, bytes, power and sum of each lane: prefix pairs of every conversation, whatever its length."""
    fields = ["conv_id", "pos", "digest", "bytes", *_lanes("power"), *_lanes("sum")]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pos, power, total = None, 0, [1] * len(PRIMES), [0] * len(PRIMES)
        for batch in batches:
            convs, digests = batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()
            out: list[list] = [[] for _ in range(1 + 2 * len(PRIMES))]
            for conv, digest in zip(convs, digests):
                if conv != current:
                    current, pos, power, total = conv, 0, [1] * len(PRIMES), [0] * len(PRIMES)
                pos += 1
                number = int(digest, 16)
                power = [v * b % p for v, b, p in zip(power, bases, PRIMES)]
                total = [(v * b + number) % p for v, b, p in zip(total, bases, PRIMES)]
                for column, value in zip(out, (pos, *power, *total)):
                    column.append(value)
            longs = [pa.array(c, pa.int64()) for c in out]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), longs[0], batch.column("digest"), batch.column("bytes"), *longs[1:]], fields)

    kinds = ", ".join(f"{c} {'string' if c == 'digest' else 'long'}" for c in fields)
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    parts = staged(spark, ordered.mapInArrow(local, kinds).withColumn("part", F.spark_partition_id()), "trie-scan")
    carried = _carried(parts)
    if not carried:
        return parts.select(*fields)
    names = ["part", "conv_id", "before", *_lanes("carry"), *_lanes("more")]
    rows = [(*row, *[pow(b, row[2], p) for b, p in zip(bases, PRIMES)]) for row in carried]
    # one row a task at most
    known = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'part' else 'long'}" for c in names))
    joined = parts.join(F.broadcast(known), ["part", "conv_id"], "left")
    sums = [F.when(F.col("before").isNull(), F.col(f"sum{i}")).otherwise((F.col(f"carry{i}") * F.col(f"power{i}") + F.col(f"sum{i}")) % PRIMES[i]).alias(f"sum{i}") for i in LANES]
    powers = [F.when(F.col("before").isNull(), F.col(f"power{i}")).otherwise(F.col(f"power{i}") * F.col(f"more{i}") % PRIMES[i]).alias(f"power{i}") for i in LANES]
    return joined.select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes", *powers, *sums)


def _carried(parts: DataFrame) -> list[tuple]:
    """part, conv_id, turns before and their sums, for each task that begins inside a conversation: from each task's ends."""
    last = F.max(F.struct("conv_id", "pos", *_lanes("power"), *_lanes("sum"))).alias("last")
    ends = parts.groupBy("part").agg(F.min("conv_id").alias("first"), last).orderBy("part").collect()  # one row a task
    out, conv, before, sums = [], None, 0, [0] * len(PRIMES)
    for row in ends:
        end = row.last
        same = row.first == conv
        if same:
            out.append((row.part, conv, before, *sums))
        if same and end.conv_id == conv:  # the whole task lies inside
            sums = [(s * end[f"power{i}"] + end[f"sum{i}"]) % PRIMES[i] for i, s in enumerate(sums)]
            before += end.pos
        else:
            conv, before, sums = end.conv_id, end.pos, [end[f"sum{i}"] for i in LANES]
    return out


# ---- the rebuilt ones, as pairs ----


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_HEAD + 1)


def _keys(sums: list[Column]) -> list[Column]:
    """Two longs for four lanes."""
    return [(F.shiftleft(sums[0], 31) + sums[1]), (F.shiftleft(sums[2], 31) + sums[3])]


def rebuilt(prefixes: DataFrame, bases: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, turns, k1, k2 of all of them) and their turns.

    A turn has conv_id, depth, whether it is the last, the keys of the prefix that ends with it (k1, k2) and of the one before (p1, p2), and the
    digest and bytes of the stored turn it refers to.
    """
    sums = _lanes("sum")
    early = prefixes.where(F.col("pos") <= MOST_HEAD)
    owned = early.groupBy("conv_id").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", F.struct("digest", "bytes", *sums)))).alias("head")  # at most MOST_HEAD turns
    )
    lengths = prefixes.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = lengths.join(owned, "conv_id").withColumns({"h": head_length(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % 5})
    heads = owned.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    convs = convs.join(heads, "base", "left")
    taken = F.coalesce(F.least(F.col("h"), F.size("base_head")), F.lit(0)).cast("long")
    at = lambda m, n, field: F.coalesce(F.try_element_at(m, n)[field], F.lit(0).cast("long"))
    inverse = lambda i: F.element_at(F.array(*[F.lit(pow(pow(bases[i], k, PRIMES[i]), -1, PRIMES[i])) for k in range(MOST_HEAD + 1)]), (F.col("h") + 1).cast("int"))
    convs = convs.withColumn("taken", F.when(F.col("base_head").isNull(), F.lit(0)).otherwise(taken))
    # s: (sum of the head - sum of the own first h turns) / power of h
    starts = {f"s{i}": (at(F.col("base_head"), F.col("taken"), f"sum{i}") - at(F.col("head"), F.col("h"), f"sum{i}") + PRIMES[i]) % PRIMES[i] * inverse(i) % PRIMES[i] for i in LANES}
    convs = convs.withColumns(starts)

    own = prefixes.join(convs.where("own > h").select("conv_id", "own", "h", "taken", *[f"s{i}" for i in LANES]), "conv_id").where("pos > h")
    full = [(F.col(f"s{i}") * F.col(f"power{i}") + F.col(f"sum{i}")) % PRIMES[i] for i in LANES]
    rest = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), (F.col("pos") == F.col("own")).alias("last"), "digest", "bytes", *[f.alias(f"f{i}") for i, f in enumerate(full)])

    entries = F.transform(F.sequence(F.lit(1), F.col("taken").cast("int")), lambda n: F.struct(n.cast("long").alias("depth"), F.element_at("base_head", n.cast("long")).alias("turn")))
    ends = (F.col("own") <= F.col("h")) & (F.col("e.depth") == F.col("taken"))
    head = convs.where("taken > 0").select("conv_id", "own", "h", "taken", F.explode(entries).alias("e"))
    head = head.select("conv_id", "e.depth", ends.alias("last"), "e.turn.digest", "e.turn.bytes", *[F.col(f"e.turn.sum{i}").alias(f"f{i}") for i in LANES])
    turns = head.unionByName(rest)
    before = [_before(i, bases) for i in LANES]
    keys, parents = _keys([F.col(f"f{i}") for i in LANES]), _keys(before)
    turns = turns.select("conv_id", "depth", "last", keys[0].alias("k1"), keys[1].alias("k2"), parents[0].alias("p1"), parents[1].alias("p2"), "digest", "bytes")
    members = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))
    return members, turns


def _before(i: int, bases: tuple[int, ...]) -> Column:
    """The sum of a prefix without its last turn: (f - digest) / BASE."""
    p = PRIMES[i]
    # the digest's 256 bits modulo p, from words of 28 bits: each step stays inside a long
    words = [F.conv(F.substring("digest", k + 1, 7), 16, 10).cast("long") for k in range(0, 63, 7)]
    last = F.conv(F.substring("digest", 64, 1), 16, 10).cast("long")
    number = reduce(lambda t, w: (t * (1 << 28) + w) % p, words, F.lit(0).cast("long"))
    number = (number * 16 + last) % p
    return (F.col(f"f{i}") - number + p) % p * pow(bases[i], -1, p) % p


# ---- nodes ----

KEY = ["depth", "k1", "k2"]


def nodes_of(turns: DataFrame) -> DataFrame:
    """depth, k1, k2, p1, p2, conv_id (smallest member), n_convs, bytes, equal: whether all members' last turns and parents are the same."""
    same = (F.min("digest") == F.max("digest")) & (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2"))
    return turns.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), same.alias("equal")
    )


def _doubled(spark: SparkSession, shared: DataFrame) -> DataFrame:
    """conv_id, depth, leaves, saved of ``shared`` nodes (with up, the conv_id of the parent): summed over their subtrees.

    A node is named by (depth, conv_id); its ancestor at distance 2^k by (depth - 2^k, up).
    """
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    current, reach = shared.select("depth", "conv_id", "up", "leaves", "saved"), 1
    while reach <= deepest:
        below = current.where(F.col("depth") >= reach)
        sent = below.groupBy((F.col("depth") - reach).alias("depth"), F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        summed = current.join(sent, ["depth", "conv_id"], "left")
        above = current.select((F.col("depth") + reach).alias("depth"), F.col("conv_id").alias("up"), F.col("up").alias("next_up"))
        jumped = summed.join(above.where("next_up is not null"), ["depth", "up"], "left")
        total = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("long"))).alias(c)
        current = staged(spark, jumped.select("depth", "conv_id", F.col("next_up").alias("up"), total("leaves"), total("saved")), "trie-sums")
        reach *= 2
    return current.select("depth", "conv_id", "leaves", "saved")


def ends_digests(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """depth, conv_id (of the node), ends_sha256 for rows (depth, conv_id, member): SHA-256 over the members' ids in order.

    Ranges of members are joined to texts of ``CHUNK_CHARS`` first, so the task that hashes a
    node's ids in their order, as the digest demands, streams a row for some thousand of them.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, chars = None, 0, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([first]), pa.array([",".join(ids)])], ["depth", "conv_id", "first", "ids"])

        for batch in batches:
            for depth, conv, member in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "member"))):
                if ids and ((depth, conv) != key or chars >= CHUNK_CHARS):
                    yield row()
                    ids, chars = [], 0
                if not ids:
                    key, first = (depth, conv), member
                ids.append(str(member))
                chars += len(ids[-1]) + 1
        if ids:
            yield row()

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([digest.hexdigest()])], ["depth", "conv_id", "ends_sha256"])

        for batch in batches:
            for depth, conv, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "ids"))):
                if (depth, conv) != key:
                    if key is not None:
                        yield row()
                    key, digest = (depth, conv), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if key is not None:
            yield row()

    order = ["depth", "conv_id", "member"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = ends.select(*order).repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(join, "depth long, conv_id long, first long, ids string")
    dealt = chunks.repartition("depth", "conv_id").sortWithinPartitions("depth", "conv_id", "first")
    return dealt.mapInArrow(hash_, "depth long, conv_id long, ends_sha256 string")


def prefix_trie(spark: SparkSession, table: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    bounded_batches(spark)
    turns = stored_turns(table)
    for bases in BASES:
        prefixes = staged(spark, scanned(spark, turns, bases), "trie-prefixes")
        members, refs = rebuilt(prefixes, bases)
        members, refs = staged(spark, members, "trie-members"), staged(spark, refs, "trie-turns")
        nodes = staged(spark, nodes_of(refs), "trie-nodes")
        if nodes.where("not equal").isEmpty():
            return _described(spark, members, refs, nodes)
    raise FingerprintCollision("prefixes that differ have equal fingerprints")


def _described(spark: SparkSession, members: DataFrame, refs: DataFrame, nodes: DataFrame) -> DataFrame:
    top, n_convs = members.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    root = spark.createDataFrame([(0, top, None, n_convs, 0)] if n_convs else [], "depth long, conv_id long, up long, n_convs long, bytes long")
    # parents by fingerprint; depth 1 has the root
    names = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("up"))
    deep = nodes.where("depth > 1").join(names, ["depth", "p1", "p2"]).select("depth", "conv_id", "up", "n_convs", "bytes")
    first = nodes.where("depth = 1").select("depth", "conv_id", F.lit(top).cast("long").alias("up"), "n_convs", "bytes")
    every = staged(spark, root.unionByName(first).unionByName(deep), "trie-named")

    alone = F.count_if(F.col("n_convs") == 1).alias("alone")
    children = every.where("up is not null").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("conv_id")).agg(F.count(F.lit(1)).alias("n_children"), alone)
    known = every.join(children, ["depth", "conv_id"], "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_children", "alone")})
    known = staged(spark, known, "trie-children")
    # what a node adds itself: a leaf if it has no child, and the one leaf of each chain of a single member below it
    own = F.col("alone") + F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0))
    shared = known.where("n_convs > 1").select("depth", "conv_id", "up", own.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    sums = _doubled(spark, staged(spark, shared, "trie-shared"))

    at_end = refs.where("last").select(*KEY, F.col("conv_id").alias("member"))
    named = at_end.join(nodes.select(*KEY, "conv_id"), KEY).select("depth", "conv_id", "member")
    turnless = members.where("turns = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(top).cast("long").alias("conv_id"), F.col("conv_id").alias("member"))
    digests = ends_digests(spark, named.unionByName(turnless))

    out = known.join(sums, ["depth", "conv_id"], "left").join(digests, ["depth", "conv_id"], "left")
    return out.select(
        "conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
