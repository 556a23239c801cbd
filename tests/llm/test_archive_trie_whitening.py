"""The WARC writer, the conversation trie and the whitening against brute force, round trips and exact algebra."""

import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from tidemark.llm import prefix_trie, queries, warc, whitening

SF = "/root/testdata/sf0.001"


def tuples(df):
    return Counter(tuple(r) for r in df.collect())


def of_sql(name, **tables):
    db = duckdb.connect()
    for table, frame in tables.items():
        db.register(table, frame)
    result = db.execute(queries.oracle_sql()[name])
    return [d[0] for d in result.description], Counter(result.fetchall())


# ---- WARC ----

PAGES = "page_id long, url string, html string, digest string, packed string, file string, first_page string"


def made_pages():
    long_, other = "<p>" + "same ä漢 " * 40, "<p>" + "x" * 97
    rows = [
        (7, "http://a/7", long_), (3, "http://a/3", long_), (3, "http://a/3", long_), (3, "http://a/3b", long_), (9, "http://a/9", other), (8, "http://a/8\r\nX: y", other),
        (1, None, None), (2, "http://a/2", ""), (4, "http://a/4", "short"), (5, "http://a/5", "short"), (5, "http://a/5", "short"), (None, "http://n/1", long_), (None, None, "y" * 200),
        (None, None, "y" * 200), (10, "http://a/ü?q= z", "z\x00\r\n\r\nz" * 30), (11, "http://a/11", "long " * 60_000), (-4, "http://a/-4", "w" * 100), (6, "http://a/6", "w" * 100),
    ]
    return [(*r, *"abcd") for r in rows]


def brute_warc(rows):
    groups = defaultdict(list)
    for i, (page_id, url, html, *_) in enumerate(rows):
        groups[(html or "").encode()].append((page_id is None, page_id or 0, url or "", i))
    out = Counter()
    for payload, members in groups.items():
        members.sort()
        for k, (none, page_id, *_) in enumerate(members):
            again = k > 0 and len(payload) >= 100
            first = None if members[0][0] else members[0][1]
            out[(None if none else page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
    return out


def test_warc_reads_back_what_was_written(spark, tmp_path):
    rows = made_pages()
    root = f"file://{tmp_path}/one"
    listed = warc.write_archive(spark, spark.createDataFrame(rows, PAGES), root, roll_bytes=1_000).collect()
    assert len(listed) > 3
    assert tuples(warc.resolved(spark, warc.read_archive(spark, root))) == brute_warc(rows)
    read = warc.read_archive(spark, root, payloads=True)
    ids = [r.record_id for r in read.collect()]
    assert len(set(ids)) == len(ids) == len(rows)
    whole = warc.resolved(spark, read).select("page_id", "payload").collect()
    assert Counter((r.page_id, bytes(r.payload).decode()) for r in whole) == Counter((r[0], r[2] or "") for r in rows)
    for entry in listed:
        data = (tmp_path / "one" / entry.name).read_bytes()
        assert len(data) == entry.bytes and hashlib.sha256(data).hexdigest() == entry.sha256
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == entry.records
    assert not (tmp_path / "one/_temporary").exists()


def test_warc_bytes_do_not_depend_on_tasks(spark, tmp_path):
    rows, found = made_pages(), []
    for name, parts in (("a", 1), ("b", 7), ("c", 3)):
        random.Random(name).shuffle(rows)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            warc.write_archive(spark, spark.createDataFrame(rows, PAGES).repartition(parts), f"file://{tmp_path}/{name}", roll_bytes=1_500)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        found.append({p.name: p.read_bytes() for p in (tmp_path / name).glob("part-*")})
    assert found[0] == found[1] == found[2] and len(found[0]) > 2


def test_warc_is_invisible_until_committed(spark, tmp_path, monkeypatch):
    root, pages = f"file://{tmp_path}/r", spark.createDataFrame(made_pages(), PAGES)

    def lost(*_):
        raise OSError("the driver is lost")

    with monkeypatch.context() as patched:
        patched.setattr(warc, "committed", lost)
        with pytest.raises(OSError):
            warc.write_archive(spark, pages, root)
    assert not (tmp_path / "r/manifest").exists() and not list((tmp_path / "r").glob("part-*"))
    warc.write_archive(spark, pages, root)
    assert tuples(warc.resolved(spark, warc.read_archive(spark, root))) == brute_warc(made_pages())
    with pytest.raises(FileExistsError):
        warc.write_archive(spark, pages, root)


def test_warc_notices_damage(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    warc.write_archive(spark, spark.createDataFrame(made_pages(), PAGES), root)
    (path,) = (tmp_path / "r").glob("part-*")
    path.write_bytes(path.read_bytes()[:-20])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archive(spark, root).count()
    record = gzip.decompress(warc.response(1, "u", hashlib.sha256(b"abc").hexdigest(), b"abc"))
    with pytest.raises(ValueError):
        warc.parsed(record.replace(b"abc\r\n", b"abd\r\n"))


def test_warc_of_no_pages_and_of_the_table(spark):
    none = spark.createDataFrame([], PAGES)
    root = queries.scratch_dir(spark, "warc")
    assert warc.write_archive(spark, none, root).count() == 0 and warc.resolved(spark, warc.read_archive(spark, root)).count() == 0
    frame = queries.op11_sharded_warc(spark, SF)
    names, want = of_sql("op11_sharded_warc", pages=spark.read.parquet(f"{SF}/pages.parquet").toPandas())
    assert tuples(frame.select(names)) == want


# ---- trie ----

TURNS = "conv_id long, turn long, role string, text string, digest string, depth string, h string, pos string, k1 string"


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = Counter()
    for node, convs in members.items():
        inside = [(o, m) for o, m in members.items() if o[: len(node)] == node]
        children = {o for o, _ in inside if len(o) == len(node) + 1}
        leaves = sum(not any(len(y) == len(o) + 1 and y[: len(o)] == o for y in members) for o, _ in inside)
        saved = sum((len(m) - 1) * len(o[-1][1].encode()) for o, m in inside if o)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(whole[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out[(min(convs), len(node), parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def made_turns(seed=1):
    rng, rows = random.Random(seed), []
    words = ["a", "b", "ä漢", "", None]
    for c in [*range(-7, 40), 1_000, 1_001, 2_503]:
        for t in range(rng.choice([1, 2, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(words) if rng.random() < 0.5 else "a"))
    rows += rows[:9] + [(None, 1, "user", "lost"), (3, None, None, None)]
    # copies of a long conversation, cut at every length: a caterpillar
    for k in range(12):
        rows += [(5_000 + 5 * k, t, "user", f"t{t}") for t in range(9 + k)]
    return [(*r, *"abcde") for r in rows]


def test_trie_equals_brute_force(spark):
    rows = made_turns()
    found = prefix_trie.prefix_trie(spark, spark.createDataFrame(rows, TURNS).repartition(5))
    assert tuples(found) == brute_trie(rows)
    names, want = of_sql("op12_conversation_trie", conversations=spark.createDataFrame(rows, TURNS).select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert tuples(found.select(names)) == want


def test_trie_of_one_conversation_over_many_ranges(spark, monkeypatch):
    """A conversation with most of the rows is scanned in ranges, and its ids are hashed in chunks."""
    rows = [(5, t, "user", f"{t % 3}") for t in range(300)] + [(c, t, "user", f"{t % 3}") for c in range(100, 160) for t in range(4)]
    monkeypatch.setattr(prefix_trie, "CHUNK_CHARS", 20)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = tuples(prefix_trie.prefix_trie(spark, spark.createDataFrame([(*r, *"abcde") for r in rows], TURNS)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == brute_trie(rows)


def test_trie_fingerprints_compose(spark):
    """The pair of a sequence, and the one of head and own rest, equal the product over the rebuilt digests."""
    rows = made_turns(3)
    bases = prefix_trie.BASES[0]
    turns = prefix_trie.stored_turns(spark.createDataFrame(rows, TURNS))
    _, refs = prefix_trie.rebuilt(prefix_trie.scanned(spark, turns, bases), bases)
    by_conv = defaultdict(list)
    for r in refs.collect():
        by_conv[r.conv_id].append((r.depth, r.k1, r.k2, r.p1, r.p2, int(r.digest, 16)))
    for found in by_conv.values():
        sums = [0] * 4
        for depth, (at, k1, k2, p1, p2, digest) in enumerate(sorted(found), 1):
            before = (sums[0] << 31) + sums[1], (sums[2] << 31) + sums[3]
            sums = [(s * b + digest) % p for s, b, p in zip(sums, bases, prefix_trie.PRIMES)]
            assert (at, p1, p2, k1, k2) == (depth, *before, (sums[0] << 31) + sums[1], (sums[2] << 31) + sums[3])


def test_trie_notices_equal_fingerprints(spark, monkeypatch):
    rows = [(c, t, "user", f"{c}-{t}") for c in (5, 10, 15) for t in range(12)]
    frame = spark.createDataFrame([(*r, *"abcde") for r in rows], TURNS)
    monkeypatch.setattr(prefix_trie, "_keys", lambda sums: [sums[0] * 0, sums[0] * 0])
    with pytest.raises(prefix_trie.FingerprintCollision):
        prefix_trie.prefix_trie(spark, frame).collect()


def test_trie_of_nothing_and_of_the_table(spark):
    assert prefix_trie.prefix_trie(spark, spark.createDataFrame([], TURNS)).count() == 0
    turnless = [(2_503, 1, "user", "x", *"abcde")]
    assert tuples(prefix_trie.prefix_trie(spark, spark.createDataFrame(turnless, TURNS))) == brute_trie(turnless)
    names, want = of_sql("op12_conversation_trie", conversations=spark.read.parquet(f"{SF}/conversations.parquet").toPandas())
    assert tuples(queries.op12_conversation_trie(spark, SF).select(names)) == want


# ---- whitening ----

VECTORS = "vec_id long, embedding array<float>, x string, n string, pos string, part string"


def brute_whitening(rows, components):
    good = [(i, [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in good], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    t = n * x - sums
    cov = (t.T @ t).astype(object)  # n^3 times the covariance, exact
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in cov])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    white = np.array([[float(Fraction(int(c), n)) for c in row] for row in t]) @ (axes / np.sqrt(values))
    return [i for i, _ in good], n, [int(s) for s in (t * t).sum(axis=1)], white, values / np.trace(v)


def made_vectors(seed, count=400, d=12):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    data = (rng.normal(size=(count, d)) * np.geomspace(0.3, 20, d)) @ turn + rng.normal(size=d) * 50
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]


def whitened(spark, rows, components=32, parts=3):
    frame = spark.createDataFrame([(*r, *"abcd") for r in rows], VECTORS).repartition(parts)
    return whitening.whiten(spark, frame, components).collect()


def test_whitening_equals_brute_force(spark):
    good = made_vectors(5) + [(7, made_vectors(5)[7][1])] * 150  # a vector with a quarter of all rows
    odd = [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] * 12), (904, [float("inf")] + [1.0] * 11), (905, [0.5] * 13)]
    found = whitened(spark, good + odd, components=8)
    ids, n, deviation, white, explained = brute_whitening(good, 8)
    by_row = defaultdict(dict)
    for r in found:
        by_row[r.vec_id].setdefault(r.component, []).append(r)
    assert set(by_row) == set(ids) and len(found) == 8 * len(ids) and {r.n for r in found} == {n}
    got = np.array([[by_row[i][c][0].whitened for c in range(1, 9)] for i in ids])
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-9
    assert all(by_row[i][1][0].deviation == d for i, d in zip(ids, deviation))
    assert np.allclose([by_row[ids[0]][c][0].explained for c in range(1, 9)], explained, rtol=1e-12)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-11


def test_whitening_without_variance_or_rows(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, [1.0, 2.0])]) == [] and whitened(spark, [(1, [1.0, 2.0])] * 5) == []
    few = whitened(spark, made_vectors(2, count=4))  # three dimensions of variance
    assert {r.component for r in few} == {1, 2, 3} and few[0].identity_error < 1e-9
    flat = whitened(spark, [(i, [1.0, float(i)]) for i in range(9)] + [(None, [1.0, 9.0])])
    assert {r.component for r in flat} == {1} and sum(r.vec_id is None for r in flat) == 1


def test_whitening_of_huge_entries_is_exact(spark):
    rng = random.Random(1)
    rows = [(i, [float(np.float32(rng.uniform(-1e12, 1e12))), float(np.float32(rng.uniform(-1e12, 1e12))), float(i)]) for i in range(50)]
    found = whitened(spark, rows, components=2)
    assert all(r.deviation is None for r in found) and found[0].identity_error < 1e-9
    vectors = whitening.usable_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    x = np.array([r.x for r in vectors.collect()], dtype=object)
    parts = whitening._entries(whitening.products(vectors, [0, 0, 0], 64), "i").collect()
    assert {(r.i, r.i + r.pos): whitening._joined(r) for r in parts} == {(i, j): int((x[:, i] * x[:, j]).sum()) for i in range(3) for j in range(i, 3)}


def hadamard(n):
    h = np.array([[1]])
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h.astype(object)


@pytest.mark.parametrize("values", [[10**14 + k for k in range(20)] + [10**6 + 3 * k for k in range(8)] + [0] * 4, [1000] * 10 + [999] * 10 + [5] * 12, [7] * 32, [3**k for k in range(32)]])
def test_clustered_eigenvalues(values):
    """Eigenvectors known exactly: eigenvalues apart by 1 in 10^14 are told apart, equal ones span the right space."""
    n, h = len(values), hadamard(len(values))
    matrix = (h * np.array(values, dtype=object)).dot(h.T)  # n times the matrix
    found, axes = whitening.eigen(matrix.tolist(), n)
    order = sorted(range(n), key=lambda i: -values[i])
    assert np.allclose(found, [values[i] for i in order], rtol=1e-15, atol=1e-15 * max(values))
    assert np.abs(axes.T @ axes - np.eye(n)).max() < 1e-15
    true = h.astype(float) / np.sqrt(n)
    for value in set(values):
        columns = [k for k, i in enumerate(order) if values[i] == value]
        space = true[:, [i for i in range(n) if values[i] == value]]
        inside = space @ (space.T @ axes[:, columns])
        assert np.abs(inside - axes[:, columns]).max() < 1e-15
