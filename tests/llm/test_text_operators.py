"""Exact dedup, n-gram join, sentence spans, decontamination and packing against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, exact_dedup, ngram_join, packing, quality, sentence_dedup

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows(df):
    return [r.asDict() for r in df.collect()]


def brute_exact(data):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(data):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append((doc_id is None, doc_id or 0, i))
    out = Counter()
    for members in groups.values():
        keep = min(members)
        for none, doc_id, i in members:
            out[(None if none else doc_id, None if keep[0] else keep[1], len(members), i == keep[2])] += 1
    return out


def exact_result(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows(df))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_exact_dedup_equals_brute_force(spark, odd, sample):
    for docs in (odd, sample):
        assert exact_result(exact_dedup.exact_dedup(spark, docs)) == brute_exact(pairs(docs))


def test_exact_dedup_checks_bytes_of_equal_digests(spark, sample):
    weak = exact_dedup.exact_dedup(spark, sample, digest=lambda sha: F.substring(sha, 1, 1))
    assert exact_result(weak) == brute_exact(pairs(sample))


def test_exact_dedup_of_other_plans(spark, sample):
    twice = sample.union(sample)
    assert exact_dedup.is_scan(sample) and not exact_dedup.is_scan(twice) and not exact_dedup.is_scan(sample.where("doc_id > 3"))
    assert exact_result(exact_dedup.exact_dedup(spark, twice)) == brute_exact(pairs(twice))


def test_exact_dedup_state_grows_with_its_rows(spark, sample, tmp_path, monkeypatch):
    """A small first run doesn't bind later ones to its one store, and what it saw is still known."""
    monkeypatch.setattr(exact_dedup, "ROWS_PER_STORE", 20)
    monkeypatch.setattr(exact_dedup, "MOST_STORES", 7)
    state, data = str(tmp_path / "state"), pairs(sample)
    parts = [data[:5], data[5:15], data[15:], data[:3]]
    seen, checkpoints = [], []
    for number, part in enumerate(parts):
        path = str(tmp_path / f"docs-{number}")
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.parquet(path)
        found = rows(exact_dedup.exact_dedup(spark, spark.read.parquet(path), state_dir=state))
        known = {norm(t) for _, t in seen}
        assert Counter((r["doc_id"], r["kept"]) for r in found) == Counter((i, norm(t) not in known and kept) for (i, t), kept in zip(part, first_of(part)))
        seen += part
        checkpoints.append(sorted(p.name for p in (tmp_path / "state").glob("checkpoint-*")))
    assert checkpoints == [["checkpoint-1"], ["checkpoint-1"], ["checkpoint-1", "checkpoint-7"], ["checkpoint-1", "checkpoint-7"]]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def first_of(part):
    """Whether each row has the smallest id of its text."""
    least = {}
    for doc_id, text in part:
        least[norm(text)] = min(least.get(norm(text), doc_id), doc_id)
    return [least[norm(text)] == doc_id for doc_id, text in part]


def test_exact_dedup_over_many_batches(spark, sample, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    sample.repartition(6).write.parquet(path)
    docs = spark.read.parquet(path)
    monkeypatch.setattr(exact_dedup, "COPIES_PER_TASK", 2)
    found = exact_dedup.exact_dedup(spark, docs, files_per_trigger=2)
    assert exact_result(found) == brute_exact(pairs(docs))


def test_exact_dedup_keeps_its_state_between_runs(spark, sample, tmp_path):
    half, new = sample.where("doc_id % 2 = 1"), sample.where("doc_id % 2 = 0")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    before, now, by_id = defaultdict(list), defaultdict(list), {i: norm(t) for i, t in pairs(sample)}
    for i, t in by_id.items():
        (before if i % 2 else now)[t].append(i)
    for weak in (False, True):  # the second run reads new rows alone; hits are checked against the first run's files
        state = str(tmp_path / f"state-{weak}")
        digest = (lambda sha: F.substring(sha, 1, 1)) if weak else exact_dedup.full_digest
        assert exact_result(exact_dedup.exact_dedup(spark, half, digest=digest, state_dir=state)) == brute_exact(pairs(half))
        found = {r["doc_id"]: r for r in rows(exact_dedup.exact_dedup(spark, new, digest=digest, state_dir=state))}
        assert found.keys() == {i for i, _ in pairs(new)}
        if weak:  # no two texts are taken for one
            assert all(by_id[r["keep_id"]] == by_id[i] for i, r in found.items())
            continue
        for t, ids in now.items():
            keep = min(before[t]) if t in before else min(ids)
            for i in ids:
                assert found[i]["keep_id"] == keep and found[i]["kept"] == (i == keep) and found[i]["group_size"] == len(ids) + len(before.get(t, []))
        assert sum(t in now for t in before) > 3


def test_exact_dedup_leaves_the_session_alone(spark, sample):
    streaming = lambda: {k: v for k, v in spark.conf.getAll.items() if "streaming" in k}
    before = streaming()
    exact_dedup.exact_dedup(spark, sample).count()
    assert streaming() == before


def test_exact_dedup_empty_and_columns(spark, odd, none):
    assert exact_dedup.exact_dedup(spark, none).count() == 0
    clash = odd.withColumn("_metadata", F.lit("x")).withColumn("tm_0", F.lit(1))
    assert exact_dedup.drop_copies(spark, clash).columns == clash.columns
    kept = exact_dedup.drop_copies(spark, odd)
    assert kept.columns == odd.columns
    assert sorted(pairs(kept), key=str) == sorted([(1, odd.first().text), (3, None), (5, "   \t\n "), *pairs(odd)[6:9]], key=str)


def shingle_set(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_near(data, threshold=0.8):
    sets = [shingle_set(t) for _, t in data]
    linked = defaultdict(set)
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                linked[i].add(j)
                linked[j].add(i)
    out, seen = Counter(), {}
    for i in range(len(sets)):
        if i not in seen:
            todo, group = [i], {i}
            while todo:
                for j in linked[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            ids = [data[j][0] for j in group if data[j][0] is not None]
            for j in group:
                seen[j] = min(ids) if ids else None
        out[(data[i][0], seen[i], len(linked[i]))] += 1
    return out


def near_result(df):
    return Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in rows(df))


def test_near_duplicates_equal_brute_force(spark, odd, sample, none):
    for docs in (odd, sample):
        assert near_result(ngram_join.near_duplicates(spark, docs)) == brute_near(pairs(docs))
    assert ngram_join.near_duplicates(spark, none).count() == 0


def near_copies(n, words=140, seed=3):
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 10_000, words)]
    out = []
    for i in range(n):
        w = list(base)
        w[int(rng.integers(0, words))] = f"x{i}"
        if i % 3 == 0:
            w[-1] = f"y{i}"
        out.append((i, " ".join(w)))
    return out


def test_large_groups_in_blocks_lose_no_link(spark, monkeypatch):
    data = near_copies(90)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for size in (512, 16):
        monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", size)
        found, want = near_result(ngram_join.near_duplicates(spark, docs)), brute_near(data)
        total = lambda c: sum(k[2] * n for k, n in c.items())
        assert 0.999 * total(want) <= total(found) <= total(want) and total(want) > 4_000
        assert {k[:2] for k in found} == {k[:2] for k in want}


def test_keep_one(spark, odd, sample):
    kept = ngram_join.keep_one(spark, odd)
    assert kept.columns == odd.columns
    assert Counter(pairs(kept)) == Counter(p for p in pairs(odd) if p[0] != 2)
    want = Counter(k[0] for k in brute_near(pairs(sample)) if k[0] == k[1])
    assert Counter(r.doc_id for r in ngram_join.keep_one(spark, sample).collect()) == want


def depth_of(spark, data, recall=ngram_join.RECALL):
    docs = spark.createDataFrame(data, "doc_id long, text string")
    sketched = ngram_join.staged(spark, ngram_join.sketches(docs), "test-sketches")
    classes = sketched.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = ngram_join.staged(spark, classes, "test-classes")
    found, depth = ngram_join.links(spark, docs, classes, recall=recall)
    return found.agg(F.sum("links")).first()[0], depth


def pairs_at(n, words, changed, seed):
    """n pairs of texts, ``changed`` words of the second replaced far from each other."""
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        w = [f"w{k}" for k in rng.integers(0, 50_000, words)]
        v = list(w)
        for k in range(changed):
            v[5 + k * 12] = f"x{i}y{k}"
        out += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    return out


def test_prefixes_shorten_until_the_recall_is_reached(spark):
    close, far = pairs_at(300, 300, 1, 1), pairs_at(300, 190, 4, 2)  # similarities 0.97 and just over 0.8
    (n_close, deep), (n_far, short) = depth_of(spark, close), depth_of(spark, far)
    assert (n_close, deep) == (300, ngram_join.DEPTH) and n_far == 300 and short < deep
    n_early, early = depth_of(spark, far, recall=0.9)
    assert early == ngram_join.DEPTH and 0.9 * 300 <= n_early <= 300


def test_found_share_is_the_share_found():
    """Signatures of pairs just over the threshold share a prefix as often as the estimate says."""
    sketcher = ngram_join.Sketcher()
    rows = []
    for i in range(0, 1200, 2):
        rng = np.random.default_rng(i)
        both, own = rng.integers(0, 1 << 62, 80).astype(np.uint64), rng.integers(0, 1 << 62, 20).astype(np.uint64)
        for s in (np.concatenate((both, own[:10])), np.concatenate((both, own[10:]))):
            rows.append((0, b"", 0, 1, sketcher.signature(np.sort(s)), b""))
    for depth in (6, 5, 4):
        at = ngram_join._nodes(rows, depth)
        found = (at[::2] == at[1::2]).any(axis=1).mean()
        assert abs(found - ngram_join.found_share(0.8, depth)) < 0.01


def test_contraction_of_a_path(spark):
    names = [bytes([k * 37 % 101]) for k in range(40)]
    edges = spark.createDataFrame([(a, b) for a, b in zip(names[:25], names[1:25])] + [(names[30], names[31])], "a binary, b binary")
    roots = {bytes(r.node): bytes(r.root) for r in ngram_join.contracted(spark, edges).collect()}
    assert {roots[n] for n in names[:25]} == {min(names[:25])} and roots[names[30]] == roots[names[31]] == min(names[30:32])


def brute_units(text):
    """(where it ends, its words) of each sentence or part of a long one, read character by character."""
    ends = [m.end() for m in re.finditer(r"[.!?]+[\"')\]]*\s+|\s*\n\s*", text)] + [len(text)]
    out, at = [], 0
    for end in ends:
        found = list(re.finditer(r"\w+", text[at:end]))
        if not found:
            if out:
                out[-1][0] = end
            at = end if out else at  # what stands before the first word goes with it
            continue
        words = [m[0].lower() for m in found]
        for k, m in enumerate(found):
            chosen = len(words) > 16 and k and int(sentence_dedup.word_hashes([words[k - 1]])[0]) % 8 == 0
            if not k or chosen:
                if k:
                    out[-1][0] = at + m.start()
                out.append([end, []])
            out[-1][1].append(words[k])
        at = end
    return out


def brute_spans(data, least=20, within=False):
    """All runs by plain loops; which words an earlier document has, by a table of word tuples."""
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0))
    first, found = {}, []
    for i in order:
        units = brute_units(data[i][1] or "")
        n = len(units)
        size = lambda s, e: sum(len(units[k][1]) for k in range(s, e))  # noqa: B023, E731
        spans = {next(((s, e) for e in range(s + 1, n + 1) if size(s, e) >= least), None) for s in range(n)}
        spans |= {next(((s, e) for s in range(e - 1, -1, -1) if size(s, e) >= least), None) for e in range(1, n + 1)}
        for s, e in spans - {None}:
            key = tuple(w for k in range(s, e) for w in units[k][1])
            me = (data[i], s) if within else data[i]
            if within and first.get(key, (None, 0))[0] == data[i]:
                first[key] = min(first[key], me, key=lambda x: x[1])
            first.setdefault(key, me)
            found.append((key, i, s, e))
    gone = defaultdict(set)
    for key, i, s, e in found:
        if first[key] != ((data[i], s) if within else data[i]):
            gone[i].update(range(s, e))
    out = Counter()
    for i in order:
        text, at, kept = data[i][1], 0, []
        if gone[i]:
            for k, (end, _) in enumerate(brute_units(text)):
                kept += [] if k in gone[i] else [text[at:end]]
                at = end
            text = "".join(kept).strip()
        out[(data[i][0], text, len(gone[i]))] += 1
    return out


def test_sentence_spans_equal_brute_force(spark, sample, odd, none):
    for docs in (sample, odd):
        for within in (False, True):
            cleaned = sentence_dedup.remove_repeats(spark, docs, within=within)
            assert Counter((r["doc_id"], r["text"], r["n_removed"]) for r in rows(cleaned)) == brute_spans(pairs(docs), within=within)
    assert sentence_dedup.remove_repeats(spark, none).count() == 0


def test_a_passage_inside_other_sentences_is_found(spark):
    passage = " ".join(f"Wort{k} und {'Stadt' if k % 2 else 'Land'}" for k in range(40))
    data = [(i, f"We met in Paris and then drove to Berlin with {'ABCDE'[i]} " + passage + f" and so on to {'FGHIJ'[i]}. We met in Paris and then drove to Berlin.") for i in range(5)]
    out = rows(sentence_dedup.remove_repeats(spark, spark.createDataFrame(data, "doc_id long, text string")))
    assert {r["doc_id"] for r in out if r["n_removed"]} == {1, 2, 3, 4}
    for r in out:
        left = len(re.findall("Wort", r["text"]))
        assert left == 40 if not r["doc_id"] else left <= 12 and r["text"].startswith("We met") and r["text"].endswith("Berlin.")


def test_a_very_long_text_is_read_whole(spark):
    rng = np.random.default_rng(8)
    long_ = " ".join(f"w{k}{'.' if k % 11 == 0 else ''}" for k in rng.integers(0, 50_000, 200_000))
    tail = "This closing passage stands at the end of two texts. It has more than twenty words in it, all of them the same in both."
    data = [(1, long_ + " " + tail), (2, "Other words come first. " + tail)]
    out = {r["doc_id"]: r for r in rows(sentence_dedup.remove_repeats(spark, spark.createDataFrame(data, "doc_id long, text string")))}
    assert out[1]["n_removed"] == 0 and out[2]["text"] == "Other words come first."


def test_a_shared_passage_stays_once(spark):
    passage = "Rivers carry stones for many miles. The stones grow round and small. " + "In the end only sand is left, and the sea takes that as well. " * 1
    data = [(i, f"Text number {'abcdefg'[i]} begins in its very own way here. {passage}It ends with {'pqrstuv'[i]} and nothing else at all.") for i in range(5)]
    out = {r["doc_id"]: r["text"] for r in rows(sentence_dedup.remove_repeats(spark, spark.createDataFrame(data, "doc_id long, text string")))}
    assert out[0] == data[0][1]
    for i in range(1, 5):
        assert "sand is left" not in out[i] and "Rivers" not in out[i] and out[i].startswith("Text number") and out[i].endswith("else at all.")


def test_units_tile_the_text():
    text = "One. Two!\nthree Four  five?\n\nsix"
    units = sentence_dedup.Units(text)
    assert [text[a:b] for a, b in zip(units.at, units.at[1:])] == ["One. ", "Two!\n", "three Four  five?\n\n", "six"]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_templates_catch_new_parameters(spark, none):
    item = "A train leaves the city of Paris at 9 km and runs for 120 minutes until it meets Anna who waits with 35 bags of rice."
    changed = item.replace("120", "480").replace("35", "71").replace("Paris", "Lyon").replace("Anna", "Bert")
    mixed = item.replace("120", "35").replace("9 km", "35 km").replace("of Paris", "of Anna")
    data = [(1, f"Some words go first. {changed} Some go last."), (2, "Clean text about other things entirely, of no interest."), (3, None), (4, ""), (None, changed)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontaminate.contaminated(spark, docs, bench(spark, [(7, item), (8, item), (9, None), (None, "x y z")]))
    assert {(r["doc_id"], r["item_id"], r["consistency"]) for r in rows(found)} == {(1, 7, 1.0), (None, 7, 1.0)}
    assert mixed  # other values in the same places are consistent as long as each has one counterpart
    assert {r.doc_id for r in decontaminate.keep_clean(spark, docs, bench(spark, [(7, item)])).collect()} == {2, 3, 4}
    assert decontaminate.contaminated(spark, none, bench(spark, [(7, item)])).count() == 0
    assert decontaminate.contaminated(spark, docs, bench(spark, [])).count() == 0


def test_inconsistent_slots_are_no_leak(spark):
    item = "there are 5 red balls and 5 blue balls and 5 green balls and 5 white balls in this old box"
    same = item.replace("5", "8")
    other = item.replace("5 red", "1 red").replace("5 blue", "2 blue").replace("5 green", "3 green")
    docs = spark.createDataFrame([(1, same), (2, other)], "doc_id long, text string")
    assert {r["doc_id"] for r in rows(decontaminate.contaminated(spark, docs, bench(spark, [(1, item)])))} == {1}


def test_names_at_sentence_starts_and_case_and_space(spark):
    item = "Anna buys 3 apples. Bert buys 7 pears. Carla eats 2 of the plums. How much fruit do Anna, Bert and Carla have left in the end?"
    changed = item.replace("Anna", "Dora").replace("Bert", "Emil").replace("Carla", "Fritz").replace("3", "9")
    mixed = changed.replace("Dora buys", "Emil buys").replace("Emil buys 7", "Dora buys 7").replace("Fritz eats", "Gustav eats")
    names = "we saw Anna with Bert and Carla at Lyon near Paris while Dora met Emil in Rome then Fritz left Oslo for Bonn"
    spaced = "\n ".join(item.replace("Anna", "Hugo").split(" "))
    data = [(1, changed), (2, names.lower()), (3, names.upper().replace(" ", " \n")), (4, spaced), (5, mixed), (6, "Please compute 3 and 4"), (7, "Chapter 3 and 4")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontaminate.contaminated(spark, docs, bench(spark, [(1, item), (2, names), (3, "Compute 12 and 7")]))
    assert {(r["doc_id"], r["item_id"]) for r in rows(found)} == {(1, 1), (2, 2), (3, 2), (4, 1), (6, 3)}


def test_every_item_of_a_template_is_checked(spark):
    first = "there are 5 red balls and 5 blue balls and 5 green balls and 5 white balls in this old box"
    second = first.replace("5 red", "1 red").replace("5 blue", "2 blue").replace("5 green", "3 green")
    third = first.replace("5 green", "7 green").replace("5 white", "7 white")
    crossed = first.replace("5 red", "4 red").replace("5 white", "4 white")
    docs = spark.createDataFrame([(1, second), (2, third.replace("7", "9")), (3, crossed)], "doc_id long, text string")
    found = decontaminate.contaminated(spark, docs, bench(spark, [(1, first), (2, second), (3, third)]))
    assert {(r["doc_id"], r["item_id"], r["consistency"]) for r in rows(found) if r["doc_id"] < 3} == {(1, 1, 1.0), (2, 1, 1.0)}
    found = decontaminate.contaminated(spark, docs, bench(spark, [(1, first), (3, third)]))
    assert {r["doc_id"] for r in rows(found)} == {2}


def test_items_dense_in_slots_are_found(spark):
    items = [
        (1, "Compute 12 + 7 - 3 * 45 + 6 / 2 - 8 + 19 and give the answer"),
        (2, "Sort these numbers: 12, 7, 3, 45, 6, 2, 8, 19, 33, 51"),
        (3, "31 5 17 4 88 23 9 61 12 70"),
    ]
    docs = [
        *((i, f"Some words stand before it. {text} And some stand after.") for i, text in items),
        (4, "Some words first. Compute 13 + 9 - 4 * 46 + 7 / 3 - 5 + 20 and give the answer"),
        (5, "Please sort these numbers: 14, 9, 4, 47, 8, 1, 5, 20, 34, 52"),
        (6, "A table of 40 41 42 43 44 45 46 47 48 49 50 51 and nothing more"),
    ]
    found = decontaminate.contaminated(spark, spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, items))
    assert {(r["doc_id"], r["item_id"]) for r in rows(found)} == {(1, 1), (2, 2), (3, 3), (4, 1), (5, 2)}


def test_decontamination_finds_whole_items(spark, sample):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = [(i, plain(t)) for i, t in pairs(sample)]
    want = {(i, r.item_id) for r in items.collect() for i, t in texts if plain(r.text) in t}
    found = {(r["doc_id"], r["item_id"]) for r in rows(decontaminate.contaminated(spark, sample, items))}
    assert want <= found and len(found) <= len(want) + 3


def brute_ids(text):
    return [*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check_packing(found, data, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    want = {d: brute_ids(t) for d, t in data}
    assert by_doc.keys() == want.keys()
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(want[d][at : at + r["length"]], dtype="<u4").tobytes()
            assert r["start"] == at and r["doc_tokens"] == len(want[d]) and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(want[d])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == length or at < length and at & (at - 1) == 0  # nothing is padded


def test_packing_round_trip(spark, sample, odd, none):
    for docs in (sample, odd.where("doc_id != 2")):
        check_packing(rows(packing.pack(docs, TOKENIZER)), pairs(docs), packing.SEQUENCE)
    check_packing(rows(packing.pack(sample.limit(30), TOKENIZER, length=64)), pairs(sample.limit(30)), 64)
    assert packing.pack(none, TOKENIZER).count() == 0
    repeated = rows(packing.pack(odd.where("doc_id = 2"), TOKENIZER))
    assert sum(r["length"] for r in repeated) == 2 * len(brute_ids(odd.first().text))


def test_packing_with_any_tokenizer(spark, odd):
    """A tokenizer with other rules is used as a whole; the fast way is for its own rules alone."""
    import glob

    assert packing.splits_at_space(TOKENIZER)
    others = [p for p in glob.glob(TOKENIZER.rsplit("/", 1)[0] + "/*.json") if "tokenizer" not in p.rsplit("/", 1)[1] and p != TOKENIZER]
    texts = [t or "" for _, t in pairs(odd)]
    for path in others[:3]:
        try:
            plain = Tokenizer.from_file(path)
        except Exception:  # another kind of file
            continue
        encoder = packing.encoder_of(path)
        assert not packing.splits_at_space(path) and isinstance(encoder, packing.WholeEncoder)
        for t in texts:
            assert np.frombuffer(encoder.encode(t), dtype=np.uint32).tolist() == plain.encode(t, add_special_tokens=False).ids


def test_packing_a_very_long_text(spark):
    text = " ".join(f"word{k % 977}," for k in range(120_000))
    check_packing(rows(packing.pack(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string"), TOKENIZER)), [(1, text), (2, "short")], packing.SEQUENCE)


def test_near_duplicates_of_very_long_texts(spark):
    rng = np.random.default_rng(9)
    w = [f"w{k}" for k in rng.integers(0, 90_000, 60_000)]
    near = list(w)
    near[100], near[40_000] = "other", "another"
    data = [(1, " ".join(w)), (2, " ".join(near)), (3, " ".join(w[:30_000]))]
    found = near_result(ngram_join.near_duplicates(spark, spark.createDataFrame(data, "doc_id long, text string")))
    assert found == Counter({(1, 1, 1): 1, (2, 1, 1): 1, (3, 3, 0): 1})


def test_exact_dedup_of_very_long_texts(spark):
    text = "long text \t" * 200_000
    data = [(5, text), (3, text.replace("\t", "\n")), (4, text + "x")]
    assert exact_result(exact_dedup.exact_dedup(spark, spark.createDataFrame(data, "doc_id long, text string"))) == brute_exact(data)


def test_assignment_balances_cost_and_fills():
    rng = np.random.default_rng(5)
    lengths = [int(x) for x in rng.integers(1, 3000, 800)]
    pieces, rooms, cost = packing.assign(lengths)
    used = Counter()
    for _, _, n, s, _ in pieces:
        used[s] += n
    assert [used[s] for s in range(len(rooms))] == rooms and sum(rooms) == sum(lengths)
    full = [c for c, r in zip(cost, rooms) if r == packing.SEQUENCE]
    assert max(full) < 1.5 * min(full)
    assert len(pieces) < 1.5 * len(lengths)


def test_words_encode_as_the_tokenizer_does(sample):
    encoder, plain = packing.WordEncoder(TOKENIZER, entries=50), Tokenizer.from_file(TOKENIZER)
    texts = [t for _, t in pairs(sample)][:60]
    texts += ["don't I'M we'll 3rd x² é é ǅ Σας ﬁ İstanbul", "a\x1cb c　d", "<|endoftext|> x<|startoftext|>", "…—“quoted”…", "", " \n ", "##!! ?? a.b,c A.B. ((x))", "日本語 한국어 עברית 😀👍🏽"]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), dtype=np.uint32).tolist() == plain.encode(t, add_special_tokens=False).ids


def test_pipeline_stages_equal_brute_force(spark):
    """Each stage on what the one before it kept."""
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, items = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    stages = dict(pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    keep = lambda df, stage: pipeline.staged(spark, stages[stage](spark, df, sf), f"test-{stage}")

    good = keep(docs, "quality")
    model = quality.train(spark, docs, labels)
    scores = model.score(np.array([quality.statistics(t or "") for _, t in pairs(docs)]))
    assert ids(good) == sorted(i for (i, _), x in zip(pairs(docs), scores) if x >= quality.THRESHOLD)
    single = keep(good, "exact_dedup")
    assert ids(single) == sorted(k[0] for k in brute_exact(pairs(good)) if k[3])
    apart = keep(single, "near_dedup")
    assert ids(apart) == sorted(k[0] for k in brute_near(pairs(single)) if k[0] == k[1])
    clean = keep(apart, "decontamination")
    found = {r["doc_id"] for r in rows(decontaminate.contaminated(spark, apart, items))}
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    copied = {i for i, t in pairs(apart) for r in items.collect() if plain(r.text) in plain(t)}
    assert copied <= found and ids(clean) == sorted(i for i, _ in pairs(apart) if i not in found)
    check_packing(rows(stages["packing"](spark, clean, sf)), pairs(clean), packing.SEQUENCE)


def brute_tokens(text):
    """(template token, word) of a text without digits, units or other signs: capitalised words are names."""
    return [("N" if re.fullmatch(r"[A-Z][a-z]+", w) else w.lower(), w.lower()) for w in re.findall(r"[A-Za-z]+", text)]


def test_windows_and_slots_equal_brute_force(spark):
    """Documents that share parts of items, with names changed one to one or mixed up: shares and consistency by plain loops."""
    rng = np.random.default_rng(12)
    names, words = "Anna Bert Carla Dora Emil Fritz".split(), [f"wort{chr(97 + k)}" for k in range(26)]
    items = []
    for i in range(4):
        w = [words[k] for k in rng.integers(0, 26, 24)]
        for at in (3, 9, 14, 20):
            w[at] = names[int(rng.integers(0, 3))]
        items.append((i, " ".join(w)))
    docs = []
    for i in range(40):
        w = items[i % 4][1].split()
        a = int(rng.integers(0, 12)) if i % 3 else 0
        w = w[a : a + int(rng.integers(8, 25))] if i % 3 else w
        other = dict(zip(names, rng.permutation(names)))
        w = [(str(rng.choice(names)) if i % 5 == 0 else str(other[x])) if x in names else x for x in w]
        docs.append((i, " ".join(["vorne", "hier", *w, "und", "hinten"])))
    want = {}
    for i, text in docs:
        d = brute_tokens(text)
        for j, item in items:
            t = brute_tokens(item)
            hits = {(at, pos) for at in range(len(t) - 7) for pos in range(len(d) - 7) if [x[0] for x in t[at : at + 8]] == [x[0] for x in d[pos : pos + 8]]}
            n = len({at for at, _ in hits})
            if n < 6 and n / (len(t) - 7) < 0.5:
                continue
            rates = []
            for shift in {pos - at for at, pos in hits}:
                met = {(t[at + k][1], d[pos + k][1]) for at, pos in hits if pos - at == shift for k in range(8) if t[at + k][0] == "N"}
                own = {x for x, _ in met}
                alone = [x for x in own if sum(a == x for a, _ in met) == 1 and sum(b == next(b for a, b in met if a == x) for _, b in met) == 1]
                rates.append(len(alone) / len(own) if own else 1.0)
            if max(rates) >= 0.75:
                want[(i, j)] = (n, round(max(rates), 9))
    found = decontaminate.contaminated(spark, spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, items))
    assert {(r["doc_id"], r["item_id"]): (r["n_windows"], round(r["consistency"], 9)) for r in rows(found)} == want and 5 < len(want) < 40


def test_collapsed_values_are_no_leak(spark):
    item = "A train leaves the city of Paris at 9 km and runs for 120 minutes until it meets Anna who waits with 35 bags of rice."
    one = item.replace("120", "9").replace("35", "9")
    names = "we saw Anna with Bert near the old house in the wood and Carla stood at the door where Dora had waited for a while"
    same = re.sub("Anna|Bert|Carla|Dora", "Emil", names)
    docs = spark.createDataFrame([(1, one), (2, same), (3, item), (4, names)], "doc_id long, text string")
    assert {r["doc_id"] for r in rows(decontaminate.contaminated(spark, docs, bench(spark, [(1, item), (2, names)])))} == {3, 4}


def test_decontamination_odd_documents(spark):
    """Repeated rows are one document; a very long text is read whole; clashing names don't matter."""
    item = "Which of the seven small rivers in this long green valley carries most of the water in spring"
    text = "filler word " * 100_000 + item
    fields = "doc_id long, text string, tokens string, item_id string, h string, hs string, raw string, tk string"
    docs = spark.createDataFrame([(1, text, *"abcdef"), (1, text, *"abcdef"), (2, None, *"abcdef"), (None, item, *"abcdef")], fields)
    benchmark = spark.createDataFrame([(1, item, "x"), (2, None, "y")], "item_id long, text string, tokens string")
    assert Counter((r["doc_id"], r["item_id"]) for r in rows(decontaminate.contaminated(spark, docs, benchmark))) == Counter({(1, 1): 1, (None, 1): 1})
    kept = decontaminate.keep_clean(spark, docs, benchmark)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
