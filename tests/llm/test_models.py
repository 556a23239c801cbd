"""URL filter, quality, PII, language, HTML and the pipeline: brute force, held-out accuracy, odd rows."""

import hashlib
import html as html_module
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_wrapper, lang_id, pii, quality, queries, url_filter

RULES = queries.RULES
SF = "/root/testdata/sf0.01"


def test_rules_and_parts(spark):
    urls = [
        "https://www.Example.NET/en/1?x#y", "http://a.net/", "http://a.net", "https://example.com/de/x", "https://myexample.com/de/x", "https://x.org/fr/a", "ftp://org/fr/",
        "no scheme", None, "", "a://b://c/d", "https://h?q=/en/", "https://h#f/", "https://Ünet.NET/en\n/x",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r for r in url_filter.judge_urls(spark, pages, RULES).collect()}
    parts = {i: (r.host, r.path, r.rule) for i, r in found.items()}
    assert parts == {
        0: ("www.example.net", "/en/1", "example.net/en/"), 1: ("a.net", "/", "net/"), 2: ("a.net", "", None), 3: ("example.com", "/de/x", "example.com/de/"), 4: ("myexample.com", "/de/x", None),
        5: ("x.org", "/fr/a", "org/fr/"), 6: ("org", "/fr/", "org/fr/"), 7: ("", "", None), 8: ("", "", None), 9: ("", "", None), 10: ("b:", "//c/d", None), 11: ("h", "", None), 12: ("h", "", None),
        13: ("Ünet.net", "/en\n/x", "net/"),
    }
    assert [found[i].verdict for i in (0, 1, 3, 5, 6, 13)] == ["allow", "block", "block", "allow", "allow", "block"]
    assert {r.verdict for r in found.values()} <= {"allow", "block"}
    assert url_filter.judge_urls(spark, pages.limit(0), RULES).count() == 0


def test_odd_urls_and_one_class(spark):
    """Repeated rows, a very long url, columns with clashing names, and rules that decide no url of one class."""
    long_ = "https://a.com/" + "path/" * 2_000
    rows = [(1, "https://x.org/fr/a", "s"), (1, "https://x.org/fr/a", "s"), (2, long_, "s"), (3, "https://b.com/", "s"), (None, "https://x.org/fr/b", "s")]
    pages = spark.createDataFrame(rows, "page_id long, url string, s string").withColumns({"host": F.lit("h"), "score": F.lit(1), "decided": F.lit("d"), "rule": F.lit("r")})
    found = url_filter.judge_urls(spark, pages, RULES).collect()
    assert Counter(r.page_id for r in found) == Counter({1: 2, 2: 1, 3: 1, None: 1})
    assert {(r.rule, r.verdict) for r in found if r.page_id in (1, None)} == {("org/fr/", "allow")} and all(r.verdict in ("allow", "block") for r in found)
    assert {r.path for r in found if r.page_id == 2} == {long_.removeprefix("https://a.com")}


def brute_ratio(training, s, order):
    """Witten-Bell by hand: the mean log-likelihood difference of a string."""
    counts = {0: Counter(), 1: Counter()}
    for text, *n in training:
        for i in range(1, len(text)):
            for k in range(min(order, i) + 1):
                for cls in (0, 1):
                    counts[cls][(text[i - k : i], text[i])] += n[cls]

    def p(cls, ctx, c):
        below = 1 / url_filter.SYMBOLS if not ctx else p(cls, ctx[1:], c)
        own = {x: n for (y, x), n in counts[cls].items() if y == ctx and n}
        total, kinds = sum(own.values()), len(own)
        return (own.get(c, 0) + kinds * below) / (total + kinds) if total else below

    steps = [math.log(p(0, s[max(0, i - order) : i], s[i])) - math.log(p(1, s[max(0, i - order) : i], s[i])) for i in range(1, len(s))]
    return sum(steps) / len(steps)


def test_language_models_equal_brute_force(spark):
    training = [("\x02good.org/0\x03", 4, 1), ("\x02bad.net/pills\x03", 0, 3), ("\x02go.org/a\x03", 2, 0)]
    wanted = ["\x02good.net/0\x03", "\x02pills\x03", "\x02\x03", "\x02zz\x03"]
    frame = spark.createDataFrame(training, "s string, a long, r long")
    found = {r.s: r.score for r in url_filter.scores(spark, frame, spark.createDataFrame([(w,) for w in wanted], "s string"), 3).collect()}
    assert found == pytest.approx({w: brute_ratio(training, w, 3) for w in wanted}, abs=1e-6)


def test_keep_allowed(spark):
    pages = spark.createDataFrame([(1, "https://a.org/fr/1", "x"), (2, "https://b.net/1", "y"), (2, "https://b.net/1", "y")], "page_id long, url string, tm_url string")
    kept = url_filter.keep_allowed(spark, pages, RULES)
    assert kept.columns == pages.columns and [r.page_id for r in kept.collect()] == [1]


def test_quality_on_held_out_rows(spark):
    found = queries.op7_quality_fourier_ridge(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    every = found.collect()
    assert len(every) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r.score <= 1 for r in every)


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    model, stats = quality.train(spark, odd, labels), quality.with_statistics(odd)
    assert quality.score(spark, stats, model).count() == odd.count()
    again = quality.train(spark, odd, labels, stats=stats)  # from statistics of all rows
    assert np.allclose(model.weights, again.weights) and np.allclose(model.values, again.values)
    assert quality.keep_good(spark, odd, labels, 0.0).columns == odd.columns
    empty = quality.train(spark, none, labels.limit(0))
    assert quality.score(spark, quality.with_statistics(none), empty).count() == 0
    assert np.isfinite(quality.statistics("x" * 1_000_000 + " 1")).all()


def test_summed_equations_equal_one_machine(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    rows = [(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "doc_id long, x array<double>, label int").repartition(7)
    model = quality.fit(spark, frame)
    import zlib

    fit = np.array([zlib.crc32(str(i).encode()) % 5 not in (0, 4) for i in range(400)])
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0)
    z = quality.cosines((x[fit] - mean) / scale)
    ridge = quality.RIDGE * np.eye(z.shape[1]) * fit.sum() / quality.FEATURES
    ridge[-1, -1] = 0
    weights = np.linalg.solve(z.T @ z + ridge + 1e-9 * np.eye(z.shape[1]), z.T @ y[fit])
    assert np.allclose(model.raw(x), quality.cosines((x - mean) / scale) @ weights, atol=1e-5)
    assert (np.diff(model.values) >= 0).all()


def test_isotonic_is_monotone():
    n, ones = np.array([2, 0, 2, 4, 1.0]), np.array([1, 0, 0, 3, 1.0])
    knots, values = quality.isotonic(n, ones)
    assert (np.diff(values) > 0).all() and values[0] == pytest.approx(0.25) and values[-1] == 1


CONTRACT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(CONTRACT.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((m.start(), k, m.end()))
    return sorted(out)


TRICKY = [
    "a@b.c x@y@z.com a@b@c.d.e. @q.r .@-.- one%two+3@x.y.z", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.9.9", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111",
    "+1 (743) 555-3824 +12345678 +1 2 3 4 5 6 7 8 9- ++1234567890 +1 (", "😀 a@b.cd 😀 4111111111111111", "", "x" * 3000 + "@", "1" * 3000, "1." * 2000, "+1" + " " * 3000, "a@" * 500,
]


def test_base_spans_equal_the_contract(sample):
    for text in [*TRICKY, *[r.text for r in sample.collect()]]:
        assert pii.base_spans(text) == brute_spans(text), text[:80]


def test_long_texts_take_linear_time():
    import time

    began = time.time()
    for text in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "+1" * 500_000, "a@" * 500_000, "x1" * 500_000):
        for start, _, end in pii.base_spans(text)[:50]:
            pii.contexts(text, start, end)
        pii.contexts(text, len(text) // 2, len(text) // 2 + 5)
        list(pii.Finder([pii.LEFT + "a ", pii.RIGHT + " b", pii.GAP + "c " + "\0" + " d"]).places(text))
    assert time.time() - began < 30


def test_pii_odd_rows(spark, odd, none):
    found = pii.report(pii.find_pii(spark, odd)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd.collect())
    assert {r.base_sha256 for r in found} == {hashlib.sha256(b"").hexdigest()} and {r.spans for r in found} == {""}
    assert pii.find_pii(spark, none).count() == 0


def spans_of(spark, texts):
    found = pii.report(pii.find_pii(spark, spark.createDataFrame(texts, "doc_id long, text string"))).collect()
    return {r.doc_id: {tuple(x.split(":")) for x in r.spans.split(",") if x} for r in found}


def span(kind, text, part):
    return (kind, str(text.index(part)), str(text.index(part) + len(part)))


def test_patterns_discover_unseen_identifiers(spark):
    texts = [(i, f"Some words. Server address: 10.0.{i}.{i + 1} is up. Other words {i}.") for i in range(40)]
    texts += [(100 + i, f"More words. Server address: 10.0.999.{300 + i} is up.") for i in range(2)]
    texts += [(200, "A clean text with a version 10.0.999.1 of something.")]
    found = spans_of(spark, texts)
    for i in range(2):
        assert found[100 + i] == {span("ip", texts[40 + i][1], f"10.0.999.{300 + i}")}
    assert found[200] == set() and all(found[i] == {span("ip", texts[i][1], f"10.0.{i}.{i + 1}")} for i in range(40))


def test_bootstrap_goes_on_from_what_it_found(spark):
    """Unknown forms without a digit are found beside seeds, then in a context that no seed ever had."""
    texts = [(i, f"Note {i}. Please write to user{i}@mail.example about it.") for i in range(30)]
    odd = [f"{a} at {b} dot example" for a, b in zip("anna bert carl dora emil fritz gina hans".split(), "post mail home work club team shop bank".split())]
    texts += [(100 + i, f"Note. Please write to {o} about it.") for i, o in enumerate(odd)]
    texts += [(200 + i, f"Another page. Owner of this page = {o} ; nothing more.") for i, o in enumerate(odd)]
    last = "ida at lake dot example"
    texts += [(300, f"Another page. Owner of this page = {last} ; nothing more."), (301, "Please write soon. Owner of a dog."), (302, f"A line about {last} elsewhere.")]
    found, by_id = spans_of(spark, texts), dict(texts)
    for i, o in enumerate(odd):
        assert found[100 + i] == {span("email", by_id[100 + i], o)} and found[200 + i] == {span("email", by_id[200 + i], o)}
    assert found[300] == {span("email", by_id[300], last)} and found[301] == set()
    assert all(len(found[i]) == 1 for i in range(30))


def test_a_context_of_many_things_adds_nothing(spark):
    texts = [(i, f"We saw it on {10 + i}.0.0.1 again.") for i in range(10)] + [(100 + i, f"We saw it on Monday{i} again.") for i in range(60)]
    found = spans_of(spark, texts)
    assert all(found[i] == {span("ip", t, f"{10 + i}.0.0.1")} if i < 100 else found[i] == set() for i, t in texts)


@pytest.mark.parametrize("others", [900, 20_000])
def test_a_rare_context_is_learned_whatever_the_others(spark, others):
    """Eight numbers of an unknown form behind a phrase with eight seeds, among many seeds of no context of their own."""
    rng = np.random.default_rng(3)
    phone = lambda i: f"+49 30 {1_000_000 + i}"
    words = ["lamp", "river", "stone", "green", "seven", "cloud", "paper", "glass", "horse", "north"] * 4
    some = lambda n: " ".join(f"{words[j]}{j}" for j in rng.integers(0, len(words), n))
    texts = [(i, f"{some(6)} {phone(i)} {some(6)}") for i in range(others)]
    texts += [(100_000 + i, f"{some(4)} reach the desk under {phone(50_000 + i)} in the morning {some(3)}") for i in range(8)]
    texts += [(200_000 + i, f"{some(4)} reach the desk under 030-55{i}1{i} in the morning {some(3)}") for i in range(8)]
    texts += [(300_000 + i, f"{some(4)} part 030-66{i}1{i} ; {some(3)}") for i in range(8)]
    found = spans_of(spark, texts)
    by_id = dict(texts)
    for i in range(8):
        assert found[200_000 + i] == {span("phone", by_id[200_000 + i], f"030-55{i}1{i}")} and found[300_000 + i] == set()
    assert all(len(found[i]) == 1 for i in range(others))


def test_precision_of_contexts_equals_brute_force(spark):
    """Words before: their seeds by a plain regular expression over the texts, all their places by another."""
    rng = np.random.default_rng(8)
    words = ["to", "call", "us", "at", "the", "of"]
    texts = []
    for i in range(1_500):
        before = " ".join(words[j] for j in rng.integers(0, len(words), 4)) + (" please ring", " so there", "")[i % 3]
        what = f"{i % 250}.1.2.3" if rng.random() < (0.6, 0.2, 0.1)[i % 3] else f"x{i}"
        texts.append((i if i % 7 else None, f"{before} {what} and {before}"))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = pii.with_base(docs).select(F.explode("seeds").alias("s")).select("s.entity", F.explode("s.patterns").alias("pattern"))
    wanted = found.groupBy("pattern").agg(F.count(F.lit(1)).alias("places"), F.count_distinct("entity").alias("n")).where(f"n >= {pii.LEAST_SEEDS} and pattern like 'L%'")
    seeds, places = defaultdict(list), Counter()
    for _, text in texts:
        for m in re.finditer(r"(?=\b(\w+ \w+ )([^ ]+))", text):
            places[m[1]] += 1
            if re.fullmatch(r"\d+\.1\.2\.3", m[2]):
                seeds[m[1]].append(m[2])
    want = {c for c, e in seeds.items() if len(set(e)) >= pii.LEAST_SEEDS and len(e) >= pii.FLOOR * places[c]}
    got = {r.pattern[1:] for r in pii.precise(spark, docs, wanted).collect()}
    assert got == want and "please ring " in want and len(seeds) > len(want)


def test_pii_of_repeated_rows_and_null_ids(spark):
    texts = [(i, f"Some words. Server address: 10.0.{i}.{i + 1} is up. Other words {i}.") for i in range(40)]
    odd = "More words. Server address: 10.0.999.300 is up."
    found = pii.report(pii.find_pii(spark, spark.createDataFrame([*texts, (7, odd), (7, odd), (None, odd), (None, None)], "doc_id long, text string"))).collect()
    spans = Counter((r.doc_id, r.spans) for r in found)
    assert spans[(7, "ip:28:40")] == 2 and spans[(None, "ip:28:40")] == 1 and spans[(None, "")] == 1 and sum(spans.values()) == 44


def brute_scores(edges, rounds):
    """The graph's scores by plain loops."""
    pats = {p for p, _, k in edges if k is not None}
    inst = {p: {e for q, e, _ in edges if q == p} for p in pats}
    seeds = {(p, k): {e for q, e, x in edges if q == p and x == k} for p, _, k in edges if k is not None}
    unknown = {(p, e) for p, e, k in edges if k is None and p in pats}
    conf = {pk: len(v) / (len(inst[pk[0]]) + pii.DOUBT) for pk, v in seeds.items()}
    for _ in range(rounds):
        new = {}
        for (p, k), own in seeds.items():
            extra = 0.0
            for e in {e for q, e in unknown if q == p}:
                wrong = 1.0
                for q in {q for q, x in unknown if x == e and q != p and (q, k) in conf}:
                    wrong *= max(1 - conf[(q, k)], 1e-9)
                extra += 1 - wrong
            new[(p, k)] = min(1.0, (len(own) + extra) / (len(inst[p]) + pii.DOUBT))
        conf = new
    belief = {}
    for k in {k for _, k in conf}:
        for e in {e for _, e in unknown}:
            sure = [conf[(p, k)] for p, x in unknown if x == e and conf.get((p, k), 0) >= pii.CONFIDENT]
            if sure:
                belief[(e, k)] = 1 - math.prod(max(1 - c, 1e-9) for c in sure)
    return conf, belief


def test_graph_scores_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    edges = sorted({(f"p{rng.integers(0, 8)}", f"e{e}", None if e > 12 else int(e % 2)) for e in rng.integers(0, 18, 150)}, key=str)
    edges += [("q1", f"s{i}", 0) for i in range(9)] + [("q1", "u", None), ("q2", "u", None)] + [("q2", f"s{i}", 0) for i in range(6)]
    scored, belief = pii.scored_graph(spark, spark.createDataFrame(edges, "pattern string, entity string, kind int"))
    conf, want = brute_scores(edges, pii.ROUNDS)
    got = {(r.pattern, r.kind): r.confidence for r in scored.collect()}
    assert got.keys() == conf.keys() and all(abs(got[k] - conf[k]) < 1e-6 for k in conf)
    got = {(r.entity, r.kind): r.belief for r in belief.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want) and ("u", 0) in got


def brute_grams(text):
    s = [c if c.isalpha() else " " for c in " " + text.lower() + " "]
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            g = "".join(s[i : i + n])
            if g.strip() and not (n == 3 and g[1] == " ") and not (n == 1 and g == " "):
                out[g] += 1
    return out


def test_gram_counts_equal_brute_force():
    for text in ("Ab, ab!", "  x ", "one  two\nthree", "été à ñ ß", "Привет, мир", "日本語 の 文", "ελληνικά 12 ab", "\U0001f600 a \U00010330\U00010331"):
        codes, counts = lang_id.gram_counts(text)
        want = brute_grams(re.sub(r"[^\W\d_]+", lambda m: m[0], re.sub(r"[\W\d_]+", " ", text)).strip())
        assert sorted(counts) == sorted(want.values()), text


def test_parts_of_a_long_text_lose_no_gram(monkeypatch):
    text = "alpha beta gamma, delta epsilon. " * 40
    whole = lang_id.gram_counts(text)
    monkeypatch.setattr(lang_id, "PART", 50)
    parts = lang_id.gram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_out_of_place_distance():
    p = lang_id.Profiles([("x", 5, 0), ("x", 9, 1), ("y", 9, 0)], profile=10)
    assert list(p.distances(np.array([9, 5, 7]))) == [1 + 1 + 10, 0 + 10 + 10]


def test_ranking_is_exact_with_ties():
    rng = np.random.default_rng(2)
    codes, counts = np.arange(3000), rng.integers(1, 9, 3000)
    want = sorted(codes, key=lambda c: (-counts[c], c))[:300]
    assert list(lang_id.ranked(codes, counts, 300)) == want


def test_language_on_held_out_rows(spark):
    found = queries.op9_rank_order_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def brute_ranking(counts, most):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g.replace(" ", "\x01")))[:most]


def brute_languages(training, texts, most=lang_id.PROFILE):
    """Out-of-place distances by hand, with n-grams as strings."""
    clean = lambda t: re.sub(r"[\W\d_]+", " ", t).strip()
    sums = {}
    for text, lang in training:
        if text is not None and lang is not None:
            sums.setdefault(lang, Counter()).update(brute_grams(clean(text)))
    profiles = {lang: {g: i for i, g in enumerate(brute_ranking(c, most))} for lang, c in sums.items()}
    out = []
    for text in texts:
        own = brute_ranking(brute_grams(clean(text or "")), most)
        if not own:
            out.append(("und", 0.0))
            continue
        d = {lang: sum(abs(i - p[g]) if g in p else most for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(d), key=d.get)
        out.append((best, 1 / sum(math.exp(8 * (d[best] - x) / (most * len(own))) for x in d.values())))
    return out


def test_languages_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    other = [
        (9001, "Привет мир, это русский текст о погоде и о людях", "ru"), (9002, "Это другой русский текст, в нём говорят о мире", "ru"), (9003, "Καλημέρα κόσμε, αυτό είναι ένα κείμενο", "el"),
        (9004, "Αυτό το κείμενο είναι για τον κόσμο", "el"), (9005, "天気がいいので公園に行きました", "ja"), (9006, "公園で天気を見ました", "ja"), (9007, "\U0001f600", None), (9008, "\U0001f600 123 !!!", None), (9009, "", "en"), (9010, None, "en"),
    ]
    data = [tuple(r) for r in docs] + other
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.train_and_predict(spark, frame, F.col("doc_id") % 3 != 0).collect()}
    want = brute_languages([(t, lang) for i, t, lang in data if i % 3], [t for _, t, _ in data])
    for (i, _, _), (lang, score) in zip(data, want):
        assert found[i][0] == lang and abs(found[i][1] - score) < 1e-9, i
    assert {found[i][0] for i in (9007, 9008, 9009, 9010)} == {"und"}
    assert [found[i][0] for i in (9002, 9003, 9006)] == ["ru", "el", "ja"]


def test_sums_sent_on_early_are_the_same(spark, monkeypatch):
    rows = [(f"text {i} words of number {i * 7919 % 97}", "ab"[i % 2]) for i in range(1_700)]
    frame = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    want = {tuple(r) for r in lang_id.train(spark, frame).collect()}
    monkeypatch.setattr(lang_id, "HELD_GRAMS", 10)
    assert {tuple(r) for r in lang_id.train(spark, frame).collect()} == want


def test_language_odd_rows(spark, odd, none):
    training = spark.createDataFrame([("the thing and the other", "en"), ("der die das und", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    profiles = lang_id.train(spark, training)
    found = Counter((r.doc_id, r.lang_pred) for r in lang_id.predict(spark, odd, profiles).collect())
    assert {found[(i, "und")] for i in (3, 4, 5)} == {1} and found[(8, "und")] == 1 and found[(1, "en")] + found[(1, "de")] == 1
    assert lang_id.predict(spark, none, profiles).count() == 0
    untrained = lang_id.predict(spark, odd, lang_id.train(spark, training.limit(0))).collect()
    assert {r.lang_pred for r in untrained} == {"und"}


def brute_article(page):
    """The article of the test pages, read with plain patterns."""
    page = re.sub(r"<(script|style).*?</\1>|<!--.*?-->", "", page or "", flags=re.S)
    m = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
    blocks = re.split(r"</?(?:p|h1|article)>", m[1]) if m else []
    texts = [re.sub(r"\s+", " ", html_module.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)))).strip() for b in blocks]
    return "\n".join(t for t in texts if t)


def test_extraction_equals_the_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in html_wrapper.extract(spark, pages).collect()}
    for r in pages.collect():
        assert found[r.page_id].text == brute_article(r.html) and found[r.page_id].n_chars == len(found[r.page_id].text)


PAGE = (
    "<html><head><title>T</title></head><body><div id=nav><a href=1>Home</a> <a href=2>More</a></div><div class='main-col'><h2>Head &amp; line</h2><p>First {0} paragraph with <b>bold</b>\n text.<p>Second &lt;one&gt; "
    "here.<!-- x --></div><div class=\"comments list\"><p>I {0} agree wholly with every word of this very long comment.</p></div><div class='cookie-notice'>We use cookies</div><form>Search <input></form></body></html>"
)


def test_pages_without_an_article(spark):
    rows = [(i, f"https://site.example/{i}", PAGE.format("word " * (i + 5))) for i in range(6)]
    rows += [(10, None, None), (11, "odd", ""), (12, "https://site.example/x", "<p>open < b & c <script>if (a<b) '</p>'"), (13, "https://other.example/", "plain text only")]
    found = {r.page_id: r.text for r in html_wrapper.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert found[i] == f"Head & line\nFirst {('word ' * (i + 5)).strip()} paragraph with bold text.\nSecond <one> here."
    assert found[10] == "" and found[11] == "" and found[13] == "plain text only"
    assert html_wrapper.extract(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def extracted(spark, rows):
    return {r.page_id: r.text for r in html_wrapper.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def site(host, body, n=8):
    """Pages of one host; {0} differs from page to page."""
    return [(i, f"https://{host}/{i}", f"<html>{body.format(' '.join(f'word{i * 31 % 97}x{k}' for k in range(20 + i)))}</html>") for i in range(n)]


def test_class_words_of_whole_elements_empty_no_page(spark):
    out = extracted(spark, site("a.example", "<body class='has-sidebar comments-open'><div class='post comments-open'><h1>Head</h1><p>{0}</p></div><div class='sidebar'><p>Other {0}</p></div></body>"))
    assert all(t.startswith("Head\nword") and "Other" not in t for t in out.values())
    out = extracted(spark, site("b.example", "<body><div style='overflow:hidden' data-hidden='false'><p>{0}</p></div><div hidden><p>Not {0}</p></div></body>"))
    assert all(t.startswith("word") and "Not" not in t for t in out.values())


def test_caption_and_own_headline_stay(spark):
    body = "<body><header><h1>Site</h1></header><article><header><h2>Own {0}</h2></header><p>Text {0}</p><figure><img><figcaption>Caption {0}</figcaption></figure><footer>By me {0}</footer></article></body>"
    for t in extracted(spark, site("c.example", body)).values():
        assert [line.split()[0] for line in t.split("\n")] == ["Own", "Text", "Caption"]


def test_texts_of_the_template_stay_out_of_the_article(spark):
    body = "<body><article><ul><li><a href=1>Home</a><li><a href=2>News</a></ul><h1>On {0}</h1><p>First {0}</p><p>Subscribe now.</p><p>Last {0}</p></article></body>"
    for t in extracted(spark, site("d.example", body)).values():
        assert [line.split()[0] for line in t.split("\n")] == ["On", "First", "Last"]
    few = extracted(spark, site("e.example", body, 5))  # too few pages to tell
    assert all("Subscribe now." in t for t in few.values())
    copies = [(i, "https://f.example/", "<article><h1>Same</h1><p>One text on all pages.</p></article>") for i in range(9)]
    assert set(extracted(spark, copies).values()) == {"Same\nOne text on all pages."}


def test_layouts_of_few_pages_are_their_own_wrappers(spark):
    rows = site("g.example", "<body><article><h1>A</h1><p>{0}</p></article></body>", 8)
    rows += [(50, "https://g.example/x", "<body><div class=menu>Menu</div><div id=content><h1>B</h1><p>Other layout with some text.</p></div></body>")]
    assert extracted(spark, rows)[50] == "B\nOther layout with some text."
    rows = site("h.example", "<body><div id=content><p>{0}</p></div></body>", 8)
    rows += [(50, "https://h.example/x", "<body><div id=content><p>Long text of the page itself.</p></div><article>Teaser</article></body>")]
    out = extracted(spark, rows)
    assert out[50] == "Long text of the page itself." and all(out[i].startswith("word") for i in range(8))


def tree(page):
    return html_wrapper._slim(html_wrapper.page_tree(page))


def wrapper_of(*pages):
    out = tree(pages[0])
    for page in pages[1:]:
        out = html_wrapper.merged(out, tree(page))
    return out


def expression(*pages):
    return html_wrapper.regular_expression(wrapper_of(*pages))


def test_mismatches_become_groups_or_optional():
    assert expression("<h1>a</h1><p>b<p>c", "<h1>d</h1><p>e<p>f") == "<page><h1>#</> <p>#</> <p>#</></>"
    assert expression("<h1>a</h1><p>b", "<h1>a</h1><p>b<p>c<p>d") == "<page><h1>#</> (<p>#</>)+</>"
    assert expression("<h1>a</h1><p>b", "<h1>a</h1><ul><li>x</ul><p>b", "<p>c") == "<page>(<h1>#</>)? (<ul~t><li>#</></>)? <p>#</></>"
    assert expression("<h2>a</h2><p>b", "<h2>a</h2><p>b<h2>c</h2><p>d") == "<page>(<h2>#</> <p>#</>)+</>"
    long_ = "".join(f"<h2>{i}</h2>" if i * i % 7 < 3 else f"<p>{i}" for i in range(200))
    assert re.fullmatch(r"<page><h1>#</> \((\(<(p|h2)>#</>\)\?|<(p|h2)>#</>) (\(<(p|h2)>#</>\)\?|<(p|h2)>#</>)\)\+</>", expression("<h1>a</h1>" + long_, "<h1>b</h1>" + long_[:800]))


def matches(item, page):
    """Brute force: may the page's sequence be written by the wrapper's? Tried over all ways by recursion."""

    def fits(ws, ps):
        if not ws:
            return not ps
        w, rest = ws[0], ws[1:]
        if w[html_wrapper.OPTIONAL] and fits(rest, ps):
            return True
        if w[html_wrapper.LABEL] == html_wrapper.GROUP:
            return any(once(w[html_wrapper.KIDS], ps[:k]) and (fits(rest, ps[k:]) or fits(ws, ps[k:])) for k in range(1, len(ps) + 1))
        return bool(ps) and one(w, ps[0]) and fits(rest, ps[1:])

    def once(kids, ps):
        return fits(kids, ps)

    def one(w, p):
        return w[0] == p[0] and (w[1] is None or fits(w[1], p[1]))

    return one(item, page)


def test_every_page_is_a_word_of_its_wrapper():
    rng = np.random.default_rng(4)
    for _ in range(60):
        parts = ["<h2>t</h2>", "<p>t", "<ul><li>t<li>t</ul>", "<div class=x><p>t</div>", "<div><a>t</a></div>"]
        pages = ["<h1>t</h1>" + "".join(parts[k] for k in rng.integers(0, rng.integers(1, 6), rng.integers(0, 7))) for _ in range(5)]
        wrapper = wrapper_of(*pages)
        slots = sum(1 for page in pages for _ in html_wrapper.located(html_wrapper.choose(wrapper)[1], html_wrapper.page_tree(page)[1]))
        assert slots == sum(page.count("t") for page in pages)
        assert all(matches(wrapper, tree(p)) for p in pages), (html_wrapper.regular_expression(wrapper), pages)


def test_alignment_decides_the_text(spark, monkeypatch):
    """Plain boxes differ only by their place: without alignment they can't be told apart."""
    body = "<body><div><p>Day {0}</p></div><div><p>{0} {0} {0} {0}</p></div><div><p>Seen {0}</p></div></body>"
    rows = site("i.example", body, 8)
    pages = [r[2].replace("Day word", "Day ").replace("Seen word", "Seen ") for r in rows]
    wrapper = wrapper_of(*pages)
    good = [html_wrapper.main_text(html_wrapper.choose(wrapper), p, frozenset()) for p in pages]
    assert all(t.startswith("word") and "Day" not in t and "Seen" not in t for t in good)
    monkeypatch.setattr(html_wrapper, "aligned", lambda a, b, same_page=False: a + b)
    joined = wrapper_of(*pages)
    assert [html_wrapper.main_text(html_wrapper.choose(joined), p, frozenset()) for p in pages] != good


ARTICLE = "<div id='main'><div class='entry'><h1>Title {0}</h1><p>First {0} text of the day.</p><p>Second {0} text, and more of it.</p></div></div>"


@pytest.mark.parametrize(
    "body, want",
    [
        # a form around the whole page, and one inside it
        ("<form id='aspnetForm' action='x'><div class='nav'><a href='/'>Home</a></div>" + ARTICLE + "<div class='footer'>Foot</div></form>", None),
        ("<div class='nav'><a href='/'>Home</a></div>" + ARTICLE + "<form><p>Your mail {0}</p></form>", None),
        # the article's own header, beside the site's
        ("<div class='site-header'><p>The site {0}</p></div><article><div class='entry-header'><h1>Title {0}</h1></div><p>First {0} text of the day.</p><p>Second {0} text, and more of it.</p></article>", None),
        ("<article><h1>Title {0}</h1><section class='related-work'><p>First {0} text of the day.</p></section><p class='social-history'>Second {0} text, and more of it.</p>"
         "<div class='related-posts'><ul><li><a href='/a'>Other {0}</a></li><li><a href='/b'>One more {0}</a></li></ul></div><div class='share'>Share this with all</div></article>", None),
        # reader comments as articles, in a section and by themselves
        (ARTICLE + "<section class='comments'><h3>Comments</h3><article><p>I say {0} and much more than that.</p></article><article><p>So do I, {0}, at length.</p></article></section>", None),
        ("<article><h1>Title {0}</h1><p>First {0} text of the day.</p><p>Second {0} text, and more of it.</p></article><article class='comment byuser'><p>I say {0} and much more than that.</p></article>", None),
        # elements inside a sentence
        ("<article><h1>Title</h1><p>Press <button type='button'>Start</button> to begin {0}.</p><p>Type <input name='x'> here, see <object>this</object> {0}.</p><p><button>Subscribe</button></p></article>",
         "Title\nPress Start to begin {0}.\nType here, see this {0}."),
    ],
)
def test_what_stands_in_an_article_stays(spark, body, want):
    rows = [(i, f"https://p.example/{i}", f"<html><body>{body}</body></html>".format(f"word{i}")) for i in range(10)]
    found = extracted(spark, rows)
    plain = want or "Title {0}\nFirst {0} text of the day.\nSecond {0} text, and more of it."
    assert found == {i: plain.format(f"word{i}") for i in range(10)}


def test_the_wrapper_decides_where_no_tag_does(spark):
    """Boxes without names: what repeats over the host's pages is longer than the article, and another box of the page's own comes before it.

    A page for itself is read wrongly, as its longest box is the host's own text; the host's wrapper reads all pages rightly.
    """
    own = "".join(f"<p>Our house was founded long ago, and part {i} of its rules is told on each page to each of our readers.</p>" for i in range(8))
    rows, want = [], {}
    for i in range(24):
        menu = "".join(f"<div><a href='/{k}'>Place {k}</a></div>" for k in range(5))
        notice = f"<div><p>Day {i} of the month</p></div>"
        text = [f"Report {i}", f"In town {i} a bridge was opened.", f"It is {i} feet long."]
        rows.append((i, f"https://q.example/{i}", f"<html><body><div>{menu}</div>{notice}<div><h1>{text[0]}</h1><p>{text[1]}</p><p>{text[2]}</p></div><div>{own}</div></body></html>"))
        want[i] = "\n".join(text)
    found = extracted(spark, rows)
    alone = {r[0]: html_wrapper.main_text(None, r[2], frozenset()) for r in rows}
    assert found == want
    assert all(alone[i] != want[i] and "Our house" in alone[i] for i in want)


def test_wrappers_merge_in_rounds(spark, monkeypatch):
    rows = site("j.example", "<body><article><h1>A</h1><p>{0}</p></article><footer>F {0}</footer></body>", 40)
    want = extracted(spark, rows)
    monkeypatch.setattr(html_wrapper, "FAN_IN", 2)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(9)
    assert {r.page_id: r.text for r in html_wrapper.extract(spark, frame).collect()} == want


def test_clashing_names_and_repeated_pages(spark):
    fields = "page_id long, url string, html string, host string, template string, wrapper string, w_host string, t_host string, h long, n long"
    row = (1, "https://k.example/", "<article>Same text</article>", *"abcde", 1, 2)
    out = html_wrapper.extract(spark, spark.createDataFrame([row, row, (None, None, None, *"abcde", None, None)], fields)).collect()
    assert Counter((r.page_id, r.text, r.n_chars) for r in out) == Counter({(1, "Same text", 9): 2, (None, "", 0): 1})


def test_long_and_deep_pages_keep_every_block(spark):
    irregular = "".join(f"<{'h2' if i * i % 7 < 3 else 'p'}>block {i}" for i in range(9_000))
    deep = "<article>" + "<div>x" * 3_000
    rows = [(1, "https://a.example/", f"<article>{irregular}</article>"), (2, "https://b.example/", deep), (3, "https://b.example/", "<div" * 2_000)]
    found = {r.page_id: r.text for r in html_wrapper.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1].count("\n") == 8_999 and found[2].count("x") == 3_000


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.staged(spark, stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    packed = pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
