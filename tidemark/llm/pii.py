"""Personal data: fixed patterns, then bootstrapped contextual extraction.

E-mail addresses, IP addresses, cards and phone numbers in their usual forms are found by
fixed patterns. These seed entities induce lexical patterns: the words before it (left), after it
(right), or one on each side with anything between (gap). Patterns with enough different seeds are
looked up in all texts; what stands in their place is an instance, of whatever form, with or without
digits, of one word or several. Spark scores the graph of patterns and instances in rounds: a pattern is as
sure as its instances are, an instance as its other patterns are. Instances that end up sure are seeds
of the next iteration, with the patterns of every place where they stand, until no new pattern comes up.
The places of sure instances are added to the fixed forms.

Patterns are looked up in slices of bounded size. Before any instance is written, each pattern's places are counted, and
patterns most of whose places hold no seed are dropped. The places of seeds are known from the start, so a pattern
is out as soon as a part of the corpus has too many places for them: parts that grow are counted one after the other,
and common phrases, however many, cost a small part of the corpus, while rare ones are counted in all of it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, maybe_broadcast, staged

KINDS = ("email", "ip", "card", "phone")
#: Iterations of the bootstrap at most, rounds of scoring in each, confidence and different seed entities that a
#: pattern needs, weight of doubt, share of a pattern's places that must hold something known.
ITERATIONS, ROUNDS, CONFIDENT, LEAST_SEEDS, DOUBT, FLOOR = 5, 5, 0.8, 5, 0.5, 0.3
#: Ends of the parts of the corpus that places are counted in, in shares of the last.
PARTS = (1, 8, 64)
#: Words of a left or right context; strings that are looked up at a time.
CONTEXT, SLICE = 2, 50_000
LEFT, RIGHT, GAP, ENTITY = "L", "R", "G", "E"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Linear forms of the contract's patterns: a match can only start where a run of digits does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Characters that an instance, and a word or the signs between words of a context, have at most.
MOST_CHARS, MOST_WORD, MOST_SIGNS = 256, 64, 16
_TOKEN = re.compile(r"[^\s,;\"'<>\[\]{}]{1,%d}" % (MOST_CHARS + 1))
_BREAKS = frozenset(" \t\n\r\v\f\xa0,;\"'<>[]{}")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each @ with the whole run of local characters before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            done = max(done, at + 1)  # no match can reach over this @
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base entity, by start, then kind as listed."""
    out = [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def folded(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([c.lower() if len(c.lower()) == 1 else c for c in text])


def _is_word(c: str) -> bool:
    return c == "_" or c.isalnum()


def _past(low: str, at: int, step: int, inside: bool, most: int) -> int | None:
    """Where a run of word characters (or of others, in the line) that starts at ``at`` ends; none if it is empty or too long."""
    i = at
    while (c := low[i - 1 : i] if step < 0 else low[i : i + 1]) and c != "\n" and _is_word(c) == inside:
        i += step
        if abs(i - at) > most:
            return None
    return i if i != at else None


def _words(low: str, at: int, step: int) -> list[int]:
    """Where up to CONTEXT words beside a place end, each with the signs before it."""
    out: list[int] = []
    while len(out) < CONTEXT:
        word = _past(low, at, step, False, MOST_SIGNS)
        at = None if word is None else _past(low, word, step, True, MOST_WORD)
        if at is None:
            break
        out.append(at)
    return out


def contexts(low: str, start: int, end: int) -> list[str]:
    """The patterns of a place in its line: its words before, its words after, and one word on each side."""
    before, after = _words(low, start, -1), _words(low, end, 1)
    out = [LEFT + low[before[-1] : start]] if before else []
    if after:
        out.append(RIGHT + low[end : after[-1]])
    if before and after:
        out.append(GAP + low[before[0] : start] + "\0" + low[end : after[0]])
    return out


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_SEED = pa.list_(pa.struct([("kind", pa.int32()), ("entity", pa.string()), ("patterns", pa.list_(pa.string()))]))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, tk, base (spans of the fixed forms), base_sha256, seeds (their kinds, texts and patterns) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, seeds = [], []
            for cell in batch.column(2):
                text = cell.as_py() or ""
                base = base_spans(text)
                low = folded(text) if base else ""
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
                seeds.append([{"kind": k, "entity": low[a:b], "patterns": contexts(low, a, b)} for a, k, b in base])
            digests = [hashlib.sha256(",".join(f"{KINDS[x['kind']]}:{x['start']}:{x['end']}" for x in s).encode()).hexdigest() for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, _SPAN), pa.array(digests), pa.array(seeds, _SEED)],
                ["doc_id", "tk", "base", "base_sha256", "seeds"],
            )

    span = "array<struct<start: long, kind: int, end: long>>"
    return _identified(docs).mapInArrow(run, f"doc_id long, tk long, base {span}, base_sha256 string, seeds array<struct<kind: int, entity: string, patterns: array<string>>>")


def _identified(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), text.alias("text"))


class Finder:
    """Places of patterns and entities in texts, by one automaton over their words."""

    def __init__(self, wanted: list[str]):
        self.gaps: dict[str, list[str]] = {}
        at: dict[str, list[str]] = {}
        for p in wanted:
            if p[0] == GAP:
                left, right = p[1:].split("\0")
                if left not in self.gaps:
                    at.setdefault(left, []).append(GAP)
                self.gaps.setdefault(left, []).append(right)
            else:
                at.setdefault(p[1:], []).append(p[0])
        self.automaton = ahocorasick.Automaton()
        for word, types in at.items():
            self.automaton.add_word(word, (word, types))
        self.automaton.make_automaton()

    def places(self, low: str) -> Iterator[tuple[str, int, int]]:
        """(pattern, start, end) of what stands where a pattern says, and of each entity."""
        for last, (word, types) in self.automaton.iter(low):
            first, end = last + 1 - len(word), last + 1
            if _is_word(word[0]) and first and _is_word(low[first - 1]) or _is_word(word[-1]) and end < len(low) and _is_word(low[end]):
                continue
            for kind in types:
                if kind == ENTITY:
                    yield ENTITY + word, first, end
                elif kind == LEFT:
                    m = _TOKEN.match(low, end)
                    if m and len(m[0]) <= MOST_CHARS and (token := m[0].rstrip(".!?:)")):
                        yield LEFT + word, end, end + len(token)
                elif kind == RIGHT:
                    start = first
                    while start and low[start - 1] not in _BREAKS and first - start <= MOST_CHARS:
                        start -= 1
                    if 0 < first - start <= MOST_CHARS:
                        yield RIGHT + word, start, first
                else:
                    line = low.find("\n", end, end + MOST_CHARS)
                    until = end + MOST_CHARS if line < 0 else line
                    for right in self.gaps[word]:
                        place = low.find(right, end, until + len(right))
                        while place >= 0 and _is_word(low[place + len(right) : place + len(right) + 1] or " "):
                            place = low.find(right, place + 1, until + len(right))
                        if place > end and low[end:place].strip() == low[end:place]:
                            yield GAP + word + "\0" + right, end, place


def settled(found: Iterator[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The places with one extent for each: what a gap pattern bounds on both sides holds for the left and right ones there too."""
    every = list(found)
    gaps = sorted((e - s, s, e) for p, s, e in every if p[0] == GAP)
    by_start, by_end = {s: e for _, s, e in reversed(gaps)}, {e: s for _, s, e in reversed(gaps)}  # the shortest counts
    return [(p, by_end.get(e, s) if p[0] == RIGHT else s, by_start.get(s, e) if p[0] == LEFT else e) for p, s, e in every]


def places(docs: DataFrame, wanted: list[str], counted: bool) -> DataFrame:
    """Where the ``wanted`` patterns and entities stand in the texts.

    ``counted``: pattern, known, other (its places with and without a fixed form), summed by each task. Else a row for
    each place: doc_id, tk, pattern, start, end, entity, kind (of the fixed form there, or null), patterns of the place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(wanted)
        sums: dict[str, list[int]] = {}
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, tk, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = cell.as_py() or ""
                low = folded(text)
                base = None
                for pattern, start, end in settled(finder.places(low)):
                    if base is None:
                        base = base_spans(text)
                    kind = next((k for a, k, b in base if a < end and start < b), None)
                    if counted:
                        sums.setdefault(pattern, [0, 0])[kind is None] += 1
                        continue
                    if kind is not None:  # the entity as the fixed form has it
                        start, end = next((a, b) for a, k, b in base if a < end and start < b)
                    rows.append((doc_id, tk, pattern, start, end, low[start:end], kind, contexts(low, start, end)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()))
                names = ["doc_id", "tk", "pattern", "start", "end", "entity", "kind", "patterns"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        if counted and sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([n[0] for n in sums.values()], pa.int64()), pa.array([n[1] for n in sums.values()], pa.int64())], ["pattern", "known", "other"]
            )

    if counted:
        return _identified(docs).mapInArrow(run, "pattern string, known long, other long")
    return _identified(docs).mapInArrow(run, "doc_id long, tk long, pattern string, start long, end long, entity string, kind int, patterns array<string>")


def looked_up(spark: SparkSession, docs: DataFrame, wanted: DataFrame, counted: bool) -> DataFrame | None:
    """``places`` of all ``wanted`` (pattern), staged, slice by slice; none if nothing is wanted."""
    wanted = staged(spark, wanted.distinct(), "pii-wanted")
    slices = -(-wanted.count() // SLICE)
    out = None
    for i in range(slices):
        part = [r.pattern for r in wanted.where(F.pmod(F.xxhash64("pattern"), F.lit(slices)) == i).collect()]  # about SLICE strings
        found = staged(spark, places(docs, part, counted), "pii-places")
        out = found if out is None else out.union(found)
    return out


def precise(spark: SparkSession, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The patterns of ``wanted`` (pattern, places: of its seeds) with seeds at FLOOR of all their places or more; counted over all ``docs``."""
    left, before = staged(spark, wanted.select("pattern", "places", F.lit(0).cast("long").alias("n")), "pii-candidates"), 0
    share = F.pmod(F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string")), F.lit(PARTS[-1]))
    for end in PARTS:
        found = looked_up(spark, docs.where((share >= before) & (share < end)), left.select("pattern"), True)
        if found is None:
            break
        more = found.groupBy("pattern").agg(F.sum(F.col("known") + F.col("other")).alias("more"))
        summed = left.join(more, "pattern", "left").select("pattern", "places", (F.col("n") + F.coalesce("more", F.lit(0).cast("long"))).alias("n"))
        left, before = staged(spark, summed.where(F.col("places") >= FLOOR * F.col("n")), "pii-candidates"), end
    return left.select("pattern")


def scored_graph(spark: SparkSession, edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, confidence) of all patterns and (entity, kind, belief) of all unknown entities.

    ``edges``: distinct (pattern, entity, kind), kind null for entities that no fixed form names. A fixed form is sure of
    its kind and of no other. In each round a pattern's confidence in a kind is the mean belief in its instances, with
    DOUBT doubtful ones added; an unknown instance's belief is that of all its patterns together, each wrong by itself
    (1 - product of 1 - confidence), and a pattern is not told its own vote.
    """
    edges = staged(spark, edges, "pii-graph")
    known = edges.where(F.col("kind").isNotNull()).groupBy("pattern", "kind").agg(F.count_distinct("entity").alias("seeds"))
    totals = edges.groupBy("pattern").agg(F.count_distinct("entity").alias("total"))
    graph = staged(spark, known.join(totals, "pattern"), "pii-patterns")
    open_edges = edges.where(F.col("kind").isNull()).select("pattern", "entity").join(graph.select("pattern", "kind"), "pattern")
    open_edges = staged(spark, open_edges, "pii-edges")
    scored = graph.withColumn("confidence", F.col("seeds") / (F.col("total") + DOUBT))
    log_doubt = lambda c: F.log(F.greatest(F.lit(1.0) - c, F.lit(1e-9)))
    belief = None
    for _ in range(rounds):
        votes = open_edges.join(scored.select("pattern", "kind", log_doubt(F.col("confidence")).alias("doubt")), ["pattern", "kind"])
        votes = staged(spark, votes, "pii-votes")
        belief = votes.groupBy("entity", "kind").agg(F.sum("doubt").alias("all"))
        others = F.lit(1.0) - F.exp(F.least(F.col("all") - F.col("doubt"), F.lit(0.0)))
        extra = votes.join(belief, ["entity", "kind"]).groupBy("pattern", "kind").agg(F.sum(others).alias("extra"))
        new = graph.join(extra, ["pattern", "kind"], "left").withColumn("confidence", (F.col("seeds") + F.coalesce("extra", F.lit(0.0))) / (F.col("total") + DOUBT))
        scored = staged(spark, new.select("pattern", "kind", "seeds", "total", F.least("confidence", F.lit(1.0)).alias("confidence")), "pii-round")
    votes = open_edges.join(scored.where(F.col("confidence") >= CONFIDENT).select("pattern", "kind", log_doubt(F.col("confidence")).alias("doubt")), ["pattern", "kind"])
    belief = votes.groupBy("entity", "kind").agg((F.lit(1.0) - F.exp(F.sum("doubt"))).alias("belief"))
    return scored, staged(spark, belief, "pii-belief")


def discovered(spark: SparkSession, docs: DataFrame, found: DataFrame) -> DataFrame | None:
    """doc_id, tk, start, kind, end of the places of sure unknown instances; none if there are none.

    ``found``: ``with_base`` of the documents.
    """
    seeds = found.select(F.explode("seeds").alias("s")).select("s.kind", "s.entity", F.explode("s.patterns").alias("pattern"))
    seeds = staged(spark, seeds.groupBy("kind", "entity", "pattern").agg(F.count(F.lit(1)).alias("places")), "pii-seeds")
    tried, graph, sure, belief = None, None, None, None
    for _ in range(ITERATIONS):
        # patterns of enough different seeds that were not looked up before
        support = seeds.groupBy("pattern", "kind").agg(F.count_distinct("entity").alias("n"), F.sum("places").alias("places"))
        wanted = support.groupBy("pattern").agg(F.max("n").alias("n"), F.sum("places").alias("places")).where(F.col("n") >= LEAST_SEEDS)
        if tried is not None:
            wanted = wanted.join(tried, "pattern", "left_anti")
        wanted = staged(spark, wanted.select("pattern", "places"), "pii-wanted")
        if wanted.isEmpty():
            break
        tried = wanted.select("pattern") if tried is None else staged(spark, tried.union(wanted.select("pattern")), "pii-tried")
        certain = seeds.select("entity").distinct()
        good = precise(spark, docs, wanted)
        rows = looked_up(spark, docs, good, False)
        if rows is None:
            continue
        graph = rows if graph is None else graph.union(rows)
        edges = graph.select("pattern", "entity", "kind").distinct()
        # a seed of an earlier iteration has its kind
        if belief is not None:
            firm = maybe_broadcast(sure.select("entity", F.col("kind").alias("own_kind")))
            edges = edges.join(firm, "entity", "left").select("pattern", "entity", F.coalesce("kind", "own_kind").alias("kind")).distinct()
        _, belief = scored_graph(spark, edges)
        best = belief.where(F.col("belief") >= CONFIDENT).groupBy("entity").agg(F.max_by("kind", F.struct("belief", -F.col("kind"))).alias("kind"))
        sure = staged(spark, best if sure is None else sure.union(best.join(sure, "entity", "left_anti")), "pii-sure")
        new = sure.join(certain, "entity", "left_anti").select("kind", "entity")
        stands = looked_up(spark, docs, new.select(F.concat(F.lit(ENTITY), "entity").alias("pattern")), False)
        if stands is None:
            break
        more = stands.where(F.col("kind").isNull()).select("entity", F.explode("patterns").alias("pattern")).join(maybe_broadcast(new), "entity")
        more = more.groupBy("kind", "entity", "pattern").agg(F.count(F.lit(1)).alias("places"))
        seeds = staged(spark, seeds.unionByName(more), "pii-seeds")
    if sure is None or sure.isEmpty():
        return None
    placed = graph.where(F.col("kind").isNull()).drop("kind").join(maybe_broadcast(sure), "entity")
    return placed.select("doc_id", "tk", F.struct("start", "kind", "end").alias("span")).distinct()


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, tk, base (array of spans), base_sha256, all_spans for every row of ``docs`` (doc_id, text).

    Spans are (start, kind, end) in code points, end exclusive, by start, then kind. Null text is
    empty and has none; repeated rows give repeated rows; a null doc_id stays null and is searched
    like any other. Entities, patterns and scores cover all rows; a context is sought in its own line and
    in either case. An instance has at most MOST_CHARS characters, a word of a context MOST_WORD. Other columns are not read; an empty table gives none.
    """
    bounded_batches(spark)
    found = staged(spark, with_base(docs), "pii-base")
    more = discovered(spark, docs, found)
    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")
    if more is None:
        return found.select("doc_id", "tk", "base", "base_sha256", F.col("base").alias("all_spans"))
    per_doc = more.groupBy(F.col("doc_id").alias("x_id"), F.col("tk").alias("x_tk")).agg(F.collect_set("span").alias("extra"))
    per_doc = maybe_broadcast(staged(spark, per_doc, "pii-extra"))
    joined = found.join(per_doc, F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("tk") == F.col("x_tk")), "left")
    return joined.select("doc_id", "tk", "base", "base_sha256", F.array_sort(F.concat("base", F.coalesce("extra", none))).alias("all_spans"))


def report(found: DataFrame) -> DataFrame:
    """doc_id, a count for each kind of base span, base_sha256 and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *[count(k) for k in range(len(KINDS))], "base_sha256", as_text(F.col("all_spans")).alias("spans"))
