"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names (capitalised words) and units become typed placeholders; every window of WINDOW template
tokens of every document is hashed, in one pass over the corpus, and joined with the windows of the
benchmark's templates. A document that shares enough windows with an item is checked for slot
consistency: along an alignment, values of the item and of the document must stand for each other
one to one. So a question with other numbers is caught, and a text that only has the same shape is not.
A window that is mostly placeholders finds no document by itself; it counts where another window of the
item fits at the same alignment. Items are also read in lower case, so copies in another case are found.

Benchmark items with one template are one item on the join's small side; slots are checked for
each way in which values of its items are equal, and the best counts. The distinct hashes
are broadcast only if their size allows it (it is measured), else the join is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, maybe_broadcast, staged

#: Tokens of a window; placeholders up to which it finds a document by itself.
WINDOW, MOST_SLOTS = 8, 4
#: Words of a window that stands for an item all of whose windows have more placeholders, and of a shorter item; items with
#: fewer are found in their own words only, by hashes of another seed.
LEAST_WORDS, LITERAL = 2, 1_000
#: A document is contaminated from so many of an item's windows, or from this share of them.
LEAST_WINDOWS, LEAST_SHARE = 6, 0.5
#: Share of an item's slot values that must have a counterpart of their own.
CONSISTENT = 0.75

NAME, UNIT, NUMBER, FIRST = "\x01", "\x02", "\x03", "\x04"
SLOTS = (NAME, UNIT, NUMBER, FIRST)
UNITS = (
    "km m cm mm mi miles mile ft feet inch inches in yd yards kg g mg lb lbs pounds oz tons t l ml litres liters gallons "
    "s sec seconds min minutes h hr hours days weeks months years mph kmh kph percent pct degrees dollars euros usd eur "
    "cents w kw mw v kv hz khz mhz ghz b kb mb gb tb"
).split()
#: A capitalised word after a word, digit or comma and white space: not at a sentence's start. Then one anywhere.
_NAME = r"(?=\p{Lu})(?<=[\p{L}\p{N},;][\s\x85\p{Z}]{1,20})(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])"
_CAPITAL = r"(?<![\p{L}\p{M}\p{N}\x01-\x04])(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])"
_UNIT = r"(?<=\p{N})[\s\x85\p{Z}]{0,20}((?i:" + "|".join(UNITS) + r")(?![\p{L}\p{N}])|[%€$£°])"
_NUMBER = r"(\p{N}+(?:[.,]\p{N}+)*)"
_VALUE = r"([\x01-\x04])[^\x20]*"
#: What stands between tokens; a point or comma inside a number does not.
_BETWEEN = r"(?:[^\p{L}\p{M}\p{N}\x01-\x04.,]|(?<!\p{N})[.,]|[.,](?!\p{N}))+"


def _written(text: Column) -> Column:
    """The text with a mark before each unit and number, and a blank around them."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), "".join(SLOTS), "    ")
    out = F.regexp_replace(F.regexp_replace(plain, _UNIT, f" {UNIT}$1 "), _NUMBER, f" {NUMBER}$1 ")
    return F.when(plain.rlike(r"\p{N}"), out).otherwise(plain)


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, _BETWEEN), "")


def tokens(text: Column) -> Column:
    """Tokens as they are written, with a mark before each unit and number."""
    return _split(_written(text))


def marked(text: Column) -> Column:
    """``tokens`` with a mark before each name, and another before each capitalised word at a sentence's start too."""
    out = F.regexp_replace(_written(text), _NAME, f" {NAME}$1 ")
    return _split(F.regexp_replace(out, _CAPITAL, f" {FIRST}$1 "))


def canonical(token: Column) -> Column:
    """A placeholder for a unit, number or capitalised word; any other token in lower case."""
    first = F.substring(token, 1, 1)
    name = (token == F.initcap(token)) & (token != F.lower(token)) & (F.length(token) > 1)
    return F.when(first.isin(UNIT, NUMBER), first).when(name, F.lit(NAME)).otherwise(F.lower(token))


def window_hashes(hashes: Column, width: int, seed: int = 0) -> Column:
    """A hash for every window of ``width`` tokens, from the tokens' hashes, in order; an empty array for fewer tokens."""
    n = F.size(hashes) - width
    one = lambda i: F.xxhash64(F.lit(width + seed), *[F.get(hashes, i + k) for k in range(width)])
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), one)).otherwise(F.array().cast("array<bigint>"))


def _hashed(array: str, reading=lambda t: t) -> Column:
    return F.transform(array, lambda t: F.xxhash64(reading(t)))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id (the smallest of its template), width, n_windows, tokens, folded, raw: the distinct texts of each template.

    ``tokens`` is the template, ``folded`` the same of the lower-cased text, ``raw`` has the marked tokens.
    """
    text = benchmark["text"].cast("string")
    rows = benchmark.select(benchmark["item_id"].cast("long").alias("id"), tokens(text).alias("t"), tokens(F.lower(text)).alias("f"), marked(text).alias("raw"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("t") > 0))
    rows = rows.select("id", F.transform("t", canonical).alias("tokens"), F.transform("f", canonical).alias("folded"), "raw")
    least = F.min("id").over(Window.partitionBy("tokens"))  # rows of one template: as many as the benchmark repeats it
    width = F.least(F.lit(WINDOW), F.size("tokens"))
    rows = rows.select(least.alias("item_id"), width.alias("width"), (F.size("tokens") - width + 1).alias("n_windows"), "tokens", "folded", "raw")
    return rows.distinct()


def windows_of(items: DataFrame, widths: list[int]) -> DataFrame:
    """item_id, at, h, anchor, literal: the windows of every item in both readings; anchors find documents by themselves."""
    out = None
    placeholder = lambda t: t.isin(NAME, UNIT, NUMBER)
    for width in widths:
        for column in ("tokens", "folded"):
            own = items.where(F.col("width") == width)
            own = own.select("item_id", "raw", column, _hashed(column).alias("hs"))
            own = own.select("item_id", "raw", column, F.posexplode(window_hashes(F.col("hs"), width)).alias("at", "h"))
            # a word at a sentence's start counts as a word in a short item, where it must not change
            words = F.filter(F.slice("raw", F.col("at") + 1, F.lit(width)), lambda t: ~F.substring(t, 1, 1).isin(NAME, UNIT, NUMBER))
            slots = F.size(F.filter(F.slice(column, F.col("at") + 1, F.lit(width)), placeholder)) if width == WINDOW else width - F.size(words)
            part = own.select("item_id", "at", "h", slots.alias("slots"), F.lit(width).alias("width"), F.lit(column).alias("reading"))
            out = part if out is None else out.unionByName(part)
    least = F.min("slots").over(Window.partitionBy("item_id", "reading"))  # windows of one template
    rare = (F.col("slots") == F.col("least")) & (F.col("slots") <= F.col("width") - LEAST_WORDS)
    anchor = rare | (F.col("slots") <= MOST_SLOTS) & (F.col("width") == WINDOW)
    marked_ = out.withColumn("least", least).select("item_id", "at", "h", anchor.alias("anchor"))
    return marked_.groupBy("item_id", "at", "h").agg(F.max("anchor").alias("anchor"))


def _value(token: Column) -> Column:
    """A slot's value: a name is one wherever it stands and in either case."""
    return F.lower(F.translate(token, NAME + FIRST, ""))


def _patterns(rows: DataFrame) -> DataFrame:
    """item_id, width, pattern, raw: each way in which values of a template's texts are equal, with one text of it."""
    slots = F.transform(F.filter("raw", lambda t: F.substring(t, 1, 1).isin(*SLOTS)), _value)
    own = rows.withColumn("slots", slots).where(F.size("slots") > 0)
    own = own.withColumn("pattern", F.transform("slots", lambda t: F.array_position("slots", t)))
    own = own.groupBy("item_id", "width", "pattern").agg(F.min("raw").alias("raw"))
    return own.withColumn("pattern", F.xxhash64("pattern"))


def _identified(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), text.alias("text"))


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tk (hash of the text), item_id, n_windows, share, consistency: one row per contaminated document and item.

    ``n_windows`` of the item's windows occur in the document, which is ``share`` of them. An item
    of fewer than WINDOW tokens is one window of its whole length. An item without a window of LEAST_WORDS words is
    found in its own words only. Items with the same template are reported under the smallest item_id; consistency
    is 1 without slots. Null or empty texts and null item_ids match nothing; rows that share doc_id and text are one
    document; a null doc_id stays null. Other columns are not read; an empty table on either side gives none.
    """
    items = staged(spark, items_of(benchmark), "benchmark-items")
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # at most WINDOW values
    if not widths:
        return spark.createDataFrame([], "doc_id long, tk long, item_id long, n_windows long, share double, consistency double")
    wanted = staged(spark, windows_of(items, widths), "benchmark-windows")
    own_words = items.join(wanted.where("anchor").select("item_id").distinct(), "item_id", "left_anti")
    literal = sorted(r.width for r in own_words.select("width").distinct().collect())
    anchors = wanted.where("anchor").select("item_id", "at", "h")
    for width in literal:
        hs = F.transform("raw", lambda t: F.xxhash64(_value(t)))
        same = own_words.where(F.col("width") == width).select("item_id", hs.alias("hs"))
        anchors = anchors.union(same.select("item_id", F.posexplode(window_hashes(F.col("hs"), width, LITERAL)).alias("at", "h")).distinct())
    anchors = staged(spark, anchors, "benchmark-anchors")
    base = _identified(docs)
    written = base.select("doc_id", "tk", tokens(F.col("text")).alias("t"))
    hashed = written.select("doc_id", "tk", _hashed("t", canonical).alias("hs"), *([_hashed("t", F.lower).alias("ls")] if literal else []))
    every = [window_hashes(F.col("hs"), w) for w in widths] + [window_hashes(F.col("ls"), w, LITERAL) for w in literal]
    if len(every) == 1:
        found = hashed.select("doc_id", "tk", F.posexplode(every[0]).alias("pos", "h"))
    else:
        found = hashed.select("doc_id", "tk", F.explode(F.array(*every)).alias("w")).select("doc_id", "tk", F.posexplode("w").alias("pos", "h"))
    hits = staged(spark, found.join(maybe_broadcast(anchors.select("h").distinct()), "h", "left_semi"), "window-hits")
    matched = hits.join(maybe_broadcast(anchors), "h").select("doc_id", "tk", "item_id", "at", "pos").distinct()
    heavy = wanted.join(anchors, ["item_id", "at"], "left_anti").select("item_id", "at").distinct()
    if not heavy.isEmpty():
        matched = staged(spark, matched.union(_along(base, matched, heavy, items)).distinct(), "windows-along")
    per_item = matched.groupBy("doc_id", "tk", "item_id").agg(F.count_distinct("at").alias("n_windows"))
    sized = per_item.join(maybe_broadcast(items.select("item_id", F.col("n_windows").alias("of")).distinct()), "item_id")
    share = F.col("n_windows") / F.col("of")
    shared = sized.where((F.col("n_windows") >= LEAST_WINDOWS) | (share >= LEAST_SHARE))
    shared = staged(spark, shared.select("doc_id", "tk", "item_id", "n_windows", share.alias("share")), "window-shares")
    slotted = staged(spark, _patterns(items), "benchmark-patterns")
    checked = shared.join(maybe_broadcast(slotted.select("item_id").distinct()), "item_id", "left_semi")
    if checked.isEmpty():
        return shared.withColumn("consistency", F.lit(1.0))
    consistency = staged(spark, _consistency(base, matched, checked, slotted), "slot-consistency")
    joined = shared.alias("s").join(
        consistency.alias("c"),
        F.col("s.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("s.tk") == F.col("c.tk")) & (F.col("s.item_id") == F.col("c.item_id")),
        "left",
    )
    rated = joined.select("s.*", F.coalesce("c.consistency", F.lit(1.0)).alias("consistency"))
    return rated.where(F.col("consistency") >= CONSISTENT)


def _texts(base: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, tk, text of the documents in ``ids``."""
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.tk") == F.col("b.tk"))
    return base.alias("a").join(maybe_broadcast(ids.distinct()).alias("b"), same, "left_semi").dropDuplicates(["doc_id", "tk"])


def _along(base: DataFrame, matched: DataFrame, heavy: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, tk, item_id, at, pos: the windows that are mostly placeholders and fit where another of the item's does."""
    shifts = matched.select("doc_id", "tk", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    near = staged(base.sparkSession, shifts.join(maybe_broadcast(heavy.select("item_id").distinct()), "item_id", "left_semi"), "window-shifts")
    written = _texts(base, near.select("doc_id", "tk")).select("doc_id", "tk", F.transform(tokens(F.col("text")), canonical).alias("doc"))
    ats = heavy.groupBy("item_id").agg(F.collect_list("at").alias("ats"))  # of one item
    sides = near.join(maybe_broadcast(ats.join(items.select("item_id", "tokens", "folded").distinct(), "item_id")), "item_id")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.tk") == F.col("b.tk"))
    pairs = sides.alias("a").join(written.alias("b"), same).select("a.*", "b.doc")
    part = lambda name, at: F.slice(name, at + 1, F.lit(WINDOW))
    start = lambda at: F.greatest(at + F.col("shift"), F.lit(0))
    fits = lambda at: (at + F.col("shift") >= 0) & ((part("doc", start(at)) == part("tokens", at)) | (part("doc", start(at)) == part("folded", at)))
    kept = pairs.select("doc_id", "tk", "item_id", "shift", F.explode(F.filter("ats", fits)).alias("at"))
    return kept.select("doc_id", "tk", "item_id", "at", (F.col("at") + F.col("shift")).alias("pos"))


def _consistency(base: DataFrame, matched: DataFrame, checked: DataFrame, slotted: DataFrame) -> DataFrame:
    """doc_id, tk, item_id, consistency: of an item's values along the best alignment, the share with a counterpart of their own.

    Of items with one template, the one that fits best counts. A word at a sentence's start is no value where it stays;
    in an item shorter than a window it has to stay.
    """
    pairs = checked.select("doc_id", "tk", "item_id")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.tk") == F.col(f"{b}.tk"))
    windows = (
        matched.alias("m")
        .join(pairs.alias("p"), same("m", "p") & (F.col("m.item_id") == F.col("p.item_id")), "left_semi")
        .select("doc_id", "tk", "item_id", "at", "pos")
        .distinct()
        .join(maybe_broadcast(slotted), "item_id")
    )
    raw = _texts(base, pairs.select("doc_id", "tk")).select("doc_id", "tk", marked(F.col("text")).alias("doc_raw"))
    aligned = windows.alias("w").join(raw.alias("r"), same("w", "r"))
    steps = F.sequence(F.lit(0), F.col("width") - 1)
    each = F.transform(
        steps, lambda k: F.struct(F.get("w.raw", F.col("at") + k).alias("item_value"), F.get("r.doc_raw", F.col("pos") + k).alias("doc_value"))
    )
    values = aligned.select("w.doc_id", "w.tk", "item_id", "pattern", "width", (F.col("pos") - F.col("at")).alias("shift"), F.explode(each).alias("v"))
    values = values.withColumn("mark", F.substring("v.item_value", 1, 1)).where(F.col("mark").isin(*SLOTS))
    first = F.col("mark") == FIRST
    key = ["doc_id", "tk", "item_id", "pattern", "shift"]
    values = values.select(*key, "width", first.alias("first"), _value(F.col("v.item_value")).alias("item_value"), _value(F.col("v.doc_value")).alias("doc_value")).distinct()
    stays = F.every(F.col("first") & F.col("item_value").eqNullSafe(F.col("doc_value"))).alias("stays")
    moved = F.max(F.col("first") & (F.col("width") < WINDOW) & ~F.col("item_value").eqNullSafe(F.col("doc_value"))).alias("moved")
    by_value = values.groupBy(*key, "item_value").agg(F.count_distinct("doc_value").alias("n"), F.max("doc_value").alias("doc_value"), stays, moved)
    by_value = by_value.where(~F.col("stays"))  # a first word that stays is no name that was replaced
    others = F.count(F.lit(1)).over(Window.partitionBy(*key, "doc_value"))  # values of one item in one document
    by_value = by_value.withColumn("own", (F.col("n") == 1) & (others == 1))
    rate = F.when(F.max("moved"), 0.0).otherwise(F.avg(F.col("own").cast("double")))
    return by_value.groupBy(*key).agg(rate.alias("consistency")).groupBy("doc_id", "tk", "item_id").agg(F.max("consistency").alias("consistency"))


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay."""
    doc_id, tk = fresh(docs, "tm_doc_id"), fresh(docs, "tm_tk")
    found = contaminated(spark, docs, benchmark).select(F.col("doc_id").alias(doc_id), F.col("tk").alias(tk)).distinct()
    gone = maybe_broadcast(staged(spark, found, "contaminated"))
    own = docs["doc_id"].cast("long").eqNullSafe(gone[doc_id]) & (F.xxhash64(docs["text"].cast("string")) == gone[tk])
    return docs.join(gone, own, "left_anti")
