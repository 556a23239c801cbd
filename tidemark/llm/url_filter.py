"""URL filter: prefix rules first, then a character language-model ratio.

URLs that a rule decides train two smoothed variable-order Markov models, one of the
accepted and one of the rejected. A context is used as far as training has seen it and
blended with shorter ones (Witten-Bell). A URL that no rule decides is judged by the
difference of the two log-likelihoods per character, against a cut calibrated on rule-decided
URLs that did not train. All of it is joins and sums: n-grams are counted over every
row, after equal strings are summed up, and no count table leaves the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, staged

#: Longest context, symbols assumed for the uniform model under all, share (1 in n) that calibrates.
ORDER, SYMBOLS, CALIBRATES = 5, 128, 5
#: Scores are cut into bins of this width between -/+ LIMIT to find the cut.
BIN, LIMIT = 0.01, 10.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(known, pattern, 1), _UPPER, _LOWER), F.regexp_extract(known, pattern, 2)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null; ties go to the first given."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):  # later ones override
        text = F.when(rule.fits(host, path), F.lit(rule.text)).otherwise(text)
        verdict = F.when(rule.fits(host, path), F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def folded(host: Column, path: Column) -> Column:
    """What the models see: host and path, lower-cased, each run of digits as one 0, between marks."""
    return F.concat(F.lit("\x02"), F.regexp_replace(F.lower(F.concat(host, path)), "[0-9]+", "0"), F.lit("\x03"))


def _positions(strings: DataFrame, order: int) -> DataFrame:
    """A row for each character of ``s`` after the first: ctx (up to ``order`` characters before it) and c, without ``s`` itself."""
    at = strings.withColumn("i", F.explode(F.sequence(F.lit(2), F.length("s"))))
    start = f"greatest(1, i - {order})"
    return at.withColumns({"ctx": F.expr(f"substring(s, {start}, i - {start})"), "c": F.expr("substring(s, i, 1)")}).drop("s", "i")


def ratios(spark: SparkSession, training: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(ctx, c, ratio): log-likelihood of accepted minus rejected for every distinct ``wanted`` pair (ctx, c).

    ``training``: strings s with their numbers of accepted and rejected URLs, a and r.
    """
    seen = _positions(training, order).groupBy("ctx", "c").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    suffixes = F.transform(F.sequence(F.lit(0), F.length("ctx")), lambda k: F.col("ctx").substr(F.length("ctx") - k + 1, k))
    counts = (
        seen.withColumn("x", F.explode(suffixes)).groupBy("x", "c").agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
    )
    counts = staged(spark, counts, "url-ngrams")
    contexts = counts.groupBy("x").agg(
        F.sum("na").alias("ta"),
        F.sum("nr").alias("tr"),
        F.sum((F.col("na") > 0).cast("long")).alias("ka"),
        F.sum((F.col("nr") > 0).cast("long")).alias("kr"),
    )
    table = counts.join(contexts, "x")
    out = wanted.select("ctx", "c").distinct().withColumns({"pa": F.lit(1.0 / SYMBOLS), "pr": F.lit(1.0 / SYMBOLS)})
    for k in range(order + 1):
        # the last k characters before c, where there are that many; a context training has not seen changes nothing
        level = out.withColumn("x", F.when(F.length("ctx") >= k, F.expr(f"right(ctx, {k})" if k else "''")))
        own = table.where(F.length("x") == k).select("x", "c", "na", "nr")
        totals = contexts.where(F.length("x") == k)
        level = level.join(totals, "x", "left").join(own, ["x", "c"], "left")

        def blended(p: str, n: str, t: str, kinds: str) -> Column:
            total = F.col(t) + F.col(kinds)
            return F.when(total > 0, (F.coalesce(F.col(n), F.lit(0)) + F.col(kinds) * F.col(p)) / total).otherwise(F.col(p))

        out = level.select("ctx", "c", blended("pa", "na", "ta", "ka").alias("pa"), blended("pr", "nr", "tr", "kr").alias("pr"))
    return out.select("ctx", "c", (F.log("pa") - F.log("pr")).alias("ratio"))


def scores(spark: SparkSession, training: DataFrame, strings: DataFrame, order: int = ORDER) -> DataFrame:
    """(s, score) of every distinct string: mean log-likelihood difference per character."""
    keyed = strings.select("s").distinct().withColumn("key", F.md5("s"))  # a long string is not sent once for each of its characters
    at = _positions(keyed, order)
    each = at.join(ratios(spark, training, at, order), ["ctx", "c"])
    return keyed.join(each.groupBy("key").agg(F.round(F.avg("ratio"), 9).alias("score")), "key").select("s", "score")


def calibrated_cut(scored: DataFrame) -> float:
    """The cut that best balances the two classes (mean of both hit rates), from a histogram of fixed size."""
    bins = (
        scored.select(F.round(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), "score")) / BIN).cast("int").alias("bin"), "a", "r")
        .groupBy("bin")
        .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        .orderBy("bin")
        .collect()
    )
    total_a, total_r = sum(b.a for b in bins), sum(b.r for b in bins)
    if not total_a or not total_r:
        return 0.0
    best, cut, below_a, below_r = -1.0, 0.0, 0, 0
    for i, b in enumerate(bins):  # cut before this bin; of equal cuts the middle of the gap
        hit = (total_a - below_a) / total_a + below_r / total_r
        if hit > best + 1e-12:
            before = bins[i - 1].bin if i else b.bin - 1
            best, cut = hit, (before + b.bin) / 2 * BIN
        below_a, below_r = below_a + b.a, below_r + b.r
    return cut


def judge_urls(spark: SparkSession, pages: DataFrame, rules: list[Rule], order: int = ORDER) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict, score for every row.

    ``rules`` is a short list, compiled into the plan. A row that a rule fits has the rule's
    verdict; the others have the method's, ``allow`` from the cut on. A null or odd url has empty
    host and path and is judged by the method like all others. If the rules decide no URL
    of one class, scores lean on the other class alone and the cut is 0. Repeated rows
    give repeated rows; an empty table gives none.
    """
    host, path = host_and_path(pages["url"])
    base = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, decided = longest_rule(rules, F.col("host"), F.col("path"))
    base = base.withColumns({"rule": rule, "decided": decided, "s": folded(F.col("host"), F.col("path"))})
    strings = base.groupBy("s").agg(
        F.sum((F.col("decided") == "allow").cast("long")).alias("a"), F.sum((F.col("decided") == "block").cast("long")).alias("r")
    )
    strings = staged(spark, strings.select("s", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("r", F.lit(0)).alias("r")), "url-strings")
    apart = F.pmod(F.xxhash64("s"), F.lit(CALIBRATES)) == 0
    known = (F.col("a") > 0) | (F.col("r") > 0)
    scored = staged(spark, strings.join(scores(spark, strings.where(known & ~apart), strings, order), "s"), "url-scores")
    cut = calibrated_cut(scored.where(known & apart))
    judged = base.join(scored.select("s", "score"), "s", "left")
    verdict = F.coalesce("decided", F.when(F.coalesce("score", F.lit(0.0)) >= cut, F.lit("allow")).otherwise(F.lit("block")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def keep_allowed(spark: SparkSession, pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of ``pages`` with verdict ``allow``; judged by distinct url, all columns stay."""
    url, verdict = fresh(pages, "tm_url"), fresh(pages, "tm_verdict")
    distinct = pages.select(pages["url"].alias("url")).distinct().withColumn("page_id", F.col("url"))
    good = judge_urls(spark, distinct, rules).where(F.col("verdict") == "allow").select(F.col("page_id").alias(url), F.col("verdict").alias(verdict))
    return pages.join(good, pages["url"].eqNullSafe(good[url]), "left_semi")
