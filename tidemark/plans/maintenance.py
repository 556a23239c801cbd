"""Retention, window listing, compaction and archiving of inputs."""

from __future__ import annotations

import math
import random
import statistics
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import WINDOW_PARTS as PARTS
from tidemark.operators.versions import append, latest
from tidemark.sources import folders
from tidemark.sources.files import literal, plain_location
from tidemark.sources.folders import remove

WEEK_DAYS = 7


def managed_windows(store: DataFrame) -> DataFrame:
    """The store's windows in order: read from partition names alone."""
    return store.select(*PARTS).distinct().orderBy("window_start_ms", "write_year", "write_month")


def expired(windows: DataFrame, today: Column, limit_days: int) -> DataFrame:
    """Windows whose write month ended more than the limit ago; the limit is a week at least."""
    last = F.last_day(F.make_date("write_year", "write_month", F.lit(1)))
    return windows.where(last < F.date_sub(today, max(limit_days, WEEK_DAYS)))


def retain(spark: SparkSession, path: str, today: Column, limit_days: int, dry_run: bool = True) -> list[str]:
    """Folders of expired windows; they are removed only if ``dry_run`` is off."""
    gone = expired(managed_windows(spark.read.parquet(path)), today, limit_days).collect()  # partition names only
    folders = [path + "/" + "/".join(f"{p}={r[p]}" for p in PARTS) for r in gone]
    if not dry_run:
        remove(spark, folders)
    return folders


def compact(spark: SparkSession, path: str, condition: Column) -> int:
    """Rewrites the windows and write months that match, many runs' files as few; how many run folders went.

    The new files are written first, then the old folders go. What breaks off in between leaves rows twice, which are
    one again when they are read (``versions.latest``), until the next compaction.
    """
    rows = spark.read.parquet(path).where(condition)
    old = rows.select(*PARTS, "run").distinct().collect()  # partition names only
    if not old:
        return 0
    append(latest(rows.drop("run")) if "id" in rows.columns else rows.drop("run"), path)
    remove(spark, [f"{path}/" + "/".join(f"{p}={r[p]}" for p in [*PARTS, "run"]) for r in old])
    return len(old)


#: Files below half of this are small; the files of a compaction have about this size.
FILE_BYTES = 128 << 20


def small_files(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> list[str]:
    """Files of a store that can be made fewer: those below half of ``file_bytes`` of each window and write month that has several. From the listing alone."""
    by_part: dict[str, list[str]] = {}
    for file, _, size in folders.files(spark, path) or []:
        name = file.rpartition("/")[2]
        if size < file_bytes // 2 and not name.startswith(("_", ".")) and "/_" not in file[len(path) :]:
            by_part.setdefault(file.rpartition("/run=")[0], []).append(file)
    return sorted(f for part in by_part.values() if len(part) > 1 for f in part)


def compact_small(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> int:
    """Makes small files fewer; large ones are neither read nor written. How many files went.

    Files of about ``file_bytes`` are made by adaptive execution from what the small ones hold, resends among them collapsed.
    They are written first, then the small ones go; what breaks off in between leaves rows twice, which are one again
    when they are read, until the next compaction.
    """
    found = small_files(spark, path, file_bytes)
    if not found:
        return 0
    rows = spark.read.option("basePath", path).parquet(*[literal(f) for f in found]).drop("run")
    name, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(name, str(file_bytes))
    try:
        append(latest(rows) if "id" in rows.columns else rows, path)
    finally:
        spark.conf.set(name, before)
    remove(spark, found)
    return len(found)


def run_maintenance(spark: SparkSession, path: str, today: Column, limit_days: int, dry_run: bool = True) -> dict[str, int]:
    """The regular job on a store: expired windows go, then windows of earlier months that several runs wrote become few files."""
    expired_folders = retain(spark, path, today, limit_days, dry_run)
    store = spark.read.parquet(path)
    months = F.make_date("write_year", "write_month", F.lit(1)) < F.trunc(today, "month")
    split = store.where(months).select(*PARTS, "run").distinct().groupBy("window_start_ms").count().where("count > 1").collect()
    starts = [r.window_start_ms for r in split]
    return {"expired": len(expired_folders), "compacted": 0 if dry_run or not starts else compact(spark, path, months & F.col("window_start_ms").isin(starts))}


def archive_inputs(spark: SparkSession, files: list[str], root: str, run_ms: int) -> list[str]:
    """Moves processed input files to ``root/run_ms/`` after a run; their paths below the file system's root stay."""
    moved = []
    for file in files:
        moved.append(f"{root}/{run_ms}{spark._jvm.org.apache.hadoop.fs.Path(file).toUri().getPath()}")
        folders.move(spark, file, moved[-1])
    return moved


@dataclass(frozen=True)
class Estimate:
    """A number of rows and the interval that holds the true one with the confidence asked for; exact if all three are equal."""

    rows: int
    least: int
    most: int


def estimated_count(df: DataFrame, files: int = 30, confidence: float = 0.95, seed: int = 0) -> Estimate:
    """About how many rows there are, from a sample of the files that ``df`` (a scan and what filters it) reads: for debugging.

    Only the files drawn are read, by a filter on their names, and only the columns that the plan's filters need; without
    filters these are Parquet's footers. The interval comes from how the files' counts differ. What reads few files, or none, is counted.
    """
    names = sorted(df.inputFiles())
    if len(names) <= files:
        n = df.count()
        return Estimate(n, n, n)
    drawn = random.Random(seed).sample(names, files)
    paths = [path for name in drawn for path in {name, plain_location(name)}]
    per_file = df.where(F.col("_metadata.file_path").isin(paths)).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()  # one row a file drawn
    counts = [r["count"] for r in per_file] + [0] * (files - len(per_file))
    mean, share = statistics.fmean(counts), 1 - files / len(names)
    spread = statistics.NormalDist().inv_cdf((1 + confidence) / 2) * statistics.stdev(counts) * math.sqrt(share / files)
    return Estimate(round(mean * len(names)), max(sum(counts), math.floor((mean - spread) * len(names))), math.ceil((mean + spread) * len(names)))


def approximate_count(df: DataFrame, files: int = 30, confidence: float = 0.95) -> int:
    """The number of ``estimated_count``."""
    return estimated_count(df, files, confidence).rows
