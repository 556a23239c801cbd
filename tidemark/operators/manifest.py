"""The file manifest as a table of actions (org, file, status, message, seq).

``status`` is pending, done or failed. The state of a file is its newest action; of actions of one ``seq`` done counts
before failed and failed before pending. Failed files leave the pending list as well.

Stored, it is a snapshot and the actions since: each ``append`` is a folder of the log, and ``compact`` makes a new
snapshot of the newest action of every file and all failures, after which the folders it holds go. So a run reads
one snapshot and a short log. An action that is in both, as while folders go, counts once.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import folders

SCHEMA = "org string, file string, status string, message string, seq long"
PENDING, DONE, FAILED = "pending", "done", "failed"


def actions(files: DataFrame, status: str, seq: Column, message: Column | None = None) -> DataFrame:
    text = message if message is not None else F.lit(None)
    return files.select("org", "file", F.lit(status).alias("status"), text.cast("string").alias("message"), seq.cast("long").alias("seq"))


def state(manifest: DataFrame) -> DataFrame:
    """org, file, status: the newest action of every file."""
    return manifest.groupBy("org", "file").agg(F.max_by("status", _age()).alias("status"))


def _age() -> Column:
    rank = F.when(F.col("status") == DONE, 2).when(F.col("status") == FAILED, 1).otherwise(0)
    return F.struct("seq", rank)


def pending(manifest: DataFrame) -> DataFrame:
    return state(manifest).where(F.col("status") == PENDING).select("org", "file")


def remove(files: DataFrame, finished: DataFrame) -> DataFrame:
    """Files that are not finished; finished ones that were never listed don't matter."""
    return files.join(finished.select("org", "file").distinct(), ["org", "file"], "left_anti")


def merged(manifest: DataFrame) -> DataFrame:
    """org, files (set), errors (file -> messages in order): a tenant's manifest as one row, for reports on small ones."""
    files = pending(manifest).groupBy("org").agg(F.array_sort(F.collect_set("file")).alias("files"))
    failed = manifest.where(F.col("status") == FAILED).dropDuplicates()
    per_file = failed.groupBy("org", "file").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "message"))), lambda x: x["message"]).alias("messages"))
    errors = per_file.groupBy("org").agg(F.map_from_entries(F.collect_list(F.struct("file", "messages"))).alias("errors"))
    return files.join(errors, "org", "full_outer")


def failures(manifest: DataFrame) -> DataFrame:
    """org, file, message for every failure."""
    return manifest.where(F.col("status") == FAILED).dropDuplicates().select("org", "file", "message")


#: Folders of the log from which on a run makes a new snapshot.
MOST_LOG = 50


def read(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's actions: the newest snapshot's and those since; none where nothing was listed yet."""
    found = [*folders.subfolders(spark, f"{path}/snapshots")[-1:], *folders.subfolders(spark, f"{path}/log")]
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*found)


def append(rows: DataFrame, path: str) -> None:
    """Adds actions, all of them or none."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/log/_{name}")
    folders.move(rows.sparkSession, f"{path}/log/_{name}", f"{path}/log/{name}")


def settled(manifest: DataFrame) -> DataFrame:
    """The actions that decide the state and the failures: the newest of every file, and every failure once."""
    newest = manifest.groupBy("org", "file").agg(F.max_by(F.struct("status", "message", "seq"), _age()).alias("a")).select("org", "file", "a.*")
    return newest.where(F.col("status") != FAILED).unionByName(manifest.where(F.col("status") == FAILED).dropDuplicates())


def compact(spark: SparkSession, path: str, most: int = MOST_LOG) -> int:
    """A new snapshot if the log has at least ``most`` folders; how many of them went into it.

    The snapshot appears by a rename before what it holds is removed. The snapshot before it stays for readers that have begun; older ones go.
    """
    held = folders.subfolders(spark, f"{path}/log")
    if len(held) < most or not held:
        return 0
    before = folders.subfolders(spark, f"{path}/snapshots")
    name = f"{time.time_ns():020d}"
    settled(spark.read.schema(SCHEMA).parquet(*before[-1:], *held)).write.parquet(f"{path}/snapshots/_{name}")
    folders.move(spark, f"{path}/snapshots/_{name}", f"{path}/snapshots/{name}")
    folders.remove(spark, [*held, *before[:-1]])
    return len(held)
