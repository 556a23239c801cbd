"""The batch job: files that the manifest lists -> archive, store and dead letters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import conform as C
from tidemark.operators import manifest as M
from tidemark.operators import versions as V
from tidemark.schema import snapshot
from tidemark.sources.files import discover, read_events


@dataclass
class BatchOptions:
    """Where a run reads and writes. ``transforms`` may change what a sink gets: archive, store, malformed."""

    manifest: str
    archive: str
    store: str
    errors: str
    run_ms: int
    readers: dict[str, Callable] = field(default_factory=dict)
    transforms: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def sent(self, sink: str, df: DataFrame) -> DataFrame:
        return self.transforms.get(sink, lambda x: x)(df)


def written(df: DataFrame, parts: list[str], count: Observation | None = None) -> DataFrameWriter:
    """A writer by partitions that a repetition replaces; a tenant with most rows is split. ``count`` gets the ``rows`` written."""
    dealt = df.hint("rebalance", *[F.col(p) for p in parts])
    dealt = dealt.observe(count, F.count(F.lit(1)).alias("rows")) if count is not None else dealt
    return dealt.write.partitionBy(*parts).mode("overwrite").option("partitionOverwriteMode", "dynamic")


def run_batch(spark: SparkSession, options: BatchOptions, metrics: DataFrame, fields: DataFrame) -> dict[str, int]:
    """Runs once over all pending files; every write must succeed, then the manifest gets its new rows.

    Every file at or below an entry is read, whatever its name. Entries that aren't there leave the pending list with their reason. No pending file is no work. The run's
    id is a partition of what it writes, so the repetition of a run that broke off replaces its rows.
    """
    listed = M.pending(M.read(spark, options.manifest))
    entries = [(r.org, r.file) for r in listed.orderBy("org", "file").collect()]  # names only, bounded by the manifest
    if not entries:
        return {"files": 0, "stored": 0, "malformed": 0, "failed_files": 0}
    found, failed = discover(spark, entries)
    events = read_events(spark, found, options.readers)
    orgs = listed.select("org")
    conformed = C.conform(events, snapshot(metrics, orgs), snapshot(fields, orgs)).persist()
    try:
        stored, bad = Observation("stored"), Observation("malformed")
        run, name = F.lit(options.run_ms), f"batch-{options.run_ms}"
        good = C.good(conformed)
        # everything that came is archived, malformed lines as well
        archived = conformed.select("org", "payload", "metric_id", "metric_alias", "ts_ms", "known", "unknown", F.col("error").isNull().alias("ok"), run.alias("run_ms"))
        written(options.sent("archive", archived), ["run_ms", "org"]).parquet(options.archive)
        V.append(options.sent("store", V.stored(good, run)), options.store, name, stored)
        letters = C.malformed(C.failed(conformed), run, F.col("payload")).withColumns({"run_ms": run, "org": F.col("apikey")})
        written(options.sent("malformed", letters), ["run_ms", "org"], bad).json(options.errors)
    finally:
        conformed.unpersist()
    done = M.actions(M.remove(listed, failed), M.DONE, run).unionByName(M.actions(failed, M.FAILED, run, F.col("message")))
    M.append(done, options.manifest)
    M.compact(spark, options.manifest)
    return {"files": len(entries), "stored": stored.get["rows"], "malformed": bad.get["rows"], "failed_files": failed.count()}
