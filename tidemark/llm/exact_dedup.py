"""Exact deduplication by a stateful stream.

The rows' digests run through a Structured Streaming aggregation whose keyed state
lives on disk (RocksDB), has no watermark and never expires. Per digest it retains
the stable identifier and the content locator (file and row) of the row that stays,
and how many rows hit it. Then every hit is checked against the full bytes of the
retained content, found by its locator; rows whose bytes differ in spite of an equal
digest form groups of their own, by their whole text.

With a state folder the state outlives the run: the next run reads its new documents alone, and a
row whose text an earlier run has seen is a copy of the row that stayed then.

The state is partitioned by digest and partially aggregated before the shuffle, so a
text with a third of all copies costs one state row. In the check, copies of a hot
digest are dealt over many tasks and the retained text is sent to each.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, maybe_broadcast, scratch_dir, squeezed, staged
from tidemark.sources import folders

#: Copies of one digest that one task compares with the retained text.
COPIES_PER_TASK = 100
#: Files of staged digests that one micro-batch reads.
FILES_PER_TRIGGER = 1_000

#: State stores: one for so many rows of staged digests, but no more than MOST_STORES; if a state folder has come to need
#: GROWTH times as many as it has, its digests are streamed once more into a new state.
ROWS_PER_STORE, MOST_STORES, GROWTH = 20_000, 2_000, 4

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no log space is reserved ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """What texts are compared by: null as empty, each run of ASCII white space as one space."""
    return squeezed(F.coalesce(text.cast("string"), F.lit("")))


def full_digest(sha: Column) -> Column:
    return F.unhex(sha)


def is_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` is a file scan as it stands, so that each row has a file and a row number of its own."""
    plain = docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    return plain and "_metadata" not in {c.lower() for c in docs.columns}


#: Names in what is written because it is no file scan.
_ID, _TEXT = "tm_doc_id", "tm_text"


def located(spark: SparkSession, docs: DataFrame, doc_id: str, text: str, folder: str) -> DataFrame:
    """doc_id, normalised text, its SHA-256 and the locator of each row: its file and its row there.

    What is no file scan is first written to ``folder``.
    """
    if not is_scan(docs):
        base = docs.select(docs[doc_id].cast("long").alias(_ID), docs[text].cast("string").alias(_TEXT))
        base.write.parquet(folder)
        docs, doc_id, text = spark.read.schema(base.schema).parquet(folder), _ID, _TEXT
    plain = normalised(docs[text])
    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        plain.alias("text"),
        F.sha2(plain, 256).alias("sha"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def _place() -> Column:
    """What the row that stays has least of: run, then doc_id with a null one last, then file and row; and its column of text."""
    return F.struct("run", F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row", "text_column")


def retained_state(spark: SparkSession, folder: str, run: int, schema, files_per_trigger: int) -> DataFrame | None:
    """Stream the digests under ``folder`` that are new through its keyed state: digest, keep (locator of the row that stays), hits.

    Only the digests of this run come back, with the hits of all runs; none if there was no input.
    """
    digests, updates = f"{folder}/digests", f"{folder}/updates/run-{run}"
    every = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(digests)
    # a session of its own: other queries, and another call at the same time, don't see these settings
    own, stores = spark.newSession(), stores_of(spark, folder, every.count())
    for k, v in (ROCKSDB | {"spark.sql.shuffle.partitions": str(stores)}).items():
        own.conf.set(k, v)
    stream = (
        own.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(digests)
        .groupBy("digest")
        .agg(F.min(_place()).alias("keep"), F.count(F.lit(1)).alias("hits"))
    )
    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint-{stores}")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{updates}/batch-{i}"))
        .start()
    )
    query.awaitTermination()
    if not query.lastProgress:  # no input: no batch ran
        return None
    written = spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(updates)
    # a digest may have been updated by several batches; its last state has the smallest locator and the most hits
    return written.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("hits").alias("hits"))


def stores_of(spark: SparkSession, folder: str, rows: int) -> int:
    """How many stores the state has; its checkpoint is named by them. A number that has no checkpoint yet begins a new state, from all digests."""
    has = [int(path.rpartition("-")[2]) for path in folders.subfolders(spark, folder) if path.rpartition("/")[2].startswith("checkpoint-")]
    wanted = min(MOST_STORES, max(1, -(-rows // ROWS_PER_STORE)))
    return wanted if not has or wanted >= GROWTH * max(has) else max(has)


def exact_dedup(
    spark: SparkSession,
    docs: DataFrame,
    digest: Callable[[Column], Column] = full_digest,
    files_per_trigger: int = FILES_PER_TRIGGER,
    doc_id: str = "doc_id",
    text: str = "text",
    state_dir: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, file, row, sha, keep_id, group_size, kept.

    Of rows with equal normalised text the one with the smallest doc_id stays; among rows
    that share this doc_id, the first by file and row. A null doc_id comes after all others,
    null text counts as empty, an empty table gives no rows, other columns are not read.
    ``digest`` makes the state's key from the SHA-256; a weak one only costs more byte checks.

    ``state_dir``: a shared folder that keeps the state. A later call with it takes ``docs`` as new documents: copies
    of what earlier calls saw are not kept, keep_id names the row that stayed then, group_size counts the rows of all
    calls. The files of earlier calls must still be there, as hits are checked against their bytes; calls with one
    folder go one after the other. Of different texts with one digest a later call knows the retained one alone.
    """
    folder = state_dir.rstrip("/") if state_dir else scratch_dir(spark, "exact-state")
    run = max(run_numbers(spark, folder), default=-1) + 1 if state_dir else 0
    source = located(spark, docs, doc_id, text, f"{folder}/source/run-{run}")
    text_column = text if is_scan(docs) else _TEXT
    keyed = source.withColumn("digest", digest(F.col("sha"))).withColumns({"run": F.lit(run), "text_column": F.lit(text_column)})
    slim = keyed.drop("text")
    slim.write.parquet(f"{folder}/digests/run-{run}")
    rows = spark.read.schema(slim.schema).parquet(f"{folder}/digests/run-{run}")
    state = retained_state(spark, folder, run, slim.schema, files_per_trigger)
    if state is None:
        return spark.createDataFrame([], "doc_id long, file string, row long, sha string, keep_id long, group_size long, kept boolean")
    several = staged(spark, state.where("hits > 1"), "exact-several")
    differing = _differing(spark, keyed, several, run)

    found = rows.join(maybe_broadcast(several), "digest", "left").withColumns({"keep": F.coalesce("keep", _place()), "hits": F.coalesce("hits", F.lit(1))})
    if differing is not None:
        # hits that are none after all: groups of their own by digest and whole text
        own = differing.groupBy("digest", "text").agg(F.min(_place()).alias("own_keep"), F.count(F.lit(1)).alias("own_hits"))
        per_row = differing.join(own, ["digest", "text"]).select("file", "row", "own_keep", "own_hits")
        fewer = differing.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
        found = (
            found.join(fewer, "digest", "left")
            .join(per_row, ["file", "row"], "left")
            .withColumn("hits", F.coalesce("own_hits", F.col("hits") - F.coalesce("less", F.lit(0))))
            .withColumn("keep", F.coalesce("own_keep", "keep"))
        )
    stays = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row")) & (F.col("keep.run") == run)
    return found.select("doc_id", "file", "row", "sha", F.col("keep.doc_id").alias("keep_id"), F.col("hits").alias("group_size"), stays.alias("kept"))


def run_numbers(spark: SparkSession, folder: str) -> list[int]:
    """The runs that a state folder has seen."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/digests")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [int(f.getPath().getName().removeprefix("run-")) for f in files.listStatus(path)] if files.exists(path) else []


def _earlier(spark: SparkSession, several: DataFrame, run: int) -> DataFrame | None:
    """digest, keep, hits, text, file, row: the contents that earlier runs retained, read from their files."""
    old = several.where(F.col("keep.run") < run)
    files = old.select("keep.file", "keep.text_column").distinct().collect()  # files of earlier runs, not documents
    out = None
    for column in sorted({f.text_column for f in files}):
        there = spark.read.parquet(*[unquote(f.file) for f in files if f.text_column == column])  # locators are encoded
        there = there.select(normalised(there[column]).alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        own = maybe_broadcast(old.where(F.col("keep.text_column") == column))
        own = there.join(own, (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row")))
        out = own if out is None else out.unionByName(own)
    return out


def _differing(spark: SparkSession, keyed: DataFrame, several: DataFrame, run: int) -> DataFrame | None:
    """Rows whose bytes differ from the retained content of their digest; None if there are none.

    One shuffle, of the rows that hit: the retained row goes to every share of its digest's
    copies and comes first there.
    """
    names = ["digest", "doc_id", "run", "file", "row", "text_column", "text"]
    is_keep = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row")) & (F.col("keep.run") == F.col("run"))
    hit = keyed.join(maybe_broadcast(several), "digest").withColumn("is_keep", is_keep).select(*names, "hits", "is_keep")
    if run and (old := _earlier(spark, several, run)) is not None:
        hit = hit.unionByName(old.select("digest", "keep.doc_id", "keep.run", "file", "row", "keep.text_column", "text", "hits", F.lit(True).alias("is_keep")))
    shares = F.ceil(F.col("hits") / COPIES_PER_TASK).cast("int")
    share = F.when(F.col("is_keep"), F.sequence(F.lit(0), shares - 1)).otherwise(F.array(F.pmod(F.xxhash64("file", "row"), shares).cast("int")))
    dealt = hit.withColumn("share", F.explode(share))
    first = Window.partitionBy("digest", "share").orderBy(F.col("is_keep").desc())
    retained = F.first("text").over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    unequal = dealt.withColumn("retained", retained).where(~F.col("is_keep") & (F.col("text") != F.col("retained"))).select(*names)
    differing = staged(spark, unequal, "exact-differing")
    return None if differing.isEmpty() else differing


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops; all its columns stay."""
    names, inner = docs.columns, dict(zip(docs.columns, docs.columns))
    if not is_scan(docs):  # under names of its own, as any may clash with the reader's
        inner = {c: f"tm_{i}" for i, c in enumerate(names)}
        renamed, path = docs.toDF(*inner.values()), scratch_dir(spark, "exact-docs")
        renamed.write.parquet(path)
        docs = spark.read.schema(renamed.schema).parquet(path)
    dropped = exact_dedup(spark, docs, doc_id=inner["doc_id"], text=inner["text"]).where(~F.col("kept"))
    file, row = fresh(docs, "tm_file"), fresh(docs, "tm_row")
    gone = staged(spark, dropped.select(F.col("file").alias(file), F.col("row").alias(row)), "exact-gone")
    keyed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return keyed.join(maybe_broadcast(gone), [file, row], "left_anti").select(*[F.col(f"`{inner[c]}`").alias(c) for c in names])
