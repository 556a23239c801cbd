"""Stream ingest: archive raw payloads first, then conform, store and put aside what is bad."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators import conform as C
from tidemark.operators import manifest as M
from tidemark.operators import versions as V
from tidemark.sources import folders
from tidemark.sources.requests import accepted_events, concatenated_events
from tidemark.streaming import keyed

PARSED = "org string, metric_id string, metric_alias string, ts_ms long, known map<string,string>, unknown map<string,string>"
COUNTERS = "handled long, empty long, stored long, failed long, uncommitted long"


@dataclass
class StreamSinks:
    """Folders of the sinks. ``transforms`` may change what one gets: raw, parsed, store, malformed, commit_errors.

    ``store`` may be the batch job's. ``counters``: a row for each micro-batch with what it handled, stored and put aside.
    ``state``: the checkpoint of ``store_versions``; if it is given, rows reach the store through that query only.
    """

    raw: str
    parsed: str
    store: str
    malformed: str
    commit_errors: str
    checkpoint: str
    counters: str | None = None
    state: str | None = None
    transforms: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def sent(self, sink: str, df: DataFrame) -> DataFrame:
        return self.transforms.get(sink, lambda x: x)(df)


def process(batch: DataFrame, metrics: DataFrame, fields: DataFrame, requests: bool = False) -> DataFrame:
    """Payload rows (org, payload) as conformed events; broken payloads keep their text and get a reason.

    ``requests``: each payload is a request with its own customer key and one or several events, within the request limits.
    """
    return C.conform(accepted_events(batch) if requests else concatenated_events(batch), metrics, fields)


#: Halvings after which a piece that fails is put aside if no piece was stored yet: then the store is away, not a row bad.
GIVE_UP = 3
#: Halvings after which a piece that fails is put aside in any case.
MOST_HALVINGS = 40


def commit(rows: DataFrame, put: Callable[[DataFrame, str], None], run: str) -> list[tuple[DataFrame, str]]:
    """Stores ``rows`` by ``put(rows, run)``, which writes all it gets or fails; what can't be stored comes back, with the reasons.

    If all can't be stored at once, they are halved by content again and again, until what fails has one
    content: a bad row costs a write or two a halving, and all others are stored, in runs named after ``run``.
    """
    try:
        put(rows, run)
        return []
    except Exception as error:  # the reason is kept with the rows
        whole = str(error)
    rows = rows.persist()  # read for every piece; the caller lets go of it
    place, content = F.xxhash64(*V.KEY, "id"), F.struct(*V.KEY, "id")
    failed: list[tuple[DataFrame, str]] = []
    stored, todo = 0, [(0, 0, whole)]
    while todo:
        depth, value, reason = todo.pop()
        piece = rows.where(place.bitwiseAND(F.lit((1 << depth) - 1)) == value)
        least, most = piece.agg(F.min(content), F.max(content)).first()
        if least == most or depth >= MOST_HALVINGS or (depth >= GIVE_UP and not stored):
            failed.append((piece, reason))
            continue
        good = False
        for half in (value, value | 1 << depth):
            if good:  # then what fails is in the other half
                todo.append((depth + 1, half, reason))
                continue
            part = piece.where(place.bitwiseAND(F.lit((2 << depth) - 1)) == half)
            try:
                put(part, f"{run}.{depth + 1}.{half}")
                good = True
                stored += 1
            except Exception as error:
                todo.append((depth + 1, half, str(error)))
    return failed


def store_rows(rows: DataFrame, sinks: StreamSinks, run: str, put_aside: Callable[[DataFrame], None]) -> tuple[int, int]:
    """Commits rows to the store, those that can't be to ``put_aside`` with their reason; how many of each.

    Pieces of an attempt that broke off are known by a sign beside the commit errors and are removed first.
    """
    spark, sign = rows.sparkSession, f"{sinks.commit_errors}/_pieces/{run}"
    if folders.exists(spark, sign):
        folders.remove(spark, folders.matching(spark, f"{sinks.store}/*/*/*/*/run={run}.*"))
    counts: list[Observation] = []

    def put(part: DataFrame, name: str) -> None:
        if name != run and not folders.exists(spark, sign):
            folders.mark(spark, sign)
        count = Observation()
        V.append(sinks.sent("store", part), sinks.store, name, count)
        counts.append(count)

    lost = Observation()
    try:
        failed = commit(rows, put, run)
        if failed:
            pieces = [piece.withColumn("reason", F.lit(reason[:500])) for piece, reason in failed]
            every = pieces[0]
            for piece in pieces[1:]:
                every = every.unionByName(piece)
            put_aside(every.observe(lost, F.count(F.lit(1)).alias("rows")))
    finally:
        rows.unpersist()
    return sum(c.get["rows"] for c in counts), lost.get["rows"] if failed else 0


def write_batch(
    batch: DataFrame, number: int, sinks: StreamSinks, metrics: DataFrame, fields: DataFrame, write_ms: Column, source: str, requests: bool = False
) -> None:
    """One micro-batch of the query ``source``. What it writes is named by both and is replaced on a repetition.

    Raw payloads are archived before they are parsed, malformed ones as well. Good rows that the store
    can't take go to the commit-error sink, all others are stored, and the stream goes on. Counters come from the writes.
    """
    name = f"source={source}/batch={number}"

    def put(sink: str, df: DataFrame) -> None:
        sinks.sent(sink, df).write.mode("overwrite").parquet(f"{getattr(sinks, sink)}/{name}")

    came, bad = Observation("came"), Observation("bad")
    batch = batch.persist()
    conformed = process(batch, metrics, fields, requests).persist()
    try:
        put("raw", batch.observe(came, F.count(F.lit(1)).alias("handled"), F.count_if(F.length(F.trim("payload")) == 0).alias("empty")))
        good = C.good(conformed)
        put("parsed", good.select("org", "metric_id", "metric_alias", "ts_ms", "known", "unknown").hint("rebalance", F.col("org")))
        stored, uncommitted = (0, 0) if sinks.state else store_rows(V.stored(good, write_ms), sinks, f"{source}-{number}", lambda rows: put("commit_errors", rows))
        letters = C.malformed(C.failed(conformed), write_ms, F.col("payload")).observe(bad, F.count(F.lit(1)).alias("rows"))
        sinks.sent("malformed", letters).write.mode("overwrite").json(f"{sinks.malformed}/{name}")
        if sinks.counters:
            row = (came.get["handled"], came.get["empty"], stored, bad.get["rows"], uncommitted)
            batch.sparkSession.createDataFrame([row], COUNTERS).coalesce(1).write.mode("overwrite").parquet(f"{sinks.counters}/{name}")
    finally:
        conformed.unpersist()
        batch.unpersist()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query has as long as its checkpoint: a new checkpoint is a new query."""
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).select(F.get_json_object("value", "$.id").alias("id"))
    return text.first().id


def ingest(stream: DataFrame, sinks: StreamSinks, metrics: DataFrame, fields: DataFrame, write_ms: Column | None = None, requests: bool = False) -> StreamingQuery:
    """Starts the query over a stream of (org, payload); it ends when what is there has been read."""
    now = F.unix_millis(F.current_timestamp()) if write_ms is None else write_ms
    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, sinks, metrics, fields, now, query_id(batch.sparkSession, sinks.checkpoint), requests)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", sinks.checkpoint).trigger(availableNow=True).start()


def store_versions(spark: SparkSession, sinks: StreamSinks, write_ms: Column | None = None, files_per_trigger: int = 1_000) -> StreamingQuery:
    """Starts the query that brings parsed rows to the store through the state of their keys (``keyed``); it ends when what is there has been read.

    New content is stored, what was sent again is not, and content that contradicts what its id stands for is a dead letter.
    """
    now = F.unix_millis(F.current_timestamp()) if write_ms is None else write_ms
    parsed = spark.readStream.schema(PARSED).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger).parquet(sinks.parsed)

    def write(batch: DataFrame, number: int) -> None:
        source = query_id(batch.sparkSession, sinks.state)
        name = f"source={source}/batch={number}"
        batch = batch.persist()
        try:
            put_aside = lambda rows: sinks.sent("commit_errors", rows).write.mode("overwrite").parquet(f"{sinks.commit_errors}/{name}")
            store_rows(keyed.accepted(batch), sinks, f"{source}-{number}", put_aside)
            sinks.sent("malformed", keyed.refused(batch, now)).write.mode("overwrite").json(f"{sinks.malformed}/{name}")
        finally:
            batch.unpersist()

    return keyed.started(keyed.versioned(V.stored(parsed, now)).writeStream.foreachBatch(write).option("checkpointLocation", sinks.state).trigger(availableNow=True), spark)


def counts(spark: SparkSession, sinks: StreamSinks) -> dict[str, int]:
    """What all micro-batches handled, stored and put aside."""
    sums = counter_rows(spark, sinks).agg(*[F.sum(c).alias(c) for c in ("handled", "empty", "stored", "failed", "uncommitted")]).first().asDict()
    lost = sums.pop("uncommitted")
    return sums | {"events": sums["stored"] + sums["failed"] + lost}


def counter_rows(spark: SparkSession, sinks: StreamSinks) -> DataFrame:
    """The counters of each micro-batch: handled, empty, stored, failed, uncommitted (good, but not taken by the store)."""
    return spark.read.option("recursiveFileLookup", True).schema(COUNTERS).parquet(sinks.counters)


def without_resends(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drops resent content within ``delay`` of its arrival.

    The watermark is on arrival, never on data time, so late data passes. What comes again later than that
    is stored twice and is one row again when it is read (``versions.latest``).
    """
    arrived = stream.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", delay)
    return arrived.dropDuplicatesWithinWatermark([*V.KEY, "id"]).drop("arrived")


def read_payloads(spark: SparkSession, path: str, files_per_trigger: int = 1_000, archive: str | None = None) -> DataFrame:
    """A stream of (org, payload) from Parquet files as they come.

    ``archive``: files that have been read move there, a micro-batch after the one that read them is committed, so the last
    ones stay until more come. It must not lie in ``path``.
    """
    reader = spark.readStream.schema("org string, payload string").option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)


def track_uploads(notifications: DataFrame, manifest: str, checkpoint: str) -> StreamingQuery:
    """Adds the files of upload notifications (org, file) to the manifest, once a batch and only if there are any."""

    def add(batch: DataFrame, number: int) -> None:
        files = batch.select("org", "file").dropna().distinct()
        if not files.isEmpty():
            M.append(M.actions(files, M.PENDING, F.lit(number)), manifest)

    return notifications.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
