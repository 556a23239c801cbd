"""The hot store: append-only rows with content ids, versions of one timestamp, range scans."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.timewindow import DAY_MS, overlaps, with_window
from tidemark.functions.values import absent_if_empty, content_id, first_present, sorted_entries
from tidemark.schema import cast_value, field_columns, metric_aliases

KEY = ["org", "metric_id", "ts_ms"]


def suppress_empty(records: DataFrame, columns: list[str]) -> DataFrame:
    """Texts of length zero are absent."""
    return records.withColumns({c: absent_if_empty(F.col(c)) for c in columns})


def with_ids(records: DataFrame, values: list[str], unknown: str | None = None) -> DataFrame:
    """Adds the content id. Write time and alias are no content."""
    return records.withColumn("id", content_id(F.col("ts_ms"), [F.col(v) for v in values], F.col(unknown) if unknown else None))


def stored(good: DataFrame, write_ms: Column) -> DataFrame:
    """Good events as rows of the store, the same on every path: known values as sorted JSON, content id, window, write month.

    Nulls and texts of length zero are absent, so they are no content either.
    """
    rows = good.select("org", "metric_id", "metric_alias", "ts_ms", "known", "unknown")
    present = rows.withColumn("known", F.map_filter("known", lambda k, v: v.isNotNull() & (v != "")))
    as_json = present.withColumn("known", F.to_json(F.map_from_entries(sorted_entries(F.col("known")))))
    return store_rows(with_ids(as_json, ["known"], "unknown"), write_ms)


def decoded(rows: DataFrame, columns: list[tuple[str, str, list[str]]]) -> DataFrame:
    """Rows of the store with a column for each field in its type, in the order given; ``known`` goes.

    ``columns``: field_id, type and the names under which a row may hold it; the first that is there counts.
    """
    values = rows.withColumn("known", F.from_json("known", "map<string,string>"))
    names = lambda f, aliases: F.array(*[F.lit(n) for n in dict.fromkeys([f, *aliases])])
    fields = [cast_value(first_present(F.col("known"), names(f, aliases)), t).alias(f) for f, t, aliases in columns]
    return values.select(*[c for c in rows.columns if c != "known"], *fields)


def latest(records: DataFrame) -> DataFrame:
    """Each (org, metric, time, id) once: of what was sent again, the row that was written last."""
    rest = [c for c in records.columns if c not in (*KEY, "id")]
    newest = F.max_by(F.struct(*rest), F.struct("write_ms", *[c for c in rest if _orderable(records, c)]))
    return records.groupBy(*KEY, "id").agg(newest.alias("r")).select(*KEY, "id", "r.*").select(*records.columns)


def _orderable(df: DataFrame, column: str) -> bool:
    return column != "write_ms" and not dict(df.dtypes)[column].startswith(("map", "array<map"))


def collapse(records: DataFrame, values: list[str]) -> DataFrame:
    """One row per (org, metric, time): the set of ids and, for each value, a map from id to it.

    Versions are collected once, as rows of their id and values, and not for the ids and each value again.
    """
    once = records.groupBy(*KEY, "id").agg(*[F.min(v).alias(v) for v in values])
    versions = F.array_sort(F.collect_list(F.struct(F.col("id"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])))
    sorted_once = once.groupBy(*KEY).agg(versions.alias("versions"))
    pairs = lambda i: F.transform(F.filter("versions", lambda x: x[f"v{i}"].isNotNull()), lambda x: F.struct(x["id"], x[f"v{i}"]))
    return sorted_once.select(*KEY, F.array_compact(F.col("versions.id")).alias("ids"), *[F.map_from_entries(pairs(i)).alias(v) for i, v in enumerate(values)])


def expand(wide: DataFrame, values: list[str]) -> DataFrame:
    """The inverse: one row per id, null where an id has no value."""
    each = wide.withColumn("id", F.explode("ids"))
    return each.select(*KEY, "id", *[F.try_element_at(v, F.col("id")).alias(v) for v in values])


def conflicts(records: DataFrame, values: list[str]) -> DataFrame:
    """Ids that are stored with different values."""
    kinds = F.count_distinct(F.struct(*values)).alias("n_values")
    return records.groupBy(*KEY, "id").agg(kinds).where("n_values > 1")


def version_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(*KEY).agg(F.count_distinct("id").alias("n_versions"))


def scan(store: DataFrame, org: str, metric_id: str, start_ms: int, end_ms: int, whole_windows: bool = False) -> DataFrame:
    """A tenant's metric in [start, end): filters on partition columns first, then on time.

    ``whole_windows`` returns everything in the windows that the range touches.
    """
    touched = overlaps(F.lit(start_ms), F.lit(end_ms), F.col("window_start_ms"), F.col("window_end_ms"))
    rows = store.where((F.col("org") == org) & (F.col("metric_id") == metric_id) & touched)
    return rows if whole_windows else rows.where((F.col("ts_ms") >= start_ms) & (F.col("ts_ms") < end_ms))


def scan_by_alias(store: DataFrame, metrics: DataFrame, org: str, alias: str, start_ms: int, end_ms: int) -> DataFrame:
    """``scan`` of the metric that a tenant calls ``alias``; the first by id if several do, no rows if none does."""
    found = metric_aliases(metrics).where((F.col("org") == org) & (F.col("alias") == alias)).head()
    if found is None:
        return store.limit(0)
    return scan(store, org, found.metric_id, start_ms, end_ms)


def scan_decoded(store: DataFrame, metrics: DataFrame, fields: DataFrame, org: str, alias: str, start_ms: int, end_ms: int, user_names: bool = False) -> DataFrame:
    """``scan_by_alias`` with resends collapsed and values in their types; with ``user_names`` under the tenant's own names."""
    found = latest(scan_by_alias(store, metrics, org, alias, start_ms, end_ms))
    metric = metric_aliases(metrics).where((F.col("org") == org) & (F.col("alias") == alias)).head()
    columns = field_columns(fields, metric.metric_id, org) if metric is not None else []
    out = decoded(found, [(f, t, aliases) for f, t, _, aliases in columns])
    return out.withColumnsRenamed({f: name for f, _, name, _ in columns if name}) if user_names else out


#: Levels of dyadic blocks of days: more than milliseconds in a long can span.
LEVELS = 38


def _halved(day: Column, level: Column) -> Column:
    return F.call_function("shiftright", day, level)


def _blocks_of(start_ms: Column, end_ms: Column) -> Column:
    """The fewest dyadic blocks (level, number) of days that make up the days of a range: two a level at most."""
    first, end = F.floor(start_ms / DAY_MS), F.floor((end_ms - 1) / DAY_MS) + 1

    def at(level: Column) -> Column:
        low, high = -_halved(-first, level), _halved(end, level)
        odd = lambda n: F.pmod(n, F.lit(2)) == 1
        block = lambda n: F.struct(level.alias("level"), n.alias("number"))
        left, right = F.when((low < high) & odd(low), block(low)), F.when((low < high) & odd(high), block(high - 1))
        return F.array_compact(F.array(left, right))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))


def _blocks_above(ms: Column) -> Column:
    """The dyadic blocks that a point lies in, one a level."""
    day = F.floor(ms / DAY_MS)
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda level: F.struct(level.alias("level"), _halved(day, level).alias("number")))


def covering_windows(windows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Windows (window_start_ms, window_end_ms) that each range (range_start, range_end) touches.

    Of two ranges that overlap, one begins inside the other. So begins are looked up in ranges: a range is dealt to the few
    dyadic blocks of days that make it up, some thirty for fifty years, and a begin to the blocks above it. These are
    equi-joins whose rows are then checked; windows and ranges are never all compared.
    """
    ranges, windows = ranges.where("range_start < range_end").dropDuplicates(), windows.where("window_start_ms < window_end_ms").dropDuplicates()
    inside = ranges.withColumn("block", F.explode(_blocks_of(F.col("range_start"), F.col("range_end"))))
    begun = windows.withColumn("block", F.explode(_blocks_above(F.col("window_start_ms"))))
    later = inside.join(begun, "block").where("window_start_ms >= range_start and window_start_ms < range_end")
    around = windows.withColumn("block", F.explode(_blocks_of(F.col("window_start_ms"), F.col("window_end_ms"))))
    begins = ranges.withColumn("block", F.explode(_blocks_above(F.col("range_start"))))
    earlier = begins.join(around, "block").where("range_start > window_start_ms and range_start < window_end_ms")
    return later.drop("block").unionByName(earlier.drop("block"))


def store_rows(records: DataFrame, write_ms: Column) -> DataFrame:
    """Rows of the store: late data goes to the window of its own time, and to the month it was written in."""
    return with_window(records.withColumn("write_ms", write_ms))


#: Partitions of the store; ``run`` names the run or micro-batch that wrote the rows.
WINDOW_PARTS = ["window_start_ms", "window_end_ms", "write_year", "write_month"]
PARTS = [*WINDOW_PARTS, "run"]


#: Order of the rows of a window; the bytes of a row group, so that one tenant's rows are few of them.
CLUSTER = ["org", "metric_id", "ts_ms"]
ROW_GROUP_BYTES = 16 << 20


def append(rows: DataFrame, path: str, run: str | None = None, count: Observation | None = None) -> None:
    """Windows appear as partitions when rows for them come. A repetition of ``run`` replaces what it wrote before.

    Rows are dealt by window and write month, so a folder gets one file and not one from every task, and adaptive execution splits
    what is too large, as a window may have most of them. Files are sorted by tenant, metric and time, so that row groups and pages tell a
    ``scan`` by their least and most values, and by a Bloom filter of tenants, that they have nothing for it. ``count`` gets the ``rows`` written.
    """
    out = rows.withColumn("run", F.lit(run or uuid.uuid4().hex)).hint("rebalance", *[F.col(c) for c in WINDOW_PARTS])
    out = out.observe(count, F.count(F.lit(1)).alias("rows")) if count is not None else out  # behind the shuffle, so a task that is repeated counts once
    clustered = out.sortWithinPartitions(*WINDOW_PARTS, *[c for c in CLUSTER if c in rows.columns])
    writer = clustered.write.partitionBy(*PARTS).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.bloom.filter.enabled#org", "true").parquet(path)
