"""Archive ETL: distinct records, known and unknown rows, late aliases, range reads."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.timewindow import event_date
from tidemark.functions.values import sorted_entries
from tidemark.sources.folders import exists

INTERNAL_COLUMNS = ("write_ms", "id", "metric_alias", "window_start_ms", "window_end_ms", "write_year", "write_month")


def distinct_records(records: DataFrame) -> DataFrame:
    """Each record once. Maps can't be compared, so they are compared as sorted entries and rebuilt."""
    maps = [f.name for f in records.schema.fields if f.dataType.typeName() == "map"]
    plain = records.withColumns({m: sorted_entries(F.col(m)) for m in maps}) if maps else records
    once = plain.dropDuplicates()
    return once.withColumns({m: F.map_from_entries(m) for m in maps}) if maps else once


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; a column that one lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def promote_aliases(records: DataFrame, field: str, type_name: str, aliases: list[str]) -> DataFrame:
    """Fills a null field from the unknown map by the first alias that fits its type; the entry then leaves the map.

    A value that is not of the type gives null and stays in the map.
    """
    keys = F.array(*[F.lit(a) for a in aliases])
    fitting = F.filter(keys, lambda k: schema.fits(F.try_element_at("unknown", k), F.lit(type_name)) & F.try_element_at("unknown", k).isNotNull())
    hit = F.when(F.col(field).isNull(), F.try_element_at(fitting, F.lit(1)))
    with_hit = records.withColumn("promoted_by", hit)
    value = schema.cast_value(F.try_element_at("unknown", F.col("promoted_by")), type_name)
    left = F.map_filter("unknown", lambda k, v: ~k.eqNullSafe(F.col("promoted_by")))
    return with_hit.withColumns({field: F.coalesce(F.col(field), value), "unknown": left}).drop("promoted_by")


def unknown_rows(records: DataFrame) -> DataFrame:
    """org, metric_id, ts_ms, unknown of the records that have unknown entries."""
    return records.where(F.size("unknown") > 0).select("org", "metric_id", "ts_ms", "unknown", *[c for c in ("run",) if c in records.columns])


def with_date(records: DataFrame) -> DataFrame:
    return records.withColumn("date", event_date(F.col("ts_ms")))


def key_list(records: DataFrame) -> DataFrame:
    """The groups that a write makes, with their sizes: every record counts as known, with unknown entries also as unknown."""
    both = F.when(F.size("unknown") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    each = with_date(records).select("org", "metric_id", "date", F.explode(both).alias("is_unknown"))
    return each.groupBy("org", "metric_id", "date", "is_unknown").agg(F.count(F.lit(1)).alias("n"))


def without_internal(records: DataFrame) -> DataFrame:
    return records.drop(*INTERNAL_COLUMNS)


def rejoin(known: DataFrame, unknown: DataFrame) -> DataFrame:
    return known.join(unknown, ["org", "metric_id", "ts_ms"])


def unknown_value(key: str, type_name: str) -> Column:
    """An unknown field read as a type."""
    return schema.cast_value(F.try_element_at("unknown", F.lit(key)), type_name)


def rename_for_user(records: DataFrame, names: dict[str, str]) -> DataFrame:
    """Canonical columns under the names that a user gave them."""
    return records.withColumnsRenamed(names)


def between_dates(records: DataFrame, start: str, stop: str) -> DataFrame:
    """Rows dated after ``start`` and before ``stop``, both excluded."""
    return records.where((F.col("date") > F.lit(start).cast("date")) & (F.col("date") < F.lit(stop).cast("date")))


def known_rows(records: DataFrame, fields: DataFrame) -> DataFrame:
    """org, metric_id, ts_ms, fields of every record: its known values as one variant, each in the type that its tenant registered.

    One schema holds all metrics and tenants, so no metric needs a write of its own, a metric without fields keeps
    its base columns, and two tenants may register one field with different types. A value that doesn't fit its type is
    null; a field that nobody registered stays text.
    """
    types = schema.field_types(fields)
    joined = records.join(types, ["org", "metric_id"], "left").withColumn("types", F.coalesce("types", F.create_map().cast("map<string,string>")))
    kind = lambda k: F.coalesce(F.try_element_at("types", k), F.lit("STRING"))
    values = F.transform_values(F.coalesce("known", F.create_map().cast("map<string,string>")), lambda k, v: schema.as_variant(v, kind(k)))
    return joined.select("org", "metric_id", "ts_ms", F.to_variant_object(values).alias("fields"), *[c for c in ("run",) if c in records.columns])


def field(field_id: str, type_name: str, column: str = "fields") -> Column:
    """A field of known rows as a type; null if it is absent or doesn't fit."""
    known = schema.TYPES.get(type_name.upper())
    kind = known.simpleString() if known else type_name
    if re.fullmatch(r"\w+", field_id):
        return F.try_variant_get(column, f"$.{field_id}", kind)
    # a path has no way to write any name
    return F.try_variant_get(F.try_element_at(F.variant_get(column, "$", "map<string,variant>"), F.lit(field_id)), "$", kind)


def known_archive(spark: SparkSession, root: str, metric_id: str | None = None, org: str | None = None) -> DataFrame:
    """Rows of the known archive: ts_ms, fields (variant), metric_id, org, date, run. Plain names prune the listing, others the partitions."""
    path = root
    if metric_id is not None and re.fullmatch(r"[\w.-]+", metric_id):
        path = f"{root}/metric_id={metric_id}" + (f"/org={org}" if org is not None and re.fullmatch(r"[\w.-]+", org) else "")
    if not exists(spark, path):
        return spark.createDataFrame([], schema.KNOWN_ROW)
    rows = spark.read.schema(schema.KNOWN_ROW).option("basePath", root).parquet(path)
    wanted = [F.col(c) == v for c, v in (("metric_id", metric_id), ("org", org)) if v is not None]
    return rows.where(reduce(lambda a, b: a & b, wanted)) if wanted else rows


def read_known(spark: SparkSession, root: str, org: str, metric_id: str, start: str, stop: str, columns: list[tuple[str, str]] | None = None) -> DataFrame:
    """Known rows of a metric by date, oldest first, with a column for each field; it is null where a row lacks it.

    ``columns`` are the registry's (``schema.known_columns``), in its order. Without them they are the fields that the
    rows have, by name, which takes a pass over these rows.
    """
    rows = between_dates(known_archive(spark, root, metric_id, org), start, stop).drop("run")
    if columns is None:
        found = rows.agg(F.schema_of_variant_agg("fields")).first()[0] or ""
        kind = "STRUCT<" + found[len("OBJECT<") :] if found.startswith("OBJECT<") and found != "OBJECT<>" else None
        out = rows.withColumn("fields", F.variant_get("fields", "$", kind)).select("ts_ms", "fields.*", "metric_id", "org", "date") if kind else rows.drop("fields")
    else:
        out = rows.select("ts_ms", *[field(f, t).alias(f) for f, t in columns], "metric_id", "org", "date")
    return out.orderBy("ts_ms")


def read_unknown(spark: SparkSession, root: str, start: str, stop: str) -> DataFrame:
    parts = "ts_ms long, unknown map<string,string>, org string, metric_id string, date date, run string"
    return between_dates(spark.read.schema(parts).json(root), start, stop).drop("run")


def write_dated(rows: DataFrame, root: str, parts: list[str], run: str | None = None, kind: str = "parquet") -> None:
    """Writes rows by ``parts``, date and run (or the rows' column ``run``). A repetition of the run replaces what it wrote; other runs' rows stay.

    Adaptive execution splits what is too large, as one tenant's day may have most rows.
    """
    out = with_date(rows if run is None else rows.withColumn("run", F.lit(run))).hint("rebalance", *[F.col(p) for p in parts], F.col("date"))
    out.write.partitionBy(*parts, "date", "run").mode("overwrite").option("partitionOverwriteMode", "dynamic").format(kind).save(root)


def write_known(records: DataFrame, fields: DataFrame, root: str, run: str | None = None) -> None:
    """Known rows of all metrics and tenants in one write, by metric, tenant, date and run."""
    write_dated(known_rows(records, fields), root, ["metric_id", "org"], run)


def write_unknown(records: DataFrame, root: str, run: str | None = None) -> None:
    """Unknown rows as JSON by org, metric, date and run."""
    write_dated(unknown_rows(records), root, ["org", "metric_id"], run, "json")
