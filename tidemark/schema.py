"""The schema registry as DataFrames, value types, and the base columns of every event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORG_KEY, METRIC_KEY, TIMESTAMP_KEY = "org", "metrictype", "timestamp"
#: Dead letters without a tenant go here.
INTERNAL = "_internal"
BASE_KEYS = (ORG_KEY, METRIC_KEY, TIMESTAMP_KEY)

REGISTRY_METRIC = (
    "org string, metric_id string, display_name string, aliases array<string>, metric_keys array<string>, "
    "ts_aliases array<string>, ts_formats array<string>"
)
REGISTRY_FIELD = "org string, metric_id string, field_id string, display_name string, aliases array<string>, type string, visible boolean"
#: Names of value types as the registry writes them, and Spark's.
TYPES: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "VARCHAR": T.StringType(),
    "BYTES": T.BinaryType(),
}
MALFORMED = "apikey string, message string, event string, handled_timestamp long"
#: The known archive: all metrics and tenants in one schema.
KNOWN_ROW = "ts_ms long, fields variant, metric_id string, org string, date date, run string"
UNKNOWN_ROW = "org string, metric_id string, ts_ms long, unknown map<string,string>"


def snapshot(registry: DataFrame, orgs: DataFrame) -> DataFrame:
    """The registry rows of the tenants of a batch."""
    return registry.join(orgs.select("org").distinct(), "org", "left_semi")


def metric_aliases(metrics: DataFrame) -> DataFrame:
    """org, alias, metric_id: every name of a metric, its display name included; ties go to the least id."""
    names = F.explode(F.array_distinct(F.concat(F.array("display_name", "metric_id"), F.coalesce("aliases", F.array().cast("array<string>")))))
    return metrics.select("org", "metric_id", names.alias("alias")).where(F.col("alias").isNotNull()).groupBy("org", "alias").agg(F.min("metric_id").alias("metric_id"))


def type_name(column: str = "type") -> Column:
    """A type as TYPES names it; nested types keep their case, as their fields have names."""
    return F.when(F.upper(column).isin(*TYPES), F.upper(column)).otherwise(F.col(column))


def field_aliases(fields: DataFrame) -> DataFrame:
    """org, metric_id, alias, field_id, type: every name of a field; base keys are never fields."""
    names = F.explode(F.array_distinct(F.concat(F.array("display_name", "field_id"), F.coalesce("aliases", F.array().cast("array<string>")))))
    exploded = fields.select("org", "metric_id", "field_id", type_name().alias("type"), names.alias("alias"))
    named = exploded.where(F.col("alias").isNotNull() & ~F.col("alias").isin(*BASE_KEYS))
    return named.groupBy("org", "metric_id", "alias").agg(F.min_by("type", "field_id").alias("type"), F.min("field_id").alias("field_id"))


def field_types(fields: DataFrame) -> DataFrame:
    """org, metric_id, types (field_id -> type): of a field that is registered with several types the first by name counts."""
    once = fields.where(F.col("field_id").isNotNull()).groupBy("org", "metric_id", "field_id").agg(F.min(type_name()).alias("type"))
    return once.groupBy("org", "metric_id").agg(F.map_from_entries(F.collect_list(F.struct("field_id", "type"))).alias("types"))


def lookup(metrics: DataFrame, fields: DataFrame) -> DataFrame:
    """org, alias -> metric_id, names (alias -> field_id), types (field_id -> type), ts_aliases, ts_formats: one row an alias."""
    names = field_aliases(fields).groupBy("org", "metric_id").agg(F.map_from_entries(F.collect_list(F.struct("alias", "field_id"))).alias("names"))
    maps = names.join(field_types(fields), ["org", "metric_id"])
    empty = F.array().cast("array<string>")
    stamps = metrics.select("org", "metric_id", F.coalesce("ts_aliases", empty).alias("ts_aliases"), F.coalesce("ts_formats", empty).alias("ts_formats"))
    none = F.create_map().cast("map<string,string>")
    joined = metric_aliases(metrics).join(stamps, ["org", "metric_id"]).join(maps, ["org", "metric_id"], "left")
    return joined.withColumns({"names": F.coalesce("names", none), "types": F.coalesce("types", none)})


def metric_keys(metrics: DataFrame) -> DataFrame:
    """org, keys: the tenant's own metric keys, sorted; the standard key comes after them."""
    own = metrics.select("org", F.explode("metric_keys").alias("k")).where(F.col("k").isNotNull())
    return own.groupBy("org").agg(F.array_sort(F.collect_set("k")).alias("keys"))


def cast_value(value: Column, type_name: str) -> Column:
    """A string as the registry's type; null if it doesn't fit.

    Besides the names in TYPES, any nested type in Spark's notation (arrays, arrays of arrays, structs) is read from JSON.
    """
    if type_name.upper() not in TYPES:
        return F.from_json(value, type_name)
    kind = TYPES[type_name.upper()]
    return value.cast(kind) if isinstance(kind, (T.StringType, T.BinaryType)) else value.try_cast(kind)


def fits(value: Column, type_name: Column) -> Column:
    """Whether a string can be read as the type that a column names; an unknown type takes any."""
    out = F.lit(True)
    for name in ("BOOLEAN", "INTEGER", "INT", "LONG", "FLOAT", "DOUBLE"):
        out = F.when(type_name == name, cast_value(value, name).isNotNull()).otherwise(out)
    return out


def _resolved(fields: DataFrame, metric_id: str, org: str | None) -> DataFrame:
    """A row for each visible field of a metric, in the registry's order: by ``position`` where it has that column, then by field_id.

    Without a tenant, and where a field is registered twice, the first type by name counts.
    """
    chosen = fields.where((F.col("metric_id") == metric_id) & F.coalesce("visible", F.lit(True)) & F.col("field_id").isNotNull())
    if org is not None:
        chosen = chosen.where(F.col("org") == org)
    position = F.min("position") if "position" in fields.columns else F.lit(None).cast("int")
    first = F.min(F.struct(type_name().alias("type"), "display_name", "aliases")).alias("r")
    return chosen.groupBy("field_id").agg(position.alias("position"), first).select("field_id", "position", "r.*").orderBy(F.asc_nulls_last("position"), "field_id")


def field_columns(fields: DataFrame, metric_id: str, org: str | None = None) -> list[tuple[str, str, str | None, list[str]]]:
    """(field_id, type, display_name, aliases) of a metric's visible fields, in order: bounded by the registry."""
    return [(r.field_id, r.type, r.display_name, list(r.aliases or [])) for r in _resolved(fields, metric_id, org).collect()]


def known_columns(fields: DataFrame, metric_id: str, org: str | None = None) -> list[tuple[str, str]]:
    """(field_id, type) of a metric's visible fields, in order: bounded by the registry."""
    return [(r.field_id, r.type) for r in _resolved(fields, metric_id, org).collect()]


def as_variant(value: Column, kind: Column) -> Column:
    """A string as a variant of the type that a column names; null if it doesn't fit. Nested types are read as JSON, other types stay text."""
    out = F.when(F.upper(kind).rlike("^(ARRAY|STRUCT|MAP)\\b"), F.try_parse_json(value)).otherwise(value.cast("variant"))
    for name in ("BOOLEAN", "INTEGER", "INT", "LONG", "FLOAT", "DOUBLE"):
        out = F.when(kind == name, cast_value(value, name).cast("variant")).otherwise(out)
    return F.when(kind == "BYTES", value.cast("binary").cast("variant")).otherwise(out)
