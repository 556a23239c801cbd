"""Conform raw events: tenant, metric, time, known and unknown fields, or the reason why not.

One plan for all tenants and metrics: the registry is one row per metric alias and is joined
once; fields stay in maps until a metric's columns are projected. An error is a value
of the row, so one pass yields both the events and the dead letters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators.gates import MOST_EVENT_BYTES, event_fits, has_tenant, longest_json
from tidemark.functions.values import first_present, first_present_key, parse_millis, stamp_tenant

#: Bytes of the registry's lookup up to which it is broadcast; they are measured first.
BROADCAST_BYTES = 8 << 20


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is known to be small, else for a shuffled join."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def conform(events: DataFrame, metrics: DataFrame, fields: DataFrame) -> DataFrame:
    """``events`` (org, fields map, other columns pass) with metric_alias, metric_id, ts_ms, known, types, unknown, error.

    A column ``rejected`` (a gate's reason, or null) is taken for an error, and an event of more bytes than the limit is one;
    its ``payload``, if there is one, tells at once for most.

    The envelope's org wins over one in the event. ``error`` is null, or struct(key, message) for a
    missing tenant, metric key, metric, time, or a value that is not of its type. The first applies.
    """
    events = events.withColumn("rejected", F.coalesce(F.col("rejected") if "rejected" in events.columns else F.lit(None).cast("string"), too_large(events)))
    keys = small(schema.metric_keys(metrics))
    names = small(schema.lookup(metrics, fields))
    standard = F.array(F.lit(schema.METRIC_KEY))
    stamped = events.withColumn("fields", stamp_tenant(F.col("fields"), F.col("org"), schema.ORG_KEY)).join(keys, "org", "left")
    all_keys = F.concat(F.coalesce("keys", F.array().cast("array<string>")), standard)
    keyed = stamped.withColumns({"metric_key": first_present_key(F.col("fields"), all_keys), "metric_alias": first_present(F.col("fields"), all_keys)}).drop("keys")
    joined = keyed.join(names.withColumnRenamed("alias", "metric_alias"), ["org", "metric_alias"], "left")
    formats = [r.f for r in metrics.select(F.explode("ts_formats").alias("f")).distinct().orderBy("f").collect()]  # bounded by the registry
    raw_time = F.coalesce(F.try_element_at("fields", F.lit(schema.TIMESTAMP_KEY)), first_present(F.col("fields"), F.col("ts_aliases")))
    time_key = F.array(F.lit(schema.TIMESTAMP_KEY))
    parsed = [parse_millis(F.col("raw_time"))]
    parsed += [F.when(F.array_contains("ts_formats", f), parse_millis(F.col("raw_time"), f)) for f in formats]
    timed = joined.withColumn("raw_time", raw_time).withColumn("ts_ms", F.coalesce(*parsed))
    base = F.concat(time_key, F.array(F.lit(schema.ORG_KEY), F.col("metric_key")), F.coalesce("ts_aliases", F.array().cast("array<string>")))
    own = F.map_filter("fields", lambda k, v: ~F.array_contains(F.col("base_keys"), k))
    split = timed.withColumn("base_keys", F.array_compact(base)).withColumn("own", own)
    known = F.map_filter("own", lambda k, v: F.map_contains_key("names", k))
    unknown = F.map_filter("own", lambda k, v: ~F.coalesce(F.map_contains_key("names", k), F.lit(False)) & v.isNotNull())
    # two aliases of one field in an event: the first by name counts
    entries = F.transform(F.array_sort(F.map_entries(known)), lambda e: F.struct(F.element_at("names", e["key"]).alias("key"), e["value"].alias("value")))
    # a column of its own, as the sort would be done again for each element inside the lambda
    split = split.withColumn("entries", entries)
    once = F.filter("entries", lambda e, i: ~F.exists(F.slice("entries", 1, i), lambda x: x["key"] == e["key"]))
    conformed = split.withColumn("known", F.map_from_entries(once)).withColumn("unknown", unknown)
    bad = F.array_sort(
        F.map_keys(F.map_filter("known", lambda k, v: v.isNotNull() & ~schema.fits(v, F.element_at("types", k))))
    )
    conformed = conformed.withColumn("bad", F.when(F.col("known").isNotNull(), bad))
    return conformed.withColumn("error", _error()).drop("names", "ts_aliases", "ts_formats", "base_keys", "own", "entries", "bad", "raw_time", "metric_key", "rejected")


def too_large(events: DataFrame) -> Column:
    """A reason for events over the size limit, else null. Only what may be too large, by the bytes that it came with or has at least, is written out as JSON."""
    if "payload" in events.columns:
        doubt = ~event_fits(F.col("payload"))
    else:
        doubt = longest_json(F.col("fields")) > MOST_EVENT_BYTES
    over = doubt & ~event_fits(F.to_json("fields"))
    return F.when(over, F.lit("event too large"))


def _error() -> Column:
    reason = lambda text: F.struct(F.coalesce("org", F.lit(schema.INTERNAL)).alias("key"), text.alias("message"))
    failed = "Failed to apply schema for record: "
    return (
        F.when(~has_tenant(F.col("org")), F.struct(F.lit(schema.INTERNAL).alias("key"), F.lit(failed + "no tenant").alias("message")))
        .when(F.col("rejected").isNotNull(), reason(F.concat(F.lit(failed), F.col("rejected"))))
        .when(F.col("fields").isNull(), reason(F.lit(failed + "not an event")))
        .when(F.col("metric_alias").isNull(), reason(F.lit(failed + "no metric key")))
        .when(F.col("metric_id").isNull(), reason(F.concat(F.lit(failed + "unknown metric "), F.col("metric_alias"))))
        .when(F.col("ts_ms").isNull(), reason(F.lit(failed + "no timestamp")))
        .when(F.size("bad") > 0, reason(F.concat(F.lit(failed + "wrong type of "), F.array_join("bad", ","))))
    )


def good(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col("error").isNull())


def failed(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col("error").isNotNull())


def malformed(failures: DataFrame, write_ms: Column | None = None, body: Column | None = None, overrides: dict[str, Column] | None = None) -> DataFrame:
    """Dead letters: apikey, message, event as JSON text (or ``body``, as UTF-8 if binary), handled_timestamp.

    ``overrides``: other expressions for some of these columns, or for more, over the columns of ``failures``.
    """
    event = F.to_json("fields") if body is None else body
    if body is not None and dict(failures.select(body.alias("b")).dtypes)["b"] == "binary":
        event = F.decode(body, "UTF-8")
    now = F.unix_millis(F.current_timestamp())
    columns = {
        "apikey": F.coalesce("error.key", F.lit(schema.INTERNAL)),
        "message": F.col("error.message"),
        "event": event,
        "handled_timestamp": F.coalesce(write_ms, now) if write_ms is not None else now,
    }
    return failures.select(*[value.alias(name) for name, value in (columns | (overrides or {})).items()])


def typed(conformed: DataFrame, columns: list[tuple[str, str]], *extra: str, overrides: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """A metric's rows as fixed columns: org, metric_id, ts_ms, then each field in its type; missing ones are null.

    ``overrides``: for some fields, how the text that came becomes the value, instead of a cast to the type.
    """
    raw = lambda f: F.try_element_at("known", F.lit(f))
    values = [((overrides or {})[f](raw(f)) if f in (overrides or {}) else schema.cast_value(raw(f), t)).alias(f) for f, t in columns]
    return conformed.select("org", "metric_id", "ts_ms", *values, *extra)
