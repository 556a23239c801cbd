"""Value functions over event maps: look-ups, timestamps, content ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
#: RFC 1123; Spark parses no weekday names, so they are cut off first.
RFC_1123 = "EEE, dd MMM yyyy HH:mm:ss z"


def first_present(fields: Column, keys: Column) -> Column:
    """The value of the first key, in the order of the array, that the map has with a value."""
    return F.try_element_at(F.filter(F.transform(keys, lambda k: F.try_element_at(fields, k)), lambda v: v.isNotNull()), F.lit(1))


def first_present_key(fields: Column, keys: Column) -> Column:
    return F.try_element_at(F.filter(keys, lambda k: F.try_element_at(fields, k).isNotNull()), F.lit(1))


def stamp_tenant(fields: Column, org: Column, org_key: str = "org") -> Column:
    """The event with its envelope's tenant, which replaces any the event names."""
    others = F.map_filter(fields, lambda k, v: k != org_key)
    return F.when(org.isNull(), others).otherwise(F.map_concat(others, F.create_map(F.lit(org_key), org)))


def without_keys(fields: Column, keys: Column) -> Column:
    return F.map_filter(fields, lambda k, v: ~F.array_contains(keys, k))


def sorted_entries(m: Column) -> Column:
    """A map as its entries in order, which can be compared, grouped and hashed."""
    return F.array_sort(F.map_entries(m))


def absent_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def parse_millis(value: Column, pattern: str | None = None) -> Column:
    """Epoch milliseconds of a text: a number as it is, or a date by ``pattern``.

    A pattern may end in ``@ zone``: texts without a zone are then read in that one. Dates that don't fit
    give null. The session's zone must be UTC.
    """
    if pattern is None:
        return value.try_cast("long")
    form, _, zone = (p.strip() for p in pattern.partition("@"))
    if form.startswith("EEE,"):
        value, form = F.regexp_replace(value, r"^\s*\p{L}+,\s*", ""), form[4:].strip()
    parsed = F.try_to_timestamp(value, F.lit(form))
    return F.unix_millis(F.to_utc_timestamp(parsed, zone) if zone else parsed)


def content_id(ts_ms: Column, values: list[Column], unknown: Column | None = None) -> Column:
    """A digest of time, values and unknown entries: equal content has equal ids, whenever it is written.

    A missing value differs from an empty one; unknown entries count in sorted order.
    """
    parts = [ts_ms.cast("string")] + [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("")) for v in values]
    if unknown is not None:
        pairs = F.transform(sorted_entries(unknown), lambda e: F.concat_ws("=", e["key"], e["value"]))
        parts.append(F.array_join(pairs, SEPARATOR))
    return F.md5(F.concat_ws(SEPARATOR, *parts))
