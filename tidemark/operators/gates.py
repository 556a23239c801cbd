"""Limits on events and requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed limits: bytes of an event, events and bytes of a request.
MOST_EVENT_BYTES, MOST_EVENTS, MOST_REQUEST_BYTES = 999_488, 500, 5_000_000


def event_fits(serialized: Column, most: int = MOST_EVENT_BYTES) -> Column:
    return F.octet_length(serialized) <= most


def longest_json(fields: Column) -> Column:
    """Bytes that an event's JSON has at most: a byte may take six, and an entry has ten signs or fewer around it."""
    texts = F.concat_ws("", F.map_keys(fields), F.map_values(fields))
    return 6 * F.octet_length(texts).cast("long") + 10 * F.size(fields) + 2


def request_fits(events: Column, most_events: int = MOST_EVENTS, most_bytes: int = MOST_REQUEST_BYTES) -> Column:
    """Whether a request's events (an array of maps) are few and small enough."""
    total = F.aggregate(F.transform(events, lambda e: F.octet_length(F.to_json(e)).cast("long")), F.lit(0).cast("long"), lambda a, n: a + n)
    each = F.forall(events, lambda e: event_fits(F.to_json(e)))
    return (F.size(events) <= most_events) & (total <= most_bytes) & each


def has_tenant(org: Column) -> Column:
    return org.isNotNull() & (org != "")
