"""Events in requests, notifications and stream payloads."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gates import request_fits

REQUEST = "customerKey string, event map<string,string>, events array<map<string,string>>"


def request_events(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """org, fields: one row for the request's event, or for each of its events; an empty list gives none."""
    parsed = requests.select(F.from_json(payload, REQUEST).alias("r"))
    each = F.when(F.col("r.event").isNotNull(), F.array("r.event")).otherwise(F.col("r.events"))
    return parsed.select(F.col("r.customerKey").alias("org"), F.explode(each).alias("fields"))


def accepted_events(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """org, payload, fields, rejected: the events of requests within the limits, and a row with the reason for each other request.

    A request that can't be read, or is over a limit, has null fields; one without events gives none.
    """
    parsed = requests.where(F.length(F.trim(payload)) > 0).withColumn("r", F.from_json(payload, REQUEST))
    each = F.when(F.col("r.event").isNotNull(), F.array("r.event")).otherwise(F.col("r.events"))
    bad = F.when(F.col("r.customerKey").isNull() & each.isNull(), F.lit("not a request")).when(~request_fits(each), F.lit("request over the limits"))
    rows = parsed.select(F.col("r.customerKey").alias("org"), F.col(payload).alias("payload"), each.alias("each"), bad.alias("rejected"))
    none = F.array(F.lit(None).cast("map<string,string>"))
    return rows.select("org", "payload", F.explode(F.when(F.col("rejected").isNotNull(), none).otherwise(F.col("each"))).alias("fields"), "rejected")


#: Where one top-level value may end and the next begin (or the same inside a string: then Python decides).
_NEXT_VALUE = r"[}\]]\s*[{\[]"


def objects_of(payload: Column) -> Column:
    """The objects of one JSON object or array, as maps; null for anything else (several values in a row, broken text)."""
    many = F.from_json(payload, "array<map<string,string>>")
    one = F.from_json(payload, "map<string,string>")
    single = F.when(F.ltrim(payload).startswith("["), many).otherwise(F.when(one.isNotNull(), F.array(one)))
    return F.when(~F.regexp_like(payload, F.lit(_NEXT_VALUE)), single)


def payload_events(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The other columns and fields, a row for each object. Empty payloads are skipped; scalars in an array are."""
    full = payloads.where(F.length(F.trim(payload)) > 0)
    each = full.withColumn("fields", F.explode(objects_of(F.col(payload))))
    return each.where(F.col("fields").isNotNull())


def fields_of(event: dict) -> dict[str, str | None]:
    """An event's fields as texts: strings as they are, all else as JSON."""
    return {k: v if isinstance(v, str) else None if v is None else json.dumps(v) for k, v in event.items()}


def split_objects(text: str | None) -> list[dict[str, str] | None]:
    """Top-level objects of a text that may hold several in a row, arrays flattened, scalars skipped.

    Objects before broken text count; the broken rest is one null.
    """
    found, at, decoder = [], 0, json.JSONDecoder()
    text = text or ""

    def take(value: object) -> Iterator[dict[str, str]]:
        if isinstance(value, dict):
            yield fields_of(value)
        elif isinstance(value, list):
            for v in value:
                yield from take(v)

    while at < len(text):
        if text[at].isspace():
            at += 1
            continue
        try:
            value, at = decoder.raw_decode(text, at)
        except ValueError:
            found.append(None)
            break
        found += take(value)
    return found


def concatenated_events(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Like ``payload_events``, for any payload: what built-ins can't read goes to Python, broken text has null fields."""

    @F.pandas_udf("array<map<string,string>>")
    def split(texts):
        return texts.map(split_objects)

    # read once: Python gets a null for each payload that built-ins have read
    full = payloads.where(F.length(F.trim(payload)) > 0).withColumn("tm_each", objects_of(F.col(payload)))
    full = full.withColumn("tm_odd", F.when(F.col("tm_each").isNull(), F.col(payload)))
    rows = full.withColumn("fields", F.explode(F.coalesce("tm_each", split("tm_odd"))))
    return rows.where(F.col("fields").isNotNull() | F.col("tm_odd").isNotNull()).drop("tm_each", "tm_odd")


def own_bucket_notification(payload: Column, scheme: str = "s3://") -> tuple[Column, Column]:
    """org and file of an upload to the own bucket: the key's second part up to ``_`` is the tenant."""
    bucket = F.get_json_object(payload, "$.Records[0].s3.bucket.name")
    key = F.get_json_object(payload, "$.Records[0].s3.object.key")
    org = F.substring_index(F.get(F.split(key, "/"), 1), "_", 1)
    return org, F.concat(F.lit(scheme), bucket, F.lit("/"), key)


def remote_notification(subject: Column, message: Column) -> tuple[Column, Column]:
    return subject, message
