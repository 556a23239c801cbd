"""Seven-day data-time windows, write months, window names and range overlap.

All of it is integer arithmetic on epoch milliseconds in UTC, so the session's zone does not matter.
A year's weeks are counted from 1 January; its last window runs into the next year and
overlaps that year's first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
WINDOW_DAYS = 7
_NAME = r"^(.*)_(\d+)_(\d+)_(\d+)_(\d+)$"


def event_date(ts_ms: Column) -> Column:
    """The UTC day of a timestamp in milliseconds."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ts_ms / DAY_MS).cast("int"))


def day_start_ms(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * DAY_MS


def millis(ts_ntz: Column) -> Column:
    """Milliseconds of a timestamp without zone, taken as UTC."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts_ntz.cast("timestamp_ntz"))
    return F.floor(micros.cast("decimal(20,0)") / 1000)


def window_start(ts_ms: Column) -> Column:
    """First day of the window: weeks from 1 January of the timestamp's own year."""
    day = event_date(ts_ms)
    return F.date_sub(day, F.pmod(F.dayofyear(day) - 1, F.lit(WINDOW_DAYS)))


def window_start_ms(ts_ms: Column) -> Column:
    return day_start_ms(window_start(ts_ms))


def window_end_ms(ts_ms: Column) -> Column:
    return window_start_ms(ts_ms) + WINDOW_DAYS * DAY_MS


def write_month(write_ms: Column) -> Column:
    return F.month(event_date(write_ms))


def write_year(write_ms: Column) -> Column:
    return F.year(event_date(write_ms))


def window_name(prefix: Column, start_ms: Column, end_ms: Column, month: Column, year: Column) -> Column:
    return F.concat_ws("_", prefix, *[c.cast("string") for c in (start_ms, end_ms, month, year)])


def parse_window_name(name: Column) -> Column:
    """struct(prefix, start_ms, end_ms, month, year); null unless the four last parts are numbers."""
    part = lambda i: F.regexp_extract(name, _NAME, i)
    parsed = F.struct(
        part(1).alias("prefix"),
        part(2).try_cast("long").alias("start_ms"),
        part(3).try_cast("long").alias("end_ms"),
        part(4).try_cast("int").alias("month"),
        part(5).try_cast("int").alias("year"),
    )
    return F.when(F.regexp_like(name, F.lit(_NAME)), parsed)


def name_stem(name: Column) -> Column:
    """A name without its last part."""
    return F.regexp_replace(name, "_[^_]*$", "")


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Half-open ranges that share a point."""
    return (a_start < b_end) & (b_start < a_end)


def partition_key(org: Column, metric_id: Column) -> Column:
    return F.concat(org, metric_id)


def with_window(df, ts: str = "ts_ms", write: str = "write_ms"):
    """Adds the store's partition columns: the window of the data time, the month of the write."""
    return df.withColumns(
        {
            "window_start_ms": window_start_ms(F.col(ts)),
            "window_end_ms": window_end_ms(F.col(ts)),
            "write_year": write_year(F.col(write)),
            "write_month": write_month(F.col(write)),
        }
    )
