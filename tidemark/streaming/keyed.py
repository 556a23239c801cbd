"""Keyed state of the store's stream: what the ids of each (org, metric, time) stand for.

The state maps each (org, metric, time, content id) to its values, on disk (RocksDB) and without expiry. A row of a new id is
passed; one that says again what is known is dropped; one that adds fields to its id is passed and
remembered; one that has another value for a field of its id is refused. As the state outlives restarts, so does
all of this, however late something is sent again.

Entries are dealt to SLOTS groups by their hash, so a micro-batch calls Python once a slot and not once a key, and a key
that has a third of all rows is spread over the slots by its ids.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.versions import KEY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEW, CONFLICT = "new", "conflict"
#: Groups that entries are dealt to. It must stay what it was when a state folder was made, like the number of shuffle partitions.
SLOTS = 4096
#: What an entry of the state is found by; the order in which rows of a micro-batch are judged, whatever the order of arrival.
ENTRY = [*KEY, "id"]
ORDER = ["write_ms", "known", "unknown", "metric_alias"]


def judged(held: str | None, known: str) -> tuple[str | None, str | None, str | None]:
    """What becomes of values that come for an id: outcome (none for a resend), what to hold from now on, fields that contradict."""
    if held is None:
        return NEW, known, None
    before, now = json.loads(held), json.loads(known)
    other = sorted(k for k, v in now.items() if k in before and before[k] != v)
    if other:
        return CONFLICT, None, ",".join(other)
    added = {k: v for k, v in now.items() if k not in before}
    return (NEW, json.dumps(before | added, sort_keys=True), None) if added else (None, None, None)


def contents(chunks: Iterator[pd.DataFrame]) -> tuple[list[str], list[tuple]]:
    """A slot's columns, with ``copies`` behind them, and its rows in their order: of equal contents of an entry the first row.

    The memory is that of the slot's different contents, however often one is sent.
    """
    columns: list[str] = []
    first: dict[tuple, tuple] = {}
    for chunk in chunks:
        columns = list(chunk.columns)
        same = [columns.index(c) for c in (*ENTRY, "known", "unknown")]
        order = [columns.index(c) for c in ORDER]
        for row in zip(*[chunk[c].tolist() for c in columns]):
            content, place = tuple(row[i] for i in same), tuple((row[i] is not None, row[i]) for i in order)  # nulls first
            held = first.get(content)
            copies = 1 if held is None else held[2] + 1
            first[content] = (place, row, copies) if held is None or place < held[0] else (*held[:2], copies)
    return [*columns, "copies"], [(*row, copies) for _, row, copies in sorted(first.values(), key=lambda x: x[0])]


class KeepVersions(StatefulProcessor):
    def init(self, handle) -> None:
        self.held = handle.getMapState("entries", "org string, metric_id string, ts_ms long, id string", "known string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        columns, found = contents(rows)
        *at, known = [columns.index(c) for c in (*ENTRY, "known")]
        passed = []
        for row in found:
            entry = tuple(row[i] for i in at)
            value = self.held.getValue(entry)  # none for a new entry; each call to the state is a message to its process
            outcome, hold, reason = judged(None if value is None else value[0], row[known])
            if hold is not None:
                self.held.updateValue(entry, (hold,))
            if outcome is not None:
                passed.append((*row, outcome, reason))
        if passed:
            yield pd.DataFrame(passed, columns=[*columns, "outcome", "reason"]).drop(columns="slot")

    def close(self) -> None:
        pass


def versioned(rows: DataFrame) -> DataFrame:
    """A stream of the store's rows with outcome (new or conflict), reason and the copies in the micro-batch; resends are gone."""
    flat = rows.withColumn("unknown", F.to_json("unknown"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields) + ", copies long, outcome string, reason string"
    slots = flat.withColumn("slot", F.pmod(F.xxhash64(*ENTRY), F.lit(SLOTS)).cast("int"))
    return slots.groupBy("slot").transformWithStateInPandas(KeepVersions(), out, "append", "none")


def accepted(batch: DataFrame) -> DataFrame:
    """The rows to store."""
    return batch.where(F.col("outcome") == NEW).drop("copies", "outcome", "reason").withColumn("unknown", F.from_json("unknown", "map<string,string>"))


def refused(batch: DataFrame, now: Column) -> DataFrame:
    """The dead letters of conflicts: apikey, message, event, handled_timestamp."""
    text = F.concat(F.lit("Failed to apply schema for record: id "), F.col("id"), F.lit(" has other values of "), F.col("reason"))
    event = F.to_json(F.struct(*KEY, "id", "known", "unknown"))
    each = batch.where(F.col("outcome") == CONFLICT).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(F.col("org").alias("apikey"), text.alias("message"), event.alias("event"), now.alias("handled_timestamp"))


def started(writer, spark: SparkSession) -> StreamingQuery:
    """Starts a query with state on disk; the session's own setting is as before."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)
