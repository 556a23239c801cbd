"""Acceptance cases: conforming, files, manifest, versions, windows, streams."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import timewindow as W
from tidemark.functions.values import parse_millis
from tidemark.operators import archive as A
from tidemark.operators import conform as C
from tidemark.operators import gates
from tidemark.operators import manifest as M
from tidemark.operators import versions as V
from tidemark.plans import batch, etl, maintenance
from tidemark.sources import files, requests
from tidemark.streaming import ingest

DAY = 86_400_000
EVENTS = "org string, fields map<string,string>"


@pytest.fixture(scope="module")
def registry(spark):
    metrics = [
        ("org1", "m1", "metric", ["alias1"], [], [], []),
        ("org2", "m1", "metric", [], ["somekey"], ["tsAlias"], ["EEE, dd MMM yyyy HH:mm:ss z"]),
        ("org1", "m2", "sensor", [], [], ["measured_at"], ["yyyy-MM-dd HH:mm:ss @ -06:00"]),
    ]
    fields = [
        ("org1", "m1", "f1", "field1", ["other"], "INTEGER", True),
        ("org2", "m1", "f2", "fieldname", [], "BOOLEAN", True),
        ("org1", "m2", "s1", "measurement", [], "DOUBLE", True),
        ("org1", "m2", "s2", "unit", [], "VARCHAR", True),
    ]
    return spark.createDataFrame(metrics, schema.REGISTRY_METRIC), spark.createDataFrame(fields, schema.REGISTRY_FIELD)


def conformed(spark, registry, rows):
    return [r.asDict(True) for r in C.conform(spark.createDataFrame(rows, EVENTS), *registry).collect()]


def test_conform_known_unknown_and_aliases(spark, registry):
    (row,) = conformed(spark, registry, [("org1", {"metrictype": "alias1", "timestamp": "1234", "other": "5", "jfield-new": "1", "org": "intruder"})])
    assert row["error"] is None and row["metric_id"] == "m1" and row["ts_ms"] == 1234
    assert row["known"] == {"f1": "5"} and row["unknown"] == {"jfield-new": "1"} and row["fields"]["org"] == "org1"


def test_conform_custom_key_and_time_alias(spark, registry):
    (row,) = conformed(spark, registry, [("org2", {"somekey": "metric", "tsAlias": "Tue, 06 Sep 2016 19:00:46 GMT", "fieldname": "true"})])
    assert row["error"] is None and row["ts_ms"] == 1473188446000 and row["known"] == {"f2": "true"} and row["unknown"] == {}


def test_conform_errors(spark, registry):
    rows = [
        (None, {"metrictype": "metric", "timestamp": "1"}),
        ("org1", {"timestamp": "1234"}),
        ("org1", {"metrictype": "nothing", "timestamp": "1"}),
        ("org1", {"metrictype": "metric"}),
        ("org1", {"metrictype": "metric", "timestamp": "1", "field1": "x"}),
        ("org1", None),
        ("org1", {"metrictype": "metric", "timestamp": "1", "field1": None}),
    ]
    found = conformed(spark, registry, rows)
    got = {json.dumps(r["fields"], sort_keys=True): r["error"] for r in found}
    assert sum(e is None for e in got.values()) == 1
    assert {e["key"] for e in got.values() if e} == {"org1", "_internal"}
    assert all(e["message"].startswith("Failed to apply schema for record") for e in got.values() if e)


def test_zone_of_a_pattern(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([("2015-10-24 04:00:00",), ("soon",), (None,)], "v string")
    found = [r[0] for r in df.select(parse_millis(F.col("v"), "yyyy-MM-dd HH:mm:ss @ -06:00")).collect()]
    assert found == [1445680800000, None, None]


@pytest.mark.parametrize(
    "ts, start",
    [(0, 0), (1000, 0), (7 * DAY - 1, 0), (7 * DAY, 7 * DAY), (1446422400000, 1446076800000), (1446595200000, 1446076800000), (1419984000000, 1419984000000)],
)
def test_window_edges(spark, ts, start):
    row = spark.range(1).select(W.window_start_ms(F.lit(ts)).alias("a"), W.window_end_ms(F.lit(ts)).alias("b")).first()
    assert (row.a, row.b) == (start, start + 7 * DAY)


def test_short_timestamp_is_inside_its_window(spark):
    row = spark.range(1).select(W.window_start_ms(F.lit(1475001526)).alias("a"), W.window_end_ms(F.lit(1475001526)).alias("b")).first()
    assert row.a < 1475001526 < row.b


def test_window_names(spark):
    name = "some_table_1446076800000_1446681600000_11_2015"
    row = spark.range(1).select(W.parse_window_name(F.lit(name)).alias("p"), W.parse_window_name(F.lit("a_b_c")).alias("q"), W.name_stem(F.lit(name)).alias("s")).first()
    assert tuple(row.p) == ("some_table", 1446076800000, 1446681600000, 11, 2015) and row.q is None and row.s == name[:-5]


def test_covering_windows_are_half_open(spark):
    windows = spark.createDataFrame([(i * 7 * DAY, (i + 1) * 7 * DAY) for i in range(5)], "window_start_ms long, window_end_ms long")
    ranges = spark.createDataFrame([(1, 0, 7 * DAY), (2, 7 * DAY - 1, 7 * DAY + 1), (3, 5, 5), (4, 10 * DAY, 30 * DAY)], "r int, range_start long, range_end long")
    found = sorted((r.r, r.window_start_ms // (7 * DAY)) for r in V.covering_windows(windows, ranges).collect())
    assert found == [(1, 0), (2, 0), (2, 1), (4, 1), (4, 2), (4, 3), (4, 4)]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if path.suffix == ".gz" else text.encode())
    return str(path)


JSON = '{"metrictype": "metric", "timestamp": %d, "field1": 1}\n'
CSV = "metrictype,timestamp,field1\n\"metric\",%d,1\n"


@pytest.fixture
def options(tmp_path):
    return batch.BatchOptions(*[str(tmp_path / x) for x in ("manifest", "archive", "store", "errors")], run_ms=1_447_000_000_000)


def listed(spark, options, entries):
    rows = spark.createDataFrame(entries, "org string, file string")
    M.append(M.actions(rows, M.PENDING, F.lit(1)), options.manifest)


def test_batch_formats_missing_and_bad(spark, registry, options, tmp_path):
    paths = [
        write(tmp_path / "in/a.json", JSON % 1234), write(tmp_path / "in/b.json.gz", JSON % 1235),
        write(tmp_path / "in/c.csv", CSV % 1236), write(tmp_path / "in/d.csv.gz", CSV % 1237),
    ]
    bad = write(tmp_path / "in/bad.json", '{"timestamp": 1234}\n{broken\n')
    listed(spark, options, [*(("org1", p) for p in paths), ("org1", bad), ("org1", str(tmp_path / "in/none.json"))])
    report = batch.run_batch(spark, options, *registry)
    assert report == {"files": 6, "stored": 4, "malformed": 2, "failed_files": 1}
    store = spark.read.parquet(options.store)
    assert sorted(r.ts_ms for r in V.scan(store, "org1", "m1", 0, 2_000).collect()) == [1234, 1235, 1236, 1237]
    letters = [r.asDict() for r in spark.read.schema(schema.MALFORMED).json(options.errors).collect()]
    assert {r["apikey"] for r in letters} == {"org1"} and {r["event"] for r in letters} == {'{"timestamp": 1234}', "{broken"}
    manifest = M.read(spark, options.manifest)
    assert M.pending(manifest).count() == 0
    assert [(r.org, r.file) for r in M.failures(manifest).select("org", "file").collect()] == [("org1", str(tmp_path / "in/none.json"))]
    assert batch.run_batch(spark, options, *registry)["files"] == 0


def test_batch_two_tenants_and_hooks(spark, registry, options, tmp_path):
    one = write(tmp_path / "in/x.csv", CSV % 10)
    two = write(tmp_path / "in/y.json", '{"somekey": "metric", "timestamp": 11, "fieldname": true}\n')
    listed(spark, options, [("org1", one), ("org2", two)])
    options.transforms = {"archive": lambda df: df.withColumn("copied", F.lit(True))}
    assert batch.run_batch(spark, options, *registry)["stored"] == 2
    assert {r.org for r in spark.read.parquet(options.archive).where("copied").collect()} == {"org1", "org2"}


def test_sensor_lines(spark, registry, options, tmp_path):
    lines = ["metrictype,measurement,measured_at,unit,bad_data"] + [f"sensor,1.5,2015-10-24 04:{m:02d}:00,kW,f" for m in (0, 15, 30, 45)]
    listed(spark, options, [("org1", write(tmp_path / "in/s.csv", "\n".join(lines) + "\n"))])
    assert batch.run_batch(spark, options, *registry)["stored"] == 4
    assert [r[0] for r in spark.read.parquet(options.store).agg(F.min("ts_ms")).collect()] == [1445680800000]


def test_etl_promotes_and_reads_back(spark, registry, tmp_path):
    records = [
        ("org1", "m1", 10, {"f1": "3"}, {"late": "7"}),
        ("org1", "m1", 10, {"f1": "3"}, {"late": "7"}),
        ("org1", "m1", DAY + 5, {}, {"field9": "4", "rest": "x"}),
        ("org2", "m1", 3 * DAY, {"f2": "true"}, {}),
    ]
    staged = str(tmp_path / "staged")
    spark.createDataFrame(records, "org string, metric_id string, ts_ms long, known map<string,string>, unknown map<string,string>").write.parquet(staged)
    later = registry[1].union(spark.createDataFrame([("org1", "m1", "f9", "field9", [], "INTEGER", True)], schema.REGISTRY_FIELD))
    options = etl.EtlOptions(staged, str(tmp_path / "known"), str(tmp_path / "unknown"))
    report = etl.run_etl(spark, options, later)
    assert report["known"]["rows"] == 3 and report["unknown"]["rows"] == 2
    rows = A.read_known(spark, options.known, "org1", "m1", "1969-12-31", "1970-01-03").collect()
    assert [(r.ts_ms, r.f1, r.f9) for r in rows] == [(10, 3, None), (DAY + 5, None, 4)]
    assert A.read_known(spark, options.known, "org1", "m1", "1970-01-01", "1970-01-02").count() == 0
    unknown = A.read_unknown(spark, options.unknown, "1969-12-31", "1970-01-09")
    joined = A.rejoin(A.read_known(spark, options.known, "org1", "m1", "1969-12-31", "1970-01-03").select("org", "metric_id", "ts_ms", "f1"), unknown.drop("date"))
    assert {(r.ts_ms, r.u) for r in joined.withColumn("u", A.unknown_value("late", "INT")).collect()} == {(10, 7), (DAY + 5, None)}


def test_versions_round_trip_resend_and_conflict(spark):
    rows = spark.createDataFrame([("o", "m", t, v, "") for t in range(20) for v in (1, 2, 3)], "org string, metric_id string, ts_ms long, f1 int, s string")
    rows = V.suppress_empty(rows, ["s"])
    ided = V.with_ids(rows, ["f1", "s"])
    back = V.expand(V.collapse(ided.union(ided), ["f1", "s"]), ["f1", "s"])
    assert back.count() == 60 and back.where("s is not null").count() == 0 and back.agg(F.sum("f1")).first()[0] == 120
    sent = ided.withColumn("write_ms", F.lit(1)).union(ided.withColumn("write_ms", F.lit(2)))
    assert V.latest(sent).count() == 60 and V.latest(sent).agg(F.min("write_ms")).first()[0] == 2
    assert V.conflicts(ided, ["f1"]).count() == 0 and V.conflicts(ided.withColumn("id", F.lit("x")), ["f1"]).count() == 20
    assert {r.n_versions for r in V.version_counts(ided).collect()} == {3}


def test_requests(spark):
    payloads = [json.dumps({"customerKey": "c", "event": {"a": 1}}), json.dumps({"customerKey": "c", "events": [{"a": 2}, {"a": 3}]}), json.dumps({"customerKey": "c", "events": []})]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    assert sorted(r.fields["a"] for r in requests.request_events(df).collect()) == ["1", "2", "3"]
    many = spark.range(1).select(gates.request_fits(F.array_repeat(F.create_map(F.lit("a"), F.lit("b")), 501)).alias("a"), gates.request_fits(F.array_repeat(F.create_map(F.lit("a"), F.lit("b")), 500)).alias("b"))
    assert tuple(many.first()) == (False, True)


def test_concatenated_objects(spark):
    df = spark.createDataFrame([(1, '{"a":1}{"a":"}{"}[{"a":[2]}, 3]'), (2, '[{"a":"x"},{"b":"y"}]'), (3, " "), (4, None), (5, "{oops")], "n int, payload string")
    rows = requests.concatenated_events(df).collect()
    assert [r.n for r in rows if r.fields is None] == [5]
    found = sorted((r.n, tuple(sorted(r.fields.items()))) for r in rows if r.fields is not None)
    assert found == [(1, (("a", "1"),)), (1, (("a", "[2]"),)), (1, (("a", "}{"),)), (2, (("a", "x"),)), (2, (("b", "y"),))]


def test_json_array_file(spark, tmp_path):
    path = write(tmp_path / "list.json", '[{"a": "1"},\n {"a": "2"}]')
    assert sorted(r.fields["a"] for r in files.read_json_array(spark, path).collect()) == ["1", "2"]


def test_manifest_sets_and_errors(spark):
    act = lambda f, s, n, m=None: M.actions(spark.createDataFrame([("o", f)], "org string, file string"), s, F.lit(n), F.lit(m))
    log = [act("file1", M.PENDING, 1), act("file2", M.PENDING, 1), act("file2", M.PENDING, 2), act("gone", M.FAILED, 3, "first"), act("gone", M.FAILED, 4, "second"), act("never", M.DONE, 5)]
    row = M.merged(A.union_all(log)).first()
    assert row.files == ["file1", "file2"] and row.errors == {"gone": ["first", "second"]}
    done = spark.createDataFrame([("o", "file1"), ("o", "never")], "org string, file string")
    assert [r.file for r in M.remove(M.pending(A.union_all(log)), done).collect()] == ["file2"]


def test_late_data_survive_arrival_watermark(spark, tmp_path):
    days = [1_700_000_000_000, 1_700_100_000_000, 1_420_000_000_000, 1_700_000_000_000]
    for i, ts in enumerate(days):
        spark.createDataFrame([("o", "m", ts, str(ts))], "org string, metric_id string, ts_ms long, id string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("org string, metric_id string, ts_ms long, id string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = ingest.without_resends(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.ts_ms for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(set(days))


def test_stream_keeps_raw_and_commit_errors(spark, registry, tmp_path):
    payloads = [("org1", JSON % 5), ("org1", "{broken"), ("org1", " "), ("org1", '{"timestamp": 1}')]
    spark.createDataFrame(payloads, "org string, payload string").write.parquet(str(tmp_path / "in"))
    sinks = ingest.StreamSinks(*[str(tmp_path / x) for x in ("raw", "parsed", "store", "malformed", "commit_errors", "checkpoint")])

    def unreachable(df):
        raise OSError("store is away")

    sinks.transforms = {"store": unreachable}
    ingest.ingest(ingest.read_payloads(spark, str(tmp_path / "in")), sinks, *registry, write_ms=F.lit(9)).awaitTermination()
    read = lambda p: spark.read.option("recursiveFileLookup", True).parquet(p)
    assert read(sinks.raw).count() == 4 and read(sinks.parsed).count() == 1
    (row,) = read(sinks.commit_errors).collect()
    assert "store is away" in row.reason and row.ts_ms == 5
    assert spark.read.option("recursiveFileLookup", True).json(sinks.malformed).count() == 2


def test_retention_and_compaction(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("o", "m", t * 7 * DAY) for t in range(6)], "org string, metric_id string, ts_ms long")
    for _ in range(2):
        V.append(V.store_rows(rows, F.lit(1_447_000_000_000)), path)
    windows = maintenance.managed_windows(spark.read.parquet(path))
    assert windows.count() == 6
    day = lambda d: F.lit(d).cast("date")
    assert maintenance.expired(windows, day("2015-12-05"), 1).count() == 0 and maintenance.expired(windows, day("2015-12-09"), 1).count() == 6
    runs = lambda: spark.read.parquet(path).where("window_start_ms = 0").select("run").distinct().count()
    assert runs() == 2 and maintenance.compact(spark, path, F.col("window_start_ms") == 0) == 2 and runs() == 1
    assert spark.read.parquet(path).count() == 12
    assert maintenance.run_maintenance(spark, path, day("2015-12-05"), 7, dry_run=False) == {"expired": 0, "compacted": 10}
    assert spark.read.parquet(path).count() == 12 and spark.read.parquet(path).select("run").distinct().count() == 2
    gone = maintenance.retain(spark, path, day("2015-12-09"), 7, dry_run=True)
    assert len(gone) == 6 and spark.read.parquet(path).count() == 12
    maintenance.retain(spark, path, day("2015-12-09"), 7, dry_run=False)
    assert not [p for p in (tmp_path / "store").glob("window*/*/*/*/*/*.parquet")]


def test_scan_by_alias(spark, registry):
    rows = spark.createDataFrame([("org1", "m1", 5), ("org1", "m1", DAY * 30), ("org2", "m1", 5)], "org string, metric_id string, ts_ms long")
    store = V.store_rows(rows, F.lit(1))
    assert [r.ts_ms for r in V.scan_by_alias(store, registry[0], "org1", "alias1", 0, DAY).collect()] == [5]
    assert V.scan_by_alias(store, registry[0], "org1", "nothing", 0, DAY).count() == 0
    assert V.scan(store, "org1", "m1", 0, 1, whole_windows=True).count() == 1
    assert maintenance.approximate_count(rows) == 3


def test_uploads_reach_the_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("1234", "file"), ("1234", "file"), (None, "x")], "org string, file string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("org string, file string").parquet(str(tmp_path / "in"))
    ingest.track_uploads(stream, str(tmp_path / "manifest"), str(tmp_path / "c")).awaitTermination()
    assert [tuple(r) for r in M.pending(M.read(spark, str(tmp_path / "manifest"))).collect()] == [("1234", "file")]


def test_archive_inputs(spark, tmp_path):
    path = write(tmp_path / "in/z.json", "x")
    (moved,) = maintenance.archive_inputs(spark, [path], str(tmp_path / "archive"), 7)
    assert not (tmp_path / "in/z.json").exists() and moved.endswith(f"/archive/7{path}")


def test_evolving_schema_union(spark):
    old = spark.createDataFrame([(1, 2)], "ts_ms long, a int")
    new = spark.createDataFrame([(2, 3, "x")], "ts_ms long, a int, b string")
    assert [(r.ts_ms, r.b) for r in A.union_all([old, new]).orderBy("ts_ms").collect()] == [(1, None), (2, "x")]


def test_nested_and_binary_values(spark):
    """Nested types of the registry are read from JSON, bytes as they are."""
    fields = {"a": "[[1,2],[3]]", "b": "caf\u00e9", "c": '[{"x": 1, "y": "z"}, {"x": 2}]', "d": '{"x": {"y": [true]}}', "e": "[1"}
    types = {"a": "ARRAY<ARRAY<INT>>", "b": "BYTES", "c": "ARRAY<STRUCT<x: INT, y: STRING>>", "d": "STRUCT<x: STRUCT<y: ARRAY<BOOLEAN>>>", "e": "ARRAY<INT>"}
    df = spark.createDataFrame([("o", "m", 1, fields)], "org string, metric_id string, ts_ms long, known map<string,string>")
    row = C.typed(df, list(types.items())).first()
    assert row.a == [[1, 2], [3]] and bytes(row.b).decode() == "caf\u00e9" and [tuple(r) for r in row.c] == [(1, "z"), (2, None)]
    assert row.d.x.y == [True] and row.e is None


def test_odd_file_names_lose_no_line(spark, registry, options, tmp_path):
    names = ["plain.json", "day 1.json", "\u00e9.json", "50%.json", "a+b.json", "x[1]{2}.json", "q?*.json", "sub dir/in ner.csv", "100% [x].csv.gz"]
    paths = [write(tmp_path / "in" / n, (CSV if ".csv" in n else JSON) % (1_000 + i)) for i, n in enumerate(names)]
    listed(spark, options, [*(("org1", p) for p in paths[:7]), ("org1", str(tmp_path / "in/sub dir")), ("org1", paths[8])])
    report = batch.run_batch(spark, options, *registry)
    assert report == {"files": 9, "stored": 9, "malformed": 0, "failed_files": 0}
    assert {r.ts_ms for r in spark.read.parquet(options.store).collect()} == {1_000 + i for i in range(9)}
    assert M.pending(M.read(spark, options.manifest)).count() == 0


def test_a_run_that_is_repeated_replaces_its_rows(spark, registry, options, tmp_path):
    path = write(tmp_path / "in/a.json", JSON % 5 + "{broken\n")
    for again in range(2):
        listed(spark, options, [("org1", path)])
        M.append(M.actions(spark.createDataFrame([("org1", path)], "org string, file string"), M.PENDING, F.lit(options.run_ms + 1 + again)), options.manifest)
        batch.run_batch(spark, options, *registry)
    assert spark.read.parquet(options.store).count() == 1 and spark.read.parquet(options.archive).count() == 2 and spark.read.json(options.errors).count() == 1


def test_no_manifest_yet_is_no_work(spark, registry, options):
    assert batch.run_batch(spark, options, *registry)["files"] == 0


def test_batch_and_stream_store_the_same(spark, registry, options, tmp_path):
    lines = [JSON % 5, '{"metrictype": "metric", "timestamp": 6, "field1": 2, "note": ""}\n', '{"metrictype": "metric", "timestamp": 7, "field1": null, "note": "x"}\n', '{"metrictype": "metric", "timestamp": 7, "note": "x"}\n']
    listed(spark, options, [("org1", write(tmp_path / "in/a.json", "".join(lines)))])
    batch.run_batch(spark, options, *registry)
    spark.createDataFrame([("org1", x) for x in lines] + [("", JSON % 9)], "org string, payload string").write.parquet(str(tmp_path / "s"))
    sinks = ingest.StreamSinks(*[str(tmp_path / x) for x in ("raw", "parsed")], options.store, *[str(tmp_path / x) for x in ("malformed", "commit", "checkpoint", "counters")])
    ingest.ingest(ingest.read_payloads(spark, str(tmp_path / "s")), sinks, *registry, write_ms=F.lit(options.run_ms)).awaitTermination()
    store = spark.read.parquet(options.store)  # one store, both paths
    assert store.count() == 8 and V.latest(store).count() == 3
    by_path = {r.n for r in store.groupBy("ts_ms", "id").agg(F.count_distinct(F.substring("run", 1, 5)).alias("n")).collect()}
    assert by_path == {2}
    assert ingest.counts(spark, sinks) == {"handled": 5, "empty": 0, "events": 5, "stored": 4, "failed": 1}
    assert [r.apikey for r in spark.read.option("recursiveFileLookup", True).json(sinks.malformed).collect()] == ["_internal"]  # an empty tenant is none
    # another query on the same sinks starts at batch 0 again and replaces nothing
    sinks.checkpoint = str(tmp_path / "checkpoint2")
    ingest.ingest(ingest.read_payloads(spark, str(tmp_path / "s")), sinks, *registry, write_ms=F.lit(options.run_ms)).awaitTermination()
    assert spark.read.option("recursiveFileLookup", True).parquet(sinks.raw).count() == 10 and spark.read.parquet(options.store).count() == 12


def test_store_reads_back_in_types_and_user_names(spark, registry, options, tmp_path):
    text = '{"metrictype": "alias1", "timestamp": 5, "other": 7, "late": "8"}\n{"metrictype": "sensor", "timestamp": 6, "measurement": 1.5, "unit": ""}\n'
    listed(spark, options, [("org1", write(tmp_path / "in/a.json", text))])
    batch.run_batch(spark, options, *registry)
    store = spark.read.parquet(options.store)
    (row,) = V.scan_decoded(store, *registry, "org1", "alias1", 0, 10).collect()
    assert (row.ts_ms, row.f1, row.unknown) == (5, 7, {"late": "8"})
    (row,) = V.scan_decoded(store, *registry, "org1", "sensor", 0, 10, user_names=True).collect()
    assert (row.measurement, row.unit) == (1.5, None)
    assert V.scan_decoded(store, *registry, "org1", "nothing", 0, 10).count() == 0


def test_gates_on_events_and_requests(spark, registry, tmp_path):
    large = json.dumps({"metrictype": "metric", "timestamp": 1, "text": "x" * gates.MOST_EVENT_BYTES})
    found = C.conform(spark.createDataFrame([("org1", large, {"metrictype": "metric", "timestamp": "1", "text": "x" * gates.MOST_EVENT_BYTES})], "org string, payload string, fields map<string,string>"), *registry)
    assert "too large" in found.first().error.message
    event = {"metrictype": "metric", "timestamp": 1}
    requests_ = [{"customerKey": "org1", "event": event}, {"customerKey": "org1", "events": [event] * 501}, {"customerKey": "org1", "events": [event, event]}, {"event": event}]
    batch_ = spark.createDataFrame([(None, json.dumps(r)) for r in requests_] + [(None, "oops")], "org string, payload string")
    rows = ingest.process(batch_, *registry, requests=True).collect()
    assert sum(r.error is None for r in rows) == 3
    assert sorted(r.error.message.rpartition(": ")[2] for r in rows if r.error) == ["no tenant", "no tenant", "request over the limits"]


def test_etl_run_again_archives_and_reports(spark, registry, tmp_path):
    options = etl.EtlOptions(*[str(tmp_path / x) for x in ("staged", "known", "unknown", "completed", "reports")])
    assert etl.run_etl(spark, options, registry[1]) == {"known": {"groups": 0, "rows": 0}, "unknown": {"groups": 0, "rows": 0}}
    rows = lambda ts: spark.createDataFrame([("org1", "m1", ts, {"f1": "3"}, {"late": "7"})], etl.STAGED).coalesce(1)
    rows(10).write.parquet(options.staged)
    keep = etl.EtlOptions(options.staged, options.known, options.unknown)
    for _ in range(2):
        etl.run_etl(spark, keep, registry[1])  # a repetition
    read = lambda: A.read_known(spark, options.known, "org1", "m1", "1969-12-31", "1970-01-02")
    assert read().count() == 1 and A.read_unknown(spark, options.unknown, "1969-12-31", "1970-01-02").count() == 1
    etl.run_etl(spark, options, registry[1], run_ms=7)
    assert read().count() == 1 and len(list((tmp_path / "completed/7").rglob("*.parquet"))) == 1 and not list((tmp_path / "staged").rglob("*.parquet"))
    (report,) = [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", True).text(options.reports).collect()]
    assert report["known"]["rows"] == 1 and report["files"] == 1
    rows(20).write.mode("append").parquet(options.staged)  # new records of the same day
    etl.run_etl(spark, options, registry[1], run_ms=8)
    assert [r.ts_ms for r in read().collect()] == [10, 20]
