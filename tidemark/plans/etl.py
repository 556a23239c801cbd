"""The archive ETL: staged records -> known rows as Parquet, unknown rows as JSON."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import archive as A
from tidemark.plans.maintenance import archive_inputs
from tidemark.sources.files import plain_location
from tidemark.sources.folders import exists, matching, remove

STAGED = "org string, metric_id string, ts_ms long, known map<string,string>, unknown map<string,string>"
#: Which run took a staged file, and which runs have written all their rows.
LOG = "run string, file string, done boolean"
#: Version and format of what is written; with ``versioned`` a level of the output paths each.
VERSION, FORMATS = "0", {"known": "parquet", "unknown": "json"}


@dataclass
class EtlOptions:
    """Folders of the job: staged records, known and unknown rows.

    ``completed``: where the staged files go after all rows are written. ``reports``: where a run leaves its report.
    ``log``: where the runs are noted (beside the known rows if it isn't given). ``versioned``: whether what is written
    goes below ``<folder>/<version>/<format>``, so that a later form can stand beside it.
    """

    staged: str
    known: str
    unknown: str
    completed: str | None = None
    reports: str | None = None
    log: str | None = None
    versioned: bool = False

    def folder(self, kind: str) -> str:
        """Where the known or unknown rows are."""
        root = getattr(self, kind)
        return f"{root}/{VERSION}/{FORMATS[kind]}" if self.versioned else root

    @property
    def runs(self) -> str:
        return self.log or f"{self.known.rstrip('/')}-runs"


class RowsMissing(Exception):
    """What was written is not what was to be written."""


def promoted(records: DataFrame, fields: DataFrame) -> DataFrame:
    """Unknown entries whose name became a field's since move to ``known``, if they fit its type.

    A known value is never replaced; of several aliases the first in the registry's list counts.
    """
    ranked = fields.select("org", "metric_id", "field_id", schema.type_name().alias("type"), F.posexplode(F.concat(F.array("field_id", "display_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("rank", "alias"))
    per_metric = ranked.groupBy("org", "metric_id").agg(F.array_sort(F.collect_list(F.struct("field_id", "rank", "alias", "type"))).alias("names"))
    joined = records.join(per_metric, ["org", "metric_id"], "left")
    usable = F.filter(
        F.coalesce("names", F.array().cast("array<struct<field_id:string,rank:int,alias:string,type:string>>")),
        lambda n: F.try_element_at("unknown", n["alias"]).isNotNull()
        & F.try_element_at("known", n["field_id"]).isNull()
        & schema.fits(F.try_element_at("unknown", n["alias"]), n["type"]),
    )
    first = F.filter(F.col("usable"), lambda n, i: ~F.exists(F.slice("usable", 1, i), lambda x: x["field_id"] == n["field_id"]))
    new = F.map_from_entries(F.transform("first", lambda n: F.struct(n["field_id"], F.element_at("unknown", n["alias"]))))
    taken = F.transform("first", lambda n: n["alias"])
    out = joined.withColumn("usable", usable).withColumn("first", first)
    old = F.map_filter("known", lambda k, v: ~F.exists("first", lambda n: n["field_id"] == k))
    return out.withColumns({"known": F.map_concat(old, new), "unknown": F.map_filter("unknown", lambda k, v: ~F.array_contains(taken, k))}).drop("names", "usable", "first")


def _noted(spark: SparkSession, options: EtlOptions) -> tuple[dict[str, str], set[str]]:
    """The run of each file that a run took, and the runs that are done: names only."""
    if not exists(spark, options.runs):
        return {}, set()
    rows = spark.read.schema(LOG).json(options.runs).collect()
    return {r.file: r.run for r in rows if not r.done}, {r.run for r in rows if r.done}


def _note(spark: SparkSession, options: EtlOptions, rows: list[tuple[str, str | None, bool]]) -> None:
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").json(options.runs)


def _forget(spark: SparkSession, root: str, run: str) -> None:
    """Removes what an earlier attempt of a run left: partitions of three levels, date among them, and the run."""
    remove(spark, matching(spark, f"{root}/*/*/*/run={run}"))


def run_etl(spark: SparkSession, options: EtlOptions, fields: DataFrame, run_ms: int = 0) -> dict:
    """Distinct staged records by metric, tenant and day: one write for all known rows, one for all unknown entries.

    A run is a set of staged files, noted before anything is written, so a file keeps its run: what broke off is repeated
    under the same name and replaces its own rows, and files that came since are another run of the same job. When all
    rows are there, which is counted, the run is noted as done and its files move away; a done run whose files
    moved in part only goes on moving. No staged file is no work.
    """
    nothing = {"known": {"groups": 0, "rows": 0}, "unknown": {"groups": 0, "rows": 0}}
    if not exists(spark, options.staged):
        return nothing
    source = spark.read.schema(STAGED).parquet(options.staged)
    staged = sorted(plain_location(unquote(f)) for f in source.inputFiles())
    taken, done = _noted(spark, options)
    files_of: dict[str, list[str]] = {}
    for file, run in taken.items():
        files_of.setdefault(run, []).append(file)
    listed = set(staged)
    moving = {run for run in done if not set(files_of.get(run, [])) <= listed}
    rest = [f for f in staged if taken.get(f) in moving]
    if options.completed and rest:
        archive_inputs(spark, rest, options.completed, run_ms)
    new = [f for f in staged if f not in taken]
    if new:
        run = uuid.uuid4().hex
        _note(spark, options, [(run, f, False) for f in new])
        taken |= dict.fromkeys(new, run)
    files = [f for f in staged if taken[f] not in moving]
    if not files:
        return nothing
    runs = sorted({taken[f] for f in files})
    for run in set(runs) & set(files_of):
        _forget(spark, options.folder("known"), run)
        _forget(spark, options.folder("unknown"), run)
    named = spark.createDataFrame([(f, taken[f]) for f in files], "file string, run string")
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    located = source.withColumn("file", F.regexp_replace(path, "^file:/+", "file:/"))
    whole = promoted(A.distinct_records(located.join(named, "file").drop("file")), fields).persist()
    try:
        A.write_known(whole, fields, options.folder("known"))
        A.write_unknown(whole, options.folder("unknown"))
        counted = A.key_list(whole).groupBy("is_unknown").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).collect()
    finally:
        whole.unpersist()
    report = nothing | {("unknown" if r.is_unknown else "known"): {"groups": r.groups, "rows": r.rows} for r in counted}
    for kind, format_ in FORMATS.items():
        wrote = _written(spark, options.folder(kind), format_, runs)
        if wrote != report[kind]["rows"]:
            raise RowsMissing(f"{wrote} {kind} rows of {report[kind]['rows']} are there; the staged files stay")
    _note(spark, options, [(run, None, True) for run in runs if run not in done])
    if options.reports:
        write_report(spark, report | {"runs": runs, "files": len(files)}, f"{options.reports}/run={runs[-1] if len(runs) == 1 else run_ms}")
    if options.completed:
        archive_inputs(spark, files, options.completed, run_ms)
    return report


def _written(spark: SparkSession, root: str, kind: str, runs: list[str]) -> int:
    """The rows that the runs have in a folder, by what is there."""
    if not exists(spark, root):
        return 0
    stored = spark.read.schema("ts_ms long, run string").format(kind).load(root)
    return stored.where(F.col("run").isin(runs)).count()


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A small JSON file next to the data; a repetition replaces it."""
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
