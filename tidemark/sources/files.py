"""Event files: discovery, format by name, JSON and CSV lines and JSON lists as maps."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import folders
from tidemark.sources.requests import fields_of

FOUND = "org string, file string, path string, location string, size long"
LINES = "payload string, path string, fields map<string,string>"
#: Bytes that are read of a file at once, characters of an element of a JSON list, rows and characters of a batch.
CHUNK, MOST_ELEMENT, BATCH_ROWS, BATCH_CHARS = 1 << 20, 64 << 20, 1_000, 4 << 20
#: Tasks that read files which Spark's own readers don't; bytes that one of them reads, and what opening a file counts for, as in those.
MOST_TASKS, TASK_BYTES, OPEN_BYTES = 10_000, 128 << 20, 4 << 20


def literal(path: str) -> str:
    """A path for a reader that takes patterns: the signs of patterns stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def plain_location(location: str) -> str:
    """One form for local files, which listings and readers write with one slash or three."""
    return re.sub("^file:/+", "file:/", location)


def hidden(path: str) -> bool:
    """Whether Spark's readers pass over a file for its name, even if it is asked for."""
    return path.rstrip("/").rpartition("/")[2].startswith(("_", "."))


def format_of(path: Column) -> Column:
    """csv for .csv and .csv.gz, json-array for .json-array and .json-array.gz, json for all else."""
    named = lambda ending: F.regexp_like(path, F.lit(rf"\.{ending}(\.gz)?$"))
    return F.when(named("csv"), F.lit("csv")).when(named("json-array"), F.lit("json-array")).otherwise(F.lit("json"))


def discover(spark: SparkSession, pending: list[tuple[str, str]], scheme: str = "file:") -> tuple[DataFrame, DataFrame]:
    """Files under every pending entry (org, path), and the entries that don't exist with the reason.

    Every file counts, those in hidden folders and with hidden names as well. Only names and sizes are read, an entry at a time.
    ``path`` is what a reader takes, ``location`` what rows carry as ``_metadata.file_path``, where some signs are
    encoded. A file that two entries name has a row for each.
    """
    locations = [entry if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", entry) else scheme + entry for _, entry in pending]
    with ThreadPoolExecutor(16) as pool:
        listed = list(pool.map(lambda location: folders.files(spark, location), locations))
    failed = [(org, entry, f"PATH_NOT_FOUND: {where}") for (org, entry), where, files in zip(pending, locations, listed) if files is None]
    found = [(org, entry, path, plain_location(location), size) for (org, entry), files in zip(pending, listed) for path, location, size in files or []]
    return spark.createDataFrame(found, FOUND), spark.createDataFrame(failed, "org string, file string, message string")


# ---- files that Spark's readers don't read, or only whole ----


def _store_of(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path, and its name there."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@+,;=&$!*'()"))


def _opened(path: str) -> pa.NativeFile:
    """A file as a stream, unpacked if its name says so."""
    store, name = _store_of(path)
    return store.open_input_stream(name)


def write_each(rows: DataFrame, path: str) -> int:
    """Writes each of ``rows`` (name, value) as a file of its own below a folder; how many.

    Different rows have different names, so a task that is repeated writes its own files again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store_of(path)
        made: set[str] = set()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = f"{root}/{name}".rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(value.encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism  # costs are by file and not by byte
    return rows.select("name", "value").repartition(tasks, "name").mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def tasks_for(sizes: list[int], least: int = 1) -> int:
    """Tasks for files of these sizes: one for each large file, and small ones together, as many as Spark's own readers would take."""
    by_bytes = -(-sum(size + OPEN_BYTES for size in sizes) // TASK_BYTES)
    return max(1, min(len(sizes), MOST_TASKS, max(least, by_bytes)))


def _streamed(
    spark: SparkSession, paths: list[str], rows_of: Callable[[pa.NativeFile], Iterator[tuple]], kinds: str, schema: pa.Schema, sizes: dict[str, int] | None = None
) -> DataFrame:
    """Rows (location, then what ``rows_of`` gives) of files that are streamed, each by one task, which has several if they are small.

    A file without a known size counts as a large one.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, location in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, chars = [], 0
                with _opened(path) as stream:
                    for row in rows_of(stream):
                        held.append((location, *row))
                        chars += len(row[0])
                        if len(held) == BATCH_ROWS or chars >= BATCH_CHARS:
                            yield _batch(held, schema)
                            held, chars = [], 0
                if held:
                    yield _batch(held, schema)

    encoded = [folders.encoded(spark, p) for p in sorted(paths)]  # as other rows carry it
    names = spark.createDataFrame(list(zip(sorted(paths), encoded)), "path string, location string")
    tasks = tasks_for([(sizes or {}).get(p, TASK_BYTES) for p in paths], 4 * spark.sparkContext.defaultParallelism)
    return names.repartitionByRange(tasks, "path").mapInArrow(read, kinds)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def text_lines(stream: Iterable) -> Iterator[tuple[str, int]]:
    """The lines of a stream and their numbers."""
    decoder, rest, n = codecs.getincrementaldecoder("utf-8")("replace"), "", 0
    for chunk in iter(lambda: stream.read(CHUNK), b""):
        *lines, rest = (rest + decoder.decode(chunk)).split("\n")
        for line in lines:
            yield line.removesuffix("\r"), n
            n += 1
    if rest:
        yield rest.removesuffix("\r"), n


def list_elements(stream: Iterable) -> Iterator[tuple[str, list[tuple[str, str | None]] | None]]:
    """Text and fields of each element of a stream that is one JSON list; what is no object has no fields.

    Only the element being read is held. What can't be read ends the list, as one element without fields.
    """
    decoder, parser = codecs.getincrementaldecoder("utf-8")("replace"), json.JSONDecoder()
    buffer, begun, wanted = "", False, 0
    while True:
        chunk = stream.read(CHUNK)
        buffer += decoder.decode(chunk, final=not chunk)
        if chunk and len(buffer) < wanted:
            continue
        at = 0
        while True:
            at = re.compile(r"[\s,]*" if begun else r"[\s\ufeff]*").match(buffer, at).end()
            if at == len(buffer):
                break
            if not begun and buffer[at] == "[":
                begun, at = True, at + 1
                continue
            if begun and buffer[at] == "]":
                return
            try:
                value, end = parser.raw_decode(buffer, at)
            except ValueError:
                break
            if not begun or (end == len(buffer) and chunk and not isinstance(value, (dict, list, str))):
                break  # no list, or a number that may go on
            fields = list(fields_of(value).items()) if isinstance(value, dict) else None
            yield buffer[at:end], fields
            at = end
        buffer = buffer[at:]
        if not chunk or len(buffer) > MOST_ELEMENT or (buffer and not begun):
            if buffer.strip():
                yield buffer, None
            return
        wanted = 2 * len(buffer)  # an element that goes on is not tried again for each chunk


def _lines(spark: SparkSession, paths: list[str], sizes: dict[str, int] | None = None) -> DataFrame:
    """value, path, start (of the block), n (grows inside a block) of every line."""
    seen, others = [p for p in paths if not hidden(p)], [p for p in paths if hidden(p)]
    frames = []
    if seen:
        text = spark.read.text([literal(p) for p in seen])
        frames.append(text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")))
    if others:
        schema = pa.schema([("path", pa.string()), ("value", pa.string()), ("n", pa.int64())])
        streamed = _streamed(spark, others, text_lines, "path string, value string, n long", schema, sizes)
        frames.append(streamed.select("value", "path", F.lit(0).cast("long").alias("start"), "n"))
    lines = frames[0].unionByName(frames[1]) if len(frames) > 1 else frames[0]
    return lines.where(F.length(F.trim("value")) > 0)


# ---- readers ----


def read_json(spark: SparkSession, paths: list[str], sizes: dict[str, int] | None = None) -> DataFrame:
    """payload, fields, path of every line, plain or compressed; a line that is no object has null fields."""
    return _lines(spark, paths, sizes).select(F.col("value").alias("payload"), "path", F.from_json("value", "map<string,string>").alias("fields"))


def cells(line: Column) -> Column:
    """The cells of a CSV line as an array: empty ones are null, quoted ones lose their quotes; a quote inside is doubled or behind a backslash."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"\\]|\\.|"")*"|[^,]*)'), F.lit(1))
    inner = lambda c: F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r'\\"|""', '"')
    return F.transform(raw, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), inner(c)).otherwise(F.nullif(c, F.lit(""))))


def headers(lines: DataFrame) -> DataFrame:
    """path, head of each file: its first line, from first blocks only."""
    return lines.where("start = 0").groupBy("path").agg(F.min_by("value", "n").alias("head"))


def read_csv(spark: SparkSession, paths: list[str], sizes: dict[str, int] | None = None) -> DataFrame:
    """The same for CSV with a header, in one scan for any number of headers: values stay text, by the names of their own file's header.

    A line equal to the header is none, and a line is a row (no line breaks in quotes). Columns without a name, or with that
    of one before, are named by their place as well; cells beyond the header are dropped.
    """
    lines = _lines(spark, paths, sizes)
    found = headers(lines).collect()  # names and headers of files
    if not found:
        return spark.createDataFrame([], LINES)
    named = spark.createDataFrame([(r.path, r.head) for r in found], "path string, head string").withColumn("names", cells(F.col("head")))
    named = named.withColumn("names", F.transform("names", lambda c, i: F.coalesce(c, F.concat(F.lit("_c"), i.cast("string")))))
    once = F.transform("names", lambda c, i: F.when(F.array_contains(F.slice("names", 1, i), c), F.concat(c, i.cast("string"))).otherwise(c))
    rows = lines.join(named.withColumn("names", once), "path").where("value <> head")
    pairs = F.zip_with("names", cells(F.col("value")), lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    fields = F.map_from_entries(F.filter(pairs, lambda p: p["key"].isNotNull() & p["value"].isNotNull()))
    return rows.withColumn("fields", fields).select(F.to_json("fields").alias("payload"), "path", "fields")


def read_json_list(spark: SparkSession, paths: list[str], sizes: dict[str, int] | None = None) -> DataFrame:
    """The same for files that are one JSON list each, of any size: a file is streamed, and only one element of it held."""
    schema = pa.schema([("path", pa.string()), ("payload", pa.string()), ("fields", pa.map_(pa.string(), pa.string()))])
    return _streamed(spark, paths, list_elements, "path string, payload string, fields map<string,string>", schema, sizes).select("payload", "path", "fields")


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """fields of every event of a file, or of all files of a folder, that are one JSON list each."""
    files = {p: size for p, _, size in folders.files(spark, path) or []}
    return read_json_list(spark, list(files), files).select("fields") if files else spark.createDataFrame([], "fields map<string,string>")


def _location(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


READERS: dict[str, Callable[..., DataFrame]] = {"json": read_json, "csv": read_csv, "json-array": read_json_list}


def read_events(spark: SparkSession, found: DataFrame, readers: dict[str, Callable] | None = None) -> DataFrame:
    """org, payload, fields of every line of the ``found`` files: one read a format, tenants joined by location.

    A line of a file that no entry names keeps a null org, so it ends up as a dead letter and is not lost.
    """
    own = readers or {}
    listed = found.select("path", "size", format_of(F.col("path")).alias("format")).distinct().collect()  # names only, as Spark's own listing
    sizes = {r.path: r["size"] for r in listed}
    frames = []
    for kind in sorted({r.format for r in listed}):
        paths = sorted({r.path for r in listed if r.format == kind})
        frames.append((own[kind](spark, paths) if kind in own else READERS[kind](spark, paths, sizes)).select("payload", "fields", "path"))
    if not frames:
        return spark.createDataFrame([], "org string, payload string, fields map<string,string>")
    lines = frames[0]
    for frame in frames[1:]:
        lines = lines.unionByName(frame)
    orgs = found.select("org", "location").distinct()
    return lines.withColumn("location", _location(F.col("path"))).join(orgs, "location", "left").select("org", "payload", "fields")
