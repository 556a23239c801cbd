"""A WARC writer whose archives depend on the records alone, and their reader.

Each record is a gzip member of its own, so its compressed size doesn't depend on its neighbours. Records are ordered
by page_id, url and digest; files roll where the bytes of all records before, summed over that order, pass a
multiple of ``roll_bytes``. The sum is made of the sums of ranges, which Spark sorts apart, so neither the
number of tasks nor where they are cut changes a byte of any file. Headers and digests are made anew from
the payload. Of equal payloads of at least ``LEAST`` bytes the first in that order is kept; the others are revisits of it.

A task writes a file under a temporary name; only what succeeded tasks report is moved to its final name, and the
manifest, which readers go by, appears last, by a rename. A run that broke off leaves nothing readable, and its
repetition replaces what it left. Files are streamed both ways: a task holds a batch of records, never a file. Files are opened with
``pyarrow.fs``, so the folder may be on any store that it and Spark both know.

Edge cases: null html is an empty payload; a null url is named by the page's number; a null page_id comes last, and counts
as a page of its own for each url; of rows equal in page, url and payload the first is the response and the others are revisits of it (below ``LEAST``
bytes all are responses), each under an id of its own; line breaks in urls are encoded; an empty table gives a manifest without files;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, maybe_broadcast, staged

#: Payloads below this are never revisits: the record would be longer than the payload.
LEAST = 100
#: Compressed bytes after which a file rolls.
ROLL_BYTES = 64 << 20
#: Compression level of members, and the date that all records carry.
LEVEL, DATE = 6, "1970-01-01T00:00:00Z"
#: Bytes of records that a reader's batch holds, besides the last one.
BATCH_BYTES = 4 << 20
CHUNK = 1 << 20

MANIFEST = "file long, temporary string, name string, records long, bytes long, sha256 string"
RECORD = "name string, record_id string, record_type string, page_id long, url string, refers_to_id string, payload_digest string, payload_bytes long"
KEY = ["no_id", "page_id", "url", "digest"]


# ---- records ----


def gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # a gzip member without a time
    return packer.compress(data) + packer.flush()


def named_id(*parts: object) -> str:
    """A record's id, from what it is."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16])}>"


def target_uri(page_id: int | None, url: str) -> str:
    """The url without what would end a header line."""
    return quote(url, safe="".join(chr(c) for c in range(33, 127))) if url else f"urn:page:{'' if page_id is None else page_id}"


def member(kind: str, record_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}", *[f"{k}: {v}" for k, v in fields]]
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    return gzipped("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _http(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _page_fields(page_id: int | None, url: str, digest: str) -> list[tuple[str, str]]:
    fields = [("WARC-Target-URI", target_uri(page_id, url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    return fields if page_id is None else [*fields, ("Page-ID", str(page_id))]


def response(page_id: int | None, url: str, digest: str, payload: bytes, copy: int = 0) -> bytes:
    return member("response", named_id("response", page_id, url, digest, copy), _page_fields(page_id, url, digest), _http(len(payload)) + payload)


def revisit(page_id: int | None, url: str, digest: str, length: int, first_page: int | None, first_url: str, copy: int = 0) -> bytes:
    fields = _page_fields(page_id, url, digest)
    fields += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", named_id("response", first_page, first_url, digest, 0)),
        ("WARC-Refers-To-Target-URI", target_uri(first_page, first_url)),
        ("WARC-Refers-To-Date", DATE),
    ]
    return member("revisit", named_id("revisit", page_id, url, digest, copy), fields, _http(length))


def warcinfo(name: str) -> bytes:
    return member("warcinfo", named_id("warcinfo", name), [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"software: tidemark\r\nformat: WARC File Format 1.1\r\n")


def members_of(stream: Iterable[bytes]) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one at a time."""
    unpacker, parts, begun = zlib.decompressobj(31), [], False
    for chunk in stream:
        while chunk:
            begun = True
            parts.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts, begun = zlib.decompressobj(31), [], False
            else:
                break
    if begun:
        raise ValueError("the archive ends inside a record")


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record, by lower-case name, and its block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["warc-block-digest"]:
        raise ValueError(f"record {fields.get('warc-record-id')} is damaged")
    return fields, block


# ---- writing ----


def _packed(pages: DataFrame, whole: bool) -> DataFrame:
    """page_id, url, digest, n and size, or with ``whole`` packed: every page as a response record. Nothing but the row decides its bytes."""
    chosen = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        F.coalesce(pages["url"].cast("string"), F.lit("")).alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary").alias("payload"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload in zip(*(batch.column(c) for c in ("page_id", "url", "payload"))):
                page_id, url, payload = page_id.as_py(), url.as_py(), payload.as_py()
                digest = hashlib.sha256(payload).hexdigest()
                record = response(page_id, url, digest, payload)
                out.append((digest, len(payload), record if whole else len(record)))
            digests, lengths, last = zip(*out) if out else ((), (), ())
            columns = [pa.array(digests, pa.string()), pa.array(lengths, pa.int64()), pa.array(last, pa.binary() if whole else pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *columns], ["page_id", "url", "digest", "n", "packed" if whole else "size"])

    return _ordered(chosen.mapInArrow(pack, "page_id long, url string, digest string, n long, " + ("packed binary" if whole else "size long")))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("no_id", F.col("page_id").isNull())


def with_first(slim: DataFrame, least: int) -> DataFrame:
    """``slim`` with first_page and first_url, and has_first: which record of equal payloads stays; only where there are several."""
    repeated = slim.where(F.col("n") >= least).groupBy("digest").agg(F.min(F.struct("no_id", "page_id", "url")).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    firsts = repeated.select("digest", F.col("first.page_id").alias("first_page"), F.col("first.url").alias("first_url"), F.lit(True).alias("has_first"))
    return slim.join(maybe_broadcast(firsts), "digest", "left").withColumn("has_first", F.coalesce("has_first", F.lit(False)))


class Sequence:
    """Numbers the rows of one key as they come in order, and tells which of them are revisits."""

    def __init__(self) -> None:
        self.last: tuple | None = None
        self.copy = 0

    def next(self, key: tuple) -> int:
        self.copy = self.copy + 1 if key == self.last else 0
        self.last = key
        return self.copy


def _again(page_id: int | None, url: str, copy: int, has_first: bool, first_page: int | None, first_url: str | None) -> bool:
    return has_first and (copy > 0 or (first_page, first_url) != (page_id, url))


def boundaries(spark: SparkSession, slim: DataFrame, roll_bytes: int) -> tuple[list[int], list[tuple]]:
    """The files' numbers and the keys they begin with: one of each for every ``roll_bytes`` of the archive."""
    names = [*KEY, "start", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, rows = 0, Sequence()
        for batch in batches:
            starts, sizes = [], []
            columns = [batch.column(c).to_pylist() for c in (*KEY, "n", "size", "has_first", "first_page", "first_url")]
            for no_id, page_id, url, digest, n, size, *first in zip(*columns):
                copy = rows.next((no_id, page_id, url, digest))
                if _again(page_id, url, copy, *first):
                    size = len(revisit(page_id, url, digest, n, *first[1:], copy))
                starts.append(start)
                sizes.append(size)
                start += size
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in KEY], pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names)

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = slim.repartitionByRange(ranges, *KEY).sortWithinPartitions(*KEY)
    kinds = "no_id boolean, page_id long, url string, digest string, start long, size long"
    sized = staged(spark, ordered.mapInArrow(run, kinds).withColumn("part", F.spark_partition_id()), "warc-sizes")
    totals = sized.groupBy("part").agg(F.sum("size").alias("total")).orderBy("part").collect()  # one row a task
    before, offsets = 0, []
    for row in totals:
        offsets.append((row.part, before))
        before += row.total
    known = F.broadcast(spark.createDataFrame(offsets, "part int, offset long"))
    numbered = sized.join(known, "part").withColumn("file", F.floor((F.col("offset") + F.col("start")) / roll_bytes))
    begins = numbered.groupBy("file").agg(F.min(F.struct(*KEY)).alias("key")).orderBy("file").collect()  # one row a file
    return [r.file for r in begins], [_comparable(*r.key) for r in begins]


def _comparable(no_id: bool, page_id: int | None, url: str, digest: str) -> tuple:
    return no_id, page_id or 0, url, digest


def _file_of(files: list[int], keys: list[tuple]):
    @F.pandas_udf("long")
    def of(no_id, page_id, url, digest):
        rows = zip(no_id, page_id.fillna(0).astype("int64"), url, digest)
        return type(url)([files[bisect.bisect_right(keys, row) - 1] for row in rows], dtype="int64")

    return of(*[F.col(k) for k in KEY])


def file_name(file: int) -> str:
    return f"part-{file:08d}.warc.gz"


def _written(rows: DataFrame, root: str) -> DataFrame:
    """Writes each file's rows, which come in order, under a temporary name; a manifest row for each file."""
    fields = ["file", "temporary", "name", "records", "bytes", "sha256"]
    columns = ["file", *KEY, "n", "packed", "has_first", "first_page", "first_url"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(root)
        store.create_dir(f"{base}/_temporary", recursive=True)
        current, sink, entry, digest, sequence, first = None, None, {}, None, Sequence(), None

        def put(data: bytes) -> None:
            sink.write(data)
            digest.update(data)
            entry["records"] += 1
            entry["bytes"] += len(data)

        def closed() -> pa.RecordBatch:
            sink.close()
            entry["sha256"] = digest.hexdigest()
            return pa.RecordBatch.from_pylist([{f: entry[f] for f in fields}])

        for batch in batches:
            for file, no_id, page_id, url, key_digest, n, packed, *known in zip(*(batch.column(c) for c in columns)):
                file, no_id, page_id, url, key_digest = file.as_py(), no_id.as_py(), page_id.as_py(), url.as_py(), key_digest.as_py()
                if file != current:
                    if sink is not None:
                        yield closed()
                    name = file_name(file)
                    current, entry, digest = file, {"file": file, "temporary": f"{uuid.uuid4().hex}.warc.gz", "name": name, "records": 0, "bytes": 0}, hashlib.sha256()
                    sink = store.open_output_stream(f"{base}/_temporary/{entry['temporary']}", compression=None)
                    put(warcinfo(name))
                key, packed = (no_id, page_id, url, key_digest), packed.as_py()
                if packed is None:  # comes before the records of its key
                    first = (key, [k.as_py() for k in known])
                    continue
                copy = sequence.next(key)
                about = first[1] if first is not None and first[0] == key else [False, None, None]
                if _again(page_id, url, copy, *about):
                    packed = revisit(page_id, url, key_digest, n.as_py(), *about[1:], copy)
                elif copy:  # too short for a revisit: the same response under another id
                    payload = parsed(next(members_of([packed])))[1].partition(b"\r\n\r\n")[2]
                    packed = response(page_id, url, key_digest, payload, copy)
                put(packed)
        if sink is not None:
            yield closed()

    return rows.select(*columns).mapInArrow(write, MANIFEST)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, root: str) -> None:
    """Moves the files that the pending manifest names to their final names, by tasks, and then the manifest."""
    pending, system = _hadoop_path(spark, f"{root}/_manifest")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{base}/_temporary/{row['temporary']}", f"{base}/{row['name']}"
                if store.get_file_info(source).type != pyarrow.fs.FileType.NotFound:  # else a lost task has moved it
                    if store.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
                        store.delete_file(target)
                    store.move(source, target)
                found = store.get_file_info(target)
                if found.size != row["bytes"]:
                    raise OSError(f"{target} has {found.size} bytes instead of {row['bytes']}")
            yield batch.select(["name"])

    spark.read.schema(MANIFEST).json(f"{root}/_manifest").mapInArrow(move, "name string").count()
    final, _ = _hadoop_path(spark, f"{root}/manifest")
    if not system.rename(pending, final):
        raise OSError(f"{root}/_manifest can't be renamed")
    temporary, _ = _hadoop_path(spark, f"{root}/_temporary")
    system.delete(temporary, True)


def write_archive(spark: SparkSession, pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, least: int = LEAST) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC files under ``root`` and returns their manifest. A folder takes one archive."""
    final, system = _hadoop_path(spark, f"{root}/manifest")
    if system.exists(final):
        raise FileExistsError(f"{root} has an archive")
    bounded_batches(spark)
    index = staged(spark, _packed(pages, whole=False), "warc-index")
    slim = staged(spark, with_first(index, least), "warc-firsts")
    files, keys = boundaries(spark, slim, roll_bytes)
    heads = slim.where("has_first").select(*KEY, "n", "has_first", "first_page", "first_url", F.lit(None).cast("binary").alias("packed"))
    # records are packed again, as they would take the disk of a third archive
    every = _packed(pages, whole=True).unionByName(heads, allowMissingColumns=True)
    if files:
        dealt = every.withColumn("file", _file_of(files, keys)).repartition(len(files), "file")
        # a key's head comes before its records
        ordered = dealt.sortWithinPartitions("file", *KEY, F.col("packed").isNotNull())
        _written(ordered, root).write.mode("overwrite").json(f"{root}/_manifest")
    else:
        spark.createDataFrame([], MANIFEST).write.mode("overwrite").json(f"{root}/_manifest")
    committed(spark, root)
    return manifest(spark, root)


# ---- reading ----


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{root}/manifest")


def read_archive(spark: SparkSession, root: str, payloads: bool = False) -> DataFrame:
    """The records of the files in the manifest: name, record_id, record_type, page_id, url, refers_to_id, payload_digest, payload_bytes.

    Blocks and payloads are checked against their digests. A revisit has no payload of its own: null bytes here. With
    ``payloads`` there is a column payload as well.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(root)
        schema = pa.schema([("name", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to_id", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])
        schema = schema.append(pa.field("payload", pa.binary())) if payloads else schema
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for record in members_of(iter(lambda: stream.read(CHUNK), b"")):
                        fields, block = parsed(record)
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(_row(name, fields, block))
                        held += len(block) if payloads else 0
                        if len(rows) == 1_000 or held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    names = manifest(spark, root).select("name")
    files = max(1, names.count())
    kinds = RECORD + (", payload binary" if payloads else "")
    return names.repartitionByRange(files, "name").mapInArrow(read, kinds)


def _row(name: str, fields: dict[str, str], block: bytes) -> dict:
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    page = fields.get("page-id")
    return {
        "name": name, "record_id": fields["warc-record-id"], "record_type": kind, "page_id": None if page is None else int(page), "url": fields["warc-target-uri"],
        "refers_to_id": fields.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": None if payload is None else len(payload), "payload": payload,
    }


def resolved(spark: SparkSession, records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id): revisits take their payload's size
    from the record they refer to, which must be there with the same digest; and the payload, if the records have it.
    """
    extra = [c for c in ("payload",) if c in records.columns]
    rows = staged(spark, records.select("record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to_id", *extra), "warc-read")
    whole = rows.where("record_type = 'response'")
    held = whole.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("held_digest"), *extra)
    again = rows.where("record_type = 'revisit'").drop("payload_bytes", *extra).join(held, "refers_to_id", "left")
    digest = _or_error(F.col("held_digest").eqNullSafe(F.col("payload_digest")), F.col("payload_digest"), "a revisit refers to no record of its payload")
    again = again.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", *extra)
    return whole.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), *extra).unionByName(again)


def _or_error(condition: Column, value: Column, message: str) -> Column:
    return F.when(condition, value).otherwise(F.raise_error(message).cast("string"))
