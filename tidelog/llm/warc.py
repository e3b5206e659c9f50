"""WARC archives as a PySpark data source.

Writing: a gzip member per record, files of bounded size, a manifest of the files of tasks that committed; what a lost
task wrote is never read. Reading: a partition per file or bundle of small files. Conditions on record type and
header columns are pushed down and settled on the header; the payload of a record they rule out is passed over, not
decoded, and with ``payload=false`` so is every payload.

Archives are opened with pyarrow's file systems, so the folder must be one that all executors reach that way (a
shared file system, HDFS with its client library, or an object store).
"""

from __future__ import annotations

import gzip
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from io import BufferedReader

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from tidelog.llm.common import forget_at_exit
from tidelog.session import scratch_path

#: Column and its header.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "WARC-Payload-Length",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"
#: Uncompressed bytes after which a task begins another file; bytes of files read by one task; of records handed over at once.
FILE_BYTES, BUNDLE_BYTES, BATCH_BYTES = 256 << 20, 32 << 20, 8 << 20
MANIFEST = "_manifest.json"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_bytes(values: dict) -> bytes:
    """One record. Line ends in header values are written as %0D and %0A; null headers are left out."""
    payload = values["payload"]
    block = b"" if payload is None else _HTTP % len(payload) + payload
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = values.get(column)
        if column == "content_type":
            value = value or "application/http; msgtype=response"
        if value is not None:
            lines.append(f"{header}: {str(value).replace('\r', '%0D').replace('\n', '%0A')}")
    if values.get("record_type") == "revisit":
        lines.append(f"WARC-Profile: {_REVISIT}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.level, self.overwrite = options["path"], int(options.get("level", "3")), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for k in range(0, batch.num_rows, 64):
                for values in batch.slice(k, 64).to_pylist():
                    if out is None or size >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    raw = record_bytes(values)
                    out.write(gzip.compress(raw, self.level, mtime=0))
                    size += len(raw)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        files, manifest = {f for m in messages if m for f in m.files}, f"{root}/{MANIFEST}"
        if not self.overwrite and system.get_file_info(manifest).is_file:
            with system.open_input_stream(manifest) as file:
                files |= set(json.loads(file.read()))
        with system.open_output_stream(manifest) as out:
            out.write(json.dumps(sorted(files)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        for file in (f for m in messages if m for f in m.files):
            system.delete_file(f"{root}/{file}")


@dataclass
class Bundle(InputPartition):
    files: list[str]

    def __init__(self, files: list[str]) -> None:
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list) -> Iterator:
        kinds = {EqualTo: "equal", In: "in", IsNotNull: "given", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains"}
        for x in filters:
            if type(x) in kinds and len(x.attribute) == 1 and x.attribute[0] in HEADERS:
                self.tests.append((kinds[type(x)], x.attribute[0], getattr(x, "value", None)))
            else:
                yield x

    def partitions(self) -> list[Bundle]:
        system, root = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        sizes = {x.path: x.size for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz"))}
        manifest = f"{root}/{MANIFEST}"
        if any(x.path == manifest for x in found):
            with system.open_input_stream(manifest) as file:
                sizes = {f"{root}/{f}": sizes[f"{root}/{f}"] for f in json.loads(file.read())}
        bundles, size = [], BUNDLE_BYTES
        for path in sorted(sizes):
            if size + sizes[path] > BUNDLE_BYTES:
                bundles.append([])
                size = 0
            bundles[-1].append(path)
            size += sizes[path]
        return [Bundle(x) for x in bundles] or [Bundle([])]

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.path)
        names = [*HEADERS, "payload"]
        types = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload", pa.binary())])
        rows, size = [], 0
        for path in partition.files:
            for row in records(system, path, self.matches, self.payload):
                rows.append(row)
                size += 200 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types.field(c).type) for c in names], schema=types)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types.field(c).type) for c in names], schema=types)

    def matches(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            found = row[column]
            if found is None or not (
                kind == "given"
                or kind == "equal" and found == value
                or kind == "in" and found in value
                or kind == "starts" and found.startswith(value)
                or kind == "ends" and found.endswith(value)
                or kind == "contains" and value in found
            ):
                return False
        return True


def records(system: fs.FileSystem, path: str, wanted, payload: bool = True) -> Iterator[dict]:
    """Records of one archive whose header columns ``wanted`` accepts. A damaged archive is an error."""
    raw = system.open_input_stream(path, compression=None, buffer_size=1 << 20)
    source = BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, 1 << 18)
    with raw:
        while True:
            line = source.readline()
            while line in (b"\r\n", b"\n"):
                line = source.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: no record where one should begin: {line[:40]!r}")
            headers, last = {}, None
            while (line := source.readline()) not in (b"\r\n", b"\n"):
                if not line:
                    raise ValueError(f"{path}: ends within a header")
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if text[:1] in " \t" and last:
                    headers[last] += " " + text.strip()
                    continue
                name, _, value = text.partition(":")
                last = name.strip().lower()
                headers.setdefault(last, value.strip())
            left = int(headers["content-length"])
            row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
            if payload and wanted(row) or wanted(row) and left == 0:
                block = source.read(left)
                if len(block) < left:
                    raise ValueError(f"{path}: ends within a record")
                if (row["content_type"] or "").startswith("application/http") and block:
                    block = block.partition(b"\r\n\r\n")[2]
                row["payload"] = block if payload else None
                yield row
            else:
                keep = wanted(row)
                while left:
                    skipped = len(source.read(min(left, 1 << 18)))
                    if not skipped:
                        raise ValueError(f"{path}: ends within a record")
                    left -= skipped
                if keep:
                    row["payload"] = None
                    yield row


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options: payload (true), level (3, of gzip)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def use_warc(spark: SparkSession) -> None:
    """Makes the source known to the session, and switches on filter push-down for Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    use_warc(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(frame: DataFrame, path: str) -> None:
    """Writes rows with the columns of ``SCHEMA`` (but content_type, which may be missing) as records."""
    use_warc(frame.sparkSession)
    columns = [F.col(c).cast("string").alias(c) if c in frame.columns else F.lit(None).cast("string").alias(c) for c in HEADERS]
    frame.select(*columns, F.col("payload").cast("binary").alias("payload")).write.format("warc").mode("append").save(path)


def with_revisits(pages: DataFrame, id_column: str = "page_id", uri: str = "url", html: str = "html", least_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Rows to write, one per page: of pages with equal payloads of at least ``least_bytes`` the one with the smallest id is the
    response, the others are revisits of it, without payload.

    The payload is the html in UTF-8, empty for null. Rows that repeat the smallest id are responses too. Null ids
    revisit the smallest id there is; if all ids of a payload are null, all are responses.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{uri}`").alias("target_uri"), payload.alias("body"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n")
    )
    firsts = rows.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    firsts = firsts.where("copies > 1 and first is not null").select("digest", "first")
    rows = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), c.cast("string"), F.lit(">"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(name(F.col("id")), F.lit("<urn:x-page:>")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.col("n").alias("payload_bytes"),
        F.when(again, name(F.col("first"))).alias("refers_to"),
        F.when(~again, F.col("body").cast("binary")).alias("payload"),
    )


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from archives of ``with_revisits``.

    For responses size and digest are those of the payload read; a payload that is not what its header says is an error.
    """
    number = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1)
    ident = lambda c: F.when(number(c) != "", number(c)).cast("long")
    responses = read_warc(spark, path).where("record_type = 'response'")
    digest = F.sha2("payload", 256)
    checked = F.when(F.concat(F.lit("sha256:"), digest) == F.col("payload_digest"), digest).otherwise(F.raise_error(F.lit("payload does not match its digest")))
    responses = responses.select(
        ident(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to")
    )
    revisits = read_warc(spark, path, payload=False).where("record_type = 'revisit'")
    revisits = revisits.select(
        ident(F.col("record_id")).alias("page_id"),
        F.col("payload_bytes").cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type",
        ident(F.col("refers_to")).alias("refers_to"),
    )
    return responses.unionAll(revisits)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages as archives (below the shared folder unless a path is given) and returns what is read back."""
    spark = pages.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or scratch_path(spark, "warc"))
    folder = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder)
    place = re.sub("^file:/+", "file:///", folder.toString())
    write_warc(with_revisits(pages), place)
    if path is None:
        forget_at_exit(pages, place)
    return page_records(spark, place)
