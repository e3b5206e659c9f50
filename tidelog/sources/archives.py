"""Text lines inside ZIP archives that are rows of a table, unpacked by the tasks.

Archives in files are better read by ``tidelog.sources.zips``: an archive that is a row has at most
``spark.sql.sources.binaryFile.maxLength`` bytes and is one task's work.
"""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources import zips

# Executors need not have this package installed: the functions they run travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBER_SCHEMA = "archive string, outer string, content binary, error string"

Batches = Iterable[pa.RecordBatch]


def read_archives(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Archive files as rows: ``archive`` (path) and ``content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("archive"), "content")


def expand_archives(
    archives: DataFrame,
    member_suffix: str = "",
    nested_suffix: str | None = None,
    encoding: str = "ISO-8859-1",
    on_error: str = "raise",
) -> DataFrame:
    """Lines of the members whose names end with ``member_suffix``.

    Input columns ``archive`` and ``content``. With ``nested_suffix`` the members so named are
    archives themselves and the lines come from inside them; ``outer`` holds their name, and they
    are spread over the cluster before they are opened, so a large outer archive keeps many tasks
    busy. ``line_no`` counts from 1. An archive or member that cannot be read whole gives no line: it
    fails the query, or is one row with ``error`` (``on_error="row"``), or is left out (``"skip"``).
    """
    if on_error not in ("raise", "row", "skip"):
        raise ValueError(f"unknown on_error: {on_error}")
    nothing = F.lit(None).cast("string")
    if nested_suffix is None:
        packed = archives.select("archive", nothing.alias("outer"), "content", nothing.alias("error"))
    else:
        members = archives.select("archive", "content").mapInArrow(_member_reader(nested_suffix), MEMBER_SCHEMA)
        packed = members.repartition("archive", "outer")
    lines = zips.lines_of(packed.mapInArrow(_text_reader(member_suffix, encoding), zips.SCHEMA))
    if on_error == "row":
        return lines
    return zips.strict(lines) if on_error == "raise" else lines.where("error IS NULL").drop("error")


def archive_stem(path: str) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.substring_index(F.col(path), "/", -1), ".", 1)


def _member_reader(suffix: str) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    names = {"archive": pa.string(), "outer": pa.string(), "content": pa.binary(), "error": pa.string()}

    def members(batch: pa.RecordBatch) -> Iterator[tuple]:
        for archive, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
            try:
                packed = zipfile.ZipFile(pa.BufferReader(content.as_buffer()))
            except zips.UNREADABLE as error:
                yield archive, None, None, str(error)
                continue
            for info in packed.infolist():
                if not info.is_dir() and info.filename.endswith(suffix):
                    try:
                        yield archive, info.filename, packed.read(info), None
                    except zips.UNREADABLE as error:
                        yield archive, info.filename, None, str(error)

    def every(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a member is a batch of its own, so that no more than one is held
            for row in members(batch):
                yield pa.record_batch([pa.array([v], k) for v, k in zip(row, names.values(), strict=True)], names=list(names))

    return every


def _text_reader(suffix: str, encoding: str) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    def rows(batch: pa.RecordBatch) -> Iterator[zips.Row]:
        columns = [batch.column(c).to_pylist() for c in ("archive", "outer", "error")]
        for archive, outer, failed, content in zip(*columns, batch.column("content"), strict=True):
            if failed is not None:
                yield archive, outer, None, None, None, failed
                continue
            try:
                packed = zipfile.ZipFile(pa.BufferReader(content.as_buffer()) if content.is_valid else io.BytesIO())
            except zips.UNREADABLE as error:
                yield archive, outer, None, None, None, str(error)
                continue
            for info in packed.infolist():
                if not info.is_dir() and info.filename.endswith(suffix):
                    yield from zips.member_rows(packed, info, (archive, outer), encoding)

    def every(batches: Batches) -> Iterator[pa.RecordBatch]:
        yield from zips.batched(row for batch in batches for row in rows(batch))

    return every
