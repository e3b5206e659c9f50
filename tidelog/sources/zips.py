"""ZIP archives as a PySpark data source.

An archive larger than a task's share is planned from its central directory, which lies at its end: members whose names
do not fit are left out, the others are dealt to tasks by their compressed size, and a task seeks to the members it was
given. So one archive is the work of many tasks, and it may be larger than a task's memory. Smaller archives are not
opened before they are read, and a task takes as many as its share holds, so many small ones cost few tasks.

A task hands over pieces of text that end with a line; Spark cuts them into lines. Text is only handed over after the
member's checksum has been compared. What cannot be read is a row with ``error``.

Archives are opened with pyarrow's file systems, so their folder must be one that all executors reach that way.
"""

from __future__ import annotations

import fnmatch
import io
import sys
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringEndsWith

# Executors need not have this package installed: the classes they run travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "archive string, outer string, member string, line_base bigint, text string, error string"
UNREADABLE = (zipfile.BadZipFile, zlib.error, pa.ArrowInvalid, RuntimeError, EOFError, OSError, NotImplementedError, UnicodeError)

#: Compressed bytes for a task; bytes of a piece of text; a member of at most so many bytes is held until it is checked.
TASK_BYTES, PIECE_BYTES, HELD_BYTES = 32 << 20, 1 << 20, 64 << 20
#: Central directories read at once while a scan is planned; bytes that opening an archive counts for; tasks that a scan has at least, if
#: there is a megabyte for each.
AT_ONCE, OPENING_BYTES, LEAST_TASKS = 32, 64 << 10, 64

Row = tuple[str, str | None, str | None, int | None, str | None, str | None]


@dataclass
class Members:
    """Members ``first`` to ``last - 1`` of an archive's directory (all without ``last``), or the error that hides them."""

    archive: str
    first: int = 0
    last: int | None = None
    error: str | None = None


@dataclass
class Share(InputPartition):
    """What one task reads."""

    parts: list[Members]


class ZipReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.suffix, self.nested = options.get("membersuffix", ""), options.get("nestedsuffix")
        self.encoding = options.get("encoding", "ISO-8859-1")
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.suffixes, self.names, self.unnamed = [self.suffix], [], True

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on member names are settled on the directory; others go back to Spark."""
        for condition in filters:
            # no condition on a name holds for an archive that cannot be read
            self.unnamed = self.unnamed and condition.attribute != ("member",)
            if isinstance(condition, StringEndsWith) and condition.attribute == ("member",):
                self.suffixes.append(condition.value)
            elif isinstance(condition, EqualTo) and condition.attribute == ("member",):
                self.names.append(condition.value)
            else:
                yield condition

    def _fits(self, name: str) -> bool:
        return all(name.endswith(s) for s in self.suffixes) and all(name == n for n in self.names)

    def _wanted(self, info: zipfile.ZipInfo) -> bool:
        return not info.is_dir() and (info.filename.endswith(self.nested) if self.nested else self._fits(info.filename))

    def partitions(self) -> Sequence[InputPartition]:
        system, root = fs.FileSystem.from_uri(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no such folder or archive: {self.path}")
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root))
        files = sorted((f for f in found if f.is_file and fnmatch.fnmatch(f.base_name, self.glob) and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
        weights = [f.size + OPENING_BYTES for f in files]
        share = min(self.task_bytes, max(1 << 20, sum(weights) // LEAST_TASKS))
        with ThreadPoolExecutor(AT_ONCE) as pool:
            large = pool.map(lambda f: self._parts(system, f.path), [f for f in files if f.size > self.task_bytes])
            shares = [Share([part]) for parts in large for part in parts]
        held, size = [], 0
        for file, weight in zip(files, weights, strict=True):
            if file.size > self.task_bytes:
                continue
            if held and size + weight > share:
                shares.append(Share(held))
                held, size = [], 0
            held.append(Members(file.path))
            size += weight
        return [*shares, Share(held)] if held or not shares else shares

    def _parts(self, system: fs.FileSystem, archive: str) -> list[Members]:
        try:
            with system.open_input_file(archive) as file, zipfile.ZipFile(file) as packed:
                infos = packed.infolist()
        except UNREADABLE as error:
            return [Members(archive, error=str(error))]
        parts, first, size = [], None, 0
        for at, info in enumerate(infos):
            if not self._wanted(info):
                continue
            if first is not None and size + info.compress_size > self.task_bytes:
                parts.append(Members(archive, first, at))
                first = None
            if first is None:
                first, size = at, 0
            size += info.compress_size
        return parts if first is None else [*parts, Members(archive, first, len(infos))]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return batched(self._rows(partition))

    def _rows(self, share: Share) -> Iterator[Row]:
        for part in share.parts:
            for row in self._unfiltered(part):
                if row[2] is not None or self.unnamed:
                    yield row

    def _unfiltered(self, part: Members) -> Iterator[Row]:
        if part.error is not None:
            yield part.archive, None, None, None, None, part.error
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        with ExitStack() as opened:
            try:
                file = opened.enter_context(system.open_input_file(part.archive))
                packed = opened.enter_context(zipfile.ZipFile(file))
            except UNREADABLE as error:
                yield part.archive, None, None, None, None, str(error)
                return
            for info in packed.infolist()[part.first : part.last]:
                if not self._wanted(info):
                    continue
                if self.nested is None:
                    yield from member_rows(packed, info, (part.archive, None), self.encoding)
                    continue
                try:
                    inner = zipfile.ZipFile(io.BytesIO(packed.read(info)))
                except UNREADABLE as error:
                    yield part.archive, info.filename, None, None, None, str(error)
                    continue
                for each in inner.infolist():
                    if not each.is_dir() and self._fits(each.filename):
                        yield from member_rows(inner, each, (part.archive, info.filename), self.encoding)


def member_rows(packed: zipfile.ZipFile, info: zipfile.ZipInfo, place: tuple[str, str | None], encoding: str) -> Iterator[Row]:
    """A member's text in pieces that end with a line, or one row with the error. An empty member has no rows."""
    try:
        if info.file_size <= HELD_BYTES:
            pieces = list(_pieces(packed, info, encoding))
        else:
            # too large to hold: read once for the checksum, and once more for its text
            with packed.open(info) as member:
                while member.read(PIECE_BYTES):
                    pass
            pieces = _pieces(packed, info, encoding)
    except UNREADABLE as error:
        yield *place, info.filename, None, None, str(error)
        return
    lines = 0
    for text in pieces:
        yield *place, info.filename, lines, text, None
        lines += text.count("\n") + 1


def _pieces(packed: zipfile.ZipFile, info: zipfile.ZipInfo, encoding: str) -> Iterator[str]:
    """Text without the line end at the end of each piece; any of the three line ends becomes a line feed."""
    with packed.open(info) as member:
        text, open_line = io.TextIOWrapper(member, encoding=encoding, errors="replace"), []
        while block := text.read(PIECE_BYTES):
            whole, end, rest = block.rpartition("\n")
            if end:
                yield "".join([*open_line, whole])
                open_line = []
            open_line.append(rest)
        if any(open_line):
            yield "".join(open_line)


def batched(rows: Iterable[Row]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4] or "")
        if size >= PIECE_BYTES or len(held) >= 1024:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[Row]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["archive", "outer", "member", "line_base", "text", "error"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class ZipSource(DataSource):
    """``spark.read.format("zip_text")`` with path, glob, memberSuffix, nestedSuffix, encoding and taskBytes."""

    @classmethod
    def name(cls) -> str:
        return "zip_text"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> ZipReader:
        return ZipReader({k.lower(): v for k, v in self.options.items()})


def lines_of(pieces: DataFrame) -> DataFrame:
    """Pieces of text cut into lines, numbered from 1 within their member; a row with an error stays one row without a line."""
    cut = F.posexplode_outer(F.split("text", "\n")).alias("_at", "line")
    return pieces.select("archive", "outer", "member", "line_base", "error", cut).select(
        "archive", "outer", "member", (F.col("line_base") + F.col("_at") + 1).alias("line_no"), "line", "error"
    )


def read_archive_lines(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    member_suffix: str = "",
    nested_suffix: str | None = None,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Lines of the members whose names end with ``member_suffix``, and what could not be read.

    Columns: archive, outer, member, line_no, line, error. With ``nested_suffix`` the members so named are archives
    themselves; the lines come from inside them and ``outer`` holds their name. An archive or member that cannot be
    read whole gives no line but one row with ``error``. The suffix is settled on the archives' directories.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipSource)
    options = {"path": path, "glob": glob, "memberSuffix": member_suffix, "encoding": encoding}
    if nested_suffix is not None:
        options["nestedSuffix"] = nested_suffix
    return lines_of(spark.read.format("zip_text").options(**options).load())


def strict(lines: DataFrame) -> DataFrame:
    """The lines without the column ``error``; a row with one fails the query."""
    place = F.concat_ws(" ", F.lit("unreadable:"), "archive", "outer", "member", "error")
    return lines.where(F.when(F.col("error").isNotNull(), F.raise_error(place).cast("boolean")).otherwise(True)).drop("error")
