"""Headered CSV in, Parquet and CSV out."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schemas import CORRESPONDENCE_COLUMNS
from tidelog.sources.types import narrowest_types, with_types


def read_csv_untyped(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Headered CSV with every column as text: only the header line is read to plan."""
    return spark.read.csv(path, header=True, sep=sep, encoding=encoding)


def read_correspondence(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """Semicolon CSV of machines and precincts: the known columns by name, typed by their values."""
    return typed_correspondence(read_csv_untyped(spark, path, sep=";", encoding=encoding))


def typed_correspondence(raw: DataFrame) -> DataFrame:
    """The known columns of an all-text frame, each with the narrowest type that holds all its values."""
    return with_types(raw, narrowest_types(raw, CORRESPONDENCE_COLUMNS))


def append_once(frame: DataFrame, path: str, job_id: str) -> None:
    """Appends Parquet files to a folder under the name of a job; the same job again adds nothing.

    The files are written aside and then renamed to names made of the job and their number. A job that
    was cut off leaves files known by its name, which its next run takes away before it adds its own;
    the mark of a finished job is its last act.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.=-]*", job_id):
        raise ValueError(f"a job id has letters, digits, dots and hyphens: {job_id!r}")
    context = frame.sparkSession.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path
    aside, done = at(f"{path}/_adding-{job_id}"), at(f"{path}/_jobs/{job_id}")
    files = done.getFileSystem(context._jsc.hadoopConfiguration())
    if files.exists(done):
        return
    frame.write.mode("overwrite").parquet(aside.toString())
    for old in files.listStatus(at(path)):
        if old.getPath().getName().endswith(f"-of-{job_id}.parquet"):
            files.delete(old.getPath(), False)
    parts = sorted(f.getPath().getName() for f in files.listStatus(aside) if f.getPath().getName().startswith("part-"))
    for n, part in enumerate(parts):
        if not files.rename(at(aside, part), at(f"{path}/part-{n:05}-of-{job_id}.parquet")):
            raise OSError(f"could not rename {part} of job {job_id}")
    files.create(done, True).close()
    files.delete(aside, True)


def write_partitioned(frame: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Parquet with one directory per key value.

    ``rebalance`` brings equal keys together, so a directory gets few files, and lets adaptive
    execution cut an oversized key into several tasks and join up the small ones.
    """
    frame.hint("rebalance", *[F.col(key) for key in keys]).write.mode("overwrite").partitionBy(*keys).parquet(path)


def read_partitioned(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Reads ``write_partitioned`` output back with the columns and types of ``like``.

    Partition columns would come back last, and typed by the look of the directory names (``01``
    would turn into a number); the given schema and column order prevent both.
    """
    return spark.read.schema(like.schema).parquet(path).select(*[F.col(f"`{name}`") for name in like.columns])
