"""Sinks: files, connectors, load paths, and staging of intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame

from tidemark.session import scratch_path

# The two kinds of load, and the names of partition folders.
FULL, INCREMENTAL = "full", "incr"
DATE_FOLDER, HOUR_FOLDER, LOAD_FOLDER, TOKEN_FOLDER = "date", "hour", "load", "token"


def write_sink(df: DataFrame, fmt: str, mode: str = "error",
               options: dict[str, str] | None = None, *, path: str | None = None,
               table: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Any format Spark can write: files, warehouse tables, key-value stores, search indexes.

    With ``partition_by`` rows are first brought together by those columns in parts
    of even size: adaptive execution splits a folder that holds much of the data
    over many tasks and lets small ones share a task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is not None:
        writer = writer.option("dbtable", table)
    writer.save(path) if path is not None else writer.save()


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                   mode: str = "error") -> None:
    """A catalog table bucketed and sorted by the keys of its upserts.

    Read with ``spark.table``, it is not shuffled again when it is joined on those
    keys, given at least as many buckets as the session has shuffle partitions.
    Suits tables whose keys are unique; a hot key would make a hot bucket.
    """
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def load_kind(load_type: str) -> str:
    """``full`` or ``incr``, whatever the case of the given text."""
    kind = load_type.strip().lower()
    if kind not in (FULL, INCREMENTAL):
        raise ValueError(f"load type must be 'full' or 'incr', not {load_type!r}")
    return kind


def load_path(base: str, load_type: str, as_of: datetime, token: str | None = None) -> str:
    """The folder a load goes to: ``base``, or one of its own, in its hour, if incremental.

    Its name is the time of the load, with microseconds if it has any; a ``token`` sets it apart
    from another load of the same instant, and is the same again in a retry only.
    """
    base = base.rstrip("/")
    if load_kind(load_type) == FULL:
        return base
    at_time = f"{as_of:%Y%m%d%H%M%S}" + (f"{as_of.microsecond:06d}" if as_of.microsecond else "")
    path = f"{base}/{DATE_FOLDER}={as_of:%Y-%m-%d}/{HOUR_FOLDER}={as_of:%H}/{LOAD_FOLDER}={at_time}"
    return f"{path}/{TOKEN_FOLDER}=t-{quote(token, safe='')}" if token else path


def write_load(df: DataFrame, base: str, load_type: str, as_of: datetime,
               fmt: str = "parquet", mode: str = "overwrite",
               options: dict[str, str] | None = None,
               partition_by: Sequence[str] = (), token: str | None = None) -> str:
    """Writes one load; overwriting an incremental one replaces a try with the same ``as_of`` and
    ``token``."""
    path = load_path(base, load_type, as_of, token)
    write_sink(df, fmt, mode, options, path=path, partition_by=partition_by)
    return path


def write_text_gz(df: DataFrame, line: Column, path: str, mode: str = "error") -> None:
    """One gzipped text line per row."""
    df.select(line.cast("string").alias("value")).write.mode(mode) \
        .option("compression", "gzip").text(path)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back.

    Used where a costly input feeds several branches; unlike a cache it survives
    the loss of executors without being computed again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
