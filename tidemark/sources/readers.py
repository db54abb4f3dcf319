"""Sources: files, connectors, typed projections over files, payload text and views."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.columns import at, is_array, typed_projection
from tidemark.sources.sinks import stage


def read_source(spark: SparkSession, fmt: str, options: dict[str, str] | None = None, *,
                paths: str | Sequence[str] | None = None, query: str | None = None,
                table: str | None = None, schema: T.StructType | str | None = None,
                columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """Any format Spark can load: files, JDBC, warehouses, key-value stores, search indexes.

    ``columns`` are selected before ``limit`` rows are taken, so that both reach the source.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if query is not None and table is not None:
        raise ValueError("give a query or a table, not both")
    if query is not None:
        reader = reader.option("query", query)
    if table is not None:
        reader = reader.option("dbtable", table)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(paths if paths is None or isinstance(paths, str) else list(paths))
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def read_json_lines(spark: SparkSession, paths: str | Iterable[str],
                    schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON record per line, from files or folders of any depth, plain or gzipped.

    The codec follows from the file suffix. Each path is read once, and a malformed
    line fails the job. With a schema there is no inference pass.
    """
    wanted = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    reader = spark.read.option("mode", "FAILFAST").option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(wanted)


def read_parquet_prefix(spark: SparkSession, prefix: str) -> DataFrame:
    """All parquet files below a folder, columns matched by name, absent ones NULL."""
    return (spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
            .parquet(prefix))


def list_files(spark: SparkSession, folder: str, suffix: str = "", prefix: str = "") -> DataFrame:
    """Paths, sizes and times of the files below a folder, with name filters.

    The content column is not selected, so no file is opened.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"{prefix}*{suffix}").load(folder)
            .select("path", "length", "modificationTime"))


def external_table(spark: SparkSession, path: str,
                   columns: dict[str, tuple[str | Column, str]], fmt: str = "parquet") -> DataFrame:
    """Typed schema-on-read; blank strings are NULL."""
    return typed_projection(spark.read.format(fmt).load(path), columns)


def parse_payloads(df: DataFrame, column: str, schema: T.DataType | str,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Landed response bodies to rows; an array body yields one row per element."""
    parsed = df.select(*[at(k) for k in keep],
                       F.from_json(at(column), schema, {"mode": "FAILFAST"}).alias("__body"))
    if is_array(parsed.schema["__body"].dataType):
        parsed = parsed.select(*[at(k) for k in keep], F.explode("__body").alias("__body"))
    return parsed.select(*[at(k) for k in keep], "__body.*")


def dual(spark: SparkSession, view: str | None = "dual") -> DataFrame:
    """The relation of one row over which ``SELECT expr FROM dual`` is evaluated."""
    df = spark.range(1).select(F.struct(F.lit("dummy").alias("value")).alias("r"))
    if view:
        df.createOrReplaceTempView(view)
    return df


def register_view(df: DataFrame, view: str, cache: bool = False) -> None:
    df.createOrReplaceTempView(view)
    if cache:
        df.sparkSession.catalog.cacheTable(view)


def register_views(spark: SparkSession, views: dict[str, dict] | Sequence[dict]) -> list[str]:
    """``{view: {"format": ..., "cache": ..., further arguments of read_source}}``.

    Or the described form, a list of ``{view: [cache, table]}`` over tables of the catalog, or
    ``{view: [cache, query]}`` with a query, cache being Y or N. Returns the cached views.
    """
    cached = []
    parts = [views] if isinstance(views, dict) else views
    for view, source in (item for part in parts for item in part.items()):
        if isinstance(source, dict):
            spec = dict(source)
            cache = bool(spec.pop("cache", False))
            df = read_source(spark, spec.pop("format"), spec.pop("options", None), **spec)
        else:
            flag, text = source
            cache = flag is True or str(flag).strip().lower() in ("y", "yes", "true")
            df = spark.sql(text) if re.match(r"\s*(select|with)\b", text, re.I) else spark.table(text)
        register_view(df, view, cache)
        if cache:
            cached.append(view)
    return cached


def _option(statement: str) -> tuple[str, str]:
    """``set key=value`` as a pair."""
    words = statement.strip().split(None, 1)
    text = words[1] if len(words) == 2 and words[0].lower() == "set" else statement
    key, equals, value = text.partition("=")
    if not equals:
        raise ValueError(f"not an option: {statement!r}")
    return key.strip(), value.strip()


@contextmanager
def session_options(spark: SparkSession, statements: list[str]) -> Iterator[None]:
    """Applies session options for the length of a block and puts the old ones back."""
    wanted = dict(_option(s) for s in statements)
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_sql(spark: SparkSession, query: str, options: Iterable[str] = ()) -> DataFrame:
    """Runs ``SET`` statements, then the query; the session's own options are put back.

    With options the rows are computed at once and staged, as the options must hold then.
    """
    options = list(options)
    if not options:
        return spark.sql(query)
    with session_options(spark, options):
        return stage(spark.sql(query), "sql")
