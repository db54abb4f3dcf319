"""Operators that change the set, the names or the types of columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.values import blank_to_null, required

# Characters that may not stand in a column name.
ILLEGAL_IN_NAMES = "& ,;{}()\n\t=:./#-"
_ILLEGAL = re.compile("[" + re.escape(ILLEGAL_IN_NAMES) + "]")


def is_struct(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType)


def is_array(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType)


def is_map(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.MapType)


def is_array_or_map(dtype: T.DataType) -> bool:
    return is_array(dtype) or is_map(dtype)


def quoted(name: str) -> str:
    """A column's literal name, dots included, as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def at(name: str) -> Column:
    """A top-level column by its literal name."""
    return F.col(quoted(name))


def distinct_names(names: Sequence[str], what: str) -> None:
    """Fails when two names would clash for Spark, which ignores case."""
    seen: dict[str, str] = {}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"{what}: columns {seen[name.lower()]!r} and {name!r} clash")
        seen[name.lower()] = name


def rename_columns(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Renames by position, all at once; names that are not there are passed over."""
    wanted = {a.lower(): b for a, b in zip(old, new)}
    names = [wanted.get(c.lower(), c) for c in df.columns]
    distinct_names(names, "rename")
    return df.select(*[at(c).alias(n) for c, n in zip(df.columns, names)])


def narrow_decimals(df: DataFrame) -> DataFrame:
    """Decimals without a scale become long, the others double."""
    def narrowed(field: T.StructField) -> Column:
        if not isinstance(field.dataType, T.DecimalType):
            return at(field.name)
        target = "bigint" if field.dataType.scale == 0 else "double"
        return at(field.name).cast(target).alias(field.name)
    return df.select(*[narrowed(f) for f in df.schema.fields])


def typed_projection(df: DataFrame, columns: dict[str, tuple[str | Column, str]]) -> DataFrame:
    """``{name: (source, type)}`` with blank strings read as NULL."""
    def typed(name: str, source: str | Column, dtype: str) -> Column:
        value = (at(source) if isinstance(source, str) else source).cast(dtype)
        return (blank_to_null(value) if dtype == "string" else value).alias(name)
    return df.select(*[typed(n, s, t) for n, (s, t) in columns.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Maps by name onto ``schema``: absent columns are NULL, unknown ones go."""
    present = {c.lower(): c for c in df.columns}
    return df.select(*[
        (at(present[f.name.lower()]) if f.name.lower() in present else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in schema.fields])


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job that computes them fails when one of the columns is NULL."""
    return df.select(*[
        required(at(f.name), f.dataType, f"{f.name} is NULL").alias(f.name)
        if f.name in columns else quoted(f.name) for f in df.schema.fields])


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows seen and values that are not NULL, in one pass."""
    total = "rows seen"
    counts = df.agg(F.count(F.lit(1)).alias(total),
                    *[F.count(at(c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), at(total).alias("n_rows"),
                               at(c).alias("n_values")) for c in df.columns])
    return counts.select(F.inline(pairs))


def column_bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return df.agg(F.min(at(column)).alias("low"), F.max(at(column)).alias("high"))


def drop_null_columns(df: DataFrame, how: str = "all") -> DataFrame:
    """Drops columns that are NULL in all rows (``all``) or in at least one (``any``).

    One pass counts the values of the columns that may hold NULLs. A frame without rows
    keeps its columns.
    """
    if how not in ("all", "any"):
        raise ValueError(f"how must be 'all' or 'any', not {how!r}")
    nullable = [f.name for f in df.schema.fields if f.nullable]
    *values, rows = df.agg(*[F.count(at(c)) for c in nullable], F.count(F.lit(1))).first()
    found = {**dict.fromkeys(df.columns, rows), **dict(zip(nullable, values))}
    least = rows if how == "any" else min(rows, 1)
    return df.select(*[quoted(c) for c in df.columns if found[c] >= least])


def clean_name(name: str) -> str:
    return _ILLEGAL.sub("_", name)


def _clean_type(dtype: T.DataType) -> T.DataType:
    if is_struct(dtype):
        names = [clean_name(f.name) for f in dtype.fields]
        distinct_names(names, "clean names")
        return T.StructType([T.StructField(n, _clean_type(f.dataType), f.nullable)
                             for n, f in zip(names, dtype.fields)])
    if is_array(dtype):
        return T.ArrayType(_clean_type(dtype.elementType), dtype.containsNull)
    if is_map(dtype):
        return T.MapType(_clean_type(dtype.keyType), _clean_type(dtype.valueType),
                         dtype.valueContainsNull)
    return dtype


def clean_names(df: DataFrame) -> DataFrame:
    """Replaces illegal characters in column and field names at every depth."""
    cleaned = _clean_type(df.schema)
    return df.select(*[
        (at(old.name) if old.dataType == new.dataType else at(old.name).cast(new.dataType))
        .alias(new.name) for old, new in zip(df.schema.fields, cleaned.fields)])
