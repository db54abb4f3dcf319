"""Row hashes that tell whether the tracked columns of a row have changed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.columns import at

# Both must stay as they are for stored hashes to remain comparable.
SEPARATOR = "|~|"
DELETED_MARK = "DELETED"


def _columns(columns: Iterable[str | Column]) -> list[Column]:
    return [at(c) if isinstance(c, str) else c for c in columns]


def hash_skipping_nulls(*columns: str | Column) -> Column:
    """SHA-1 over the non-NULL values; ``(a, NULL, b)`` and ``(a, b, NULL)`` are alike."""
    return F.sha1(F.concat_ws(SEPARATOR, *[c.cast("string") for c in _columns(columns)]))


def hash_keeping_nulls(*columns: str | Column) -> Column:
    """SHA-1 in which a NULL keeps its slot as an empty string."""
    slots = [F.coalesce(c.cast("string"), F.lit("")) for c in _columns(columns)]
    return F.sha1(F.concat_ws(SEPARATOR, *slots))


def deleted_hash() -> Column:
    """The hash carried by rows whose source row has gone."""
    return F.sha1(F.lit(DELETED_MARK))


def with_change_hash(df: DataFrame, columns: Iterable[str], into: str = "change_hash",
                     keep_nulls: bool = True) -> DataFrame:
    make = hash_keeping_nulls if keep_nulls else hash_skipping_nulls
    return df.withColumn(into, make(*columns))
