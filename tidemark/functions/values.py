"""Small column expressions for labels, blanks and required values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def label_of(code: Column, labels: dict[str, str], default: str = "") -> Column:
    """Searched CASE from codes to labels; unknown and NULL codes get ``default``."""
    case = None
    for value, label in labels.items():
        hit = code == F.lit(value)
        case = F.when(hit, F.lit(label)) if case is None else case.when(hit, F.lit(label))
    return F.lit(default) if case is None else case.otherwise(F.lit(default))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def null_of(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def required(column: Column, dtype, message: str) -> Column:
    """The column itself; fails the job when a value is NULL."""
    return F.coalesce(column, F.raise_error(F.lit(message)).cast(dtype))
