"""Effective-dated rows and their current-record flag."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import is_effective
from tidemark.operators.columns import at


def with_current_flag(df: DataFrame, as_of: datetime | str, *, start_col: str = "start_date",
                      end_col: str = "end_date", flag_col: str = "is_current") -> DataFrame:
    """Adds ``Y`` for rows in force at ``as_of`` and ``N`` for all others."""
    in_force = is_effective(as_of, at(start_col), at(end_col))
    return df.withColumn(flag_col, F.when(in_force, "Y").otherwise("N"))


def refresh_current_flag(df: DataFrame, as_of: datetime | str, *, start_col: str = "start_date",
                         end_col: str = "end_date", flag_col: str = "is_current") -> DataFrame:
    """Turns flags that time has overtaken, leaving dates and hash alone.

    A test that comes out NULL, as for an open row without a start, turns nothing.
    """
    in_force, flag = is_effective(as_of, at(start_col), at(end_col)), at(flag_col)
    turned = (F.when(in_force & (flag == "N"), "Y")
              .when(~in_force & (flag == "Y"), "N").otherwise(flag))
    return df.withColumn(flag_col, turned)


def open_rows(df: DataFrame, end_col: str = "end_date") -> DataFrame:
    """Rows without an end."""
    return df.filter(at(end_col).isNull())
