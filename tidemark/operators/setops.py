"""Set operations on whole rows.

Both sides are tagged, put together and grouped by all columns. The partial
aggregation folds copies before the shuffle, so a row repeated any number of
times costs each map task one record. NULLs compare as equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.columns import quoted

IN_LEFT, IN_RIGHT = "__in_left", "__in_right"


def row_membership(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each distinct row once, with two flags telling the sides that hold it."""
    columns = [quoted(c) for c in left.columns]
    def tagged(df: DataFrame, in_left: bool) -> DataFrame:
        return df.select(*columns, F.lit(in_left).alias(IN_LEFT),
                         F.lit(not in_left).alias(IN_RIGHT))
    return (tagged(left, True).unionAll(tagged(right, False))
            .groupBy(*columns)
            .agg(F.max(IN_LEFT).alias(IN_LEFT), F.max(IN_RIGHT).alias(IN_RIGHT)))


def rows_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT, columns matched by name."""
    return (row_membership(left, right)
            .filter(F.col(IN_LEFT) & ~F.col(IN_RIGHT)).drop(IN_LEFT, IN_RIGHT))


def rows_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """INTERSECT DISTINCT, columns matched by name."""
    return (row_membership(left, right)
            .filter(F.col(IN_LEFT) & F.col(IN_RIGHT)).drop(IN_LEFT, IN_RIGHT))


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; a column absent from one input is NULL there."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
