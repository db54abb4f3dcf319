"""Intermediate tables in the shared folder, and columns picked for an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_path


class Scratch:
    """Tables written while one operator runs.

    A written table cuts the lineage and outlives a lost executor. ``release`` empties the
    tables that no returned frame reads any more.
    """

    def __init__(self, spark, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths.setdefault(name, []).append((path, df.schema))
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, *names: str) -> None:
        for name in names:
            for path, schema in self.paths.pop(name, []):
                self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def picked(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no further column can clash with an operator's own."""
    return df.select(*[df[f"`{n}`"] for n in names])
