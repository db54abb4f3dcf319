"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.staging import Scratch


def _only_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one centre, which hangs on none itself."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
        .alias("x")).select("x.*")
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``(node, label)`` for every node of ``links(u, v)``, the label being the smallest node
    that can be reached.

    Large and small stars alternate: larger neighbours are tied to the smallest one around,
    then smaller ones likewise, until only stars are left. Each round is written, nothing is
    collected, and a hub's neighbours meet as a folded minimum only.
    """
    links = scratch.write(links.filter("u <> v")
                          .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .distinct(), f"{name}-0")
    turn = 0
    while not _only_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")),
                              f"{name}-least-{turn}")
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        large = scratch.write(large, f"{name}-large-{turn}")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("x")).select("x.u", "x.v").filter("u <> v").distinct())
        links_next = scratch.write(small, f"{name}-{turn + 1}")
        scratch.release(f"{name}-{turn}", f"{name}-least-{turn}", f"{name}-large-{turn}")
        links, turn = links_next, turn + 1
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
