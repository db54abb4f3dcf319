"""Comparison of two snapshots: new, deleted, modified and unmodified rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.columns import at, quoted
from tidemark.operators.setops import IN_LEFT, IN_RIGHT, row_membership


class SnapshotDiff(NamedTuple):
    new: DataFrame
    deleted: DataFrame
    modified: DataFrame
    unmodified: DataFrame


def label_changes(new: DataFrame, old: DataFrame, key: str,
                  label: str = "change_type") -> DataFrame:
    """Every distinct row of either snapshot that belongs to one of the four classes.

    Rows compare as sets, NULLs being equal, while keys compare with ``=``: a
    changed row whose key is NULL is therefore new. Modified and unmodified rows
    are those of ``new``. An old row whose key was modified belongs to no class.
    Any number of rows may share a key. One shuffle of the distinct rows is used
    twice: once for the keys that were modified, once for the rows themselves. The
    join on the key is NULL-safe only so that Spark adds no NOT NULL filter below
    one of the two, which would make them differ; NULL keys are ruled out after it.
    """
    rows = row_membership(new, old)
    only_new = F.col(IN_LEFT) & ~F.col(IN_RIGHT)
    changed = "__changed_key"
    changed_keys = (rows.groupBy(at(key).alias(changed))
                    .agg(F.max(only_new).alias("__new"), F.max(IN_RIGHT).alias("__old"))
                    .filter(F.col("__new") & F.col("__old"))
                    .select(changed, F.lit(True).alias("__hit")))
    key_changed = F.col("__hit").isNotNull() & at(key).isNotNull()
    kind = (F.when(F.col(IN_LEFT) & F.col(IN_RIGHT), "unmodified")
            .when(only_new & key_changed, "modified")
            .when(only_new, "new")
            .when(~F.col(IN_LEFT) & ~key_changed, "deleted"))
    return (rows.join(changed_keys, at(key).eqNullSafe(F.col(changed)), "left_outer")
            .withColumn(label, kind).filter(F.col(label).isNotNull())
            .select(*[quoted(c) for c in new.columns], label))


def diff_snapshots(new: DataFrame, old: DataFrame, key: str) -> SnapshotDiff:
    """The four classes as four DataFrames over one labelled plan.

    To write several of them, stage ``label_changes`` once and filter that instead.
    """
    labelled = label_changes(new, old, key, label="__class")
    def only(kind: str) -> DataFrame:
        return labelled.filter(F.col("__class") == kind).drop("__class")
    return SnapshotDiff(only("new"), only("deleted"), only("modified"), only("unmodified"))


def label_changes_by_hash(new: DataFrame, old: DataFrame, key: str, hash_col: str,
                          label: str = "change_type") -> DataFrame:
    """The same classes by key, for keys that are unique and never NULL.

    Compares ``hash_col`` instead of whole rows, and returns the old row for
    deleted keys. Check the keys first (``keys.require_unique``); otherwise use
    ``label_changes``. Rows of ``new`` look up their key in ``old`` and rows of ``old`` theirs in
    ``new``: two joins of a kind that adaptive execution can split where a key is hot, which it
    can't do for a full outer join, and for which it may send a small side to all tasks.
    """
    n, o = new.alias("n"), old.select(*[quoted(c) for c in new.columns])
    kept = o.select(at(key).alias("__key"), at(hash_col).alias("__hash"), F.lit(True).alias("__old"))
    kind = (F.when(F.col("__old").isNull(), "new")
            .when(F.col(f"n.`{hash_col}`").eqNullSafe(F.col("__hash")), "unmodified")
            .otherwise("modified"))
    there = (n.join(kept, F.col(f"n.`{key}`") == F.col("__key"), "left_outer")
             .select(*[F.col(f"n.`{c}`") for c in new.columns], kind.alias(label)))
    keys = new.select(at(key).alias("__key"))
    gone = o.join(keys, at(key) == F.col("__key"), "left_anti")
    return there.unionAll(gone.select(*[quoted(c) for c in new.columns], F.lit("deleted").alias(label)))
