"""Key checks, one row per key, and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.columns import at, quoted
from tidemark.session import shared_folder

# Fixed value: the first surrogate key of an empty dimension.
FIRST_SURROGATE = 250_000


def any_null(keys: Sequence[str]) -> Column:
    return F.expr(" OR ".join(f"{quoted(k)} IS NULL" for k in keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "n_rows",
                   null_safe: bool = False) -> DataFrame:
    """Keys held by more than one row. NULL keys match nothing, so they do not count."""
    rows = df if null_safe else df.filter(~any_null(keys))
    return (rows.groupBy(*[quoted(k) for k in keys])
            .agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1))


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Runs the check now and fails on the first key that is NULL or repeated."""
    if df.filter(any_null(keys)).limit(1).count():
        raise ValueError(f"NULL in key {list(keys)}")
    hit = duplicate_keys(df, keys).limit(1).first()
    if hit is not None:
        raise ValueError(f"duplicate key {hit.asDict()}")


def dealt_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by their keys, in as many parts as the session's shuffles have.

    Short rows, such as bare keys, shrink to a few bytes in a shuffle. By those adaptive execution
    would put together many millions of them, far more than their size says once they are sorted or
    hashed in one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *[quoted(k) for k in keys])


def failing_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A relation without rows that fails the job it is part of when a key is repeated.

    Reads and shuffles keys only, and in the same job as the rows they belong to. A hot key is not
    folded before the shuffle, as it is the error that is sought.
    """
    columns = [quoted(k) for k in keys]
    counted = (dealt_by_key(df.select(*columns), keys)
               .groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")))
    # The message holds the count, so the test cannot be moved below the aggregation.
    message = F.concat(F.lit("duplicate source key: "),
                       F.to_json(F.struct(*[at(k) for k in keys], "n_rows")))
    repeated = F.when(F.col("n_rows") > 1, F.raise_error(message).cast("boolean"))
    return counted.filter(repeated.otherwise(False))


def split_keyless(df: DataFrame, keys: Sequence[str],
                  null_safe: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key can match another, and the others, which take no part in joins."""
    if null_safe:
        return df, None
    return df.filter(~any_null(keys)), df.filter(any_null(keys))


def _ranked(df: DataFrame, keys: Sequence[str], prefer: str) -> DataFrame:
    """Rows with their ``__rank`` among those of their key."""
    comparable = [f.name for f in df.schema.fields if f.name not in (*keys, prefer)
                  and f.dataType.typeName() not in ("map", "variant")]
    best = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(
        *[at(c).desc() for c in (prefer, *comparable)])
    return df.withColumn("__rank", F.row_number().over(best))


def unique_keyed(df: DataFrame, keys: Sequence[str], prefer: str) -> DataFrame:
    """Of the rows of one key, that with the largest ``prefer``; further columns break ties.

    All rows must have a key. Spark applies the limit of one row per key in the map
    tasks already, so a hot key shuffles one row per task.
    """
    return _ranked(df, keys, prefer).filter(F.col("__rank") == 1).drop("__rank")


def one_row_per_key(df: DataFrame, keys: Sequence[str], prefer: str,
                    dealt: bool = False) -> DataFrame:
    """``unique_keyed``, with rows that have a NULL key left as they are.

    Reads its input twice; stage one that is costly to compute. ``dealt`` says that the rows are
    partitioned by the keys already (``dealt_by_key``); they are then read once and not shuffled. It
    only decides the plan. Fold copies before rows are dealt, as all rows of a key go to one task.
    """
    if dealt:
        return (_ranked(df, keys, prefer).filter((F.col("__rank") == 1) | any_null(keys))
                .drop("__rank"))
    keyed, keyless = split_keyless(df, keys)
    return unique_keyed(keyed, keys, prefer).unionAll(keyless)


def assign_surrogates(df: DataFrame, key: str, order_by: Sequence[str], start: int) -> DataFrame:
    """Consecutive numbers from ``start`` in the order of ``order_by``, without a global sort task.

    Rows are range-partitioned on the ordering columns, a random last column
    spreading rows that are alike, sorted in their partitions and checkpointed, so
    that neither pass sees rows move when an executor is lost. The offsets are one
    row per partition.
    """
    shared_folder(df.sparkSession)
    order = [at(c).asc_nulls_last() for c in order_by]
    fixed = (df.withColumn("__spread", F.rand(7))
             .repartitionByRange(*order, F.col("__spread").asc())
             .sortWithinPartitions(*order).drop("__spread").checkpoint())
    position = F.monotonically_increasing_id()
    placed = fixed.select("*", F.shiftright(position, 33).alias("__part"),
                          position.bitwiseAND(F.lit((1 << 33) - 1)).alias("__place"))
    # One row per partition: small enough for one task and for a broadcast at any scale.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
               .select("__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0))
                       .alias("__before")))
    return (placed.join(F.broadcast(offsets), "__part")
            .withColumn(key, F.lit(start).cast("bigint") + F.col("__before") + F.col("__place"))
            .select(*[at(c) for c in df.columns], key))


def next_surrogate(existing: DataFrame, key: str) -> int:
    """One more than the largest key in use."""
    largest = existing.agg(F.max(at(key))).first()[0]
    return FIRST_SURROGATE if largest is None else largest + 1
