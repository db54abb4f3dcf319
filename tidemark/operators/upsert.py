"""Soft delete and upsert as joins that yield the next state of a table.

Plain files know no UPDATE or MERGE, so each function returns the whole new
state, to be written as the next version of the dataset.

The target is always the streamed side of an outer or semi join and the source
holds one row per key. A small source is broadcast by Spark and the target is not
shuffled; otherwise adaptive execution may split a target partition that a hot
key has made large, which it cannot do for a full outer join. Rows with a NULL
key match nothing, so they take no part in any join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.dates import instant
from tidemark.functions.hashing import deleted_hash
from tidemark.operators.columns import at, quoted
from tidemark.operators.keys import dealt_by_key, failing_duplicates, split_keyless, unique_keyed

SOURCE = "__source_"
MATCHED, CLOSING, CHANGED = "__matched", "__closing", "__changed"


def _prefixed(df: DataFrame) -> DataFrame:
    return df.toDF(*[SOURCE + c for c in df.columns])


def _same_key(keys: Sequence[str], null_safe: bool) -> Column:
    operator = "<=>" if null_safe else "="
    return F.expr(" AND ".join(f"{quoted(k)} {operator} {quoted(SOURCE + k)}" for k in keys))


def _match(target: DataFrame, source: DataFrame, keys: Sequence[str],
           null_safe: bool = False, shared: bool = False) -> DataFrame:
    """Every target row with its source row, if any, and a flag that tells.

    ``shared`` says that ``_unmatched_source`` joins the same source. Where keys aren't NULL, the
    source's key then is the flag, and columns get their prefix after the join, as Spark moves it
    behind the other join as well: both read one relation, which is shuffled once.
    """
    keyed, keyless = split_keyless(target, keys, null_safe)
    if shared and not null_safe:
        same = F.expr(" AND ".join(f"__target.{quoted(k)} = __source.{quoted(k)}" for k in keys))
        joined = (keyed.alias("__target").join(source.alias("__source"), same, "left_outer")
                  .select("__target.*", *[F.col(f"__source.{quoted(c)}").alias(SOURCE + c)
                                          for c in source.columns])
                  .withColumn(MATCHED, at(SOURCE + keys[0]).isNotNull()))
    else:
        marked = _prefixed(source).withColumn(MATCHED, F.lit(True))
        joined = (keyed.join(marked, _same_key(keys, null_safe), "left_outer")
                  .withColumn(MATCHED, F.coalesce(F.col(MATCHED), F.lit(False))))
    if keyless is None:
        return joined
    alone = [F.lit(None).cast(f.dataType).alias(SOURCE + f.name) for f in source.schema.fields]
    return joined.unionAll(keyless.select("*", *alone, F.lit(False).alias(MATCHED)))


def _unmatched_source(target: DataFrame, keyed: DataFrame, raw: DataFrame,
                      keys: Sequence[str], null_safe: bool, delta: bool) -> DataFrame:
    """Rows of ``keyed`` without a target row.

    Only key columns of the target are read. For a ``delta`` they are made distinct
    before their shuffle, so the partial aggregation folds hot keys, and are
    first reduced to keys of the source: Spark moves a semi join with a small
    source below that aggregation, and then no other target key is shuffled. It
    takes its keys from the ``raw`` source, so that the choice of one row per key
    is not made twice. Otherwise all keys are shuffled and dealt out first, so that
    no task gets too many of them; the copies of a hot key then meet in one task, as
    bare keys, of which it keeps one.
    """
    columns, condition = [quoted(k) for k in keys], _same_key(keys, null_safe)
    known = target.select(*columns)
    if delta:
        wanted = _prefixed(raw.select(*columns).distinct())
        known = known.distinct().join(wanted, condition, "left_semi")
    else:
        known = dealt_by_key(known, keys).distinct()
    return _prefixed(keyed).join(known, condition, "left_anti")


def _close(matched: DataFrame, as_of: datetime | str, end_col: str, update_col: str,
           hash_col: str, restamp_closed: bool) -> DataFrame:
    """Stamps the rows to be closed and flags them."""
    is_open, gone = at(end_col).isNull(), ~F.col(MATCHED)
    closing = gone | ~is_open if restamp_closed else gone & is_open
    stamps = {end_col: instant(as_of), update_col: instant(as_of), hash_col: deleted_hash()}
    return matched.withColumn(CLOSING, closing).withColumns(
        {c: F.when(F.col(CLOSING), v).otherwise(at(c)) for c, v in stamps.items()})


def soft_delete(target: DataFrame, source: DataFrame, keys: Sequence[str],
                as_of: datetime | str, *, end_col: str = "end_date",
                update_col: str = "update_date", hash_col: str = "change_hash",
                restamp_closed: bool = False, action_col: str | None = None) -> DataFrame:
    """Closes target rows whose key has left the source.

    By default only open rows are closed. With ``restamp_closed`` every row that is
    already closed is stamped again on each run, its key in the source or not.
    ``action_col`` adds ``close`` or ``same``.
    """
    live = source.select(*[quoted(k) for k in keys]).distinct()
    closed = _close(_match(target, live, keys), as_of, end_col, update_col, hash_col,
                    restamp_closed)
    told = [F.when(F.col(CLOSING), "close").otherwise("same").alias(action_col)] if action_col else []
    return closed.select(*[quoted(c) for c in target.columns], *told)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 as_of: datetime | str, *, hash_col: str = "change_hash",
                 stamp_on_update: Sequence[str] = ("update_date",),
                 stamp_on_insert: Sequence[str] = ("start_date", "creation_date", "update_date"),
                 keep_on_update: Sequence[str] = ("start_date", "creation_date"),
                 on_duplicate: str = "error", null_safe: bool = False, delta: bool = True,
                 action_col: str | None = None) -> DataFrame:
    """Updates matched rows whose hash differs and inserts source rows without a match.

    Repeated source keys fail the job (``error``), are settled in favour of the
    largest hash (``largest``), or are known not to occur (``unique``). The first and
    the last join the source as it is; prefer them, over a source made unique and
    staged beforehand, when target keys may be hot.

    Columns are mapped by name; target columns that the source lacks stay on update
    and are NULL on insert. A NULL hash on either side means no update, and a NULL
    key matches nothing, so such source rows are inserted each time (``null_safe``
    makes NULL keys equal). ``action_col`` adds ``insert``, ``update`` or ``same``.

    ``delta`` says that the source is small beside the target. It only decides the
    plan; set it to False for a source of about the target's size.
    """
    return _next_state(target, source, keys, as_of, None, hash_col=hash_col,
                       stamp_on_update=stamp_on_update, stamp_on_insert=stamp_on_insert,
                       keep_on_update=keep_on_update, on_duplicate=on_duplicate,
                       null_safe=null_safe, delta=delta, action_col=action_col)


def sync_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                as_of: datetime | str, *, end_col: str = "end_date",
                update_col: str = "update_date", hash_col: str = "change_hash",
                stamp_on_insert: Sequence[str] = ("start_date", "creation_date", "update_date"),
                keep_on_update: Sequence[str] = ("start_date", "creation_date"),
                on_duplicate: str = "error", restamp_closed: bool = False,
                action_col: str | None = None) -> DataFrame:
    """``soft_delete`` and then ``merge_upsert`` with the same whole snapshot, in one join.

    A row closed by an earlier run carries the deleted hash, so its key coming
    back counts as a change and opens it again. ``action_col`` may also say ``close``.
    """
    def close(matched: DataFrame) -> DataFrame:
        return _close(matched, as_of, end_col, update_col, hash_col, restamp_closed)
    return _next_state(target, source, keys, as_of, close, hash_col=hash_col,
                       stamp_on_update=(update_col,), stamp_on_insert=stamp_on_insert,
                       keep_on_update=keep_on_update, on_duplicate=on_duplicate,
                       null_safe=False, delta=False, action_col=action_col)


def _next_state(target: DataFrame, source: DataFrame, keys: Sequence[str],
                as_of: datetime | str, close, *, hash_col: str,
                stamp_on_update: Sequence[str], stamp_on_insert: Sequence[str],
                keep_on_update: Sequence[str], on_duplicate: str, null_safe: bool,
                delta: bool, action_col: str | None) -> DataFrame:
    """Rows that were there, closed and updated, together with rows that are new."""
    if on_duplicate not in ("error", "largest", "unique"):
        raise ValueError(f"on_duplicate must be error, largest or unique, not {on_duplicate!r}")
    spelled = {c.lower(): c for c in target.columns}
    source = source.toDF(*[spelled.get(c.lower(), c) for c in source.columns])
    raw, keyless = split_keyless(source, keys, null_safe)
    keyed = unique_keyed(raw, keys, hash_col) if on_duplicate == "largest" else raw
    types: dict[str, T.DataType] = {f.name: f.dataType for f in target.schema.fields}
    given = {f.name: f.dataType for f in source.schema.fields}
    now = f"TIMESTAMP_NTZ'{as_of}'"
    fixed = {*keys, *keep_on_update}

    def from_source(name: str) -> str:
        column = quoted(SOURCE + name)
        return column if given[name] == types[name] else (
            f"CAST({column} AS {types[name].simpleString()})")

    def updated(name: str) -> str:
        if name in stamp_on_update:
            return f"if({CHANGED}, {now}, {quoted(name)}) AS {quoted(name)}"
        if name in fixed or name not in given:
            return quoted(name)
        return f"if({CHANGED}, {from_source(name)}, {quoted(name)}) AS {quoted(name)}"

    def fresh(name: str) -> str:
        value = now if name in stamp_on_insert else (
            from_source(name) if name in given
            else f"CAST(NULL AS {types[name].simpleString()})")
        return f"{value} AS {quoted(name)}"

    kept, added = [updated(c) for c in types], [fresh(c) for c in types]
    if action_col:
        closed = f"WHEN {CLOSING} THEN 'close'" if close else ""
        kept.append(f"CASE WHEN {CHANGED} THEN 'update' {closed} ELSE 'same' END "
                    f"AS {quoted(action_col)}")
        added.append(f"'insert' AS {quoted(action_col)}")
    matched = _match(target, keyed, keys, null_safe, shared=True)
    matched = (close(matched) if close else matched).withColumn(
        CHANGED, F.expr(f"{MATCHED} AND {quoted(hash_col)} <> {quoted(SOURCE + hash_col)}"))
    inserted = _unmatched_source(target, keyed, raw, keys, null_safe, delta)
    result = matched.selectExpr(*kept).unionAll(inserted.selectExpr(*added))
    if keyless is not None:
        result = result.unionAll(_prefixed(keyless).selectExpr(*added))
    if on_duplicate == "error":
        # Without rows, or else the job fails; counted among the inserted rows.
        nothing = [f"CAST(NULL AS {t.simpleString()}) AS {quoted(c)}" for c, t in types.items()]
        check = failing_duplicates(raw, keys)
        result = result.unionAll(check.selectExpr(*nothing, *added[len(nothing):]))
    return result
