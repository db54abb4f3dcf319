"""Flattening of structs, arrays and maps, and nesting of rows.

Schemas are walked as types, never as text, and nothing runs while a plan is
being built, except for the passes that must look at the data (``widen_arrays``
and dropping of NULL columns). Names are path parts joined with one underscore.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.columns import (
    at, clean_name, clean_names, distinct_names, drop_null_columns, is_array, is_array_or_map,
    is_map, is_struct,
)
from tidemark.session import shared_folder
from tidemark.sources.sinks import stage


def _leaves(parts: tuple[str, ...], value: Column, dtype: T.DataType,
            depth: int | None = None) -> Iterator[tuple[tuple[str, ...], Column, T.DataType]]:
    """Path, value and type of everything below a value that is not a struct."""
    if is_struct(dtype) and dtype.fields and (depth is None or depth > 0):
        below = None if depth is None else depth - 1
        for field in dtype.fields:
            yield from _leaves(parts + (field.name,), value.getField(field.name),
                               field.dataType, below)
    else:
        yield parts, value, dtype


def _frame_leaves(df: DataFrame, depth: int | None = None):
    for field in df.schema.fields:
        yield from _leaves((field.name,), at(field.name), field.dataType, depth)


# Characters that flattened names lose beside those of all column names.
_ILLEGAL_IN_PATHS = str.maketrans(dict.fromkeys('"[]', "_"))


def _joined(parts: Sequence[str]) -> str:
    return "_".join(clean_name(p).translate(_ILLEGAL_IN_PATHS) for p in parts)


def _explode(name: str, value: Column, dtype: T.DataType, outer: bool,
             positions: bool, position: str | None = None) -> Column:
    """A generator with the column names that go with it."""
    if positions:
        generator = (F.posexplode_outer if outer else F.posexplode)(value)
        names = [position or f"{name}_pos"]
    else:
        generator = (F.explode_outer if outer else F.explode)(value)
        names = []
    names += [f"{name}_key", f"{name}_value"] if is_map(dtype) else [name]
    return generator.alias(*names)


# Columns that tables split with ``keep_positions`` carry: the record's number, the positions on the
# way to a row, and those of the row of the table above that it belongs to.
RECORD, PLACE, PARENT = "__record", "__place", "__parent"
_CARRIED, _HERE = (RECORD, PLACE, PARENT), "__here"


def split_tables(df: DataFrame, name: str = "root", *, outer: bool = True,
                 positions: bool = True, keep_positions: bool = False) -> dict[str, DataFrame]:
    """One flat table per nesting grain.

    Structs are inlined. Every array or map becomes a child table, named
    ``parent_path``, that repeats the scalars of its parent. ``outer`` keeps parents of
    empty and NULL arrays with a row of NULLs. A level without scalars has no table of its
    own. Two tables of one name are an error.

    With ``keep_positions`` tables also repeat the positions of outer arrays, and carry what
    ``rejoin_tables`` needs: ``RECORD``, ``PLACE`` and ``PARENT``, whose metadata names the table
    above. The records are staged for that, so that all tables number them alike. Otherwise nothing
    runs; persist the input when several tables are to be written.
    """
    if not keep_positions:
        return _split(df, name, outer, positions, False, None, frozenset())
    marked = stage(df.withColumns({RECORD: F.monotonically_increasing_id(), PLACE: F.lit(""),
                                   PARENT: F.lit("")}), "records")
    return _split(marked, name, outer, positions, True, None, frozenset())


def _split(df: DataFrame, name: str, outer: bool, positions: bool, keep: bool, above: str | None,
           generated: frozenset[str]) -> dict[str, DataFrame]:
    """The tables of one level and those below. ``above`` is the nearest table with rows of its own,
    ``generated`` the columns that hold positions."""
    scalars: dict[str, Column] = {}
    nested: dict[str, tuple[Column, T.DataType]] = {}
    plain = df.drop(*_CARRIED) if keep else df
    leaves = [(_joined(parts), value, dtype) for parts, value, dtype in _frame_leaves(plain)]
    distinct_names([n for n, _, _ in leaves], f"flatten {name}")
    for path, value, dtype in leaves:
        if is_array_or_map(dtype):
            nested[path] = (value, dtype)
        else:
            scalars[path] = value
    tables: dict[str, DataFrame] = {}
    parent = PARENT
    if scalars:
        own = [at(RECORD), at(PLACE), at(PARENT).alias(PARENT, metadata={"above": above})] if keep else []
        tables[name] = df.select(*[v.alias(n) for n, v in scalars.items()], *own)
        above, parent = name, PLACE
    carried = [v.alias(n) for n, v in scalars.items() if keep or n not in generated]
    for path, (value, dtype) in nested.items():
        if keep:
            distinct_names([*scalars, *([f"{path}_pos"] if positions else [])], f"flatten {name}")
            child = df.select(*carried, at(RECORD), at(PLACE), at(parent).alias(PARENT),
                              _explode(path, value, dtype, outer, True, _HERE))
            step = F.concat(at(PLACE), F.lit("/"), F.coalesce(at(_HERE).cast("string"), F.lit("")))
            child = child.withColumn(PLACE, step)
            child = child.withColumnRenamed(_HERE, f"{path}_pos") if positions else child.drop(_HERE)
        else:
            child = df.select(*carried, _explode(path, value, dtype, outer, positions))
        below = _split(child, f"{name}_{path}", outer, positions, keep, above,
                       generated | {f"{path}_pos"})
        distinct_names([*tables, *below], f"flatten {name}: tables")
        tables.update(below)
    return tables


def rejoin_tables(tables: dict[str, DataFrame], keys: Sequence[str] = (),
                  root: str = "root") -> DataFrame:
    """Joins the tables of ``split_tables`` back into one.

    The tables must be split with ``keep_positions``: each row then carries the number of its record
    and the place of its parent, and its table the name of the one above. So neither names nor values
    decide who belongs to whom, and a parent is kept whatever is NULL or repeated in it. ``keys``, if
    given, must be in every table. Sibling children of one parent multiply. ``inline_tables`` gives
    the same rows without a join as long as the nested input is at hand.
    """
    def place_of(name: str) -> str:
        return f"{PLACE}_{name}"

    for name, table in tables.items():
        if not set(_CARRIED) <= set(table.columns):
            raise ValueError(f"table {name} doesn't say where its rows belong: "
                             "split with keep_positions=True")
        if not set(keys) <= set(table.columns):
            raise ValueError(f"table {name} lacks keys of {list(keys)}")
    parents = {name: child.schema[PARENT].metadata.get("above") for name, child in tables.items()}

    def depth(name: str) -> int:
        if name == root:
            return 0
        if parents[name] is None:
            raise ValueError(f"table {name} belongs to no table: {root} is another's")
        return 1 + depth(parents[name])

    first = tables[root]
    wide = first.select(*[at(c) for c in first.columns if c not in _CARRIED], at(RECORD),
                        at(PLACE).alias(place_of(root)))
    added = {root: [c for c in first.columns if c not in _CARRIED]}
    # Tables of one parent follow each other, so that they share a shuffle, and deeper ones, which
    # have the more rows, come last: each is shuffled once, and what it is joined to is still short.
    for name in sorted(tables, key=lambda n: (depth(n), parents[n] or "")):
        if name == root:
            continue
        child, above = tables[name], parents[name]
        own = [c for c in child.columns if c not in tables[above].columns]
        distinct_names([*[c for c in wide.columns if not c.startswith("__")], *own], f"rejoin {name}")
        side = child.select(at(RECORD).alias("__child"), at(PARENT), at(PLACE).alias(place_of(name)),
                            *[at(c) for c in own])
        match = (F.col("__child") == F.col(RECORD)) & (F.col(PARENT) == at(place_of(above)))
        wide = side.join(wide, match).select(*[at(c) for c in wide.columns],
                                             *[at(c) for c in own], at(place_of(name)))
        added[name] = own
    return wide.select(*[at(c) for name in tables for c in added[name]])


def inline_tables(df: DataFrame, *, outer: bool = True, positions: bool = True) -> DataFrame:
    """The fully flat table in one pass: all tables of ``split_tables`` joined, with no shuffle."""
    while True:
        leaves = [(_joined(parts), value, dtype) for parts, value, dtype in _frame_leaves(df)]
        distinct_names([n for n, _, _ in leaves], "flatten")
        nested = next((leaf for leaf in leaves if is_array_or_map(leaf[2])), None)
        if nested is None:
            return df.select(*[v.alias(n) for n, v, _ in leaves])
        df = df.select(*[_explode(n, v, t, outer, positions) if n == nested[0] else v.alias(n)
                         for n, v, t in leaves])


def _flat_element(dtype: T.StructType, element: Column) -> Column:
    fields = [f for field in dtype.fields
              for f in _leaves((field.name,), element.getField(field.name), field.dataType)]
    distinct_names(["_".join(p) for p, _, _ in fields], "flatten element")
    return F.struct(*[_flat_value(v, t).alias("_".join(p)) for p, v, t in fields])


def _flat_value(value: Column, dtype: T.DataType) -> Column:
    """Arrays of structs get flat elements; all else stays."""
    if is_array(dtype) and is_struct(dtype.elementType):
        return F.transform(value, lambda e: _flat_element(dtype.elementType, e))
    return value


def flatten_level(df: DataFrame) -> DataFrame:
    """Inlines structs, also inside the elements of arrays, without exploding any."""
    leaves = list(_frame_leaves(df))
    distinct_names(["_".join(p) for p, _, _ in leaves], "flatten")
    return df.select(*[_flat_value(v, t).alias("_".join(p)) for p, v, t in leaves])


def explode_arrays(df: DataFrame) -> DataFrame:
    """Explodes every array column, keeping rows of empty and NULL arrays; several multiply."""
    for field in df.schema.fields:
        if is_array(field.dataType):
            df = df.select(*[F.explode_outer(at(c)).alias(c) if c == field.name else at(c)
                             for c in df.columns])
    return df


def flatten_levels(df: DataFrame, levels: int = 1) -> DataFrame:
    """``flatten_level`` and ``explode_arrays``, repeated."""
    for _ in range(levels):
        df = explode_arrays(flatten_level(df))
    return df


def _flat_to_depth(df: DataFrame, depth: int | None) -> DataFrame:
    leaves = list(_frame_leaves(df, depth))
    distinct_names(["_".join(p) for p, _, _ in leaves], "normalize")
    return df.select(*[v.alias("_".join(p)) for p, v, _ in leaves])


def normalize_path(df: DataFrame, path: str | Sequence[str], level: int | None = None) -> DataFrame:
    """The records found at ``path``, flat down to ``level``, without all-NULL columns.

    Each part of the path names a field of the records reached so far; arrays on
    the way are exploded, and rows with empty or NULL arrays have no records. The records
    are staged, as their columns must be counted before they are read.
    """
    for part in [path] if isinstance(path, str) else path:
        field = df.schema[part]
        value = F.explode(at(part)) if is_array(field.dataType) else at(part)
        df = df.select(value.alias(part))
        reached = df.schema[part].dataType
        df = df.filter(at(part).isNotNull())
        if is_struct(reached):
            df = df.select(*[at(part).getField(f.name).alias(f.name) for f in reached.fields])
    return clean_names(drop_null_columns(stage(_flat_to_depth(df, level), "records"), "all"))


def normalize_any(df: DataFrame) -> DataFrame:
    """Flattens all structs and drops each column that holds a NULL."""
    return drop_null_columns(_flat_to_depth(df, None), "any")


def _containers(df: DataFrame) -> tuple[set[str], dict[str, T.DataType]]:
    """Names of array columns, and of map columns with the type of their keys."""
    return ({f.name for f in df.schema.fields if is_array(f.dataType)},
            {f.name: f.dataType.keyType for f in df.schema.fields if is_map(f.dataType)})


def _widen_level(df: DataFrame, widths: dict[str, int], keys: dict[str, list[str]],
                 checked: bool) -> DataFrame:
    """Arrays and maps that are columns become columns of their elements."""
    arrays, maps = _containers(df)
    wide: list[Column] = []
    for c in df.columns:
        if c in arrays:
            array, n = at(c), widths.get(c, 0)
            if checked and n:
                array = F.when(F.size(array) > n, F.raise_error(F.lit(
                    f"{c} has more than {n} elements")).cast(df.schema[c].dataType)) \
                    .otherwise(array)
            wide += [F.get(array, F.lit(i)).alias(f"{c}_{i}") for i in range(n)]
        elif c in maps:
            wide += [F.try_element_at(at(c), F.lit(k).cast(maps[c])).alias(f"{c}_{k}")
                     for k in keys.get(c, [])]
        else:
            wide.append(at(c))
    return df.select(*wide)


def _named_keys(name: str) -> Column:
    """The keys of a map column, each with the column's name."""
    found = F.transform(F.map_keys(at(name)), lambda k: F.struct(
        F.lit(name).alias("name"), k.cast("string").alias("key")))
    return F.coalesce(found, F.array().cast("array<struct<name:string,key:string>>"))


def measure_arrays(df: DataFrame) -> tuple[dict[str, int], dict[str, list[str]]]:
    """Widths of arrays and keys of maps at every depth, by flattened name.

    One pass per depth, over the containers of that depth alone. A width is an aggregate of its
    column; keys are exploded, as their number is not known, and folded in the map tasks. As many
    values reach the driver as ``widen_arrays`` makes columns of them.
    """
    widths: dict[str, int] = {}
    keys: dict[str, list[str]] = {}
    while True:
        df = _flat_to_depth(df, None)
        arrays, maps = _containers(df)
        if not arrays and not maps:
            return widths, keys
        df = df.select(*[at(c) for c in df.columns if c in arrays or c in maps])
        if arrays:
            found = df.agg(*[F.max(F.size(at(c))).alias(c) for c in sorted(arrays)]).first()
            widths |= {c: max(found[c] or 0, 0) for c in arrays}
        if maps:
            pairs = F.concat(*[_named_keys(c) for c in maps])
            for name, key in df.select(F.explode(pairs).alias("x")).select("x.*").distinct().collect():
                keys.setdefault(name, []).append(key)
            keys |= {c: sorted(keys[c]) for c in maps if c in keys}
        df = _widen_level(df, widths, keys, False)


def widen_arrays(df: DataFrame, widths: dict[str, int] | None = None,
                 keys: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per record: element ``i`` of an array becomes the column ``name_i``.

    Maps become one column per key. Widths and keys are given by flattened name, or else
    come from the data, in one pass for each depth of nesting. Given widths that are
    exceeded are an error when rows are computed; empty containers yield no column.
    """
    checked = widths is not None
    if widths is None or keys is None:
        found = measure_arrays(df)
        widths, keys = widths if checked else found[0], found[1] if keys is None else keys
    while True:
        df = _flat_to_depth(df, None)
        arrays, maps = _containers(df)
        if not arrays and not maps:
            return df.select(*[at(c).alias(clean_name(c)) for c in df.columns])
        df = _widen_level(df, widths, keys, checked)


def nest_rows(df: DataFrame, group_by: Sequence[str], columns: Sequence[str], into: str,
              part_size: int | None = None, part_col: str = "part", *,
              part_bytes: int | None = None) -> DataFrame:
    """Rows to lists of structs, in the order of the structs' fields.

    A list holds ``part_size`` rows at most: rows are numbered inside their group in that
    order, and each ``part_size`` of them in turn are one part, numbered from 0. With
    ``part_bytes`` instead, a part ends with the row that brings its rows, written as JSON, to so
    many bytes, so it is larger by one row at most; a row of several times that size leaves the
    numbers after its part out. Either way parts are the same in any layout of the input, and none
    is larger than a task can hold.

    Rows are range-partitioned by group and columns, a random last column spreading rows that
    are alike, and checkpointed. A group that spans partitions gets offsets, of which there
    are at most two per partition. Bytes are added up inside the pieces of groups that lie in one
    partition, for which rows are shuffled once more.
    """
    if (part_size is None) == (part_bytes is None):
        raise ValueError("give either part_size or part_bytes")
    shared_folder(df.sparkSession)
    place, task, spread, size, before = "__place", "__task", "__spread", "__size", "__before"
    wanted = df.select(*[at(c) for c in dict.fromkeys([*group_by, *columns])])
    names = list(wanted.columns)
    fixed = (wanted.withColumn(spread, F.rand(7))
             .repartitionByRange(*[at(c).asc() for c in names], F.col(spread).asc())
             .sortWithinPartitions(*[at(c) for c in names]).drop(spread).checkpoint())
    position = F.monotonically_increasing_id()
    placed = fixed.withColumns({task: F.shiftright(position, 33).cast("int"), place: position})
    keys = [at(g) for g in group_by]
    earlier = (Window.partitionBy(*keys).orderBy(task)
               .rowsBetween(Window.unboundedPreceding, -1))
    if part_bytes is None:
        measured, amount, zero = placed, F.count(F.lit(1)), F.min(place)
    else:
        ahead = (Window.partitionBy(task, *keys).orderBy(place)
                 .rowsBetween(Window.unboundedPreceding, -1))
        measured = placed.withColumn(size, F.octet_length(F.to_json(
            F.struct(*[at(c) for c in columns]))).cast("bigint"))
        measured = measured.withColumn(before, F.coalesce(F.sum(size).over(ahead), F.lit(0)))
        amount, zero = F.sum(size), F.lit(0).cast("bigint")
    pieces = measured.groupBy(task, *keys).agg(amount.alias("__amount"), zero.alias("__from"))
    starts = pieces.select(task, *[k.alias(f"__group_{i}") for i, k in enumerate(keys)],
                           (F.col("__from") - F.coalesce(F.sum("__amount").over(earlier), F.lit(0)))
                           .alias("__zero"))
    same = F.col(f"__start_{task}") == F.col(task)
    for i, key in enumerate(keys):
        same = same & key.eqNullSafe(F.col(f"__group_{i}"))
    starts = starts.withColumnRenamed(task, f"__start_{task}")
    here = F.col(place if part_bytes is None else before) - F.col("__zero")
    part = F.floor(here / F.lit(part_size or part_bytes)).cast("int")
    items = F.sort_array(F.collect_list(F.struct(*[at(c) for c in columns])))
    return (measured.join(starts, same).groupBy(*keys, part.alias(part_col))
            .agg(items.alias(into)))


def to_documents(df: DataFrame, into: str = "document",
                 json_columns: Sequence[str] = ()) -> DataFrame:
    """Each row as a JSON document without its NULL fields.

    Text in ``json_columns`` that parses as an object or array is embedded as
    such instead of being quoted.
    """
    def embedded(name: str) -> Column:
        text = F.btrim(at(name), F.lit(" \t\r\n"))
        looks_nested = text.rlike(r"(?s)^(\{.*\}|\[.*\])$")
        parsed = F.when(looks_nested, F.try_parse_json(text))
        return F.coalesce(parsed, at(name).cast("variant")).alias(name)
    fields = [embedded(c) if c in json_columns else at(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias(into))
