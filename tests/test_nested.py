"""Flattening, nesting and column operators on small tables."""

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F, types as T

from tidemark.operators.columns import (
    clean_names, conform, drop_null_columns, narrow_decimals, null_profile, rename_columns,
    typed_projection,
)
from tidemark.operators.nested import (
    explode_arrays, flatten_level, flatten_levels, inline_tables, measure_arrays, nest_rows,
    normalize_any, normalize_path, rejoin_tables, split_tables, to_documents, widen_arrays,
)

ARRAYS = "id int, xs array<int>"


@pytest.mark.parametrize("outer, expected", [
    (True, [(1, None), (2, None), (3, 7), (3, 8)]), (False, [(3, 7), (3, 8)])])
def test_empty_and_null_arrays(spark, rows, outer, expected):
    df = spark.createDataFrame([(1, None), (2, []), (3, [7, 8])], ARRAYS)
    assert rows(split_tables(df, outer=outer)["root_xs"], "id", "xs") == expected


def test_positions_are_left_to_their_own_table(spark):
    df = spark.createDataFrame([], "id int, a array<struct<x: int, b: array<int>>>")
    tables = split_tables(df)
    assert {n: t.columns for n, t in tables.items()} == {
        "root": ["id"], "root_a": ["id", "a_pos", "a_x"],
        "root_a_a_b": ["id", "a_x", "a_b_pos", "a_b"]}
    assert split_tables(df, positions=False)["root_a"].columns == ["id", "a_x"]


def test_no_scalars_at_the_root(spark):
    df = spark.createDataFrame([([1], ["a"])], "xs array<int>, ys array<string>")
    assert set(split_tables(df)) == {"root_xs", "root_ys"}


def test_decimals_and_misleading_names(spark):
    df = spark.createDataFrame(
        [], "s struct<a: decimal(10,2), b: int>, t struct<array_x: int, `struct y`: string>")
    root = split_tables(df)["root"]
    assert [(f.name, f.dataType.simpleString()) for f in root.schema.fields] == [
        ("s_a", "decimal(10,2)"), ("s_b", "int"), ("t_array_x", "int"), ("t_struct_y", "string")]


def test_name_clash_fails(spark):
    with pytest.raises(ValueError, match="clash"):
        split_tables(spark.createDataFrame([], "a_b int, a struct<b: int>"))


def test_maps(spark, rows):
    df = spark.createDataFrame([(1, {"k": 5}), (2, None)], "id int, m map<string, int>")
    tables = split_tables(df)
    assert rows(tables["root_m"]) == [(1, 0, "k", 5), (2, None, None, None)]
    assert split_tables(df, positions=False)["root_m"].columns == ["id", "m_key", "m_value"]


def test_flatten_builds_without_jobs(spark):
    df = spark.createDataFrame([], "id int, a array<struct<b: array<int>>>, m map<string, int>")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    split_tables(df), inline_tables(df), flatten_levels(df, 2)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_rejoin_keeps_parents_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, None, [1, 2], ["a"]), (None, "x", [], None)],
                               "id int, note string, xs array<int>, ys array<string>")
    joined = rejoin_tables(split_tables(df, keep_positions=True), ["id"])
    assert rows(joined, "id", "note", "xs", "ys") == [
        (1, None, 1, "a"), (1, None, 2, "a"), (None, "x", None, None)]
    assert rows(joined, *sorted(joined.columns)) == \
        rows(inline_tables(df), *sorted(joined.columns))


def test_inline_keeps_grandchildren_with_their_parent(spark, rows):
    df = spark.createDataFrame([(1, [("p", [1, 2]), ("q", [3])])],
                               "id int, a array<struct<n: string, xs: array<int>>>")
    assert rows(inline_tables(df, positions=False)) == [
        (1, "p", 1), (1, "p", 2), (1, "q", 3)]


def test_level_flattens_inside_arrays(spark, rows):
    df = spark.createDataFrame([((1, ("z",)), [((2, 3), "e")])],
                               "s struct<a: int, t: struct<u: string>>, "
                               "xs array<struct<p: struct<q: int, r: int>, w: string>>")
    flat = flatten_level(df)
    assert flat.columns == ["s_a", "s_t_u", "xs"]
    assert flat.schema["xs"].dataType.elementType.fieldNames() == ["p_q", "p_r", "w"]
    assert flat.selectExpr("inline(xs)").first() == (2, 3, "e")


def test_names_with_dots(spark, rows):
    df = spark.createDataFrame([((1,), [(2,)])], "`a.b` struct<`c.d`: int>, "
                                                 "xs array<struct<`e.f`: int>>")
    assert flatten_level(df).columns == ["a.b_c.d", "xs"]
    assert rows(clean_names(flatten_levels(df, 2))) == [(1, 2)]


def test_explode_multiplies_siblings_and_keeps_a_column_called_col(spark, rows):
    df = spark.createDataFrame([(9, [1, 2], ["a", "b", "c"])],
                               "col int, xs array<int>, ys array<string>")
    exploded = explode_arrays(df)
    assert exploded.columns == ["col", "xs", "ys"]
    assert exploded.count() == 6
    assert rows(explode_arrays(spark.createDataFrame([(1, None), (2, [])], ARRAYS))) == [
        (1, None), (2, None)]


def test_clean_names_at_every_depth(spark):
    df = spark.createDataFrame(
        [], "`s-1` struct<`a b`: int, l: array<array<struct<`c.d`: int>>>>, "
            "m map<string, struct<`e:f`: int>>")
    assert clean_names(df).schema.simpleString() == (
        "struct<s_1:struct<a_b:int,l:array<array<struct<c_d:int>>>>,m:map<string,struct<e_f:int>>>")
    with pytest.raises(ValueError, match="clash"):
        clean_names(spark.createDataFrame([], "`a b` int, `a.b` int"))


def test_normalize_path(spark, rows):
    df = spark.createDataFrame(
        [([(1, (5, (6,)), None)],), ([],), (None,)],
        "items array<struct<`x y`: int, s: struct<t: int, u: struct<v: int>>, gone: string>>")
    assert normalize_path(df, "items").columns == ["x_y", "s_t", "s_u_v"]
    assert rows(normalize_path(df, "items")) == [(1, 5, 6)]
    assert normalize_path(df, "items", level=0).columns == ["x_y", "s"]
    assert normalize_path(df, "items", level=1).columns == ["x_y", "s_t", "s_u"]


def test_normalize_nested_path(spark, rows):
    df = spark.createDataFrame([(([([1],), ([2, 3],)],),)],
                               "a struct<b: array<struct<c: array<int>>>>")
    assert rows(normalize_path(df, ["a", "b", "c"])) == [(1,), (2,), (3,)]


def test_normalize_any_drops_columns_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, (2, None)), (2, (3, 4))], "id int, s struct<a: int, b: int>")
    assert rows(normalize_any(df)) == [(1, 2), (2, 3)]


def test_widen_arrays(spark, rows):
    df = spark.createDataFrame(
        [(1, [(5, ["x"]), (6, [])], {"k": 1}), (2, None, {"j": 2}), (3, [(7, ["y", "z"])], None)],
        "id int, a array<struct<n: int, t: array<string>>>, m map<string, int>")
    wide = widen_arrays(df)
    assert wide.columns == ["id", "a_0_n", "a_0_t_0", "a_0_t_1", "a_1_n", "m_j", "m_k"]
    assert rows(wide) == [(1, 5, "x", None, 6, None, 1), (2, None, None, None, None, 2, None),
                          (3, 7, "y", "z", None, None, None)]


def test_widen_arrays_with_given_widths(spark, rows):
    df = spark.createDataFrame([(1, [5, 6], {7: "x"})], "id int, a array<int>, m map<int, string>")
    assert rows(widen_arrays(df, {"a": 3}, {"m": ["7", "8"]})) == [(1, 5, 6, None, "x", None)]
    with pytest.raises(Exception, match="more than 1 elements"):
        widen_arrays(df, {"a": 1}, {}).collect()


def test_widen_reads_its_input_once(spark):
    assert measure_arrays(spark.createDataFrame(
        [({"k": [1, 2]}, [[3], [4, 5, 6]])], "m map<string, array<int>>, x array<array<int>>")) == (
        {"m_k": 2, "x": 2, "x_0": 1, "x_1": 3}, {"m": ["k"]})


def test_tables_of_one_name_fail(spark):
    with pytest.raises(ValueError, match="clash"):
        split_tables(spark.createDataFrame([], "a array<array<int>>, a_a array<int>"))


def test_brackets_and_quotes_leave_flattened_names(spark):
    df = spark.createDataFrame([], "`a[0]` struct<`b\"`: int>")
    assert split_tables(df)["root"].columns == ["a_0__b_"]


def test_rejoin_keeps_grandchildren_with_their_parent(spark, rows):
    df = spark.createDataFrame([(1, [("p", [1, 2]), ("q", [3]), ("r", None)]), (2, None)],
                               "id int, a array<struct<n: string, xs: array<int>>>")
    joined = rejoin_tables(split_tables(df, keep_positions=True), ["id"])
    assert rows(joined, *sorted(joined.columns)) == rows(inline_tables(df), *sorted(joined.columns))
    assert joined.count() == 5
    with pytest.raises(ValueError, match="keep_positions"):
        rejoin_tables(split_tables(df), ["id"])


def test_json_over_several_lines_is_embedded(spark, rows):
    df = spark.createDataFrame([('{\n "a":\n1}\n',), ('[1,\n2]',)], "j string")
    assert rows(to_documents(df, json_columns=["j"])) == [('{"j":[1,2]}',), ('{"j":{"a":1}}',)]


@pytest.mark.parametrize("layout", [1, 5, 13])
def test_nest_splits_large_groups_and_loses_nothing(spark, rows, layout):
    df = spark.range(1000).repartition(layout).select(
        F.when(F.col("id") < 700, "hot").when(F.col("id") < 710, None)
        .otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") % 50).alias("v"))
    nested = nest_rows(df, ["g"], ["v"], "vs", part_size=100)
    hot = sorted(nested.filter("g = 'hot'").collect(), key=lambda r: r.part)
    assert [x.v for r in hot for x in r.vs] == sorted(i % 50 for i in range(700))
    assert {len(r.vs) for r in hot} == {100}
    assert {r.part for r in hot} == set(range(7))
    assert nested.filter("g IS NULL").select(F.size("vs"), "part").collect() == [(10, 0)]
    assert nested.count() == 7 + 1 + 290


def test_nest_then_flatten(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    nested = nest_rows(df, ["k"], ["v"], "vs", part_size=10)
    assert rows(nested.select("k", "part", "vs.v")) == [(1, 0, ["a", "b"]), (2, 0, ["c"])]
    assert rows(explode_arrays(nested).select("k", "vs.v")) == rows(df)


def test_documents_leave_nulls_out(spark, rows):
    df = spark.createDataFrame([(1, None, ' {"a": [1, 2]} '), (2, "x", "{broken"), (3, "{}", None)],
                               "id int, s string, j string")
    assert rows(to_documents(df, json_columns=["j"])) == [
        ('{"id":1,"j":{"a":[1,2]}}',), ('{"id":2,"s":"x","j":"{broken"}',), ('{"id":3,"s":"{}"}',)]


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([], "a int, b int, c int")
    assert rename_columns(df, ["a", "b", "nope", "c"], ["b", "a", "x"]).columns == ["b", "a", "c"]
    with pytest.raises(ValueError, match="clash"):
        rename_columns(df, ["a"], ["B"])


def test_narrow_decimals(spark, rows):
    df = spark.sql("SELECT CAST(5 AS DECIMAL(38,0)) AS a, CAST(1.25 AS DECIMAL(6,2)) AS b, 'x' AS c")
    assert [f.dataType.simpleString() for f in narrow_decimals(df).schema] == [
        "bigint", "double", "string"]
    assert rows(narrow_decimals(df)) == [(5, 1.25, "x")]
    big = spark.sql("SELECT CAST('99999999999999999999' AS DECIMAL(38,0)) AS a")
    with pytest.raises((ArithmeticException, NumberFormatException)):
        narrow_decimals(big).collect()


def test_null_columns(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, None, 3)], "a int, b string, c int")
    assert drop_null_columns(df).columns == ["a", "c"]
    assert drop_null_columns(df, "any").columns == ["a"]
    assert drop_null_columns(df.limit(0)).columns == df.columns
    assert rows(null_profile(df)) == [("a", 2, 2), ("b", 2, 0), ("c", 2, 1)]


def test_typed_projection_and_conform(spark, rows):
    df = spark.createDataFrame([("1", ""), ("2", "y")], "x string, y string")
    assert rows(typed_projection(df, {"n": ("x", "int"), "s": ("y", "string")})) == [
        (1, None), (2, "y")]
    schema = T.StructType().add("Y", "string").add("new", "integer").add("x", "long")
    assert rows(conform(df, schema)) == [("", None, 1), ("y", None, 2)]


_TREE = ("id int, x_pos string, a array<struct<n: string, xs: array<int>>>, a_b array<int>, "
         "m map<string, array<int>>, deep array<array<array<int>>>")
_TREES = [(1, "p", [("p", [1, 2]), ("q", [3]), ("r", None)], [7, 8], {"k": [1, 2], "l": None}, [[[1], []], None]),
          (1, "p", [("p", [1, 2]), ("q", [3]), ("r", None)], [7, 8], {"k": [1, 2], "l": None}, [[[1], []], None]),
          (2, None, [], None, None, [[[4, 5]], [[6], [7, 8]]]), (None, "y", [(None, [9])], [], {}, None)]


@pytest.mark.parametrize("positions", [True, False])
@pytest.mark.parametrize("outer", [True, False])
def test_rejoin_by_carried_parents(spark, rows, outer, positions):
    """Names that begin alike, a scalar that is named like a position, repeated and NULL records."""
    df = spark.createDataFrame(_TREES, _TREE)
    df = df.drop("deep") if positions else df  # positions of arrays in arrays share one name
    tables = split_tables(df, outer=outer, positions=positions, keep_positions=True)
    joined, inline = rejoin_tables(tables), inline_tables(df, outer=outer, positions=positions)
    columns = sorted(joined.columns)
    assert columns == sorted(inline.columns) and joined.count() > 0
    assert rows(joined, *columns) == rows(inline, *columns)
    assert "x_pos" in tables["root_a"].columns and "x_pos" in split_tables(df)["root_a"].columns


def test_rejoin_of_stored_tables(spark, tmp_path, rows):
    df = spark.createDataFrame(_TREES, _TREE).drop("deep")
    tables = split_tables(df, keep_positions=True)
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / name))
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in tables}
    columns = sorted(inline_tables(df).columns)
    assert rows(rejoin_tables(stored, ["id"]), *columns) == rows(inline_tables(df), *columns)
    with pytest.raises(ValueError, match="lacks keys"):
        rejoin_tables(stored, ["nothing"])


@pytest.mark.parametrize("layout", [1, 7])
def test_parts_are_bounded_in_bytes(spark, layout):
    df = spark.range(600).repartition(layout).select(
        F.when(F.col("id") < 500, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        F.col("id").alias("v"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int") * F.when(
            F.col("id") == 17, 100).otherwise(1)).alias("s"))
    nested = nest_rows(df, ["g"], ["v", "s"], "vs", part_bytes=1000)
    parts = nested.select("g", "part", "vs", F.transform("vs", lambda x: F.octet_length(F.to_json(x)))
                          .alias("sizes")).orderBy("g", "part").collect()
    hot = [r for r in parts if r.g == "hot"]
    assert [x.v for r in hot for x in r.vs] == list(range(500)) and len(parts) > 100
    assert all(sum(r.sizes[:-1]) < 1000 for r in parts)
    ahead = 0
    for r in hot:
        assert r.part == ahead // 1000
        ahead += sum(r.sizes)
    with pytest.raises(ValueError, match="either"):
        nest_rows(df, ["g"], ["v"], "vs")


def test_widths_are_aggregated_not_exploded(spark):
    df = spark.createDataFrame(_TREES, _TREE)
    widths, keys = measure_arrays(df)
    assert keys == {"m": ["k", "l"]}
    assert widths == {"a": 3, "a_0_xs": 2, "a_1_xs": 1, "a_2_xs": 0, "a_b": 2, "m_k": 2, "m_l": 0, "deep": 2,
                      "deep_0": 2, "deep_1": 2, "deep_0_0": 2, "deep_0_1": 0, "deep_1_0": 1, "deep_1_1": 2}
