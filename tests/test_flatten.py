import json

from ferrule.operators.flatten import RecordTables, array_levels, json_root, merged_schema, text_leaves

SCHEMA = """record_no bigint, item_pos string, items array<struct<Sample_ID:string, Composition_Info:struct<Role:string, Nominal_Composition:struct<Elements_Normalized:map<string,double>>>,
  Process_Info:struct<Key_Params:string>, Microstructure_Info:struct<Precipitates:array<struct<Phase_Type:string>>, Advanced_Quantitative_Features:string>, Properties_Info:array<struct<Property_Name:string>>>>"""


def test_rows_keep_positions_and_skip_null_entries(spark, rows):
    items = [None, ("A", ("R", ({"Ti": 1.0, "other": 2.0, "V": None},)), ('{"a": 1, "S": [{"N": "x"}, null], "e": {}}',), ([None, ("p",)], '"{\\"f\\": true}"'), [("p0",), None]), (None, None, ("",), None, [])]
    df = spark.createDataFrame([(1, "clash", items), (1, "clash", items), (2, "c", None), (3, "c", [])], SCHEMA)
    assert rows(RecordTables(df).rows()) == sorted([
        (1, 1, "item", ""), (1, 2, "item", ""), (1, 1, "property", "0"), (1, 1, "precipitate", "1"), (1, 1, "nominal_element", "Ti"), (1, 1, "nominal_element", "other"),
        (1, 1, "param", "a"), (1, 1, "param", "S[0].N"), (1, 1, "feature", "f"),
    ], key=repr)
    assert RecordTables(spark.createDataFrame([], SCHEMA)).rows().count() == 0
    assert array_levels(df.schema) == ["items", "items[].Microstructure_Info.Precipitates", "items[].Properties_Info"]


def test_leaves():
    assert [x["path"] for x in text_leaves('{"a": {"b": [1, [2]]}, "c": null}')] == ["a.b[0]", "a.b[1][0]"]
    assert text_leaves(None) == text_leaves("") == text_leaves("{bad") == text_leaves("3") == [] and json_root('"{}"') == {}
    deep = "[" * 500 + "1" + "]" * 500
    assert len(text_leaves(deep)) == 1
    wrapped = '{"a": 1}'
    for _ in range(9):
        wrapped = json.dumps(wrapped)
    assert [x["path"] for x in text_leaves(wrapped)] == ["a"]


def test_merged_schema(spark, rows):
    df = spark.createDataFrame([('{"a": [1, "x"]}',), ('{"a": [2], "b": true}',), (None,)], "j string")
    assert rows(merged_schema(df, "j")) == [("a[]", "number", 2), ("a[]", "string", 1), ("b", "boolean", 1)]


def test_every_level_of_the_schema_has_a_table(spark, rows):
    schema = "record_no bigint, items array<struct<A:struct<B:struct<x:int>>, Steps:array<struct<Name:string, Holds:array<struct<t:int>>, Gas:map<string,int>>>>>"
    df = spark.createDataFrame([(1, [((((5,),)), [None, ("s", [None, (7,)], {"Ar": 1, "N": None})])])], schema)
    t = RecordTables(df)
    assert rows(t.rows()) == sorted([(1, 0, "item", ""), (1, 0, "Steps", "1"), (1, 0, "Steps[].Holds", "1/1"), (1, 0, "Steps[].Gas", "1/Ar")], key=repr)
    assert rows(t.item()) == [(1, 0, 5)] and rows(t.listed("Steps[].Holds")) == [(1, 0, 1, 1, 7)]


def test_flat_tables_hold_their_fields(spark):
    from pathlib import Path

    import pytest

    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test data")
    n = {k: r for k, r in entry.queries()["p6_found"](spark, folder).groupBy("child_kind").count().collect()}
    for name, kinds in {"items": ["item"], "elements": ["nominal_element", "measured_element"], "parameters": ["param"], "features": ["feature"], "precipitates": ["precipitate"], "properties": ["property"]}.items():
        df = entry.queries()[f"p6_{name}"](spark, folder)
        assert df.count() == sum(n[k] for k in kinds) and len(df.columns) > 3
