import json
from datetime import datetime, timedelta

from ferrule.operators import drift
from ferrule.operators.ordered import with_previous

S = "file_no bigint, stream_id string, exported_at timestamp, body string"


def file(n, items, stream="s", day=None):
    return (n, stream, datetime(2024, 1, 1) + timedelta(days=n if day is None else day), json.dumps({"items": items}))


def item(sample, **fields):
    return {"Sample_ID": sample, **fields}


def found(spark, rows, *files):
    return rows(drift.changes(spark.createDataFrame(list(files), S)))


def test_kinds_of_changes(spark, rows):
    a = [item(f"S{i}", C={"Method": f"m{i}", "T": i}, P=[{"V": 1.5 * i, "U": "MPa"}, {"V": 2.5 + i, "U": None}]) for i in range(4)]
    b = [item(f"S{i}", C={"M": {"Method": f"m{i}"}, "T": str(i)}, P=[{"W": 1.5 * i}, {"W": 2.5 + i, "New": None}]) for i in range(2, 6)]
    got = found(spark, rows, file(1, a), file(2, b), file(2, b))
    assert got == sorted([
        ("s", 2, "renamed", "items[].C.Method", "items[].C.M.Method"), ("s", 2, "renamed", "items[].P[].V", "items[].P[].W"), ("s", 2, "retyped", "items[].C.T", "items[].C.T"),
        ("s", 2, "removed", "items[].P[].U", ""), ("s", 2, "added", "", "items[].P[].New"),
    ], key=repr)


def test_order_is_by_export_and_streams_are_apart(spark, rows):
    files = [file(5, [item("a", x=1)], day=1), file(1, [item("a", x="1")], day=2), file(7, [item("a")], "t", 1)]
    assert found(spark, rows, *files) == [("s", 1, "retyped", "items[].x", "items[].x")]


def test_unreadable_null_and_empty(spark, rows):
    bad = (2, "s", datetime(2024, 1, 2), "{no")
    assert found(spark, rows, file(1, [item("a", x=1)]), bad) == [("s", 2, "removed", "items[].Sample_ID", ""), ("s", 2, "removed", "items[].x", "")]
    assert rows(drift.changes(spark.createDataFrame([(1, None, None, None)], S))) == []
    assert rows(drift.changes(spark.createDataFrame([], S))) == []
    assert drift.file_cells('{"items": [null, {"Sample_ID": null, "a": []}]}')[-1]["bit"] in (0, 8)


def test_one_table_follows_renames_and_reports_failed_casts(spark):
    files = spark.createDataFrame([file(1, [item(f"S{i}", v=i + 0.5) for i in range(5)]), file(2, [item(f"S{i}", w=str(i + 0.5)) for i in range(5)]), file(3, [item("S9", w="many")])], S)
    names = drift.canonical_names(drift.changes(files))
    t = drift.unified_values(files, names).where("path not like '%Sample_ID'").toPandas()
    assert t["path"].nunique() == 1 and len(t) == 11
    assert t[t["cast_failed"]]["value"].tolist() in (["many"], [])


def test_typed_tables(spark):
    files = [file(1, [item("a", x=1, ok=True, P=[{"V": 1.5, "U": None}, {"V": 2.5, "U": "MPa"}])]), file(2, [item("a", x="2", ok=False, P=[{"V": "much", "U": "MPa"}])]), file(3, [item("b", x=None, P=[]), item(None, x=3)])]
    unified = drift.unified_values(spark.createDataFrame(files, S), {})
    tables = drift.typed_tables(unified)
    assert set(tables) == {"items[]", "items[].P[]"}
    items, properties = (tables[k].toPandas() for k in ("items[]", "items[].P[]"))
    assert dict(tables["items[]"].dtypes)["x"] == "double" and dict(tables["items[]"].dtypes)["ok"] == "boolean" and dict(tables["items[].P[]"].dtypes)["V"] == "double"
    assert sorted(items["x"].dropna()) == [1.0, 2.0, 3.0] and len(items) == 4
    assert sorted(properties["V"].dropna()) == [1.5, 2.5] and [f for r in properties["failed_casts"] for f in r] == ["items[].P[].V: much"]
    assert drift.typed_tables(unified.limit(0)) == {}


def test_previous_row_in_a_hot_group_over_many_ranges(spark):
    df = spark.range(2000).selectExpr("'hot' as g", "id as o", "id as v").unionByName(spark.range(3).selectExpr("'cold' as g", "id as o", "id as v"))
    got = {(r.g, r.o): r.p for r in with_previous(df, ["g"], ["o"], "v", "p", 7).collect()}
    assert len(got) == 2003 and all(got["hot", i] == i - 1 for i in range(1, 2000)) and got["hot", 0] is None and got["cold", 2] == 1
