import random

from hypothesis import given, settings
from hypothesis import strategies as st

import pandas as pd
from pyspark.sql import functions as F

from ferrule.operators import diff

S = "k string, s string, f string, g string"


def both(spark, a, b):
    return diff.diff_tables(spark.createDataFrame(a, S), spark.createDataFrame(b, S), ["k", "s"], ["f", "g"], "only_l", "only_r")


def brute(a, b):
    x, y = {(r[0], r[1]): r[2:] for r in a}, {(r[0], r[1]): r[2:] for r in b}
    out = [(*k, "only_l") for k in x if k not in y] + [(*k, "only_r") for k in y if k not in x]
    return sorted([*out, *((*k, n) for k in x if k in y for i, n in enumerate("fg") if x[k][i] != y[k][i])], key=repr)


def test_against_brute_force(spark, rows):
    r = random.Random(3)
    a = [(f"p{min(i % 7, 3)}", f"s{i}", r.choice("ab"), r.choice(["x", "", None])) for i in range(4000)]
    b = [(k, s, "z" if r.random() < 0.02 else f, g) for k, s, f, g in a if r.random() > 0.03] + [("p9", f"n{i}", "a", None) for i in range(20)]
    assert rows(both(spark, a, b).select("k", "s", "diff_kind")) == brute(a, b)


def test_null_empty_and_missing_sides(spark, rows):
    a = [(None, None, None, ""), ("p", "1", "x" * 100_000, None)]
    b = [(None, None, "", ""), ("p", "1", "x" * 100_000, None)]
    assert rows(both(spark, a, b).select("k", "s", "diff_kind")) == [(None, None, "f")]
    assert rows(both(spark, [], [])) == []
    assert {x[2] for x in rows(both(spark, a, []))} == {"only_l"}
    assert {x[2] for x in rows(both(spark, [], b))} == {"only_r"}


def test_equal_tables_send_no_rows_to_the_field_diff(spark):
    a = [("p", f"{i:06d}", "x", "y") for i in range(3000)]
    one = spark.createDataFrame(a, S)
    assert diff.unmatched_rows(one, one, ["k", "s"], ["f", "g"]).count() == 0
    changed = one.withColumn("f", F.when(F.col("s") == "001500", "new").otherwise(F.col("f")))
    assert 0 < diff.unmatched_rows(one, changed, ["k", "s"], ["f", "g"]).count() < 1000


def test_current_rows_take_the_latest_and_ignore_clashing_columns(spark, rows):
    df = spark.createDataFrame([("a", 1, "old", "r"), ("a", 2, "new", "v"), ("a", 2, "new", "v"), (None, None, "n", "o0")], "k string, at int, f string, v string")
    got = diff.current_rows(df, {"k": F.col("k")}, {"f": F.col("f")}, [F.col("at")])
    assert rows(got) == [("a", "new"), (None, "n")]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.booleans(), st.booleans()), max_size=80), st.integers(1, 20))
def test_any_batches_give_all_differing_rows(cells, size):
    """Whatever the cuts and batches are: rows that differ always come out, and both sides of a key alike."""
    left, right = {}, {}
    for k, in_left, same in cells:
        left[k], right[k] = (1, 1) if same else (1, 2)
        if not in_left:
            left.pop(k)
    frame = [(s, k, v) for k in sorted({*left, *right}) for s, side in enumerate((left, right)) for v in ([side[k]] if k in side else [])]
    df = pd.DataFrame(frame, columns=["_side", "_k", "_h1"])
    df["_h2"] = df["_h1"] * 7 + df["_k"]
    batches = (df.iloc[i : i + size].reset_index(drop=True).assign(key=lambda x: x["_k"]) for i in range(0, len(df), size))
    out = pd.concat([*diff._unmatched(batches), pd.DataFrame(columns=["_side", "key"])])
    got = {(int(s), int(k)) for s, k in zip(out["_side"], out["key"])}
    for k in {*left, *right}:
        if left.get(k) != right.get(k):
            assert all((s, k) in got for s, side in enumerate((left, right)) if k in side)
