"""Queries beside their SQL on the smallest data, and the shape of plans."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")
CORE = [n for n in entry.oracle_sql() if n in {**entry.reference_queries.QUERIES, **entry.score_queries.QUERIES, **entry.core_queries.QUERIES}]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for p in Path(FOLDER).glob("*.parquet"):
        c.sql(f"create view {p.stem} as from '{p}'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    form = lambda x: "" if x is None or x != x else f"{float(x):.6g}" if isinstance(x, (int, float)) or type(x).__name__ == "Decimal" else str(x)
    return sorted(tuple(form(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", CORE)
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), want.columns)


def test_entry_and_plans(spark):
    assert entry.entry(spark).count() > 0
    for name in ("bbox_anti_join", "iou_best_match", "pair_cost", "positional_agreement", "p5_found"):
        assert "CartesianProduct" not in entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    plan = entry.queries()["temperature_to_k"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Value_Numeric" not in plan
