import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.functions import numbers as N
from ferrule.functions import process as P
from ferrule.functions import text as X
from ferrule.operators import hooks, layout, matching, merge, restructure, scoring, tables
from ferrule.sources import corpus
from ferrule.streaming import incremental


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize("text,k", [("measured at 298 K in air", 298.0), ("AT 873 K; compression", 873.0), ("tested at 25 C", 298.15), ("at 100 c in vacuum", 373.15), ("873K tensile test", 873.0), ("room temperature test", 298.15), ("tensile test under argon", None), ("", None)])
def test_kelvin(spark, text, k):
    assert value(spark, N.kelvin(F.lit(text))) == k


def test_numbers(spark):
    assert value(spark, N.formula(F.lit("FeCoCrNiMo0.5"))) == {"Fe": 1.0, "Co": 1.0, "Cr": 1.0, "Ni": 1.0, "Mo": 0.5}
    assert "Ba" not in value(spark, N.with_balance(F.lit("NiBalCr21.49W13.13"))) and value(spark, N.with_balance(F.lit("NiBalCr21.49W13.13")))["Ni"] == pytest.approx(65.38)
    assert value(spark, N.balance_line(F.lit("21.49 Cr - 13.13 W - 6.699 Co - Bal Ni")))["Ni"] == pytest.approx(58.681)
    m = value(spark, N.valid_map(F.create_map(*[F.lit(x) for x in ("Ti", 30.0, "Nb", 30.0, "Zr", 30.0)])))
    assert sum(m.values()) == pytest.approx(100, abs=1e-5)
    assert value(spark, N.valid_map(F.create_map(*[F.lit(x) for x in ("Ti", 50.0, "Xx", 50.0)]))) == {"Ti": 100.0}
    assert value(spark, N.no_large_other(F.create_map(*[F.lit(x) for x in ("Ni", 1.0, "Er", 1.0, "Zr", 0.73, "other", 97.27)]), F.lit("Al"))) == {"Ni": 1.0, "Er": 1.0, "Zr": 0.73, "Al": 97.27}
    v = value(spark, N.value_std_range(F.lit("10-20 MPa")))
    assert (v.value, v.range, v.std) == (15.0, "10-20", None) and value(spark, N.value_std_range(F.lit("12.5 ± 0.3"))).std == 0.3
    assert value(spark, N.span_text(F.lit(100.0), F.lit(50.0))) == "50-100" and value(spark, N.compact(F.lit(2.5))) == "2.5" and value(spark, N.first_number(F.lit("x -3.5 y"))) == -3.5
    assert value(spark, N.as_boolean(F.lit(" Yes "))) is True and value(spark, N.slug_upper(F.lit("a b-c"))) == "A_B_C" and value(spark, N.composition_type(F.lit("at. %"))) == "at%"


def test_normalisers_are_idempotent(spark):
    once = N.valid_map(F.create_map(*[F.lit(x) for x in ("Ti", 49.0, "V", 50.5)]))
    assert value(spark, once) == value(spark, N.valid_map(once))
    for f in (X.squeeze, X.decimal_repair, X.text_key, X.safe_name, N.slug_upper):
        assert value(spark, f(F.lit(" a  b/1，5 "))) == value(spark, f(f(F.lit(" a  b/1，5 "))))


def test_process_and_text(spark):
    assert value(spark, P.category(F.lit("made by L-PBF with graded powder blends"))) == "AM_LPBF + Powder_Blending + Graded_Composition"
    assert value(spark, P.category(F.lit("broadcast"))) == "Unknown" and value(spark, P.tensile_speed(F.lit("0.006 mm/s"))) == pytest.approx(0.36)
    assert value(spark, P.parameter(F.lit("laser power of 200 W"), "Laser_Power_W")) == 200.0 and value(spark, P.main_phase(F.lit("FCC with L12"))) == "FCC + L12"
    assert value(spark, X.first_doi(F.lit("see https://doi.org/10.1016/j.x.2020.1."))) == "10.1016/j.x.2020.1" and value(spark, X.latex(F.lit("α 1.5e-3"))) == r"\alpha 1.5 \times 10^{-3}"
    lines = spark.createDataFrame([(1, "Body\n\nBody\nReferences\n[1] x\nAppendix A\nkept"), (2, None), (3, "")], "id int, text string")
    kept = X.without_references(X.lines_of(lines, "text", "id"), "id").where("id = 1").orderBy("pos")
    assert [r.line for r in kept.collect()] == ["Body", "", "Body", "Appendix A", "kept"]
    assert X.normalized_lines(X.lines_of(lines, "text", "id"), "id").where("id = 1").count() == 5
    assert [r.v for r in spark.createDataFrame([("1. Introduction",), ("2.1 Methods",), ("Results",), ("a line of text.",)], "l string").select(X.heading_level(F.col("l")).alias("v")).collect()] == [2, 3, 2, None]


def test_figure_filter(spark, rows):
    B = "pos int, page int, typer string, block_label string, bbox array<double>, paper_id string"
    data = [(0, 1, "image", "image", [100.0, 100.0, 300.0, 300.0]), (1, 1, "paragraph", "text", [120.0, 120.0, 160.0, 140.0]), (2, 1, "paragraph", "text", [97.0, 97.0, 200.0, 200.0]), (3, 1, "paragraph", "text", [280.0, 100.0, 320.0, 120.0]), (4, 1, "paragraph", "figure_title", [120.0, 290.0, 200.0, 299.0]), (5, 2, "paragraph", "text", [120.0, 120.0, 160.0, 140.0]), (6, 1, "paragraph", "text", None), (7, 1, "table", "table", [120.0, 120.0, 160.0, 140.0])]
    df = spark.createDataFrame([(*d, "p") for d in data], B)
    kept = layout.not_within(df, df.where("typer = 'image'"), (F.col("typer") == "paragraph") & (F.col("block_label") != "figure_title"))
    assert sorted(r.pos for r in kept.collect()) == [0, 3, 4, 5, 6, 7]
    assert "CartesianProduct" not in kept._jdf.queryExecution().executedPlan().toString()


def test_tables(spark):
    html = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr><tr><td>x<sub>2</sub></td><td>y</td></tr></table>"
    assert tables.html_cells(html)[1] == {"row": 1, "col": 0, "name": "a", "value": "x_{2}"} and tables.html_markdown("<p>t</p>" + html).splitlines()[:2] == ["t", "| a | b |"]
    assert tables.html_markdown(None) is None and tables.html_cells("") == [] and tables.gap_columns("a    b\nc    d") == [["a", "b"], ["c", "d"]] and tables.gap_columns(None) is None
    rows = tables.text_rows(spark.createDataFrame([(1, "| a | b |\n|---|---|\n| 1 | 2 |\n| odd |"), (2, None)], "id int, t string"), "t", "id").orderBy("row").collect()
    assert [r.cells for r in rows] == [["a", "b"], ["1", "2"]]


def test_merge(spark, rows):
    runs = merge.ranked(spark.createDataFrame([("p", 1, 0.92, "A", "SEM"), ("p", 2, 0.88, "A", "a longer text"), ("p", 3, 0.92, "B", ""), ("p", 4, None, "C", None)], "p string, pos int, c double, k string, t string"), ["p"], "c", "pos")
    assert [r.pos for r in runs.orderBy("run_rank").collect()] == [1, 3, 2, 4]
    assert rows(merge.base_and_new(runs, ["p", "k"], "run_rank").select("k", "pos")) == [("A", 1), ("B", 3), ("C", 4)]
    assert rows(runs.groupBy("k").agg(merge.longest("t", "run_rank"), merge.first_filled("t", "run_rank"))) == [("A", "a longer text", "SEM"), ("B", "", None), ("C", None, None)]


def test_assignment_is_optimal():
    r = np.random.default_rng(1)
    for _ in range(100):
        n, m = (int(x) for x in r.integers(1, 6, 2))
        c = r.integers(0, 20, (n, m)).astype(float)
        got = matching.assignment(c)
        small, large, flip = (n, m, False) if n <= m else (m, n, True)
        best = min(sum(c[(p[i], i) if flip else (i, p[i])] for i in range(small)) for p in itertools.permutations(range(large), small))
        assert len(got) == small and sum(c[i, j] for i, j in got) == pytest.approx(best)


def test_matching(spark, rows):
    costs = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, 1.0), (1, 1, 1, 2.0), (1, 1, 0, 900.0)], "g int, a int, b int, cost double")
    assert rows(matching.optimal(costs, "g", "a", "b", 300.0)) == [(1, 0, 0, 5.0), (1, 1, 1, 2.0)]
    assert rows(matching.mutual_best(costs, "g", "a", "b").select("a", "b")) == [(0, 1)]
    scores = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, 5.0), (1, 1, 1, 9.0), (1, 1, 0, 1.0)], "g int, a int, b int, score double")
    assert rows(matching.greedy(scores, "g", "a", "b")) == [(1, 0, 1, 5.0)]
    t = "p string, u string, k int, t double, v double"
    near = matching.nearest_tests(spark.createDataFrame([("Y", "MPa", 1, 298.0, 5.0), ("Y", "GPa", 2, None, 1.0)], t), spark.createDataFrame([("Y", "MPa", 1, 299.0, 5.5), ("Y", "MPa", 2, 299.1, 5.0), ("Y", "GPa", 3, None, 1.0)], t), ["p", "u"], "k")
    assert rows(near.select("g", "f")) == [(1, 1), (2, 3)]
    assert matching.similarity("abc", "ABC") == 1.0 and matching.similarity(None, "a") == 0.0


def test_scores_and_restructure(spark, rows):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "t boolean, f boolean")
    assert rows(scoring.detection(df, F.col("t"), F.col("f"))) == [(1, 1, 1, 0.5, 0.5, 0.5)]
    assert rows(scoring.detection(df.limit(0), F.col("t"), F.col("f"))) == [(0, 0, 0, 0.0, 0.0, 0.0)]
    assert value(spark, scoring.quality_score(F.lit(1), F.lit(3), F.lit(True), F.lit(0.5), F.lit(0.25), F.lit(1.0))) == 66
    assert value(spark, restructure.pages_of(F.lit("3-1, 5,x,9-99"), F.lit(10))) == [1, 2, 3, 5, 9, 10] and value(spark, restructure.graded_family(F.lit("0 wt% to 30 wt.% and 45 % or 80 %"))) == [0.0, 30.0, 45.0]
    chain = spark.range(40).selectExpr("cast(id as string) a", "cast(id + 1 as string) b").unionByName(spark.createDataFrame([("x", "y")], "a string, b string"))
    got = restructure.linked(chain).groupBy("root").count().collect()
    assert sorted(r["count"] for r in got) == [2, 41]


def test_hooks(spark):
    assert hooks.first_object('say {bad {"a": 1} now') == {"a": 1} and hooks.first_object(None) is None and hooks.flatten_content([{"text": "a"}, "b", None]) == "a\nb"
    waits, tries = [], []
    with pytest.raises(ValueError):
        hooks.with_retry(lambda: tries.append(1) or (_ for _ in ()).throw(ValueError("x")), 3, 5.0, waits.append)
    assert waits == [5.0, 10.0] and len(tries) == 3
    with pytest.raises(hooks.Denied):
        hooks.with_retry(lambda: (_ for _ in ()).throw(hooks.Denied()), 3, 5.0, waits.append)
    out = hooks.ask_once(spark.createDataFrame([("a",), ("a",), (None,)], "n string"), ["n"], hooks.prompt_of("{n}!", n=F.col("n")), hooks.stub).collect()
    assert len(out) == 3 and all(json.loads(r.answer)["length"] in (1, 2) and r.error is None for r in out)
    assert value(spark, hooks.needs_rerun(F.lit(0.0), F.lit(" "), F.lit(False), F.lit(1), 3)) is True and value(spark, hooks.needs_rerun(F.lit(0.9), F.lit("ok"), F.lit(True), F.lit(3), 3)) is False


def test_corpus_and_streaming(spark, tmp_path, rows):
    (tmp_path / "in" / "processed").mkdir(parents=True)
    (tmp_path / "in" / "B.txt").write_bytes(b"ok \xff\xfe end")
    (tmp_path / "in" / "B.md").write_text("md")
    (tmp_path / "in" / "processed" / "c.md").write_text("no")
    files = corpus.one_per_stem(corpus.scan(spark, str(tmp_path / "in")))
    assert rows(files.select("stem", "ext", "text")) == [("B", "md", "md")]
    assert corpus.not_done(files, spark.createDataFrame([("B",)], "stem string")).count() == 0
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, o int, v string").write.parquet(str(tmp_path / "s"))
    for n in (0, 1):
        if n:
            spark.createDataFrame([(1, 3, "c"), (2, 1, "d")], "k int, o int, v string").write.mode("append").parquet(str(tmp_path / "s"))
        q = incremental.upsert_latest(incremental.new_rows(spark, str(tmp_path / "s"), "k int, o int, v string"), str(tmp_path / "t"), ["k"], ["o"], str(tmp_path / "c"))
        q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "t" / "v=1")).select("k", "v")) == [(1, "c"), (2, "d")]


def test_text_tracks(spark):
    from ferrule.functions import text

    tracks = lambda t: tuple(spark.range(1).select(text.text_tracks(F.lit(t).cast("string")).alias("t")).first().t)
    sentence = "The alloy was held at 900 K for two hours in a vacuum furnace and then cooled in flowing argon gas. "
    assert tracks(None) == tracks(" \n") == ("not provided", "not provided")
    assert tracks(" Short; text.\nEnd. ") == ("Short; text.\nEnd.",) * 2
    assert tracks(sentence * 7)[1] == (sentence * 5).strip() and tracks("x" * 800)[1] == "x" * 697 + "..."
    assert tracks(("a" * 200 + ";") * 7)[1] == " ".join(["a" * 200] * 5)[:697] + "..."
    assert tracks("Original: long text || Simplified: short") == ("long text", "short")


def test_optimal_weighs_what_is_left_alone(spark, rows):
    costs = spark.createDataFrame([(1, 0, 0, 900.0, 900.0, 900.0), (1, 0, 1, 1850.0, 900.0, 900.0), (2, 0, 0, 1801.0, 900.0, 900.0)], "g int, a int, b int, cost double, ga double, fa double")
    assert rows(matching.optimal(costs, "g", "a", "b", 300.0)) == []
    assert rows(matching.optimal(costs, "g", "a", "b", 300.0, "ga", "fa")) == [(1, 0, 0, 900.0)]
