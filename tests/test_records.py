from pyspark.sql import functions as F

from ferrule.functions import records as R
from ferrule.functions import text as X
from ferrule.plans import reports
from ferrule.sources import settings


def test_kernels():
    assert R.energy_density("energy density of 60 J/mm3 up to 90.5 J/mm3") == "60-90.5" and R.energy_density(None) is None and R.energy_density("60 J/mm3") is None
    assert R.reading_order([(6, 1, 9, 11, "b"), (0, 0, 5, 10, "a"), (0, 30, 5, 40, "c")]) == ["a b", "c"] and R.reading_order([]) == []
    assert R.numeric_features('"{\\"SEM\\": 1, \\"a\\": {\\"value\\": \\"3 nm\\"}, \\"b\\": \\"x\\"}"') == '{"a": "3 nm"}' and R.numeric_features(None) is None and R.numeric_features("{bad") == "{}"
    assert R.collected_text('[{"b": ["c"], "text": "a"}, null]') == ["a", "c"] and R.collected_text(None) == []
    assert settings.env_faults('A="x\n# c\nB=1\n=2\n') == ["line 1: unbalanced quotes", "line 4: no NAME=value"] and settings.contract("a b", ["a", "z"]) == ["z"]
    assert reports.rounded({"a": [0.12345678]}) == {"a": [0.123457]}


def test_columns(spark, rows):
    df = spark.createDataFrame([("A. Smitha,b, B. Jones2", r"\alpha 2 and $\beta 3$", "the y phase", "Abstract\nKeywords: a")], "a string, b string, c string, d string")
    got = df.select(X.author_marks(F.col("a")), X.command_subscripts(F.col("b")), X.greek_repaired(F.col("c")), X.no_empty_abstract(F.col("d"))).collect()[0]
    assert tuple(got) == ("A. Smith^{a,b}, B. Jones^{2}", r"\alpha_{2} and $\beta 3$", "the γ phase", "Keywords: a")
    lines = spark.createDataFrame([(1, 0, "University of X"), (1, 1, "a,*"), (1, 2, "Body")], "id int, pos int, line string")
    assert rows(X.hanging_merged(lines, "id").select("line")) == [("Body",), ("University of X a,*",)]
    base = spark.createDataFrame([("p", "x"), ("q", "y")], "paper string, v string")
    made = R.row_clones(base, spark.createDataFrame([("p", f"c{i}") for i in range(4)] + [("q", "c0")], "paper string, code string"), "paper", "code")
    assert len(rows(made)) == 4
    assert "| paper | v |" in reports.report("T", {"part": base}) and '"v": "x"' in reports.as_json({"part": base})
    assert rows(settings.rule_table(spark, {"k": ["a", "b"]})) == [("a", "k", 0), ("b", "k", 0)]
