import pytest
from pyspark.sql import functions as F

from ferrule.llm import canon, confusables

TERMS = [(1, "Property_Name", "Yield_Strength", ["YS", None]), (2, "Process_Category", "AM_LPBF", ["L-PBF"]), (3, "Alloy_Name_Raw", "Fe40Cr35Ni25", None), (4, "Alloy_Name_Raw", "Norvalloy 265", ["NV-265"]), (5, "Process_Category", "HIP", [])]
S = "term_id bigint, field_name string, term string, also_known_as array<string>"


@pytest.fixture(scope="module")
def terms(spark):
    return canon.read_canon(spark.createDataFrame(TERMS, S))


@pytest.mark.parametrize("text,term", [
    ("Cr35Fe40Ni25", 3), ("40Fe-35Cr-25Ni", 3), ("Fe 40 Cr 35 Ni 25 (at%)", 3), ("Fe₄₀Cr₃₅Ni₂₅", 3), ("F​e40Сr35Ni25 powder", 3), ("Fe41Cr34Ni25", 0), ("Fe40Cr35", 0),
    ("norvaloy-265", 4), ("NV 265", 4), ("Norvalloy No. 265", 4), ("Norvalloy 266", 0), ("this work", 0), ("", 0), (None, 0), ("Norvalloy 265 (wrought)", 4),
])
def test_alloys(terms, text, term):
    assert terms.find("Alloy_Name_Raw", text)["term_id"] == term


def test_match_gives_each_value_its_term(spark, terms, rows):
    df = spark.createDataFrame([(1, "ys"), (2, None), (3, ""), (4, "x" * 20_000), (1, "ys"), (5, "YS; see table")], "row_id bigint, value string").withColumn("term_id", F.lit("clash"))
    got = canon.match(df, terms, "Property_Name", "row_id", F.col("value")).select("row_id", "term_id").distinct()
    assert rows(got) == [(1, 1), (3, 0), (4, 0), (5, 0)]
    assert canon.match(df.limit(0), terms, "Property_Name", "row_id", F.col("value")).count() == 0
    assert canon.Canon([]).find("Property_Name", "a")["term_id"] == 0


@pytest.mark.parametrize("text,form", [
    ("Ｎｉ３０", "Ni30"), ("Сaldurех", "Caldurex"), ("a​b­c", "abc"), ("ﬁlm", "film"), ("nai\u0308ve", "na\u00efve"), ("held at 985 Κ fοr", "held at 985 K for"), ("415 °С", "415 °C"), ("610 ºC", "610 °C"), ("319 µm", "319 μm"), ("re‐used", "re-used"), ("a\u00a0b", "a b"), ("срeднее по", "среднее по"), ("μΑ∕cm²", "μA/cm²"),
])
def test_disguised(text, form):
    assert confusables.consistent(text) == form and text != form
    assert confusables.skeleton(text) == confusables.skeleton(form)


@pytest.mark.parametrize("text", ["", None, "α+β lath", "γ and γ′ by diffraction", "10⁻³ s⁻¹ in Ω·cm²", "в 770 °C", "在770 °C下退火（氩气），", "Größe 5 μm", "Fe₄₀", "Å"])
def test_in_place(text):
    assert confusables.consistent(text) == text


def test_unify_and_groups(spark, rows):
    df = spark.createDataFrame([(1, "Ni30"), (2, "Ｎｉ３０"), (2, "Ｎｉ３０"), (3, None), (4, "")], "row_id bigint, v string").withColumn("value", F.lit("clash"))
    u = confusables.unify(df, ["row_id"], {"v": F.col("v")})
    assert rows(u.where("changed").select("row_id").distinct()) == [(2,)]
    assert ("v", "Ni30", 2, 2) in rows(confusables.groups(u))
    assert confusables.unify(df.limit(0), ["row_id"], {"v": F.col("v")}).count() == 0


@pytest.mark.parametrize("text,form", [("ᎠᎡalloy", "DRalloy"), ("ɡrain", "grain"), ("Ⅳ", "IV"), ("allοy", "alloy"), ("αlloy", "αlloy"), ("сплав", "сплав"), ("α-phase", "α-phase")])
def test_read_by_skeleton(text, form):
    got = confusables.read(text)
    assert got["form"] == form and got["changed"] == (text != form)
    assert got["skeleton"] == confusables.skeleton(text)


def test_groups_count_repeated_rows_once(spark, rows):
    df = spark.createDataFrame([(1, "alloy"), (1, "alloy"), (2, "аlloy"), (3, None)], "row_id bigint, t string")
    unified = confusables.unify(df, ["row_id"], {"t": confusables.F.col("t")})
    assert rows(confusables.groups(unified)) == [("t", "alloy", 2, 2)]
