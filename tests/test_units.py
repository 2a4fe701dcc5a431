import math

import pytest

from ferrule.functions.lexicon import Lexicon, distance, key
from ferrule.functions.units import parse, temperature_unit, temperatures
from ferrule.operators import unify_units

CODES = [("MPa", "MPa", ["stress", "hardness"]), ("GPa", "GPa", ["stress", "hardness"]), ("ksi", "ksi", ["stress"]), ("HV", "HV", ["hardness"]), ("pct", "%", ["share"]), ("fraction", "1 = 100 %", ["share"]), ("um", "μm", ["length"]), ("mm", "mm", ["length"])]
TERMS = [(1, "Property_Name", "Yield_Strength", ["YS"], "MPa"), (2, "Property_Name", "Elongation", [], "pct"), (3, "Property_Name", "Hardness", [], "HV"), (4, "Property_Name", "Grain_Size", None, "um"), (9, "Other", "x", None, None)]
P = "test_id bigint, Property_Name string, Unit string, Value_Numeric double, Test_Temperature_K double, Test_Condition string, Note string, term string, _code string"


@pytest.fixture(scope="module")
def ref(spark):
    return unify_units.reference(spark.createDataFrame(TERMS, "term_id bigint, field_name string, term string, also_known_as array<string>, common_unit string"), spark.createDataFrame(CODES, "unit_code string, symbol string, quantities array<string>"))


def rows_of(*short):
    return [(i, *(*r, None, None)[:6], "clash", "clash") for i, r in enumerate(short, 1)]


@pytest.mark.parametrize("text,scale", [("N/mm2", 1e6), ("10^6 Pa", 1e6), ("×10³ MPa", 1e9), ("kN/mm²", 1e9), ("ksi", 6894757.29), ("kip/in2", 6894757.29), ("kgf per square mm", 9806650), ("[Mpa]", 1e6), ("MPa√m", 1e6), ("N mm^-3/2", 31622.78), ("µA cm-2", 0.01), ("％", 0.01), ("10^-9 m", 1e-9)])
def test_parse(text, scale):
    assert math.isclose(parse(text)[0], scale, rel_tol=1e-4)


@pytest.mark.parametrize("text", ["", None, "n/a", "furlongs", "(", "5"])
def test_no_unit(text):
    assert parse(text) is None


def test_units_come_from_unit_text_or_own_number(spark, ref):
    lexicon, units = ref
    data = rows_of(
        ("YS", "GPa", 0.5, 298.15), ("yield-strength", "", 70.0, 25.0, "tested at 25 °C", "unit of this line is ksi"), ("Yeild Strength", None, 500.0, 77.0, "500 MPa read", "load cell 5 GPa"), ("Elongation", "fraction", 0.2, 392.0, "at 392 °F", None),
        ("Hardness", "kgf/mm2", 300.0, None, None, None), ("Grain_Size", None, 5.0, 298.0, "gauge length 25 mm", None), ("Colour", "GPa", 1.0, 298.0, None, None), (None, None, None, None, None, None), ("YS", "GPa", 0.0, -196.0, "", "x" * 50_000), ("YS", "GPa", float("nan"), 298.0, None, None),
    )
    df = spark.createDataFrame(data + data[:1], P)
    found = {tuple(r) for r in unify_units.foreign_numbers(unify_units.unify(df, lexicon, units), units).collect()}
    assert found == {(1, "Value_Numeric", "GPa"), (2, "Value_Numeric", "ksi"), (2, "Test_Temperature_K", "degC"), (4, "Value_Numeric", "fraction"), (4, "Test_Temperature_K", "degF"), (9, "Test_Temperature_K", "degC")}
    empty = spark.createDataFrame([], P)
    assert unify_units.foreign_numbers(unify_units.unify(empty, lexicon, units), units).count() == 0


def test_mixture_finds_the_unit_of_bare_numbers(spark, ref):
    lexicon, units = ref
    known = [(i, "YS", "MPa", 300.0 + i, None, None, None, "", "") for i in range(200)]
    bare = [(1000 + i, "YS", None, 0.35 + i / 1000 if i % 2 else 350.0 + i, None, None, None, "", "") for i in range(100)]
    got = unify_units.unify(spark.createDataFrame(known + bare, P), lexicon, units).where("unit_source = 'none'").toPandas()
    small = got[got["Value_Numeric"] < 1]
    assert (small["likely_unit"] == "GPa").all() and (small["unit_code"] == "GPa").all() and not small["uncertain"].any()
    assert ((small["value_common"] - small["Value_Numeric"] * 1000).abs() < 1e-6).all()
    large = got[got["Value_Numeric"] > 100]
    assert (large["likely_unit"] == "MPa").all() and (large["unit_code"] == "MPa").all()


def test_found_rows_come_through_the_mixture(spark, ref):
    lexicon, units = ref
    known = [(i, "YS", "MPa", 300.0 + i, None, None, None, "", "") for i in range(200)]
    bare = [(1000 + i, "YS", None, 0.35 + i / 1000 if i % 3 == 0 else 350.0 + i, None, None, None, "", "") for i in range(90)]
    between = [(5000, "YS", None, 15.0, None, None, None, "", "")]
    df = spark.createDataFrame(known + bare + between, P)
    unified = unify_units.unify(df, lexicon, units, keep=["test_id"])
    found = {(r.test_id, r.unit_code) for r in unify_units.foreign_numbers(unified, units).collect()}
    assert found >= {(1000 + i, "GPa") for i in range(0, 90, 3)} and not found & {(1000 + i, "GPa") for i in range(90) if i % 3}
    same = unify_units.foreign_numbers(unify_units.unify(df, lexicon, units), units).collect()
    assert {(r.test_id, r.unit_code) for r in same} == found


def test_temperatures():
    assert temperature_unit(25.0, "tested at 25 °C") == "degC" and temperature_unit(298.15, "at 25 degC") == "K" and temperature_unit(25.0, "heated at 10 K/min to 298 K") == "degC"
    assert temperature_unit(77.0, "liquid nitrogen") == "K" and temperature_unit(None, "at 25 C") == "K" and temperature_unit(25.0) == "K"
    assert not temperatures("heated at 10 K/min", None, "")


def test_lexicon():
    lex = Lexicon([(1, ["Yield_Strength", "YS"]), (2, ["Tensile Strength"]), (3, ["laser powder bed fusion", "L-PBF"]), (4, ["HIP", "hot isostatic pressing"])])
    for text, n in (("strength, yield", 1), ("measured YS (this work)", 1), ("Tensiel  strenght", 2), ("tensilestrength", 2), ("YS​", 1), ("shear strength", 0), ("", 0), (None, 0), ("y", 0)):
        assert lex.find(text)[0] == n, text
    for text, n in (("lasr powder bed fusion followed by HIP", 3), ("L-PBF, then heat treated", 3), ("cold spray plus hot isostatic pressing", 0), ("HIP", 4)):
        assert lex.find(text, True)[0] == n, text
    assert distance("abcd", "abdc", 2) == 1 and distance("a", "xyz", 1) == 2 and key(" A_b-C. ") == "a b c"
    assert Lexicon([]).find("x") == (0, "none", 0.0)
