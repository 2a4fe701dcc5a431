import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from ferrule.functions import scores
from ferrule.operators import matching


def value(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def test_treatment_ranges(spark):
    text = "Solution treatment at 1000-1100 °C for 2 to 4 h. Then aged at 1023 ~ 973 K, for 10-8 h; annealed at 500 K."
    got = {r.key: (r.low, r.high) for r in value(spark, scores.treatment_ranges(F.lit(text)))}
    assert got == {"Solution_Temperature_K": (1273.15, 1373.15), "Solution_Time_h": (2.0, 4.0), "Aging_Temperature_K": (973.0, 1023.0), "Aging_Time_h": (8.0, 10.0)}
    assert not value(spark, scores.treatment_ranges(F.lit(""))) and not value(spark, scores.treatment_ranges(F.lit(None).cast("string")))


@pytest.mark.parametrize("a,b,kind", [("LPBF", "laser powder bed fusion (LPBF)", "vocabulary"), ("LPBF + aging", "Selective laser melting", "substantive"), ("LPBF", " lpbf", "equal"), ("Casting + aging", "casting", "vocabulary"), ("laser powder bed fusion + HIP", "LPBF", "post_treatment"), ("casting", "LPBF", "substantive"), (None, None, "equal"), (None, "casting", "substantive")])
def test_process_difference(spark, a, b, kind):
    assert value(spark, scores.process_difference(F.lit(a).cast("string"), F.lit(b).cast("string"))) == kind


@pytest.mark.parametrize("name,kind", [("YieldStrength_YS", "yield_strength"), ("Hardness", "microhardness"), ("Grain size", "grainsize"), ("", "unknown"), (None, "unknown"), ("--", "unknown")])
def test_property_type(spark, name, kind):
    assert value(spark, scores.property_type(F.lit(name).cast("string"))) == kind


def test_titles_and_interface_lines(spark):
    assert value(spark, scores.wrapped_title(F.lit("\n  \nA long title of a paper on\nalloys and more\nText"))) == "A long title of a paper on alloys and more"
    for text in ("# A long title of a paper on\nalloys", "Short\nline", "A long title of a paper on\nAlloys", "A long title of a paper on", "", None):
        assert value(spark, scores.wrapped_title(F.lit(text).cast("string"))) is None
    lines = F.array(*[F.lit(x) for x in ["Check for", "updates", "A", *["x"] * 50, "updates"]])
    assert value(spark, F.size(scores.without_interface_lines(lines))) == 52


def brute(gold, found):
    """The least cost over all assignments, and how many pairs it has."""
    best = (math.inf, 0)
    for n in range(min(len(gold), len(found)) + 1):
        for g in itertools.combinations(gold, n):
            for f in itertools.permutations(found, n):
                cost = 1000.0 * (len(gold) - n)
                for (t, v), (u, w) in zip(g, f):
                    away = 0 if t is None and u is None else 10 if t is None or u is None else abs(t - u)
                    cost += math.inf if t is not None and u is not None and away > 1 else away + abs((v or 0) - (w or 0)) / 1000
                best = min(best, (round(cost, 6), -n))
    return best


def test_assigned_tests_cost_the_least(spark):
    rnd = random.Random(3)
    cases = {g: [[(rnd.choice([None, 298.0, 299.0, 299.1, 873.0]), rnd.choice([None, 1.0, 500.0, 700.0])) for _ in range(rnd.randrange(5))] for _ in range(2)] for g in range(25)}
    rows = [[(g, i, t, v) for g, sides in cases.items() for i, (t, v) in enumerate(sides[k])] for k in (0, 1)]
    gold, found = (spark.createDataFrame(r, "g int, test_pos int, t double, v double") for r in rows)
    got = {}
    for r in matching.assigned_tests(gold, found, ["g"], "test_pos").collect():
        got.setdefault(r.g, []).append((r.gold_test, r.found_test))
    for g, (a, b) in cases.items():
        pairs = got.get(g, [])
        assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        cost = 1000.0 * (len(a) - len(pairs))
        for i, j in pairs:
            (t, v), (u, w) = a[i], b[j]
            cost += (0 if t is None and u is None else 10 if t is None or u is None else abs(t - u)) + abs((v or 0) - (w or 0)) / 1000
        assert (round(cost, 6), -len(pairs)) == brute(a, b)
    assert matching.assigned_tests(gold.limit(0), found, ["g"], "test_pos").count() == 0
