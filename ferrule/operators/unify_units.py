"""Quantities recorded in different units, to the common unit of their property.

The unit of a number is known from the row's unit text, else from the row's other texts. Where both are silent, a
mixture on the log scale says how likely each listed unit is: its components are the property's own distribution,
learnt from rows of known unit, shifted by the known conversion factors; only the weights are fitted, by EM on a
histogram, from a prior that a row without any sign holds in the common unit. The posterior assigns the unit; where it
is not certain, the common one stays and the row is flagged.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.arrow import mapped
from ferrule.functions.lexicon import Lexicon
from ferrule.functions.units import Units, temperature_unit, to_kelvin
from ferrule.session import cut

#: Bins of a decade in the histograms.
BINS = 20
#: Weight that a component has before any row is seen: as many rows for the common unit, and for each other unit.
PRIOR_COMMON, PRIOR_OTHER = 5.0, 0.05
#: Below this posterior a unit is flagged as uncertain.
CERTAIN = 0.95
#: Rows that each of the two reference lists may have; more are an error.
MOST = 100_000


def reference(terms: DataFrame, unit_codes: DataFrame) -> tuple[Lexicon, Units]:
    """The term lexicon and the units, from the two fixed reference tables (some hundred rows; read to the driver)."""
    rows = terms.where("field_name = 'Property_Name'").select("term_id", "term", "also_known_as", "common_unit").limit(MOST + 1).collect()
    codes = unit_codes.select("unit_code", "symbol", "quantities").limit(MOST + 1).collect()
    if max(len(rows), len(codes)) > MOST:
        raise ValueError(f"a reference list of more than {MOST} rows")
    lexicon = Lexicon((r.term_id, [r.term, *(r.also_known_as or [])]) for r in rows)
    return lexicon, Units(((c.unit_code, c.symbol or "", c.quantities or []) for c in codes), {r.term_id: r.common_unit for r in rows if r.common_unit})


SIGN = "struct<_term:bigint, _code:string, _source:string, _factor:double>"
#: Columns that the operator adds; columns of these names in the input are replaced.
ADDED = ("term", "unit_code", "unit_source", "value_common", "likely_unit", "likely_p", "uncertain", "temperature_code", "temperature_k")


def with_signs(rows: DataFrame, lexicon: Lexicon, units: Units, texts: list[str]) -> DataFrame:
    """``rows`` with ``_term``, ``_code``, ``_source`` (unit, text or none) and ``_factor`` of Value_Numeric, and ``_temp_code``."""
    named: dict[str | None, int] = {}

    def sign(name: str | None, unit: str | None, value: float | None, *other: str | None) -> dict:
        if name not in named:
            named[name] = lexicon.find(name)[0]
        term = named[name]
        code, source = units.code(term, unit), "unit"
        if code is None:
            code, source = units.mentioned(term, value, *other), "text"
        if code is None:
            code, source = (units.common[term].name if term in units.common else None), "none"
        return {"_term": term, "_code": code, "_source": source, "_factor": units.factor(term, code) if code else None}

    s = mapped(sign, SIGN, "Property_Name", "Unit", "Value_Numeric", *texts)
    t = mapped(lambda v, *x: temperature_unit(v, *x), "string", "Test_Temperature_K", *texts)
    return rows.withColumn("_s", s).withColumn("_temp_code", t).select(*rows.columns, "_s.*", "_temp_code")


def fit_mixture(signed: DataFrame, units: Units) -> dict[int, dict]:
    """Of each term: mean and deviation of log10 |value| in the common unit, and the weight of each listed unit.

    What comes to the driver is a histogram: terms x two kinds of rows x bins of the number range, whatever the rows.
    """
    common = F.abs(F.col("Value_Numeric") * F.col("_factor"))
    known = F.col("_source") != "none"
    usable = signed.where("_factor is not null and Value_Numeric != 0 and not isnan(Value_Numeric)")
    bins = usable.groupBy(F.col("_term").alias("term"), known.alias("known"), F.floor(F.log10(common) * BINS).alias("bin")).count().collect()
    shape: dict[int, dict[bool, dict[int, int]]] = defaultdict(lambda: {True: {}, False: {}})
    for r in bins:
        if r.bin is not None:
            shape[r.term][r.known][r.bin] = r["count"]
    fitted = {}
    for term, kinds in shape.items():
        base = kinds[True] or kinds[False]
        x, n = (np.array(list(base)) + 0.5) / BINS, np.array(list(base.values()), dtype=float)
        mean = float((x * n).sum() / n.sum())
        deviation = max(math.sqrt(float(((x - mean) ** 2 * n).sum() / n.sum())), 0.05)
        codes = sorted({c.name: c for c in [units.common[term], *units.options[term]]})
        shift = np.array([math.log10(units.factor(term, c)) for c in codes])
        prior = np.array([PRIOR_COMMON if c == units.common[term].name else PRIOR_OTHER for c in codes])
        weights = prior / prior.sum()
        if free := kinds[False]:
            y, m = (np.array(list(free)) + 0.5) / BINS, np.array(list(free.values()), dtype=float)
            # A number y in unit c is 10^(y + shift) in the common one.
            density = np.exp(-0.5 * ((y[:, None] + shift[None, :] - mean) / deviation) ** 2) + 1e-12
            for _ in range(200):
                post = density * weights
                post /= post.sum(1, keepdims=True)
                new = (post * m[:, None]).sum(0) + prior
                new /= new.sum()
                if abs(new - weights).max() < 1e-9:
                    break
                weights = new
        fitted[term] = {"mean": mean, "deviation": deviation, "codes": codes, "shift": shift.tolist(), "weights": weights.tolist()}
    return fitted


def posterior(fitted: dict[int, dict], term: int | None, value: float | None) -> dict:
    """The likeliest unit of a bare number and its probability."""
    f = fitted.get(term)
    if f is None or not value or value != value:
        return {"likely": None, "p": None, "factor": None}
    y = math.log10(abs(value))
    p = [w * (math.exp(-0.5 * ((y + s - f["mean"]) / f["deviation"]) ** 2) + 1e-12) for w, s in zip(f["weights"], f["shift"])]
    best = max(range(len(p)), key=lambda i: p[i])
    return {"likely": f["codes"][best], "p": p[best] / sum(p), "factor": 10 ** f["shift"][best]}


def unify(rows: DataFrame, lexicon: Lexicon, units: Units, texts: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``rows`` with value and temperature in common units, how each unit is known, and what is uncertain.

    Adds term (0: none), unit_code, unit_source (unit, text, none), value_common, likely_unit, likely_p, uncertain,
    temperature_code, temperature_k. Nulls stay null; a value whose property has no term keeps its number. A row without
    any sign of a unit takes the unit that the mixture gives it with CERTAIN probability, else the common one, flagged.
    ``keep``: the columns wanted; then signs are written once for the mixture and the result, not read off twice.
    """
    rows = rows.drop(*ADDED, "_term", "_code", "_source", "_factor", "_temp_code", "_s", "_g")
    texts = [c for c in (texts or ["Test_Condition", "Note", "Value_Range"]) if c in rows.columns]
    signed = with_signs(rows, lexicon, units, texts)
    if keep is not None:
        wanted = dict.fromkeys([*keep, "Value_Numeric", "Test_Temperature_K"])
        rows = rows.select(*wanted)
        signed = cut(signed.select(*wanted, "_term", "_code", "_source", "_factor", "_temp_code"))
    fitted = fit_mixture(signed, units)
    bare = F.col("_source") == "none"
    guess = mapped(lambda t, v: posterior(fitted, t, v), "struct<likely:string, p:double, factor:double>", F.when(bare, F.col("_term")), F.when(bare, F.col("Value_Numeric")))
    kelvin: Column = F.col("Test_Temperature_K")
    kelvin = F.when(F.col("_temp_code") == "degC", kelvin + 273.15).when(F.col("_temp_code") == "degF", (kelvin - 32) / 1.8 + 273.15).otherwise(kelvin)
    told = bare & (F.col("_g.p") >= CERTAIN)
    return signed.withColumn("_g", guess).select(
        *rows.columns,
        F.col("_term").alias("term"),
        F.when(told, F.col("_g.likely")).otherwise(F.col("_code")).alias("unit_code"),
        F.col("_source").alias("unit_source"),
        (F.col("Value_Numeric") * F.when(told, F.col("_g.factor")).otherwise(F.coalesce("_factor", F.lit(1.0)))).alias("value_common"),
        F.col("_g.likely").alias("likely_unit"),
        F.col("_g.p").alias("likely_p"),
        F.coalesce(bare & (F.col("_g.p") < CERTAIN), F.lit(False)).alias("uncertain"),
        F.col("_temp_code").alias("temperature_code"),
        kelvin.alias("temperature_k"),
    )


def foreign_numbers(unified: DataFrame, units: Units) -> DataFrame:
    """(test_id, field_name, unit_code): numbers that change when put in the common unit, each once."""
    common = F.create_map(*[F.lit(x) for t, c in units.common.items() for x in (t, c.name)]) if units.common else F.lit(None).cast("map<bigint,string>")
    value = (F.col("unit_code") != F.try_element_at(common, F.col("term"))) & (F.col("Value_Numeric") != 0) & ~F.isnan("Value_Numeric")
    temperature = (F.col("temperature_code") != "K") & F.col("Test_Temperature_K").isNotNull()
    cases = F.array(
        F.when(value, F.struct(F.lit("Value_Numeric").alias("field_name"), F.col("unit_code").alias("code"))),
        F.when(temperature, F.struct(F.lit("Test_Temperature_K").alias("field_name"), F.col("temperature_code").alias("code"))),
    )
    found = unified.select("test_id", F.explode(F.array_compact(cases)).alias("c")).select("test_id", "c.field_name", F.col("c.code").alias("unit_code"))
    return found.distinct()


__all__ = ["fit_mixture", "foreign_numbers", "posterior", "reference", "to_kelvin", "unify", "with_signs"]
