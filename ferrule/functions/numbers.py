"""Column functions on numbers, temperatures, formulas and composition maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbols of the elements.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba "
    "La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm"
).split()
_NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def _extract(c: Column, p: str, i: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, p, i), F.lit(""))


def first_number(c: Column) -> Column:
    """The first number of a text, null where there is none or it isn't finite."""
    n = _extract(c, r"(-?[0-9]+(?:\.[0-9]+)?)").try_cast("double")
    return F.when(F.abs(n) < float("inf"), n)


def value_std_range(c: Column) -> Column:
    """(value, std, range) of '12.5 ± 0.3', '10-20' (its middle) or a plain number."""
    pm = rf"(-?{_NUMBER})\s*(?:±|\+/-|\+-)\s*({_NUMBER})"
    span = rf"(-?{_NUMBER})\s*(?:-|–|to|~)\s*({_NUMBER})"
    low, high = _extract(c, span, 1).try_cast("double"), _extract(c, span, 2).try_cast("double")
    is_pm, is_span = c.rlike(pm), c.rlike(span)
    value = F.when(is_pm, _extract(c, pm, 1).try_cast("double")).when(is_span, (low + high) / 2).otherwise(first_number(c))
    return F.struct(value.alias("value"), F.when(is_pm, _extract(c, pm, 2).try_cast("double")).alias("std"), F.when(~is_pm & is_span, F.concat(_extract(c, span, 1), F.lit("-"), _extract(c, span, 2))).alias("range"))


def kelvin(c: Column) -> Column:
    """The temperature that a text names, in kelvin to two places; room temperature is 298.15."""
    low = F.lower(c)
    pattern = [(rf"at\s+({_NUMBER})\s*k([^a-z]|$)", 0.0), (rf"at\s+({_NUMBER})\s*(?:°\s*c|℃|c)([^a-z]|$)", 273.15), (rf"({_NUMBER})\s*k([^a-z/]|$)", 0.0), (rf"({_NUMBER})\s*(?:°\s*c|℃|deg c|c)([^a-z/]|$)", 273.15)]
    out = F.when(low.rlike(r"(^|[^a-z])(room temperature|ambient temperature|rt)([^a-z]|$)"), 298.15)
    for p, shift in pattern:
        out = out.when(low.rlike(p), F.round(_extract(low, p).try_cast("double") + shift, 2))
    return out


def compact(c: Column, places: int = 3) -> Column:
    """A number without zeros at its end."""
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{places}f", c), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def span_text(a: Column, b: Column, shift: bool = False) -> Column:
    """'low-high' of two numbers, shifted to kelvin and rounded where asked."""
    low, high = F.least(a, b), F.greatest(a, b)
    f = (lambda x: F.round(x + 273.15).cast("bigint").cast("string")) if shift else compact
    return F.concat(f(low), F.lit("-"), f(high))


def formula(c: Column) -> Column:
    """Element -> amount of a formula, amounts left out are 1, repeated elements added up; invalid symbols are left out."""
    parts = F.regexp_extract_all(c, F.lit(r"([A-Z][a-z]?)([0-9]+(?:\.[0-9]+)?)?"), F.lit(0))
    pairs = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^([A-Z][a-z]?)", 1).alias("e"), F.coalesce(_extract(p, r"([0-9.]+)$").try_cast("double"), F.lit(1.0)).alias("n")))
    pairs = F.filter(pairs, lambda p: p["e"].isin(*ELEMENTS))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["e"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.aggregate(F.filter(pairs, lambda p: p["e"] == k), F.lit(0.0), lambda s, p: s + p["n"])))


def with_balance(c: Column) -> Column:
    """A formula with 'XxBal', whose element takes what is missing to 100."""
    rest = formula(F.regexp_replace(c, r"([A-Z][a-z]?)[Bb]al", ""))
    element = _extract(c, r"([A-Z][a-z]?)[Bb]al")
    missing = F.greatest(F.lit(0.0), 100.0 - total(rest))
    return F.when(element.isNotNull(), F.map_concat(F.map_filter(rest, lambda k, v: k != element), F.create_map(element, F.round(missing, 6)))).otherwise(formula(c))


def balance_line(c: Column) -> Column:
    """Element -> percent of '21.49 Cr - 13.13 W - Bal Ni'; of an element named twice the first counts."""
    parts = F.split(c, r"\s+-\s+|,\s*")
    pairs = F.filter(F.transform(parts, lambda p: F.struct(_extract(p, r"([A-Z][a-z]?)\s*$").alias("e"), _extract(p, r"^\s*([0-9.]+)").try_cast("double").alias("n"))), lambda p: p["e"].isin(*ELEMENTS))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["e"]))
    first = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["e"] == k), 1)["n"]))
    known = F.aggregate(F.map_values(first), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    return F.transform_values(first, lambda k, v: F.coalesce(v, F.round(F.greatest(F.lit(0.0), 100.0 - known), 6)))


def total(m: Column) -> Column:
    return F.aggregate(F.map_values(m), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))


def valid_map(m: Column) -> Column:
    """A composition without invalid symbols and zeros, closed to 100: small gaps go to 'other', large ones are scaled away."""
    kept = F.map_filter(m, lambda k, v: (k.isin(*ELEMENTS) | (k == "other")) & v.isNotNull() & (F.abs(v) > 1e-12))
    s = total(kept)
    gap = F.round(100.0 - s, 6)
    scaled = F.transform_values(kept, lambda k, v: F.round(v * 100.0 / s, 6))
    closed = F.map_concat(F.map_filter(kept, lambda k, v: k != "other"), F.create_map(F.lit("other"), F.round(gap + F.coalesce(F.try_element_at(kept, F.lit("other")), F.lit(0.0)), 6)))
    return F.when(F.size(kept) == 0, kept).when(F.abs(gap) <= 1e-6, kept).when((F.abs(gap) > 2) | (gap < 0), scaled).otherwise(closed)


def no_large_other(m: Column, element: Column) -> Column:
    """A map whose 'other' above 50 belongs to the matrix element that it lacks."""
    other = F.try_element_at(m, F.lit("other"))
    return F.when((other > 50) & element.isNotNull() & ~F.map_contains_key(m, element), F.map_concat(F.map_filter(m, lambda k, v: k != "other"), F.create_map(element, other))).otherwise(m)


def main_element(m: Column) -> Column:
    """The element of the greatest amount, of equal ones the first by symbol."""
    entries = F.filter(F.map_entries(m), lambda e: (e["key"] != "other") & e["value"].isNotNull())
    return F.try_element_at(F.transform(F.array_sort(F.transform(entries, lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k")))), lambda e: e["k"]), F.lit(1))


def matrix_of_name(name: Column) -> Column:
    """The matrix element that a name tells: by family, else its first symbol."""
    low = F.lower(name)
    families = [("inconel|nimonic|hastelloy|nickel", "Ni"), ("steel|316|304|maraging", "Fe"), ("titanium|^ti-?6", "Ti"), ("aluminium|aluminum|alsi", "Al"), ("cobalt|stellite", "Co")]
    out = F.when(low.rlike(families[0][0]), families[0][1])
    for p, e in families[1:]:
        out = out.when(low.rlike(p), e)
    symbol = _extract(name, r"^([A-Z][a-z]?)")
    return out.when(symbol.isin(*ELEMENTS), symbol)


def blended(a: Column, b: Column, share: Column) -> Column:
    """The map of (1 - share) of one alloy and share of another."""
    zero = F.lit(0.0)
    return F.map_zip_with(a, b, lambda k, x, y: F.round((1 - share) * F.coalesce(x, zero) + share * F.coalesce(y, zero), 6))


def as_boolean(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when(t.isin("true", "yes", "y", "1"), True).when(t.isin("false", "no", "n", "0"), False)


def slug_upper(c: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(c, r"[^A-Za-z0-9]+", "_"), F.lit("_")))


def composition_type(c: Column) -> Column:
    """wt% or at% of a unit's spelling."""
    t = F.lower(F.regexp_replace(c, r"[\s.]", ""))
    return F.when(t.rlike(r"^(wt|mass|weight)"), "wt%").when(t.rlike(r"^(at|mol|atomic)"), "at%")


def equivalent(key: Column, a: Column, b: Column) -> Column:
    """Whether two numbers of a parameter say the same: by a factor of 1000, by Celsius and kelvin, else within 5 %."""
    same = F.abs(a - b) <= 0.05 * F.greatest(F.abs(a), F.abs(b), F.lit(1e-12))
    scaled = (F.abs(a * 1000 - b) <= 1e-6 * F.abs(b)) | (F.abs(b * 1000 - a) <= 1e-6 * F.abs(a))
    shifted = (F.abs(a + 273.15 - b) <= 1.5) | (F.abs(b + 273.15 - a) <= 1.5)
    low = F.lower(key)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).when(low.contains("temp"), same | shifted).when(low.rlike("thickness|spacing|speed|size"), same | scaled).otherwise(same)


def has_number(c: Column) -> Column:
    return c.rlike(r"[-+]?[0-9]+(?:\.[0-9]+)?")


def is_formula(c: Column) -> Column:
    """Whether a text is a formula of at least two valid elements without a variable x."""
    symbols = F.regexp_extract_all(c, F.lit(r"([A-Z][a-z]?)"), F.lit(1))
    return c.rlike(r"^(?:[A-Z][a-z]?(?:[0-9]+(?:\.[0-9]+)?)?)+$") & (F.size(symbols) >= 2) & F.forall(symbols, lambda s: s.isin(*ELEMENTS))


def clean(c: Column) -> Column:
    """Null for blank texts and for words that say that there is nothing."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin("", "not provided", "n/a", "none", "null", "unknown"), t)
