"""Rules by which an extraction is compared with what it should be, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Property types by their letters and digits only.
PROPERTY_ALIASES = {
    "yieldstrengthys": "yield_strength",
    "yieldstrength": "yield_strength",
    "ultimatetensilestrengthuts": "ultimate_tensile_strength",
    "ultimatetensilestrength": "ultimate_tensile_strength",
    "uniformelongationufe": "uniform_elongation",
    "uniformelongation": "uniform_elongation",
    "totalelongationte": "total_elongation",
    "totalelongation": "total_elongation",
    "youngsmodulus": "youngs_modulus",
    "fracturestrain": "fracture_strain",
    "latticeparameter": "lattice_parameter",
    "locallatticestrain": "local_lattice_strain",
    "yieldstrengthcompressive": "yield_strength_compressive",
    "ultimatestrengthcompressive": "ultimate_strength_compressive",
    "elongationcompressive": "elongation_compressive",
    "hardnesshv": "microhardness",
    "microhardness": "microhardness",
    "hardness": "microhardness",
}
# Names of processes that mean the same, and treatments after them that a comparison leaves out.
PROCESS_SYNONYMS = {
    "laser powder bed fusion (lpbf)": "laser powder bed fusion",
    "laser powder bed fusion (pbf-lb)": "laser powder bed fusion",
    "selective laser melting (slm)": "laser powder bed fusion",
    "selective laser melting": "laser powder bed fusion",
    "lpbf": "laser powder bed fusion",
    "electron beam powder bed fusion (pbf-eb)": "electron beam powder bed fusion",
    "electron beam melting (ebm)": "electron beam melting",
    "additive manufacturing - electron beam melting": "electron beam melting",
    "laser-aided additive manufacturing (laam)": "directed energy deposition",
    "directed energy deposition (ded)": "directed energy deposition",
    "laam": "directed energy deposition",
    "ded": "directed energy deposition",
}
POST_TREATMENTS = ("heat treatment", "annealing", "thermal stabilization", "aging", "solution treatment")
# What begins the passage that gives a treatment's range.
TREATMENTS = {"Solution": r"solution(?:\s+treatment)?", "Aging": "ag(?:ing|ed)?", "Annealing": "anneal(?:ed|ing)?"}
_NUMBER = r"(\d+(?:\.\d+)?)"


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def property_type(name: Column) -> Column:
    """The type a property's name stands for: its letters and digits, by alias if there is one; unknown if there are none."""
    letters = F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "")
    return F.coalesce(_lookup(letters, PROPERTY_ALIASES), F.nullif(letters, F.lit("")), F.lit("unknown"))


def process_key(category: Column) -> Column:
    """A process without the treatments after it, under the one name of its synonyms; null is nothing."""
    slug = F.lower(F.regexp_replace(F.trim(F.coalesce(category, F.lit(""))), r"\s+", " "))
    one = F.coalesce(_lookup(slug, PROCESS_SYNONYMS), slug)
    for t in POST_TREATMENTS:
        one = F.regexp_replace(one, rf" \+ {t}$", "")
    return F.trim(one)


def process_difference(gold: Column, found: Column) -> Column:
    """equal, vocabulary (other words for the same), post_treatment (one holds the other), or substantive."""
    slug = lambda c: F.lower(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\s+", " "))
    a, b = process_key(gold), process_key(found)
    held = (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    return F.when(slug(gold) == slug(found), "equal").when((a == b) & (a != ""), "vocabulary").when(held, "post_treatment").otherwise("substantive")


def treatment_ranges(text: Column) -> Column:
    """The ranges of temperature (in kelvin) and time that a text gives for each treatment, the first of each:
    array of (key, low, high), low to high."""
    found = []
    for name, begins in TREATMENTS.items():
        for key, unit in ((f"{name}_Temperature_K", r"(k|°?\s*c)\b"), (f"{name}_Time_h", r"(h)\b")):
            pattern = rf"(?i){begins}[^.;\n]{{0,80}}?{_NUMBER}\s*(?:-|to|~)\s*{_NUMBER}\s*{unit}"
            a, b = (F.regexp_extract(text, pattern, k).try_cast("double") for k in (1, 2))
            shift = F.when(F.contains(F.lower(F.regexp_extract(text, pattern, 3)), F.lit("c")), 273.15).otherwise(0.0)
            low, high = (F.round(f(a, b) + shift, 6) for f in (F.least, F.greatest))
            found.append(F.when(a.isNotNull(), F.struct(F.lit(key).alias("key"), low.alias("low"), high.alias("high"))))
    return F.array_compact(F.array(*found))


def without_interface_lines(lines: Column, head: int = 48, words: tuple[str, ...] = ("check for", "updates")) -> Column:
    """Lines without those among the first ``head`` that hold nothing but a button's words."""
    return F.filter(lines, lambda x, i: ~((i < head) & F.lower(F.trim(x)).isin(*words)))


def wrapped_title(text: Column) -> Column:
    """The title that the first two lines of a text make, if the second goes on in small letters; else null."""
    lines = F.split(F.regexp_replace(text, r"^(?:[ \t]*\n)+", ""), "\n")
    a, b = F.trim(lines[0]), F.trim(F.get(lines, F.lit(1)))
    plain = ~F.startswith(a, F.lit("#")) & ~F.contains(a, F.lit("$")) & ~F.contains(b, F.lit("$"))
    return F.when(plain & (F.length(a) >= 18) & b.rlike(r"^\p{Ll}"), F.concat_ws(" ", a, b))
