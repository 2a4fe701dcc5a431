"""Rules on process, microstructure and property texts, as columns over fixed tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrule.functions.numbers import _extract

# Process categories with the words that name them, in the order in which they are tried.
CATEGORY_WORDS = {
    "Laser_Glazing": ["laser glazing", "laser glazed", "laser remelting", "laser surface remelting"],
    "Hybrid_AM": ["hybrid additive manufacturing", "lpbf \\+ uam", "u-lpbf", "uam"],
    "Powder_Recycling": ["powder recycling", "recycled powder", "powder reuse", "reuse cycle"],
    "EBM": ["electron beam powder bed fusion", "powder bed fusion electron beam", "pbf-eb", "electron beam melting", "arcam"],
    "AM_DED": ["laser-aided additive manufacturing", "laser aided additive manufacturing", "laam", "directed energy deposition", "ded", "lens", "laser cladding", "laser metal deposition"],
    "AM_SLM": ["selective laser melting", "slm"],
    "AM_LPBF": ["laser powder bed fusion", "lpbf", "l-pbf", "pbf-lb", "laser beam powder bed fusion"],
    "WAAM": ["wire arc additive manufacturing", "waam", "wire arc additive"],
    "Powder_Metallurgy": ["powder metallurgy", "powder-metallurgy", "pm route", "hipped", "sintered", "isothermal forging", "isothermally forged"],
    "Wrought": ["thermomechanical processing", "wrought", "wrought alloy", "rolled", "rolling", "forged", "forging", "extruded", "extrusion"],
    "SPS": ["spark plasma sintering", "sps"],
    "HIP": ["hot isostatic pressing", "hip"],
    "Arc_Melting": ["vacuum arc melting", "arc melting", "arc-melting"],
    "Casting": ["casting", "cast", "suction casting", "melt spinning", "induction melting"],
    "Mechanical_Alloying": ["mechanical alloying", "high-energy ball milling", "ball milling"],
    "HeatTreat": ["heat treatment", "heat treated", "heat-treated", "annealed", "annealing", "aged", "aging", "solution treatment", "solutionized", "stress relieved", "stress-relieved"],
    "AM": ["additive manufacturing", "additively manufactured", "3d printing"],
}
# Phases by the words that name them.
PHASES = {"bcc": "BCC", "fcc": "FCC", "hcp": "HCP", "amorphous": "amorphous", "glassy": "amorphous", "l12": "L12", "laves": "Laves", "sigma phase": "sigma"}
PRECIPITATE_WORDS = ["precipitate", "precipitation", "carbide", "nitride", "oxide", "nbc", "cr23c6", "sigma phase", "mu phase", "chi phase", "l12", "l21", "laves"]
# Process parameters with the patterns that give them, the first that matches counts.
PARAMETERS = {
    "Laser_Power_W": [r"(?:laser power|power)\s*(?:of|was|is|set to)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*w([^a-z]|$)"],
    "Scan_Speed_mm_s": [r"scan(?:ning)? (?:speed|velocity)\s*(?:of|was|is|set to)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*mm/s"],
    "Layer_Thickness_um": [r"layer thickness\s*(?:of|was|is)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*(?:μm|um|µm)"],
    "Hatch_Spacing_um": [r"hatch(?:ing)? spac(?:e|ing)\s*(?:of|was|is|set to)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*(?:μm|um|µm)", r"line spacing\s*(?:of|was|is)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*(?:μm|um|µm)"],
    "Oxygen_Content_ppm": [r"oxygen content (?:of|below|under)?\s*([0-9]+)\s*ppm", r"([0-9]+)\s*ppm oxygen"],
    "Beam_Current_mA": [r"(?:beam )?current\s*(?:of|was|is|set to)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*ma([^a-z]|$)"],
    "Acceleration_Voltage_kV": [r"accelerati(?:on|ng) voltage\s*(?:of|was|is|set to)?\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*kv"],
}
# Other keys of parameters, with the factor and shift to the unit of the key meant.
KEY_ALIASES = [("Layer_Thickness_mm", "Layer_Thickness_um", 1000.0, 0.0), ("Build_Plate_Temperature_C", "Build_Plate_Temperature_K", 1.0, 273.15), ("Preheat_Temperature_C", "Build_Plate_Temperature_K", 1.0, 273.15), ("Scan_Speed_mm_min", "Scanning_Speed_mm_s", 1 / 60, 0.0), ("Scan_Speed_mm_s", "Scanning_Speed_mm_s", 1.0, 0.0), ("Hatch_Spacing_mm", "Hatch_Spacing_um", 1000.0, 0.0), ("Laser_Power_kW", "Laser_Power_W", 1000.0, 0.0)]
DISALLOWED_KEYS = ("Process_Category", "Process_Route", "Notes", "Note")
# The order in which property names are reported.
TIERS = [("yield_strength", 1), ("ultimate_tensile_strength", 2), ("elongation", 3), ("hardness", 4), ("modulus", 5), ("fatigue", 6), ("fracture_toughness", 7), ("density", 8)]


def _word(words: list[str]) -> str:
    return "(^|[^a-z0-9])(" + "|".join(sorted(words, key=len, reverse=True)) + ")([^a-z0-9]|$)"


CATEGORY_PATTERNS = {c: _word(w) for c, w in CATEGORY_WORDS.items()}


def matches(text: Column, category: str) -> Column:
    """Whether a text names a category, its words bounded by what is no letter or digit."""
    return F.coalesce(F.lower(text).rlike(CATEGORY_PATTERNS[category]), F.lit(False))


def category(text: Column) -> Column:
    """The first category in order that a text names, 'Unknown' for none; with suffixes of powder-bed routes."""
    out = F.when(matches(text, "Laser_Glazing"), "Laser_Glazing")
    for c in list(CATEGORY_WORDS)[1:]:
        hit = matches(text, c)
        out = out.when(hit & ~matches(text, "AM") if c == "Powder_Metallurgy" else hit, c)
    base = out.otherwise("Unknown")
    low = F.lower(text)
    blend = F.when(low.rlike("blend|premix|double hopper|mixing chamber"), " + Powder_Blending").otherwise("")
    graded = F.when(low.rlike("graded|gradient|stepwise"), " + Graded_Composition").otherwise("")
    return F.when(base == "AM_LPBF", F.concat(base, blend, graded)).otherwise(base)


def resolved_category(reported: Column, inferred: Column) -> Column:
    """The reported category where it is a known one, else the inferred one, else what was reported."""
    key = F.trim(reported)
    return F.when(key.isin(*CATEGORY_WORDS), key).when(inferred != "Unknown", inferred).otherwise(F.coalesce(F.nullif(key, F.lit("")), F.lit("Unknown")))


def post_treatment(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike(_word(CATEGORY_WORDS["HIP"])), "HIP").when(low.rlike("solution (treatment|treated|annealing).*ag(e|ing)"), "Solution+Aging").when(low.rlike(_word(["aging", "aged"])), "Aging").when(low.rlike("stress reliev"), "Stress_Relief").when(low.rlike(_word(["annealing", "annealed"])), "Annealing")


def humanized(cat: Column, text: Column) -> Column:
    """A category as words, with the treatment after it."""
    after = post_treatment(text)
    return F.concat(F.replace(cat, F.lit("_"), F.lit(" ")), F.coalesce(F.concat(F.lit(" + "), after), F.lit("")))


def parameter(text: Column, name: str) -> Column:
    """The value of a parameter by the first of its patterns that matches."""
    low = F.lower(text)
    return F.coalesce(*[_extract(low, p).try_cast("double") for p in PARAMETERS[name]])


def main_phase(text: Column) -> Column:
    """Up to three phases in the order of the table, joined by ' + '; null where none is named."""
    low = F.lower(text)
    found = F.array_compact(F.array(*[F.when(low.rlike(_word([w])), F.lit(p)) for w, p in PHASES.items()]))
    return F.nullif(F.array_join(F.slice(F.array_distinct(found), 1, 3), " + "), F.lit(""))


def has_precipitates(text: Column) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for w in PRECIPITATE_WORDS:
        out = out | low.contains(w)
    return F.coalesce(out, F.lit(False))


def without_absolute(value: Column, context: Column) -> Column:
    """A percentage of 0 or 100 only where the text says so."""
    return F.when((value == 100) & ~F.coalesce(context.rlike(r"(^|[^0-9.])100(\.0+)?\s*%"), F.lit(False)), None).when((value == 0) & ~F.coalesce(context.rlike(r"(^|[^0-9.])0(\.0+)?\s*%"), F.lit(False)), None).otherwise(value)


def tier(name: Column) -> Column:
    low = F.lower(name)
    out = F.when(low.startswith(TIERS[0][0]), TIERS[0][1])
    for prefix, n in TIERS[1:]:
        out = out.when(low.contains(prefix), n)
    return out.otherwise(99)


def snake(name: Column) -> Column:
    """A property's name with its words joined by underscores."""
    return F.trim(F.regexp_replace(F.trim(name), r"[^A-Za-z0-9]+", "_"), F.lit("_"))


def default_unit(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("hardness"), "HV").when(low.rlike("strength|stress"), "MPa").when(low.contains("modulus"), "GPa").when(low.rlike("elongation|strain|density_rel|relative_density"), "%").when(low.contains("density"), "g/cm3").when(low.contains("grain_size"), "um")


def strain_rate(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"([0-9.]+\s*(?:×|x|e|\*)?\s*(?:10)?\^?[-−⁻]?[0-9⁻⁰¹²³⁴⁵]*)\s*(?:s\^?-1|s⁻¹|1/s|/s)", 1), F.lit(""))


def tensile_speed(text: Column) -> Column:
    """Millimetres a minute; a speed by second is multiplied by 60."""
    per_second = _extract(F.lower(text), r"([0-9]+(?:\.[0-9]+)?)\s*mm/s([^a-z]|$)").try_cast("double")
    return F.coalesce(_extract(F.lower(text), r"([0-9]+(?:\.[0-9]+)?)\s*mm/min").try_cast("double"), per_second * 60)


def data_source(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.rlike("fig|image|plot|curve|graph"), "image").when(low.rlike("table|text|abstract"), "text").otherwise("text")
