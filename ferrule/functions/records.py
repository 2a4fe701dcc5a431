"""Functions on the blocks of extracted records: precipitates, feature maps, property entries, microstructure texts."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.functions.numbers import ELEMENTS, has_number, is_formula

#: Names of techniques: keys of feature maps that describe how, not what.
TECHNIQUES = frozenset("sem tem stem xrd eds edx ebsd apt xps om opticalmicroscopy afm".split())


def distinct_precipitates(items: DataFrame, precipitates: Column, *keys: str) -> DataFrame:
    """(keys, pos, phase, fraction): the precipitates of each item, of phases that differ in case only the first."""
    e = items.select(*keys, F.posexplode(precipitates).alias("pos", "p")).where(F.col("p").isNotNull())
    phase = F.trim(F.col("p.Phase_Type"))
    rows = e.select(*keys, "pos", phase.alias("phase"), F.col("p.Volume_Fraction_pct").alias("fraction")).where("phase is not null and phase <> ''")
    w = Window.partitionBy(*keys, F.lower("phase")).orderBy("pos")
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def microstructure_text(original: Column, simplified: Column, phase: Column) -> Column:
    """The text of a microstructure: the original, else the simplified one, else its phase."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(blank(original), blank(simplified), F.concat(F.lit("Main phase: "), blank(phase)))


def property_entries(rows: DataFrame, *keys: str) -> DataFrame:
    """Entries of a property list: with a value and a name that belongs to tests, not to density, porosity or cracks."""
    name = F.lower("Property_Name")
    return rows.where(F.col("Value_Numeric").isNotNull() & ~F.isnan("Value_Numeric") & F.col("Property_Name").isNotNull() & ~name.rlike(r"(^|_| )(density|porosity|crack)"))


def default_note(unit: Column, source: Column) -> Column:
    return F.when(source == "image", "digitised from a figure").when(unit.isNull() | (F.trim(unit) == ""), "unit not given")


def alias_keys(text: Column, aliases: dict[str, list[str]]) -> Column:
    """The canonical keys whose aliases a text holds, sorted."""
    low = F.lower(text)
    hits = []
    for key, names in sorted(aliases.items()):
        hit = F.lit(False)
        for n in names:
            hit = hit | F.contains(low, F.lit(n))
        hits.append(F.when(hit, F.lit(key)))
    return F.array_compact(F.array(*hits))


def suffixed_key(key: Column, stat: Column) -> Column:
    """The feature key of a scalar's statistic: 'Grain_Size' and 'max' make 'Grain_Size_max'."""
    s = F.lower(F.trim(stat))
    return F.concat(key, F.when(s.isin("avg", "mean", "average", "value"), "_avg").when(s.isin("std", "sd", "stdev"), "_std").when(s.isin("min", "minimum"), "_min").when(s.isin("max", "maximum"), "_max").otherwise(F.concat(F.lit("_"), s)))


def numeric_features(text: str | None) -> str | None:
    """A feature map as JSON with only what bears numbers: wrappers opened, keys of techniques left out. Null stays null."""
    if text is None:
        return None
    try:
        value = json.loads(text)
    except ValueError:
        return "{}"
    if isinstance(value, str):
        return numeric_features(value)

    def keep(v: object) -> object:
        if isinstance(v, dict):
            if set(v) <= {"value", "unit"} and "value" in v:
                return keep(v["value"])
            out = {k: x for k, x in ((k, keep(x)) for k, x in v.items() if re.sub(r"[^a-z]", "", k.lower()) not in TECHNIQUES) if x is not None}
            return out or None
        if isinstance(v, list):
            return [x for x in map(keep, v) if x is not None] or None
        if isinstance(v, bool) or v is None:
            return None
        return v if isinstance(v, (int, float)) or re.search(r"\d", str(v)) else None

    return json.dumps(keep(value) or {}, ensure_ascii=False, sort_keys=True)


def collected_text(text: str | None) -> list[str]:
    """All texts of a nested JSON, in order; keys 'text' and 'content' first among their neighbours."""
    out: list[str] = []
    try:
        stack = [json.loads(text or "null")]
    except ValueError:
        return out
    while stack:
        v = stack.pop()
        if isinstance(v, str):
            out += [v.strip()] if v.strip() else []
        elif isinstance(v, list):
            stack.extend(reversed(v))
        elif isinstance(v, dict):
            stack.extend(v[k] for k in sorted(v, key=lambda k: (k not in ("text", "content"), k), reverse=True))
    return out


def reading_order(boxes: list[tuple[float, float, float, float, str]]) -> list[str]:
    """Texts of boxes (x0, y0, x1, y1, text) as lines: boxes whose middles lie within a band make a line, from left to right."""
    if not boxes:
        return []
    heights = sorted(b[3] - b[1] for b in boxes)
    band = max(8.0, 0.45 * heights[len(heights) // 2])
    lines: list[tuple[float, list]] = []
    for b in sorted(boxes, key=lambda b: ((b[1] + b[3]) / 2, b[0])):
        y = (b[1] + b[3]) / 2
        if lines and abs(y - lines[-1][0]) <= band:
            n = len(lines[-1][1])
            lines[-1] = ((lines[-1][0] * n + y) / (n + 1), [*lines[-1][1], b])
        else:
            lines.append((y, [b]))
    return [" ".join(b[4] for b in sorted(bs)) for _, bs in lines]


def energy_density(text: str | None, reach: int = 80) -> str | None:
    """'low-high' of the energy densities in J/mm3 that a text names within ``reach`` letters of the words; null for none."""
    found = []
    for m in re.finditer(r"energy density", text or "", re.I):
        near = (text or "")[max(0, m.start() - reach) : m.end() + reach]
        found += [float(x) for x in re.findall(r"(\d+(?:\.\d+)?)\s*J\s*/?\s*mm", near)]
    if not found:
        return None
    low, high = min(found), max(found)
    return f"{low:g}" if low == high else f"{low:g}-{high:g}"


def recovered_formula(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, formula): the token of a text that is most likely its alloy's formula: the most elements, then the earliest."""
    t = lines.select(*keys, "pos", F.posexplode(F.split("line", r"[\s,;:()]+")).alias("i", "t"))
    t = t.withColumn("t", F.regexp_replace("t", r"\.$", "")).where(is_formula(F.col("t")))
    n = F.size(F.regexp_extract_all("t", F.lit(r"([A-Z][a-z]?)"), F.lit(1)))
    return t.groupBy(*keys).agg(F.max_by("t", F.struct(n, -F.col("pos"), -F.col("i"))).alias("formula"))


def row_clones(base: DataFrame, rows: DataFrame, key: str, code: str, least: int = 4) -> DataFrame:
    """The base item of each paper once for each parsed row, where there are ``least`` rows at least; other columns are kept."""
    enough = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(key)
    return base.join(rows.join(enough, key, "left_semi").select(key, F.col(code).alias("clone_code")), key)


__all__ = ["ELEMENTS", "alias_keys", "collected_text", "default_note", "distinct_precipitates", "energy_density", "has_number", "microstructure_text", "numeric_features", "property_entries", "reading_order", "recovered_formula", "row_clones", "suffixed_key"]
