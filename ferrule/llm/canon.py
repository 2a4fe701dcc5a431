"""Freely entered values to the terms of a reference list.

A multi-pattern automaton over canonical names and aliases finds mentions, longest non-overlapping first; what has
none goes to token-set similarity. Alloys given by composition are compared as sets of element and amount, those
given by name by their name, which may be misspelt, and their number, which may not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.arrow import mapped
from ferrule.functions.lexicon import Lexicon, distance, key, slips, visible
from ferrule.llm.confusables import consistent

# Symbols of the elements.
ELEMENTS = frozenset(
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba "
    "La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm".split()
)
_UNIT = re.compile(r"[(\[,;]?\s*\b(?:at|wt|mol|mass)\.?\s*(?:%|pct|percent)\s*[)\]]?|[(\[]\s*(?:at|wt)\s*[)\]]", re.I)
_BESIDE = re.compile(r"\b(?:alloys?|hea|mea|powders?|system|sample|specimen|material|composition)\b|\bno\.?(?=\s*\d)", re.I)
_AFTER = re.compile(r"([A-Z][a-z]?)(\d+(?:\.\d+)?)?")
_BEFORE = re.compile(r"(\d+(?:\.\d+)?)([A-Z][a-z]?)")


def composition(text: str | None) -> frozenset[tuple[str, Decimal]] | None:
    """Elements with amounts, of a text that holds nothing else; None otherwise. An amount left out is 1."""
    if not text:
        return None
    t = _BESIDE.sub(" ", _UNIT.sub(" ", visible(consistent(text) or "")))
    t = re.sub(r"[\s_\-‐-―,;:·*/()\[\]]+", "", t).strip(".")
    for pattern, order in ((_AFTER, (1, 2)), (_BEFORE, (2, 1))):
        if re.fullmatch(f"(?:{pattern.pattern})+", t) and (parts := [(m[order[0]], m[order[1]]) for m in pattern.finditer(t)]):
            if all(e in ELEMENTS for e, _ in parts) and len({e for e, _ in parts}) == len(parts) and (len(parts) > 1 or parts[0][1]):
                try:
                    return frozenset((e, Decimal(n or "1").normalize()) for e, n in parts)
                except InvalidOperation:
                    return None
    return None


class Alloys:
    """Terms of alloys: by composition, or by name and number."""

    def __init__(self, terms: Iterable[tuple[int, Iterable[str]]]) -> None:
        self.mixed: dict[frozenset, int] = {}
        self.numbered: dict[str, list[tuple[str, int, bool]]] = {}
        rest = []
        for number, spellings in terms:
            spellings = [s for s in spellings if s]
            rest.append((number, spellings))
            for s in spellings:
                if c := composition(s):
                    self.mixed.setdefault(c, number)
                elif m := re.fullmatch(r"(\D+?)\s*(\d[\d.]*)", key(s)):
                    self.numbered.setdefault(m[2], []).append((m[1].replace(" ", ""), number, len(m[1]) > 3))
        self.lexicon = Lexicon(rest)

    def find(self, text: str | None) -> tuple[int, str, float]:
        """(term, route, similarity); term 0 where the list has none."""
        plain = consistent(text) if text else text
        if not plain or not plain.strip():
            return 0, "none", 0.0
        if c := composition(plain):
            return (self.mixed[c], "composition", 1.0) if c in self.mixed else (0, "none", 0.0)
        k = key(_BESIDE.sub(" ", plain))
        if k in self.lexicon.exact:
            return self.lexicon.exact[k], "spelling", 1.0
        glued = k.replace(" ", "")
        if m := re.fullmatch(r"(\D+?)(\d[\d.]*)", glued):
            return self._named(m[1], m[2])
        mention = self.lexicon.first_mention(k)
        if mention and not any(ch.isdigit() for ch in mention[1] + mention[2]):
            return mention[0], "mention", 1.0
        for m in re.finditer(r"([a-z]{4,})[\s-]*(\d+)(?!\d)", k):
            if (found := self._named(m[1], m[2]))[0]:
                return found
        return 0, "none", 0.0

    def _named(self, name: str, number: str) -> tuple[int, str, float]:
        best, score = 0, 0.0
        for known, term, long in self.numbered.get(number, []):
            if name == known:
                return term, "spelling", 1.0
            most = slips(len(known)) if long else 0
            if most and (d := distance(name, known, most)) <= most and 1 - d / len(known) > score:
                best, score = term, 1 - d / len(known)
        return (best, "similarity", score) if best else (0, "none", 0.0)


class Canon:
    """All fields of the reference list. ``steps``: fields whose values may list several steps, of which the first counts."""

    def __init__(self, rows: Iterable[tuple[int, str, str, Iterable[str] | None]], alloys: str = "Alloy_Name_Raw", steps: tuple[str, ...] = ("Process_Category",)) -> None:
        by: dict[str, list[tuple[int, list[str]]]] = {}
        for number, field, term, also in rows:
            if term:
                by.setdefault(field, []).append((number, [term, *(a for a in also or [] if a)]))
        self.steps = steps
        self.spelled = {f: {t[0] for _, t in terms} for f, terms in by.items()}
        self.finders = {f: Alloys(t) if f == alloys else Lexicon(t) for f, t in by.items()}

    def find(self, field: str, text: str | None) -> dict:
        if text is None or field not in self.finders:
            return {"term_id": 0, "route": "none", "similarity": 0.0}
        f = self.finders[field]
        term, route, score = f.find(text) if isinstance(f, Alloys) else f.find(consistent(text), field in self.steps)
        return {"term_id": term, "route": route, "similarity": float(score)}


FOUND = "struct<term_id:bigint, route:string, similarity:double>"


def read_canon(terms: DataFrame, most: int = 1_000_000) -> Canon:
    """The reference list on the driver, from where the UDF's closure carries it; its size is checked."""
    rows = terms.select("term_id", "field_name", "term", "also_known_as").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a reference list of more than {most} terms")
    return Canon((r.term_id, r.field_name, r.term, r.also_known_as) for r in rows)


def match(rows: DataFrame, canon: Canon, field: str, row_id: str, value: Column) -> DataFrame:
    """(field_name, row_id, value, term_id, route, similarity) of each value that isn't null; term 0 where there is none.

    A projection: no shuffle, so frequent values are no burden; a value repeated in a batch is matched once.
    """
    picked = rows.select(F.lit(field).alias("field_name"), F.col(row_id).alias("row_id"), value.alias("value")).where(F.col("value").isNotNull())
    found = picked.withColumn("_m", mapped(lambda v: canon.find(field, v), FOUND, "value"))
    return found.select("field_name", "row_id", "value", "_m.*")

