"""Units of measurement in text: parsing into scale and dimension, and finding them in a row's texts."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

#: Results that a Python worker remembers for each function.
REMEMBERED = 100_000
#: Exponents of kilogram, metre, second, ampere and kelvin, then of the two kinds that aren't SI: Vickers and share.
Dimension = tuple[float, ...]
_NONE: Dimension = (0.0,) * 7


def _d(kg: float = 0, m: float = 0, s: float = 0, a: float = 0, k: float = 0, hv: float = 0, share: float = 0) -> Dimension:
    return tuple(map(float, (kg, m, s, a, k, hv, share)))


_PA, _N, _J, _V, _OHM = _d(1, -1, -2), _d(1, 1, -2), _d(1, 2, -2), _d(1, 2, -3, -1), _d(1, 2, -3, -2)
_POUND, _INCH, _G = 0.45359237, 0.0254, 9.80665
_LBF = _POUND * _G
_PSI = _LBF / _INCH**2

# Unit names, their scale in SI units and their dimension.
_SYMBOLS: dict[str, tuple[float, Dimension]] = {
    "Pa": (1, _PA), "N": (1, _N), "J": (1, _J), "V": (1, _V), "Ω": (1, _OHM), "A": (1, _d(a=1)), "m": (1, _d(m=1)), "g": (1e-3, _d(1)),
    "s": (1, _d(s=1)), "K": (1, _d(k=1)), "W": (1, _d(1, 2, -3)), "L": (1e-3, _d(m=3)), "l": (1e-3, _d(m=3)),
}
_WORDS: dict[str, tuple[float, Dimension]] = {
    "pascal": (1, _PA), "newton": (1, _N), "joule": (1, _J), "volt": (1, _V), "ohm": (1, _OHM), "ampere": (1, _d(a=1)), "amp": (1, _d(a=1)),
    "metre": (1, _d(m=1)), "meter": (1, _d(m=1)), "gram": (1e-3, _d(1)), "litre": (1e-3, _d(m=3)), "liter": (1e-3, _d(m=3)), "kelvin": (1, _d(k=1)),
    "second": (1, _d(s=1)), "sec": (1, _d(s=1)), "min": (60, _d(s=1)), "h": (3600, _d(s=1)), "hr": (3600, _d(s=1)),
    "micron": (1e-6, _d(m=1)), "å": (1e-10, _d(m=1)), "angstrom": (1e-10, _d(m=1)), "angstroem": (1e-10, _d(m=1)), "ångström": (1e-10, _d(m=1)), "ångstrom": (1e-10, _d(m=1)),
    "in": (_INCH, _d(m=1)), "inch": (_INCH, _d(m=1)), "ft": (12 * _INCH, _d(m=1)), "mil": (_INCH / 1000, _d(m=1)), "cc": (1e-6, _d(m=3)), "t": (1e3, _d(1)), "tonne": (1e3, _d(1)),
    "lb": (_POUND, _d(1)), "pound": (_POUND, _d(1)), "oz": (_POUND / 16, _d(1)), "lbf": (_LBF, _N), "kip": (1e3 * _LBF, _N), "kgf": (_G, _N), "kp": (_G, _N), "gf": (_G / 1e3, _N), "dyn": (1e-5, _N), "erg": (1e-7, _J),
    "psi": (_PSI, _PA), "ksi": (1e3 * _PSI, _PA), "kpsi": (1e3 * _PSI, _PA), "msi": (1e6 * _PSI, _PA), "mpsi": (1e6 * _PSI, _PA), "bar": (1e5, _PA), "atm": (101325, _PA), "torr": (101325 / 760, _PA),
    "mpa": (1e6, _PA), "gpa": (1e9, _PA), "kpa": (1e3, _PA), "hv": (1, _d(hv=1)), "vickers": (1, _d(hv=1)), "vhn": (1, _d(hv=1)),
    "%": (1e-2, _d(share=1)), "pct": (1e-2, _d(share=1)), "percent": (1e-2, _d(share=1)), "ppm": (1e-6, _d(share=1)), "‰": (1e-3, _d(share=1)),
}
_PREFIXES = {"f": 1e-15, "p": 1e-12, "n": 1e-9, "u": 1e-6, "μ": 1e-6, "m": 1e-3, "c": 1e-2, "d": 1e-1, "k": 1e3, "M": 1e6, "G": 1e9, "T": 1e12}
_PREFIX_WORDS = {"pico": 1e-12, "nano": 1e-9, "micro": 1e-6, "milli": 1e-3, "centi": 1e-2, "kilo": 1e3, "mega": 1e6, "giga": 1e9}
#: Names of a share in parts of one.
_PART = frozenset(["fraction", "ratio", "part of 1", "parts of 1", "part of one", "parts per unit", "in/in", "mm/mm", "m/m", "cm/cm", "vol/vol", "kg/kg", "g/g", "abs", "strain", "absolute", "strain abs", "mm mm-1", "m m-1", "dimensionless", "unitless", "1", "1 = 100 %", "none", "-"])

_SUPER = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺·", "0123456789-+·")
_TOKEN = re.compile(r"\s*(?:(?P<num>\d+(?:\.\d+)?(?:e[+-]?\d+)?)(?:\^\(?(?P<pow>[+-]?\d+)\)?)?|(?P<root>√)|(?P<name>[A-Za-zμΩÅåöÖ%‰°']+)(?:\^?\(?(?P<exp>[+-]?\d+(?:\.\d+)?(?:/2)?)\)?)?|(?P<op>[·*×/()]))")


def tidy(text: str) -> str:
    """A unit's text with one form for exponents, products and widths."""
    text = re.sub("[⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺]+", lambda m: "^" + m[0].translate(_SUPER), text)
    text = unicodedata.normalize("NFKC", text).replace("−", "-").replace("µ", "μ").replace("⋅", "·").replace("∙", "·").replace("•", "·")
    return " ".join("".join(c for c in text if unicodedata.category(c) not in ("Cf", "Cc")).split())


def _one(name: str) -> tuple[float, Dimension] | None:
    """Scale and dimension of a single unit name."""
    low = name.lower()
    if name in _SYMBOLS:
        return _SYMBOLS[name]
    if name[0] in _PREFIXES and name[1:] in _SYMBOLS and low not in ("min", "mil"):
        scale, dim = _SYMBOLS[name[1:]]
        return scale * _PREFIXES[name[0]], dim
    for w in (low, low.removesuffix("s"), low.removesuffix("es")):
        if w in _WORDS:
            return _WORDS[w]
    for p, x in _PREFIX_WORDS.items():
        if low.startswith(p) and (rest := _one(low.removeprefix(p))):
            return rest[0] * x, rest[1]
    if name[0] in _PREFIXES and low[1:] in ("ohm", "ohms", "lbf", "psi", "å"):
        scale, dim = _WORDS[low[1:].removesuffix("s")]
        return scale * _PREFIXES[name[0]], dim
    return None


@lru_cache(maxsize=REMEMBERED)
def parse(text: str | None) -> tuple[float, Dimension] | None:
    """(scale in SI units, dimension) of a unit's text, None where it is none."""
    if not text:
        return None
    t = tidy(text)
    while len(t) > 1 and ((t[0], t[-1]) == ("[", "]") or (t[0], t[-1]) == ("(", ")") and ")" not in t[1:-1].split("(")[0]):
        t = t[1:-1].strip()
    t = re.sub(r"(?:\bvs\.?|_)\s*\(?(?:sce|ag/?agcl|she|rhe)\)?$", "", t, flags=re.I).strip()
    bare = re.sub(r"[().]", "", t).strip().lower()
    if bare in _PART or t.lower() in _PART:
        return 1.0, _d(share=1)
    if bare in ("psi", "ksi"):
        return _WORDS[bare]
    if m := re.fullmatch(r"[A-Za-z]\s*\((\w+)\)", t):
        return parse(m[1])
    if re.fullmatch(r"HV\s*[\d.]*", t, flags=re.I):
        return 1.0, _d(hv=1)
    t = t.rstrip(".") if re.fullmatch(r"[A-Za-z]+\.", t) else t
    t = re.sub(r"\bper\b", "/", re.sub(r"\b(?:square|sq)\.?\s*(\w+)", r"\1^2", re.sub(r"\b(?:cubic|cu)\.?\s*(\w+)", r"\1^3", t)))
    scale, dim, sign, at, units = 1.0, list(_NONE), 1, 0, 0
    root, group = 1.0, []
    while at < len(t):
        m = _TOKEN.match(t, at)
        if not m or m.end() == at:
            return None
        at = m.end()
        if m["num"]:
            n = float(m["num"]) ** int(m["pow"] or 1)
            scale *= n**sign
        elif m["root"]:
            root = 0.5
        elif m["op"]:
            if m["op"] == "/":
                sign = -sign if group and group[-1] < 0 else -1
            elif m["op"] == "(":
                group.append(sign)
            elif m["op"] == ")":
                if group:
                    group.pop()
                sign = 1
        else:
            if not (unit := _one(m["name"])):
                return None
            e = m["exp"]
            power = (float(e.removesuffix("/2")) / (2 if e.endswith("/2") else 1) if e else 1.0) * sign * root
            scale *= unit[0] ** power
            dim = [x + power * y for x, y in zip(dim, unit[1])]
            root, units = 1.0, units + 1
            sign = group[-1] if group else 1
    return (scale, tuple(dim)) if units else None


@dataclass(frozen=True)
class Code:
    """A listed unit."""

    name: str
    scale: float
    dim: Dimension
    quantities: frozenset[str] = field(default_factory=frozenset)


#: Pascals of one unit of Vickers hardness: kilogram-force by square millimetre.
HV_PA = _G * 1e6
_TEMPERATURES = ("K", "degC", "degF")


class Units:
    """The listed units, and the property terms with their common unit."""

    def __init__(self, codes: Iterable[tuple[str, str, Iterable[str]]], common: dict[int, str]) -> None:
        self.codes: dict[str, Code] = {}
        for name, symbol, quantities in codes:
            found = parse(symbol)
            if name not in _TEMPERATURES and found:
                self.codes[name] = Code(name, found[0], found[1], frozenset(quantities))
        self.common = {t: self.codes[c] for t, c in common.items() if c in self.codes}
        self.options = {t: [x for x in self.codes.values() if x.quantities & c.quantities] for t, c in self.common.items()}

    def factor(self, term: int, code: str) -> float:
        """What a number in ``code`` is multiplied by to hold in the common unit."""
        c, x = self.common[term], self.codes[code]
        return _in_pa(x) / _in_pa(c)

    def code(self, term: int, text: str | None) -> str | None:
        """The listed unit of a term that a text names, None where it names none of the property's."""
        if term not in self.common or not (found := parse(text)):
            return None
        return self.listed(term, *found)

    def listed(self, term: int, scale: float, dim: Dimension) -> str | None:
        common = self.common[term]
        for s, d in ((scale, dim), (scale * _G, tuple(x + y for x, y in zip(dim, (0, 1, -2, 0, 0, 0, 0))))):  # mass that stands for force
            if common.dim[6] and not any(d):
                d = _d(share=1)
            if common.dim[5] and d == _PA and math.isclose(s, HV_PA, rel_tol=1e-3):
                return common.name
            for x in [common, *self.options[term]]:
                if x.dim == d and math.isclose(x.scale, s, rel_tol=1e-3):
                    return x.name
        return None

    def mentioned(self, term: int, value: float | None, *texts: str | None) -> str | None:
        """The listed unit that the row's texts give for its value.

        A unit counts with the row's own number before it, or without a number behind a word or mark that
        introduces a unit. A unit behind any other number belongs to something else.
        """
        if term not in self.common:
            return None
        for text in texts:
            if not text:
                continue
            for clause in re.split(r";|,(?!\d)", tidy(text)):
                words = clause.strip().split(" ")
                for n in range(min(5, len(words)), 0, -1):
                    for i in range(len(words) - n + 1):
                        if code := self._at(term, value, words, i, n):
                            return code
        return None

    def _at(self, term: int, value: float | None, words: list[str], i: int, n: int) -> str | None:
        unit = " ".join(words[i : i + n])
        if parse(unit) is None:
            return None
        before = words[i - 1] if i else ""
        bracketed = unit[:1] in "[(" and unit[-1:] in "])"
        first = unit.lstrip("([")
        if re.match(r"[-+]?\d", first) and not re.match(r"(?:10\^?[-+]?\d+|1e[-+]?\d+|1/)", first) or not (code := self.code(term, unit)):
            return None
        number = re.fullmatch(r"[-+]?\d+(?:\.\d+)?(?:e[-+]?\d+)?", before.lower())
        if number:
            near = value is not None and math.isclose(float(before), value, rel_tol=2e-3, abs_tol=1e-12)
            return code if near else None
        alone = n == len([w for w in words if w])
        return code if bracketed or alone or before and (before.lower().rstrip(":=") in _LEADS or before[-1] in ":=/") else None


#: Words that introduce a unit.
_LEADS = frozenset(["in", "is", "unit", "units", "as", "are"])


def _in_pa(x: Code) -> float:
    return x.scale * (HV_PA if x.dim[5] else 1.0)


_TEMP = re.compile(r"(?<![\w.])([-+]?\d+(?:\.\d+)?)\s*(kelvins?|K|°\s*C|deg\.?\s*C|degrees? C(?:elsius)?|Celsius|C|°\s*F|deg\.?\s*F|degrees? F(?:ahrenheit)?|Fahrenheit|F)(?![\w/])")
# Temperatures that texts name, in kelvin.
_NAMED = {"liquid nitrogen": 77.0, "liquid helium": 4.2, "room temperature": 298.15, "ice water": 273.15, "dry ice": 194.65, "ambient": 298.15}


def to_kelvin(number: float, code: str) -> float:
    return number if code == "K" else number + 273.15 if code == "degC" else (number - 32) / 1.8 + 273.15


@lru_cache(maxsize=REMEMBERED)
def _temperatures_in(text: str) -> tuple[tuple[float, float], ...]:
    t = tidy(text)
    found = [(to_kelvin(float(n), "K" if unit[:1] in "Kk" else "degF" if "F" in unit else "degC"), 0.75) for n, unit in _TEMP.findall(t)]
    low = t.lower()
    return (*found, *((k, 8.0 if k > 200 else 2.0) for name, k in _NAMED.items() if name in low))


def temperatures(*texts: str | None) -> list[tuple[float, float]]:
    """(kelvin, tolerance) of each temperature that the texts name."""
    return [x for text in texts if text for x in _temperatures_in(text)]


def temperature_unit(number: float | None, *texts: str | None) -> str:
    """The unit in which a temperature holds, by the temperatures its row's texts name; kelvin without any sign."""
    if number is None:
        return "K"
    named = temperatures(*texts)
    for code in _TEMPERATURES:
        if any(abs(to_kelvin(number, code) - k) <= tolerance for k, tolerance in named):
            return code
    return "degC" if number < 0 else "K"
