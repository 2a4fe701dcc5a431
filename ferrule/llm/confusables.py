"""Text that looks the same but differs in its characters.

A skeleton maps a text to the prototypes of its characters: decompose, replace each by its prototype from a look-alike
table, decompose again. Texts of equal skeleton read alike. The consistent form of a text is the one its reader
expects: composed, without invisible characters, with plain spaces, and each look-alike in the script of its word.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.arrow import mapped

# Letters of other scripts that cannot be told from Latin ones, as pairs of letter and Latin letter.
_CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХԚԜаеѕіјорсухԛԝһԁӏ", "ABESIJKMHOPCTYXQWaesijopcyxqwhdl"))
_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳνοϲ", "ABEZHIKMNOPTYXCjvoc"))
#: Greek letters that resemble Latin ones but are told apart, so are only out of place inside a Latin word.
_GREEK_LOOSE = dict(zip("αβγικρτυχη", "aßyikptuxn"))
# Letters of further scripts that cannot be told from Latin ones, as pairs of letter and Latin letter.
_ARMENIAN = dict(zip("ՍՏՕոսցհօՑ", "USOnughoS"))
_CHEROKEE = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏔᏕᏙᏚᏞᏟᏢᏦᏧᏩᏭ", "DRTiYAJEWMHYGZ4WSVSLCPKdGG"))
_IPA = dict(zip("ɑɡɩɪʏʟʜʙɴʀꜱᴄᴏᴠᴡᴢℓıȷ", "agiIYLHBNRscovwzlij"))
_COPTIC = dict(zip("ⲞⲟⲢⲣⲤⲥⲦⲔⲎⲘⲚⲬ", "OoPpCcTKHMNX"))
_FURTHER = {**_ARMENIAN, **_CHEROKEE, **_IPA, **_COPTIC}
#: Signs that look the same, with the one that belongs.
_SIGNS = {"‐": "-", "‑": "-", "﹣": "-", "∕": "/", "⁄": "/", "µ": "μ", "º": "°", "∶": ":", "⋅": "·", "‧": "·", "·": "·", "・": "·", "‚": ",", "․": ".", ";": ";", "ǃ": "!", "ʼ": "’", "ʹ": "′", "∣": "|", "ː": ":", "։": ":", "−": "−"}
#: Modifiers that show nothing of their own.
_UNSEEN = frozenset("­͏؜ᅟᅠ឴឵᠎ㅤﾠ﻿")

_PROTOTYPE = {**_CYRILLIC, **_GREEK, **_FURTHER, **_SIGNS}
_CJK = re.compile("[⺀-⿿、-ヿ㐀-鿿豈-﫿（），：；？！]")
_WORD = re.compile(r"[^\W\d_]+(?:[\u0300-\u036f]+[^\W\d_]*)*")


def unseen(c: str) -> bool:
    """Whether a character can't be seen beside others."""
    return c in _UNSEEN or unicodedata.category(c) in ("Cf", "Cc") and c not in "\n\t\r" or "︀" <= c <= "️"


def _narrow(c: str) -> str:
    """Letters and digits of another width, joined letters and letter-like signs in plain form; all else as it is."""
    if "！" <= c <= "～":
        plain = chr(ord(c) - 0xFEE0)
        return plain if plain.isalnum() else c
    if "ﬀ" <= c <= "ﬆ" or "Ⅰ" <= c <= "ⅿ" or "\U0001d400" <= c <= "\U0001d7ff" or c in "ΩKÅ":
        return unicodedata.normalize("NFKC", c)
    return c


def skeleton(text: str | None) -> str | None:
    """The prototype of a text: equal for texts that read alike. Null stays null, an empty text empty."""
    if text is None:
        return None
    out = []
    for c in unicodedata.normalize("NFD", text):
        if unseen(c):
            continue
        c = " " if unicodedata.category(c) == "Zs" else _narrow(c)
        out.append("".join(_PROTOTYPE.get(x, x) for x in c))
    return unicodedata.normalize("NFD", "".join(out))


def _script(c: str) -> str:
    if "a" <= c.lower() <= "z" or "À" <= c <= "ɏ":
        return "latin"
    if "Ѐ" <= c <= "ԯ":
        return "cyrillic"
    return "greek" if "Ͱ" <= c <= "Ͽ" else "other"


_FROM_LATIN = {v: k for k, v in zip("АВЕКМНОРСТХаеорсух", "ABEKMHOPCTXaeopcyx")}


def _word(word: str, before: str, home: str) -> str:
    """A word with each look-alike in the script that the word belongs to. ``home``: the script of the text around it."""
    scripts = [_script(c) for c in word]
    sure = {"cyrillic": sum(s == "cyrillic" and c not in _CYRILLIC for c, s in zip(word, scripts)), "latin": sum(s == "latin" and c not in _FROM_LATIN for c, s in zip(word, scripts))}
    if "cyrillic" in scripts:
        unit = before[-1:] in "°" and before != ""
        own = sure["cyrillic"] > sure["latin"] or not sure["cyrillic"] and not sure["latin"] and home == "cyrillic" and "latin" not in scripts and not unit
        if own:
            plain = [_GREEK.get(c, c) if s == "greek" else c for c, s in zip(word, scripts)]
            return "".join(_FROM_LATIN.get(c, c) if s in ("latin", "greek") else c for c, s in zip(plain, scripts))
        word = "".join(_CYRILLIC.get(c, c) for c in word)
    if "greek" in scripts and home != "greek":
        latin = sum(_script(c) == "latin" for c in word)
        small_alone = len(word) == 1 and word in "ν"
        if not small_alone:
            word = "".join(_GREEK.get(c, c) for c in word)
        if latin >= 2 and len(word) > 2:
            word = "".join(_GREEK_LOOSE.get(c, c) if i or c not in "αβγη" else c for i, c in enumerate(word))
    return word


def consistent(text: str | None) -> str | None:
    """The text in one consistent form. Null stays null, empty text empty; applying it twice changes nothing more."""
    if not text:
        return text
    out = []
    for c in unicodedata.normalize("NFC", "".join(c for c in text if not unseen(c))):
        if unicodedata.category(c) == "Zs":
            # An ideographic space is in place between ideographs.
            c = c if c == "　" and out and _CJK.match(out[-1]) else " "
        c = _narrow(c)
        out.append("".join(_SIGNS.get(x, x) for x in c))
    plain = unicodedata.normalize("NFC", "".join(out))
    wide = {k: unicodedata.normalize("NFKC", k) for k in plain if "！" <= k <= "～"} if not _CJK.search(re.sub("[！-～]", "", plain)) else {}
    plain = "".join(wide.get(c, c) for c in plain)
    letters = [c for c in plain if c.isalpha()]
    if any(c in _FURTHER for c in letters) and sum(_script(c) == "other" and c not in _FURTHER and not _CJK.match(c) for c in letters) <= 2:
        plain = "".join(_FURTHER.get(c, c) for c in plain)
        letters = [c for c in plain if c.isalpha()]
    cyrillic = sum(_script(c) == "cyrillic" and c not in _CYRILLIC for c in letters)
    greek = sum(_script(c) == "greek" and c not in _GREEK for c in letters)
    home = "cyrillic" if cyrillic > 2 else "greek" if greek > len(letters) // 2 and greek > 4 else "latin"
    done, at = [], 0
    for m in _WORD.finditer(plain):
        done += [plain[at : m.start()], _word(m[0], plain[: m.start()], home)]
        at = m.end()
    return unicodedata.normalize("NFC", "".join(done) + plain[at:])


def read(text: str) -> dict:
    """(form, skeleton, changed) of a text. Only a text that isn't its own skeleton, composed, or has a Greek letter that
    resembles a Latin one can hold a look-alike; of those the consistent form says which are out of place."""
    like = skeleton(text)
    if unicodedata.normalize("NFC", like) == text and not any(c in _GREEK_LOOSE for c in text):
        return {"form": text, "skeleton": like, "changed": False}
    form = consistent(text)
    return {"form": form, "skeleton": like, "changed": form != text}


FORM = "struct<form:string, skeleton:string, changed:boolean>"


def unify(rows: DataFrame, keys: list[str], fields: dict[str, Column]) -> DataFrame:
    """(keys, field_name, value, form, skeleton, changed) of every value that is not null, a row for each.

    A projection; long texts are handled whole.
    """
    long = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), c.alias("value")) for n, c in fields.items()])).alias("f"))
    long = long.select(*keys, "f.*").where(F.col("value").isNotNull())
    formed = long.withColumn("_u", mapped(read, FORM, "value"))
    return formed.select(*keys, "field_name", "value", "_u.*")


def groups(unified: DataFrame) -> DataFrame:
    """(field_name, skeleton, n_rows, n_originals): values that read alike, with how many originals they have; repeated rows once."""
    counted = unified.distinct().groupBy("field_name", "skeleton", "value").agg(F.count("*").alias("n"))
    return counted.groupBy("field_name", "skeleton").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_originals"))
