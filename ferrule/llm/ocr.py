"""Noise in text from scanned pages: running lines, words split at line ends, misread characters; and the repair.

Lines are placed in their page. Running headers and footers are told by what recurs at page edges; halves of words at
line ends by how often the whole word and the compound occur. A misread word is a rare word whose glyphs could be
those of a frequent one: both have the same glyph skeleton, in which confusable shapes are one. Skip-gram vectors learnt
on the corpus say whether the two stand in like contexts where the counts alone don't.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.functions.arrow import each, mapped
from ferrule.llm.canon import ELEMENTS
from ferrule.session import cut

#: Element symbols that are no words.
SYMBOLS = frozenset(e for e in ELEMENTS if len(e) == 2) - {"As", "In", "At", "No", "He", "Be", "I"}

#: Lines at the top and bottom of a page that may be running lines.
TOP, BOTTOM = 2, 3
#: Papers in which a line must recur at page edges, and the share of its occurrences that must lie there.
PAPERS, EDGE_SHARE = 3, 0.75
#: Letters that a running line may lack at its end: more cut off is too near to the beginnings of sentences. Letters of a
#: line that one paper alone repeats, or that is a running line by its label only.
MOST_CUT, LONGEST = 5, 110
#: How many times as frequent a word must be to be the one meant, by length: skeletons of up to three letters meet by chance.
LIKELY, LIKELY_SHORT = 5, 200
#: Cosine of contexts from which a link holds; where a word is SURE times as frequent, less is enough.
ALIKE, ALIKE_SURE, SURE = 0.3, 0.05, 40
#: Size of the vectors, words on either side that are a word's context, and how many of the most frequent words count
#: there, by their rarity: a bounded number sent to every task. A rarer word beside a word is no sign of what it means.
DIMENSIONS, WINDOW, WEIGHED_WORDS = 64, 4, 20_000
#: Slots of the filter that says which words a task need not look at, whatever the number of words.
SLOTS = 1 << 20

# Glyphs that scanners confuse, each as the strokes it is seen as.
_STROKES = str.maketrans({**dict.fromkeys("0aoöQO", "o"), **dict.fromkeys("1lijI|!", "i"), **dict.fromkeys("tf", "t"), **dict.fromkeys("s5S", "s"), **dict.fromkeys("g9q", "g"), **dict.fromkeys("b6h8uB", "ii"), **dict.fromkeys("ec", "c"), **dict.fromkeys("z2", "z"), "d": "ci", "n": "ri", "m": "rri", "w": "vv"})
_DIGIT_LIKE = str.maketrans({"l": "1", "I": "1", "|": "1", "O": "0", "o": "0", "S": "5", "s": "5", "B": "8", "b": "6", "Z": "2", "z": "2", "g": "9", "q": "9"})
_DIGIT = re.compile(r"\d")
_AROUND = ".,;:()[]{}\"'“”*<>"
_BREAK = "-‐‑¬=­"
_UNIT = r"(?:%|°C|°|K|MPa|GPa|HV|nm|μm|µm|mm|h|s|min|kV|mV|kJ|J|W|mA|ppm|gf|cycles|builds|bars|times|reflections|fields|wt%|at%|mg/s|mm/s|units)"
_ROMAN = re.compile(r"[ivxl]{1,6}$")
_PAGE = re.compile(r"(?:page|p|pp|seite|s)?\W{0,3}(\d{1,5})(?:\W{1,3}(?:of|von|/)\W{1,3}\d{1,5})?(?:\W{0,4}p ?a ?g ?e)?\W{0,3}$")


def skeleton(word: str) -> str:
    """The shape of a word: equal for words that a scanner may confuse."""
    return word.replace("I", "l").lower().translate(_STROKES).replace("ti", "ri")


@lru_cache(maxsize=200_000)
def number_of(token: str) -> str | None:
    """The number that a token of digits and digit-like letters stands for, None where it stands for none."""
    if not _DIGIT.search(token):
        return None
    plain = token.translate(_DIGIT_LIKE)
    return plain if re.fullmatch(r"[-+]?\d+(?:[.,]\d+)*(?:\^-?\d+)?", plain) else None


def edge_form(line: str | None) -> dict:
    """How a line compares as a running line: its style as a page number with the number, and its folded key."""
    s = " ".join((line or "").split())
    if len(s) > 40 and not _DIGIT.search(s):  # neither a page number nor a number in it: only the key matters
        return {"style": None, "number": None, "key": " ".join(re.findall(r"[a-zà-ÿ0-9|]+", skeleton(s)))}
    paged = re.search(r"^p\.|^page\b|p a g e|^\[.*\]$|^[-–—] .* [-–—]$", s.lower())
    loose = lambda t: t.translate(_DIGIT_LIKE) if paged and re.fullmatch("[lIOoSBZ|]{1,4}", t) and t != "|" else None
    folded = " ".join(number_of(t.strip("[]().,-")) or loose(t.strip("[]().,-")) or t for t in s.split(" "))
    bare = re.sub(r"[^\w ]", " ", folded).strip().lower()
    style, number = None, None
    if len(s) <= 24 and (m := _PAGE.match(re.sub(r"\s+", " ", folded.lower()).strip(" -–—[]().|"))):
        number = int(m[1])
        style = "bare" if re.fullmatch(r"\d+", re.sub(r"[ .]", "", folded)) else "marked"
    elif _ROMAN.match(bare):
        style = "roman"
    parts = [skeleton(t) for t in re.findall(r"[A-Za-zÀ-ÿ0-9|]+", s) if number_of(t) is None and not t.isdigit()]
    numbers = any(re.fullmatch(r"\d[\d.,]*", t.strip("[]().,;:-")) for t in folded.split(" "))
    return {"style": style, "number": number, "key": " ".join(parts) + (" #" if numbers else "")}


EDGE = "struct<style:string, number:bigint, key:string>"


def read_lines(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """One row for each line that isn't blank of both tables, with its place in the page.

    (table_name, row_no, paper, page, pos, label, noise, line_no, line, n_lines, from_top, from_bottom). Rows repeated
    with their number count once. Rows without paper or page make pages of their own, so no null gathers a group.
    """
    b = blocks.select(F.lit("ocr_items").alias("table_name"), F.col("item_no").alias("row_no"), "paper_id", F.col("page").cast("bigint").alias("page"), F.col("pos").cast("bigint").alias("pos"), F.col("block_label").alias("label"), F.coalesce("is_layout_noise", F.lit(False)).alias("noise"), "text")
    t = texts.select(F.lit("paper_texts").alias("table_name"), F.col("text_no").alias("row_no"), "paper_id", F.col("page").cast("bigint").alias("page"), F.lit(0).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("noise"), F.col("paper_text").alias("text"))
    rows = b.unionByName(t).where(F.col("text").isNotNull()).dropDuplicates(["table_name", "row_no"])
    alone = F.concat(F.lit("row "), F.col("table_name"), F.col("row_no").cast("string"))
    placed = rows.withColumn("paper", F.when(F.col("paper_id").isNull() | F.col("page").isNull(), alone).otherwise(F.col("paper_id"))).withColumn("page", F.coalesce("page", F.lit(0).cast("bigint")))
    split = F.split("text", "\n", -1)
    lines = placed.select("table_name", "row_no", "paper", "page", "pos", "label", "noise", F.size(split).alias("n_lines"), F.posexplode(split).alias("line_no", "line"))
    lines = lines.withColumn("line_no", F.col("line_no") + 1).where(F.trim("line") != "")
    page = Window.partitionBy("table_name", "paper", "page")
    order = page.orderBy("pos", "row_no", "line_no")
    return lines.withColumn("from_top", F.row_number().over(order)).withColumn("from_bottom", F.count("*").over(page) - F.col("from_top") + 1)


def mark_running(lines: DataFrame) -> DataFrame:
    """``lines`` with ``running``: whether the line is a running header, footer or page number."""
    formed = lines.withColumn("e", each(edge_form, EDGE, "line")).select(*lines.columns, "e.*")
    labelled = F.coalesce(F.col("label").isin("header", "footer", "page_number", "number"), F.lit(False))
    edge = (F.col("from_top") <= TOP) | (F.col("from_bottom") <= BOTTOM) | labelled
    worded = F.length(F.regexp_replace("key", "[ #]", "")) >= 5
    formed = cut(formed.withColumn("edge", edge).withColumn("labelled", labelled).withColumn("worded", worded))

    # What recurs: by key over papers, by key within a paper, by page number within a paper. All are pre-aggregated.
    # A running line begins with a capital, a digit or a sign; what begins small goes on from the line before.
    keyed = formed.where("worded").where(~F.col("line").rlike(r"^\s*[a-z]"))
    by_paper = keyed.groupBy("key", "paper").agg(F.count("*").alias("n"), F.count_if("edge").alias("n_edge"), F.countDistinct(F.when(F.col("edge"), F.col("page"))).alias("pages"))
    by_key = by_paper.groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_edge").alias("n_edge"), F.count_if(F.col("n_edge") > 0).alias("papers")).where(F.col("n_edge") >= EDGE_SHARE * F.col("n"))
    common = cut(by_key.where(F.col("papers") >= PAPERS).select("key", F.lit(True).alias("common")))
    repeated = by_paper.where("pages >= 2 and n_edge = n").join(by_key.select("key"), "key").select("paper", "key", F.lit(True).alias("repeated"))
    steps = formed.where("edge and number is not null").groupBy("table_name", "paper", (F.col("number") - F.col("page")).alias("step")).agg(F.countDistinct("page").alias("p")).where("p >= 2").select("table_name", "paper", "step", F.lit(True).alias("paged"))

    candidates = formed.where("edge").withColumn("step", F.col("number") - F.col("page"))
    c = candidates.join(common, "key", "left").join(repeated, ["paper", "key"], "left").join(_cut_short(candidates, common), ["table_name", "row_no", "line_no"], "left").join(steps, ["table_name", "paper", "step"], "left")
    first = F.min("page").over(Window.partitionBy("table_name", "paper"))
    titles = lines.where((F.col("from_top") <= 2) & ((F.col("table_name") == "paper_texts") | F.col("label").isin("doc_title", "title"))).groupBy("table_name", "paper").agg(F.min(F.struct("page", "from_top", "line")).alias("t"), F.min("page").alias("first_page"))
    titles = titles.select("table_name", "paper", "first_page", F.col("t.line").alias("title"))
    c = c.join(titles, ["table_name", "paper"], "left")
    short = F.length("line") <= LONGEST
    alike = mapped(_begins, "boolean", "title", "line")
    outer = (F.col("from_top") <= 2) | (F.col("from_bottom") <= 3) | F.col("labelled")
    on = (
        F.col("noise")
        | F.coalesce("common", "shortened", F.lit(False))
        | (F.coalesce("repeated", F.lit(False)) & short & (F.col("page") >= F.coalesce("first_page", F.col("page"))) & ~F.coalesce(F.col("label").isin("table", "doc_title", "paragraph_title"), F.lit(False)))
        | (F.coalesce("paged", F.lit(False)) & outer)
        | ((F.col("style") == "marked") & outer)
        | (F.col("style").isin("bare", "roman") & (F.col("labelled") | (F.col("style") == "roman") & ((F.col("from_bottom") <= 2) | (F.col("from_top") <= 2))))
        | (F.col("labelled") & (F.col("n_lines") == 1) & short & ~F.col("line").rlike(r"[.!?]\s*$"))
        | ((F.col("page") > F.col("first_page")) & (F.col("from_top") <= 2) & F.coalesce(alike, F.lit(False)))
    )
    flagged = c.where(on & ~F.coalesce(F.col("label") == "table", F.lit(False))).select("table_name", "row_no", "line_no", F.lit(True).alias("r")).distinct()
    return lines.join(flagged, ["table_name", "row_no", "line_no"], "left").withColumn("running", F.coalesce("r", F.lit(False))).drop("r")


def _cut_short(candidates: DataFrame, common: DataFrame) -> DataFrame:
    """(table_name, row_no, line_no, shortened): lines at edges that are a common running line with its end cut off or a sign added."""
    packed = F.regexp_replace("key", "[ #]", "")
    a = candidates.where("worded").select("table_name", "row_no", "line_no", packed.alias("k"))
    # Running lines are few: their beginnings meet the lines by equality.
    whole = common.select(packed.alias("c")).distinct()
    least = F.greatest(F.lit(14), F.length("c") - MOST_CUT)
    b = whole.where(F.length("c") >= least).select(F.explode(F.transform(F.sequence(least, F.length("c")), lambda n: F.substring(F.col("c"), F.lit(1), n))).alias("k")).distinct()
    return a.join(b, "k").select("table_name", "row_no", "line_no", F.lit(True).alias("shortened")).distinct()


def _begins(title: str | None, line: str | None) -> bool:
    """Whether a line is the title, or the beginning to which it was cut, perhaps misread."""
    a, b = re.sub(r"\W", "", skeleton(title or "")), re.sub(r"\W", "", skeleton(line or ""))
    if len(b) < 12 or len(b) > len(a) + 1:
        return False
    return sum(x != y for x, y in zip(a, b)) <= max(1, len(b) // 15)


# Words of a line ------------------------------------------------------------------------------------------------------

_WORDLIKE = re.compile(r"[A-Za-zÀ-ÿ0-9|!]+")
_FORMULA = re.compile(r"(?:[A-Z][a-z]?(?:\d+(?:\.\d+)?)?)+$")


def shaped(token: str) -> bool:
    """Whether a token has the build of a chemical formula: several capitals mixed with small letters or digits."""
    if token[1:].replace("I", "l").islower() and token.isalpha():
        return False  # a word in which a small l was read as I
    return len(token) > 3 and len(re.findall("[A-Z]", token)) >= 2 and bool(re.search("[a-z0-9]", token)) and token[0].isupper() and not token.isupper()


@lru_cache(maxsize=200_000)
def _parts(token: str) -> tuple[tuple[str, str], ...]:
    """(kind, word) of a token that stands by itself; the kind of a first part that is a word is a."""
    core = token.strip(_AROUND)
    if not core:
        return ()
    if number_of(core) is not None and not (_FORMULA.match(core) and len(core) > 2):
        return () if re.fullmatch(r"[-+\d.,^]+", core) else (("n", core),)
    if "{" in token or "$" in token or "^" in core or "<" in token:
        return ()
    out = []
    for k, part in enumerate(re.split(r"[-–/+]", core)):
        part = part.strip(".,;:()[]{}\"'“”*<>’")
        if shaped(part) and (_FORMULA.match(part) or re.search(r"\d", part) or not part[1:].islower()):
            out.append(("f", part))
        elif len(part) > 1 and re.fullmatch(r"[A-Za-zÀ-ÿ0-9|!]+", part) and re.search("[A-Za-z]", part) and part not in SYMBOLS:
            out.append(("w" if k else "a", part))
    return tuple(out)


_LONE = re.compile(r"[lIOoSBZ]{1,3}")


def line_tokens(line: str | None) -> list[tuple[int, str, str]]:
    """(place, kind, word) of a line: words (kind w, parts of compounds apart), numbers with letters (n), formulas (f), the
    half at the line's end (b) and the line's first word (a), which may be the other half."""
    out: list[tuple[int, str, str]] = []
    raw = (line or "").split()
    for i, token in enumerate(raw):
        if i == len(raw) - 1 and len(token) > 1 and token[-1] in _BREAK and token[-2].isalnum():
            parts = re.split(r"[-/]", token.rstrip(_BREAK).strip("([\"'"))
            out.append((i, "b", parts[-1]))
            token = "-".join(parts[:-1])
        elif len(token) < 8 and _LONE.fullmatch(core := token.strip(_AROUND)) and i < len(raw) - 1 and re.fullmatch(_UNIT, raw[i + 1].strip(".,;:()[]")):
            out.append((i, "n", core))
            continue
        for kind, word in _parts(token):
            out.append((i, "w" if kind == "a" and i else kind, word))
    return out


TOKENS = "table_name string, row_no bigint, line_no int, kind string, word string, n bigint"


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of :data:`TOKENS`: halves, first words, numbers and formulas with their line, and, without one, a partition's
    counts of words in lower case."""
    counts: Counter[str] = Counter()
    place = ["table_name", "row_no", "line_no"]

    def told() -> pd.DataFrame:
        out = pd.DataFrame({"table_name": None, "row_no": None, "line_no": None, "kind": "w", "word": list(counts), "n": list(counts.values())}).astype({"row_no": object, "line_no": object})
        counts.clear()
        return out

    for b in batches:
        at, kinds, words = [], [], []
        for k, line in enumerate(b["line"]):
            for _, kind, word in line_tokens(line):
                if kind in "wa":
                    counts[word.lower()] += 1
                if kind != "w":
                    at.append(k)
                    kinds.append(kind)
                    words.append(word)
        yield b[place].iloc[at].reset_index(drop=True).assign(kind=kinds, word=words, n=None)
        if len(counts) > 200_000:
            yield told()
    yield told()


def read_tokens(content: DataFrame) -> DataFrame:
    """The rows of :data:`TOKENS` of lines, written once."""
    return cut(content.select("table_name", "row_no", "line_no", "line").mapInPandas(_tokens, TOKENS))


def formula_elements(word: str) -> list[str]:
    return re.findall(r"[A-Z][a-z]?", word) if _FORMULA.match(word) else []


def formula_fault(word: str, elements: frozenset[str]) -> bool:
    """Whether a token of a formula's build is none, but would be one with other glyphs."""
    if _FORMULA.match(word):
        parts = re.findall(r"([A-Z][a-z]?)(\d+(?:\.\d+)?)?", word)
        return not all(e in elements and (not n or (n[0] != "0" and float(n) <= 100)) for e, n in parts)
    return bool(re.search(r"[A-Z][a-z]", word)) and sum(word.count(e) for e in elements if len(e) == 2) >= 2


def link_words(counts: DataFrame) -> DataFrame:
    """(word, meant, n, m): words with the frequent ones of their glyph skeleton, LIKELY times as frequent.

    ``counts``: (word, n), words in lower case. Words are joined by skeleton, so no pairs of unlike words arise. These are
    the plausible glyph edits; whether a link holds is for the contexts to say.
    """
    formed = counts.where("length(word) > 1").withColumn("skeleton", mapped(skeleton, "string", "word"))
    top = formed.groupBy("skeleton").agg(F.max("n").alias("top"), F.count("*").alias("k")).where("k > 1 and top >= 3")
    grouped = formed.join(top, "skeleton").withColumn("head", F.col("n") * LIKELY > F.col("top"))
    heads = grouped.where("head").select("skeleton", F.col("word").alias("meant"), F.col("n").alias("m"))
    pairs = grouped.where("not head").select("skeleton", "word", "n").join(heads, "skeleton")
    return pairs.where((F.col("m") >= LIKELY * F.col("n")) & ((F.length("meant") > 3) | (F.col("m") >= LIKELY_SHORT * F.col("n")))).select("word", "meant", "n", "m")


def _slots(words: DataFrame) -> np.ndarray:
    """Which slots the words take: at most SLOTS rows come to the driver."""
    out = np.zeros(SLOTS, bool)
    out[[r.s for r in words.select(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(SLOTS)).cast("int").alias("s")).distinct().collect()]] = True
    return out


def word_weights(counts: DataFrame) -> dict[str, float]:
    """Weights of the most frequent words in a context: the rarer, the more, up to 1."""
    total = counts.agg(F.sum("n")).collect()[0][0] or 1
    top = counts.where("n >= 5").orderBy(F.desc("n"), "word").limit(WEIGHED_WORDS).collect()
    return {r.word: 1e-3 / (1e-3 + r.n / total) for r in top}


class _Vectors(dict):
    """Words to their numbers; a word's random signs with its weight, and whether it may be misread or meant."""

    def __init__(self, weights: dict[str, float], misread: np.ndarray, meant: np.ndarray) -> None:
        self.weights, self.misread_slots, self.meant_slots = weights, misread, meant
        self.signs: list[np.ndarray] = []
        self.flags: list[int] = []
        self.words: list[str] = []

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        slot = zlib.crc32(raw) % SLOTS
        bits = np.unpackbits(np.frombuffer(hashlib.blake2b(raw, digest_size=DIMENSIONS // 8).digest(), np.uint8))
        self.signs.append((bits * np.float32(2) - np.float32(1)) * np.float32(self.weights.get(word, 0.0)))
        self.flags.append(int(self.misread_slots[slot]) | 2 * int(self.meant_slots[slot]))
        self.words.append(word)
        self[word] = n = len(self.words) - 1
        return n


CONTEXT = "table_name string, row_no bigint, line_no int, kind string, written string, word string, n bigint, v array<float>"


def _line_contexts(weights: dict[str, float], misread: np.ndarray, meant: np.ndarray):
    """Rows of :data:`CONTEXT`: one for each word that may be misread, and, without a place, a partition's sums by word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Vectors(weights, misread, meant)
        sums: dict[str, tuple[int, np.ndarray]] = {}

        def told() -> pd.DataFrame:
            out = pd.DataFrame({"table_name": None, "row_no": None, "line_no": None, "kind": None, "written": None, "word": list(sums), "n": [n for n, _ in sums.values()], "v": [v for _, v in sums.values()]})
            sums.clear()
            return out.astype({"row_no": object, "line_no": object})

        for b in batches:
            if len(known) > 200_000:
                known = _Vectors(weights, misread, meant)
            lines = [[t for t in line_tokens(x) if t[1] in "wab"] for x in b["line"]]
            tokens = [t for ts in lines for t in ts]
            size = np.array([len(ts) for ts in lines], dtype=np.int64)
            at = np.fromiter((known[w.lower()] for _, _, w in tokens), np.int64, len(tokens))
            if not len(at):
                continue
            end = np.repeat(np.cumsum(size), size)
            start, i = end - np.repeat(size, size), np.arange(len(at))
            vectors = np.array(known.signs)[at]
            total = np.vstack([np.zeros((1, DIMENSIONS), np.float32), np.cumsum(vectors, axis=0, dtype=np.float64)])
            flags = np.array(known.flags)[at]
            own = np.flatnonzero((flags > 0) & (np.array([k for _, k, _ in tokens]) != "b"))
            around = (total[np.minimum(own + WINDOW + 1, end[own])] - total[np.maximum(own - WINDOW, start[own])] - vectors[own]).astype(np.float32)
            order = np.argsort(at[own], kind="stable")
            ids, first = np.unique(at[own][order], return_index=True)
            if len(ids):
                for k, n, v in zip(ids, np.diff(np.append(first, len(own))), np.add.reduceat(around[order], first)):
                    n0, v0 = sums.get(known.words[k], (0, 0))
                    sums[known.words[k]] = (n0 + int(n), v0 + v)
            odd = flags[own] & 1 > 0
            line = np.repeat(np.arange(len(b)), size)[own[odd]]
            rows = b[["table_name", "row_no", "line_no"]].iloc[line].reset_index(drop=True)
            which = own[odd]
            yield rows.assign(kind=[tokens[k][1] for k in which], written=[tokens[k][2] for k in which], word=[known.words[k] for k in at[which]], n=1, v=list(around[odd]))
            if len(sums) > 200_000:
                yield told()
        yield told()

    return run


def agreement(content: DataFrame, counts: DataFrame, links: DataFrame) -> DataFrame:
    """(table_name, row_no, line_no, kind, written, word, meant, n, m, here, always): every occurrence of a linked word with
    the cosine of its own context, and of all contexts of the word, with the vector of each word that may be meant.

    The vectors are those of skip-grams: a word's is the sum, over all its occurrences, of the random vectors of the
    words up to WINDOW places away, weighted by rarity. Partitions sum by word before the shuffle.
    """
    misread, meant = _slots(links.select("word")), _slots(links.select(F.col("meant").alias("word")))
    seen = cut(content.select("table_name", "row_no", "line_no", "line").mapInPandas(_line_contexts(word_weights(counts), misread, meant), CONTEXT))
    sums = seen.where("table_name is null").groupBy("word").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMENSIONS)])
    vectors = sums.select("word", F.array(*[F.col(f"v{i}").cast("float") for i in range(DIMENSIONS)]).alias("v"))
    told = links.join(vectors.withColumnRenamed("v", "v_word"), "word").join(vectors.select(F.col("word").alias("meant"), F.col("v").alias("v_meant")), "meant")
    return seen.where("table_name is not null").select("table_name", "row_no", "line_no", "kind", "written", "word", "v").join(told, "word").select("table_name", "row_no", "line_no", "kind", "written", "word", "meant", "n", "m", _cosine("v", "v_meant").alias("here"), _cosine("v_word", "v_meant").alias("always"))


def in_context(agreed: DataFrame) -> DataFrame:
    """The occurrences of :func:`agreement` that hold, each with the word meant whose contexts agree best.

    The own context and those of all occurrences count alike. A word SURE times as frequent needs less agreement; a word
    that stands alone wherever it occurs has no context, and only such a word holds for it.
    """
    sure = F.col("m") >= SURE * F.col("n")
    alike = F.greatest("here", "always")
    best = agreed.withColumn("alike", alike).where(F.when(F.col("alike").isNull(), sure).otherwise(F.col("alike") >= F.when(sure, ALIKE_SURE).otherwise(ALIKE)))
    each_ = ["table_name", "row_no", "line_no", "kind", "written", "word"]
    order = F.struct(F.coalesce(F.col("here") + F.col("always"), F.lit(-2.0)), "m", "meant")
    return best.groupBy(*each_).agg(F.max_by("meant", order).alias("meant"))


def _cosine(a: str, b: str) -> Column:
    """Cosine of two vectors, null where one is nothing."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        p, q = np.stack(x.to_numpy()).astype(float), np.stack(y.to_numpy()).astype(float)
        size = np.linalg.norm(p, axis=1) * np.linalg.norm(q, axis=1)
        return pd.Series(np.where(size > 1e-9, (p * q).sum(1) / np.maximum(size, 1e-9), np.nan))

    return F.nanvl(F.pandas_udf(lambda x, y: run(x, y), "double")(a, b), F.lit(None).cast("double"))


def find_noise(blocks: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(noise, marked, links): noise (table_name, row_no, line_no, noise_kind, word, meant, row2, line2) of all lines, each
    case once; row2 and line2 say where the second half of a split word stands.

    Null texts have no lines; blank lines have no noise. ``marked`` holds every line with its running mark.
    """
    marked = cut(mark_running(read_lines(blocks, texts)))
    content = marked.where("not running")
    key = ["table_name", "row_no", "line_no"]
    tokens = read_tokens(content)

    halves = join_halves(content, tokens)
    second = halves.select("table_name", F.col("row2").alias("row_no"), F.col("line2").alias("line_no"), F.lit("a").alias("kind"))
    # Second halves are no words of their own.
    taken = halves.select("table_name", "row2", "line2", "second").distinct().where(F.col("second").rlike("[A-Za-z]")).groupBy(F.lower("second").alias("word")).agg(F.count("*").alias("k"))
    counted = tokens.where("kind = 'w' and table_name is null").where(F.col("word").rlike("[A-Za-z]")).groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counted.join(taken, "word", "left").select("word", (F.col("n") - F.coalesce("k", F.lit(0))).alias("n")).where("n > 0"))
    links = cut(link_words(counts))

    # Split words: decided once for each pair of halves.
    compounds = content.where(F.contains("line", F.lit("-"))).select(F.explode(F.regexp_extract_all("line", F.lit(r"[A-Za-z]{2,}-[A-Za-z]{2,}"), F.lit(0))).alias("word")).groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("n"))
    pairs = halves.groupBy(F.lower("first").alias("a"), F.lower("second").alias("b")).agg(F.count("*").alias("k"))
    n = lambda df, name, as_: df.select(F.col("word").alias(name), F.col("n").alias(as_))
    pairs = pairs.withColumn("joined", F.concat("a", "b")).withColumn("compound", F.concat_ws("-", "a", "b"))
    pairs = pairs.join(n(counts, "joined", "nj"), "joined", "left").join(n(compounds, "compound", "nc"), "compound", "left").join(n(counts, "a", "na"), "a", "left").join(n(counts, "b", "nb"), "b", "left")
    # A half may be misread as well: then the whole is known by its skeleton.
    known = counts.where("n >= 3").withColumn("skeleton", mapped(skeleton, "string", "word")).groupBy("skeleton").agg(F.max_by("word", F.struct("n", "word")).alias("like"), F.max("n").alias("nl"))
    pairs = pairs.withColumn("skeleton", mapped(skeleton, "string", "joined")).join(known, "skeleton", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    as_word, as_compound = F.greatest(z("nj"), z("nl")), z("nc")
    split = F.when(as_word != as_compound, as_word > as_compound).otherwise(~((z("na") >= 3) & (z("nb") >= 3)))
    meant = F.when((z("nj") * SURE < z("nl")) & (F.col("like") != F.col("joined")), F.col("like"))
    pairs = cut(pairs.select("a", "b", split.alias("split"), F.when(split, meant).alias("meant")))
    decided = halves.withColumn("a", F.lower("first")).withColumn("b", F.lower("second")).join(pairs, ["a", "b"]).where("split")
    hyphens = decided.select(*key, F.lit("hyphen").alias("noise_kind"), F.concat("first", F.lit("-"), "second").alias("word"), F.coalesce("meant", F.concat("first", "second")).alias("meant"), "row2", "line2")
    bad = decided.where("meant is not null").withColumn("in_second", F.col("meant").startswith(F.col("a")))
    in_halves = bad.where("not in_second").select(*key, F.lit("misread").alias("noise_kind"), F.col("first").alias("word"), "meant")
    both = bad.where("in_second or not endswith(meant, b)")
    in_halves = in_halves.unionByName(both.select("table_name", F.col("row2").alias("row_no"), F.col("line2").alias("line_no"), F.lit("misread").alias("noise_kind"), F.col("second").alias("word"), "meant"))

    # Misread words, decided for each occurrence in its context.
    held = in_context(agreement(content, counts, links)).join(second, [*key, "kind"], "left_anti")
    found = held.select(*key, F.lit("misread").alias("noise_kind"), F.col("written").alias("word"), "meant")
    # A half that isn't joined to another is a word of its own line.
    numbers = faulty_numbers(content, tokens).select(*key, F.lit("misread").alias("noise_kind"), "word", "meant")
    formulas = faulty_formulas(tokens, counts).select(*key, F.lit("misread").alias("noise_kind"), "word", F.lit(None).cast("string").alias("meant"))
    running = marked.where("running").select(*key, F.lit("running").alias("noise_kind"), F.lit(None).cast("string").alias("word"), F.lit(None).cast("string").alias("meant"))
    noise = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [hyphens, running, in_halves, found, numbers, formulas])
    return noise.distinct(), marked, links


def faulty_numbers(content: DataFrame, tokens: DataFrame) -> DataFrame:
    """Tokens of kind n with the number ``meant``, without names that look like numbers, as the phase B2.

    A name is LIKELY times as frequent as the plain number it folds to; misreads stay below it however large the corpus.
    """
    found = tokens.where("kind = 'n'").withColumn("meant", mapped(lambda w: (w or "").translate(_DIGIT_LIKE), "string", "word"))
    numbers = F.transform(F.split("line", r"\s+"), lambda t: F.btrim(t, F.lit(_AROUND)))
    plain = content.where(F.col("line").rlike("[0-9]")).select(F.explode(numbers).alias("meant")).where(F.col("meant").rlike(r"^[-+\d.,^]*\d[-+\d.,^]*$")).groupBy("meant").agg(F.count("*").alias("m"))
    seen = found.groupBy("word", "meant").agg(F.count("*").alias("n")).join(plain, "meant", "left")
    return found.join(seen.where(_is_name("n", "m")).select("word"), "word", "left_anti")


def faulty_formulas(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """Tokens of kind f that are no formulas, without names: those LIKELY times as frequent, with the word of the same
    letters in ``counts``, as the right formula of the same skeleton."""
    usual = learn_elements(tokens)
    shapes = tokens.where("kind = 'f'").groupBy("word").agg(F.count("*").alias("n"))
    shapes = cut(shapes.withColumn("skeleton", mapped(skeleton, "string", "word")).withColumn("fault", mapped(lambda w: formula_fault(w or "", usual), "boolean", "word")))
    right = shapes.where("not fault").groupBy("skeleton").agg(F.max("n").alias("m"))
    words = counts.select(F.col("word").alias("lw"), F.col("n").alias("nw"))
    seen = shapes.where("fault").withColumn("lw", F.lower("word")).join(words, "lw", "left").join(right, "skeleton", "left").withColumn("n", F.col("n") + F.coalesce("nw", F.lit(0)))
    return tokens.where("kind = 'f'").join(seen.where(~_is_name("n", "m")).select("word"), "word")


def _is_name(n: str, m: str) -> Column:
    return F.col(n) >= LIKELY * F.greatest(F.coalesce(m, F.lit(0)), F.lit(1))


def learn_elements(tokens: DataFrame, least: float = 0.004) -> frozenset[str]:
    """The symbols that make up the corpus's formulas: each at least a small share of all. At most some hundred come back."""
    symbols = tokens.where("kind = 'f'").select(F.explode(mapped(lambda w: formula_elements(w or ""), "array<string>", "word")).alias("e")).groupBy("e").count().collect()
    total = sum(r["count"] for r in symbols)
    return frozenset(r.e for r in symbols if r["count"] >= least * total)


def join_halves(content: DataFrame, tokens: DataFrame) -> DataFrame:
    """(table_name, row_no, line_no, first, row2, line2, second): the halves at line ends with the first word that follows.

    The text goes on in the next line of the block, else in the next block of running text of the page, else on the
    first such line of the next page.
    """
    flowing = content.where(F.col("label").isNull() | F.col("label").isin("text", "abstract", "content", "reference"))
    page = Window.partitionBy("table_name", "paper", "page").orderBy("pos", "row_no", "line_no")
    at = F.struct(F.col("row_no").alias("row2"), F.col("line_no").alias("line2"))
    follow = flowing.withColumn("next", F.lead(at).over(page))
    # Blocks that don't flow, as captions, go on within themselves only.
    inner = content.where(F.col("label").isNotNull() & ~F.col("label").isin("text", "abstract", "content", "reference"))
    own = inner.withColumn("next", F.lead(at).over(Window.partitionBy("table_name", "row_no").orderBy("line_no")))
    columns = ["table_name", "row_no", "line_no", "paper", "page", "next"]
    follow = follow.select(*columns).unionByName(own.select(*columns))
    b = tokens.where("kind = 'b'").select("table_name", "row_no", "line_no", F.col("word").alias("first"))
    b = b.join(follow, ["table_name", "row_no", "line_no"])
    starts = flowing.groupBy("table_name", "paper", "page").agg(F.min_by(at, F.struct("pos", "row_no", "line_no")).alias("start"))
    starts = starts.select("table_name", "paper", (F.col("page") - 1).alias("page"), "start")
    b = b.join(starts, ["table_name", "paper", "page"], "left").withColumn("to", F.coalesce("next", "start"))
    b = b.where(F.col("to").isNotNull()).select("table_name", "row_no", "line_no", "first", "to.*")
    second = tokens.where("kind = 'a'").select("table_name", F.col("row_no").alias("row2"), F.col("line_no").alias("line2"), F.col("word").alias("second"))
    return cut(b.join(second, ["table_name", "row2", "line2"]))


def paragraphs(noise: DataFrame, marked: DataFrame) -> DataFrame:
    """(table_name, paper_id, page, para_no, text, goes_on): the lines without furniture, repaired and reflowed over pages.

    Lines are gathered by page, then paragraphs that a page end cut are stitched along the pages in order, so no paper is
    gathered whole. A paragraph has the page and number of its beginning; ``goes_on`` says that its end is missing.
    """
    key = ["table_name", "row_no", "line_no"]
    faults = noise.where("noise_kind != 'running'").select(*key, "noise_kind", "word", "meant", "row2", "line2")
    heads = marked.select("table_name", F.col("row_no").alias("row2"), F.col("line_no").alias("line2"), F.regexp_extract("line", r"^\s*(\S+)", 1).alias("head"), F.trim("line").rlike(rf"^\S+[{_BREAK}]$").alias("chained"))
    split = faults.where("noise_kind = 'hyphen'").join(heads, ["table_name", "row2", "line2"], "left")
    # The second half moves to the first one's line, except where it ends in the half of another word.
    carried = split.withColumn("head", F.when(~F.col("chained"), F.col("head")))
    taken = carried.where("head is not null").select("table_name", F.col("row2").alias("row_no"), F.col("line2").alias("line_no"), F.lit("taken").alias("noise_kind"), "word", "meant", F.lit(None).cast("string").alias("head"))
    others = faults.where("noise_kind != 'hyphen'").select(*key, "noise_kind", "word", "meant", F.lit(None).cast("string").alias("head"))
    all_ = others.unionByName(carried.select(*others.columns)).unionByName(taken)
    fixes = all_.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("noise_kind", "word", "meant", "head"))).alias("fixes"))
    lines = marked.where("not running").join(fixes, key, "left")
    repaired = lines.withColumn("fixed", mapped(_repair, "string", "line", F.to_json("fixes")))
    pages = repaired.groupBy("table_name", "paper", "page").agg(F.array_sort(F.collect_list(F.struct("pos", "row_no", "line_no", "label", "fixed"))).alias("ls"))
    kind = "array<struct<para_no:int, text:string, goes_on:boolean, first:boolean, last:boolean, sure:boolean>>"
    flown = pages.select("table_name", F.col("paper").alias("paper_id"), "page", F.explode(each(_reflow, kind, F.to_json("ls"))).alias("p"))
    return _stitch(cut(flown.select("table_name", "paper_id", "page", "p.*")))


def _stitch(flown: DataFrame) -> DataFrame:
    """Paragraphs with those joined that a page's last running text leaves open and the next page's first one goes on."""
    columns = ["table_name", "paper_id", "page", "para_no", "text", "goes_on"]
    along = Window.partitionBy("table_name", "paper_id").orderBy("page", "para_no")
    ends = flown.where("first or last").withColumn("before", F.lag(F.struct("page", (F.col("last") & F.col("goes_on")).alias("open"), "sure")).over(along))
    follows = F.col("first") & F.col("before.open") & (F.col("before.page") < F.col("page")) & (F.col("before.sure") | F.col("text").rlike("^[a-z0-9(]"))
    ends = ends.withColumn("start", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).withColumn("group", F.sum("start").over(along))
    parts = ends.groupBy("table_name", "paper_id", "group").agg(F.array_sort(F.collect_list(F.struct("page", "para_no", "text", "goes_on"))).alias("ps"))
    text = F.regexp_replace(F.regexp_replace(F.array_join("ps.text", "\n"), "(?:\x00|(?<=-))\n", ""), "\n", " ")
    joined = parts.select("table_name", "paper_id", F.col("ps")[0]["page"].alias("page"), F.col("ps")[0]["para_no"].alias("para_no"), text.alias("text"), F.element_at("ps", -1)["goes_on"].alias("goes_on"))
    out = flown.where("not (first or last)").select(*columns).unionByName(joined)
    return out.withColumn("text", F.replace("text", F.lit("\x00"), F.lit("")))


def _repair(line: str | None, fixes: str | None) -> str:
    """A line with its misread words put right, the word split at its end whole, and without a half that moved to the line before."""
    import json

    out, found = line or "", json.loads(fixes) if fixes else []
    cased = lambda word, meant: meant.capitalize() if word[:1].isupper() and word[1:].islower() else meant.upper() if word.isupper() else meant
    whole = {f["meant"] for f in found if f["noise_kind"] in ("hyphen", "taken")}
    if any(f["noise_kind"] == "taken" for f in found):
        out = re.sub(r"^\s*\S+\s*", "", out)
    for f in found:
        word, meant = f.get("word"), f.get("meant")
        if f["noise_kind"] == "misread" and word and meant and meant not in whole and len(meant) - len(word) in range(-3, 3):
            out = re.sub(rf"(?<![A-Za-z0-9]){re.escape(word)}(?![A-Za-z0-9])", cased(word, meant), out)
    for f in found:
        if f["noise_kind"] == "hyphen":
            stem = out.rstrip().rstrip(_BREAK)
            first, second = f["word"].split("-", 1)
            head = f.get("head")
            if head and second in head and stem.endswith(first):
                meant = f["meant"] if f["meant"] == first + second else cased(first, f["meant"])
                out = stem[: len(stem) - len(first)] + meant + head[head.index(second) + len(second) :]
            else:
                out = stem + (head or "\x00")
    return out


_FLOWING = (None, "text", "abstract", "content", "reference")


def _reflow(lines: str | None) -> list[dict]:
    """The paragraphs of a page; ``first`` and ``last`` mark those of running text that may go on over a page end, ``sure``
    those that are running text without doubt."""
    import json

    out: list[dict] = []
    block, last_no = None, 0
    closed = lambda text: bool(re.search(r"[.!?:][\"'”’)\]]*$", text))
    for x in json.loads(lines or "[]"):
        text, here = x.get("fixed", "").strip(" "), (x.get("row_no"), x.get("label"))
        if not text:  # its only word moved to the line before
            last_no = x["line_no"] if block == here else last_no
            continue
        ended = block is not None and here[0] != block[0] and closed(out[-1]["text"])
        new = block is None or here[1] != block[1] or here[1] not in (None, "text") or ended or here[0] == block[0] and x["line_no"] > last_no + 1
        if new and not (out and out[-1]["text"].endswith("\x00")) and here != block or new and here[1] is None:
            out.append({"text": text, "label": here[1]})
        else:
            before = out[-1]["text"]
            glue = "" if before.endswith("\x00") or before.endswith("-") else " "
            out[-1]["text"] = before.rstrip("\x00") + glue + text
        block, last_no = here, x["line_no"]
    flowing = [i for i, o in enumerate(out) if o["label"] in _FLOWING]
    ends = (flowing[0], flowing[-1]) if flowing else (-1, -1)
    return [{"para_no": i, "text": o["text"], "goes_on": i == ends[1] and not closed(o["text"]), "first": i == ends[0], "last": i == ends[1], "sure": o["label"] is not None or o["text"].endswith("\x00") or len(o["text"].split()) >= 8} for i, o in enumerate(out)]
