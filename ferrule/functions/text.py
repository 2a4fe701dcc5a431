"""Column functions on texts and lines. Patterns use neither look-behind nor \\b beside non-ASCII letters, so that they mean the same in other engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lines that are page furniture of journals, as patterns matched from the line's start, without case.
NOISE = [
    r"contents lists available at", r"available online", r"received [0-9]+", r"accepted [0-9]+", r"journal homepage", r"https?://www\.(sciencedirect|elsevier|springer|wiley|nature|science|acs)",
    r"full length article\s*$", r"(elsevier|springer|wiley|acs)", r"\*{1,2} corresponding author", r"e-mail address", r"[0-9]+$", r"[a-z]:\\", r"/tmp/", r"min\s*$", r"general\s*$",
    r"(structure|properties|modelling|processing)\s*$", r"check\s+for\s*$", r"updates?\s*$", r"[a-z]\.\s+[a-z]+\s+et\s+al\.?\s*$", r"(obs|diff|cal)\.?\s*$", r"[=\\-]\s*$", r"[0-9]+\.[0-9]{1,8}\s*$", r"[a-z]\s*$",
    r"volume density", r"cumulative percent", r"particle size", r"scanning strategy", r"d[0-9]+\s*=", r"[0-9]+\.\s+[0-9]+\s*$", r"p/q\s*$", r"v0\s*$",
]
NOISE_LINE = "^(?:" + "|".join(NOISE) + ")"
# Section titles, by level.
COMMON_TITLES = ("abstract", "introduction", "experimental", "experimental methods", "experimental procedure", "materials and methods", "methods", "results", "results and discussion", "discussion", "conclusion", "conclusions", "summary", "acknowledgements", "acknowledgments", "references", "appendix", "keywords")
REFERENCES = r"^(?:#+\s*)?(?:[0-9]+\.?\s*)?(?:references|bibliography)\s*:?\s*$"
AFTER_REFERENCES = r"^(?:#+\s*)?(?:appendix|supplementary|supporting information)"
# Letters and signs with their commands.
LATEX = {"α": r"\alpha", "β": r"\beta", "γ": r"\gamma", "δ": r"\delta", "ε": r"\epsilon", "η": r"\eta", "θ": r"\theta", "λ": r"\lambda", "μ": r"\mu", "ν": r"\nu", "π": r"\pi", "ρ": r"\rho", "σ": r"\sigma", "τ": r"\tau", "φ": r"\phi", "χ": r"\chi", "ψ": r"\psi", "ω": r"\omega", "Δ": r"\Delta", "Ω": r"\Omega", "±": r"\pm", "×": r"\times", "≤": r"\leq", "≥": r"\geq", "≈": r"\approx", "°": r"^{\circ}", "→": r"\rightarrow"}
DOI_URL, DOI_BARE = r"https?://(?:dx\.)?doi\.org/(10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+)", r"(10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+)"


def squeeze(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def lines_of(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """(keys, pos, line): the lines of a text, from 0; none for a null text."""
    return df.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def is_noise(line: Column, keep_doi: bool = True) -> Column:
    """Whether a line is page furniture; a line with a DOI may be spared."""
    low = F.lower(F.trim(line))
    noise = low.rlike(NOISE_LINE)
    return noise & ~low.rlike(r"10\.[0-9]{4,9}/") if keep_doi else noise


def normalized_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines with squeezed white space, without empty ones and without a line that repeats the one before."""
    kept = lines.withColumn("line", squeeze(F.col("line"))).where("line <> ''")
    before = F.lag("line").over(Window.partitionBy(*keys).orderBy("pos"))
    return kept.withColumn("_b", before).where(F.col("_b").isNull() | (F.col("_b") != F.col("line"))).drop("_b")


def drop_leading(lines: DataFrame, condition: Column, *keys: str) -> DataFrame:
    """Lines from the first one that doesn't meet ``condition``."""
    start = F.min(F.when(~condition, F.col("pos"))).over(Window.partitionBy(*keys))
    return lines.withColumn("_s", start).where(F.col("pos") >= F.col("_s")).drop("_s")


def without_references(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines without the reference section; an appendix after it is kept."""
    low = F.lower(F.trim("line"))
    mark = F.when(low.rlike(REFERENCES), "refs").when(low.rlike(AFTER_REFERENCES), "body")
    state = F.last(mark, ignorenulls=True).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("_s", F.coalesce(state, F.lit("body"))).where("_s <> 'refs'").drop("_s")


def without_legends(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines without the short fragments that stand directly before a figure caption."""
    caption = F.trim("line").rlike(r"^(?:Fig\.|Figure)\s*[0-9]+")
    fragment = F.trim("line").rlike(r"^(?:\([a-z]\)|[A-Za-z0-9]{1,3}|[0-9.]+\s*[A-Za-zμ%]{0,3})?$")
    order = Window.partitionBy(*keys).orderBy("pos")
    after = order.rowsBetween(0, Window.unboundedFollowing)
    marked = lines.withColumn("_f", fragment & ~caption)
    nexts = F.min(F.when(~F.col("_f"), F.struct("pos", caption.alias("c")))).over(after)
    return marked.withColumn("_n", nexts).where(~(F.col("_f") & F.coalesce(F.col("_n.c"), F.lit(False)))).drop("_f", "_n")


def heading_level(line: Column) -> Column:
    """The Markdown level of a heading line: numbered ones by their depth, common titles 2, null for others."""
    t = F.trim(line)
    numbered = [(r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}\.?\s+[A-Z]", 4), (r"^[0-9]{1,2}\.[0-9]{1,2}\.?\s+[A-Z]", 3), (r"^[0-9]{1,2}\.?\s+[A-Z][A-Za-z]", 2)]
    short = (F.length(t) <= 120) & ~t.rlike(r"[.;,]$")
    out = F.when(short & t.rlike(numbered[0][0]), numbered[0][1])
    for p, n in numbered[1:]:
        out = out.when(short & t.rlike(p), n)
    return out.when(F.lower(F.regexp_replace(t, r"^#+\s*", "")).isin(*COMMON_TITLES), 2)


def as_markdown(line: Column) -> Column:
    """A line with the marks of its level before it, if it is a heading."""
    level = heading_level(line)
    return F.when(level.isNotNull(), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), F.regexp_replace(F.trim(line), r"^#+\s*", ""))).otherwise(line)


def keyword_or_abstract(line: Column) -> Column:
    """Whether a line of a two-column first page belongs to the keywords ('kw') or to the abstract ('abs')."""
    t = F.trim(line)
    words = F.size(F.split(t, r"\s+"))
    return (
        F.when(F.lower(t).rlike(r"^keywords?\b"), "kw").when(F.lower(t).rlike(r"^abstract\b"), "abs").when(t.rlike(r"[.;:!?]$"), "abs").when(t.rlike(r"^[a-z]"), "abs").when(words > 6, "abs")
        .when(t.rlike(r"[0-9]{2,}"), "abs").when((words <= 4) & ~t.rlike(r"[,]"), "kw").otherwise("abs")
    )


def unleaved(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, keywords, abstract): the lines of both columns, each in its order, where they are mixed (4 lines at least)."""
    marked = lines.withColumn("class", keyword_or_abstract(F.col("line")))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("class") == c, F.struct("pos", "line")))), lambda x: x["line"]), " ")
    out = marked.groupBy(*keys).agg(joined("kw").alias("keywords"), joined("abs").alias("abstract"), F.max(F.when(F.col("class") == "kw", F.col("pos"))).alias("_k"), F.min(F.when(F.col("class") == "abs", F.col("pos"))).alias("_a"), F.count("*").alias("_n"))
    return out.where("_k > _a and _n >= 4").drop("_k", "_a", "_n")


def decimal_repair(c: Column) -> Column:
    return F.regexp_replace(c, r"([0-9])[，、·。]([0-9])", "$1.$2")


def latex(c: Column) -> Column:
    """Greek letters and signs as commands, then powers of ten."""
    for k, v in LATEX.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return scientific(c)


def scientific(c: Column) -> Column:
    """1.5e-3 and 1.5E+06 as 1.5 \\times 10^{-3} and 1.5 \\times 10^{06}."""
    return F.regexp_replace(c, r"([0-9](?:\.[0-9]+)?)[eE]\+?(-?[0-9]+)", r"$1 \\times 10^{$2}")


def subscripted(c: Column) -> Column:
    """Formulas of two and more elements with their amounts as subscripts, decimals repaired first."""
    whole = r"(?:[A-Z][a-z]?[0-9]+(?:\.[0-9]+)?){2,}"
    parts = F.regexp_extract_all(decimal_repair(c), F.lit(f"({whole})|([^A-Z]+|[A-Z])"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(f"^{whole}$"), F.regexp_replace(p, r"([A-Z][a-z]?)([0-9]+(?:\.[0-9]+)?)", r"$1_{$2}")).otherwise(p)), "")


def caption(c: Column, kind: str = "figure") -> Column:
    """(label, number, text) of a line that is a caption, null for others."""
    head = r"^\s*(Fig\.|Figure|FIG\.)\s*([0-9]+[a-z]?)[.:]?\s*(.*)$" if kind == "figure" else r"^\s*(Table|TABLE|Tab\.)\s*([0-9]+|[IVX]+)[.:]?\s*(.*)$"
    return F.when(c.rlike(head), F.struct(*[F.regexp_extract(c, head, i).alias(n) for i, n in enumerate(("label", "number", "text"), 1)]))


def first_doi(c: Column) -> Column:
    """The first DOI of a text: one in a link before a bare one, without a full stop at its end."""
    found = F.coalesce(F.nullif(F.regexp_extract(c, DOI_URL, 1), F.lit("")), F.nullif(F.regexp_extract(c, DOI_BARE, 1), F.lit("")))
    return F.rtrim(found, F.lit("."))


def first_given(*cs: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs])


def with_doi(text: Column, doi: Column) -> Column:
    """The text with the DOI before it, unless it is there."""
    return F.when(doi.isNotNull() & ~F.contains(text, doi), F.concat(F.lit("DOI: "), doi, F.lit("\n\n"), text)).otherwise(text)


def title_guess(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, title): the longest of the first eight lines that may be a title, of equal ones the first."""
    t = squeeze(F.col("line"))
    may = (F.length(t).between(15, 250)) & ~is_noise(t) & ~F.lower(t).rlike(r"^(abstract|keywords|introduction|fig|table|doi|http|received|accepted|#)") & ~t.rlike(r"[.;,]$") & t.rlike("[A-Za-z]{3}")
    ranked = lines.where(may).withColumn("t", t).withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))).where("_r <= 8")
    return ranked.groupBy(*keys).agg(F.max_by("t", F.struct(F.length("t"), -F.col("pos"))).alias("title"))


def text_tracks(c: Column) -> Column:
    """(original, simplified) of a text: as it says where it gives both, else the whole text up to 500 characters or two
    chunks, else its first five chunks, cut at 700 characters. Null and blank texts are 'not provided'."""
    strip = lambda t: F.regexp_replace(t, r"(?U)^\s+|\s+$", "")
    given = lambda t, other: F.coalesce(F.nullif(t, F.lit("")), other)
    original = given(strip(c), F.lit("not provided"))
    both = r"(?isuU)original\s*:\s*(.*?)\s*(?:\|\||\n|;\s*)\s*simplified\s*:\s*(.+)$"
    named = given(strip(F.regexp_extract(original, both, 1)), F.lit("not provided"))
    explicit = F.struct(named.alias("original"), given(strip(F.regexp_extract(original, both, 2)), named).alias("simplified"))
    chunks = F.filter(F.transform(F.split(original, r"(?U)[;\n]+|(?<=\.)\s+"), strip), lambda t: t != "")
    short = F.when((F.size(chunks) <= 2) | (F.length(original) <= 500), original).otherwise(F.array_join(F.slice(chunks, 1, 5), " "))
    cut = F.when(F.length(short) > 700, F.concat(F.regexp_replace(F.substring(short, 1, 697), r"(?U)\s+$", ""), F.lit("..."))).otherwise(short)
    return F.when(original.rlike(both), explicit).otherwise(F.struct(original.alias("original"), cut.alias("simplified")))


def simplified(c: Column) -> Column:
    """The simplified track of a text."""
    return text_tracks(c)["simplified"]


def text_key(c: Column) -> Column:
    """The key under which texts are compared: letters and digits in lower case, parted by one dash."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), F.lit("-"))


def safe_name(c: Column, most: int = 200) -> Column:
    """A file name: illegal signs and space runs as one underscore, cut at an underscore beyond half the length."""
    t = F.regexp_replace(F.regexp_replace(c, r'[<>:"/\\|?*]', ""), r"[_\s]+", "_")
    t = F.trim(t, F.lit("_"))
    cut = F.substring(t, 1, most)
    last = most + 1 - F.locate("_", F.reverse(cut))
    return F.when(F.length(t) <= most, t).when((last <= most) & (last > most // 2), F.substring(cut, F.lit(1), (last - 1).cast("int"))).otherwise(cut)


def unit_only(c: Column) -> Column:
    """Whether a title is nothing but a unit or a number."""
    return F.trim(F.regexp_replace(c, r"^#+\s*", "")).rlike(r"^\(?(?:[0-9.]+\s*)?(?:MPa|GPa|μm|um|nm|mm|K|°C|wt%|at%|%|HV|s|min|h)?\)?$")


def edges(lines: Column, top: int = 5, bottom: int = 3) -> Column:
    """(header, footer): the first and last lines of a page."""
    return F.struct(F.slice(lines, 1, top).alias("header"), F.when(F.size(lines) >= bottom, F.slice(lines, -bottom, bottom)).otherwise(lines).alias("footer"))


def within_budget(rows: DataFrame, text: str, keys: list[str], order: list[str], budget: int) -> DataFrame:
    """Rows while the total length before them is below a budget, each text once."""
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, text).orderBy(*order))).where("_r = 1")
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return first.withColumn("_t", F.coalesce(F.sum(F.length(text) + 2).over(w), F.lit(0))).where(F.col("_t") < budget).drop("_r", "_t")


def no_empty_abstract(c: Column) -> Column:
    """A heading 'Abstract' that stands directly before 'Keywords' is dropped."""
    return F.regexp_replace(c, r"(?i)#*\s*abstract\s*\n+(?=#*\s*keywords?\b)", "")


def hanging_merged(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines that hold only an affiliation's mark joined to the line before."""
    w = Window.partitionBy(*keys).orderBy("pos")
    mark = lambda c: F.trim(c).rlike(r"^(?:[a-z]|[0-9]{1,2}|\*|†)(?:,\s*(?:[a-z]|[0-9]{1,2}|\*|†))*,?$")
    after, before = F.lead("line").over(w), F.lag("line").over(w)
    joined = F.when(F.coalesce(mark(after), F.lit(False)) & ~mark(F.col("line")), F.concat(F.col("line"), F.lit(" "), F.trim(after))).otherwise(F.col("line"))
    drop = mark(F.col("line")) & F.coalesce(~mark(before), F.lit(False))
    return lines.withColumn("_j", joined).withColumn("_d", drop).where(~F.col("_d")).withColumn("line", F.col("_j")).drop("_j", "_d")


def author_marks(c: Column) -> Column:
    """Marks directly behind an author's name as superscripts."""
    return F.regexp_replace(c, r"([a-z]{2})\s?([a-f](?:,[a-f])*|[0-9]{1,2}(?:,[0-9]{1,2})*)(,\*)?(?=,|$| and )", r"$1^{$2$3}")


def greek_repaired(line: Column) -> Column:
    """Greek letters that were read as Latin ones, in lines that speak of phases only."""
    phase = F.lower(line).rlike("phase|precipitat|matrix|lath|lamell")
    fixed = F.regexp_replace(F.regexp_replace(line, r"(^|[\s(])y('|′| phase| matrix| precipitates)", "$1γ$2"), r"(^|[\s(])a \+ ?[bß]($|[\s,.)])", "$1α+β$2")
    return F.when(phase, fixed).otherwise(line)


def command_subscripts(c: Column) -> Column:
    """Numbers behind Greek commands as subscripts, but not within $...$."""
    parts = F.split(c, r"(?=\$)|(?<=\$)")
    dollars = F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit("").alias("t")), lambda a, p: F.struct((a["n"] + F.when(p == "$", 1).otherwise(0)).alias("n"), F.concat(a["t"], F.when(a["n"] % 2 == 0, F.regexp_replace(p, r"(\\(?:alpha|beta|gamma|delta|sigma|lambda|mu))\s?([0-9]+)", "$1_{$2}")).otherwise(p)).alias("t")))
    return dollars["t"]
