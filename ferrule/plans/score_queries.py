"""Queries that compare extractions: signatures, tests, processes, structure. Each that SQL can express has its SQL in score_sql."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.functions import scores as S
from ferrule.functions.numbers import ELEMENTS
from ferrule.operators import matching
from ferrule.plans.reference_queries import _documents, _items
from ferrule.sources.tables import table


def property_type(s: SparkSession, d: str) -> DataFrame:
    """Property names with the type they stand for, and how often (V1)."""
    named = table(s, d, "properties").select("test_id", "Property_Name").distinct().groupBy("Property_Name").agg(F.count("*").alias("n"))
    return named.select("Property_Name", S.property_type(F.col("Property_Name")).alias("property_type"), "n")


def _signed(s: SparkSession, d: str) -> DataFrame:
    """(record_no, item_pos, property_type, unit, t, v, test_pos) of all tests of all items."""
    tests = _items(s, d).select("record_no", "item_pos", F.posexplode("item.Properties_Info").alias("test_pos", "p")).where("p is not null")
    unit = F.coalesce(F.lower(F.trim("p.Unit")), F.lit(""))
    return tests.select("record_no", "item_pos", S.property_type(F.col("p.Property_Name")).alias("property_type"), unit.alias("unit"), F.col("p.Test_Temperature_K").alias("t"), F.col("p.Value_Numeric").alias("v"), "test_pos")


def signature_cost(s: SparkSession, d: str) -> DataFrame:
    """What the tests of an item and of the one before it in its record cost when matched: twice those without partner (V5)."""
    counts = _signed(s, d).groupBy("record_no", "item_pos", "property_type", "unit").agg(F.count("*").alias("n"))
    sides = F.array(F.struct(F.col("item_pos").alias("gold_pos"), F.col("n").alias("gold"), F.lit(0).alias("found")), F.struct((F.col("item_pos") - 1).alias("gold_pos"), F.lit(0).alias("gold"), F.col("n").alias("found")))
    both = counts.select("record_no", "property_type", "unit", F.explode(sides).alias("x")).select("record_no", "property_type", "unit", "x.*").where("gold_pos >= 0")
    per = both.groupBy("record_no", "gold_pos", "property_type", "unit").agg(F.abs(F.sum("gold") - F.sum("found")).alias("rest"))
    return per.groupBy("record_no", "gold_pos").agg((2 * F.sum("rest")).cast("bigint").alias("cost"))


def optimal_tests(s: SparkSession, d: str) -> DataFrame:
    """The tests of an item assigned to those of the item before it, by type and unit, at least cost."""
    t = _signed(s, d)
    gold = t.select("record_no", F.col("item_pos").alias("gold_item"), "property_type", "unit", "t", "v", "test_pos")
    found = t.select("record_no", (F.col("item_pos") - 1).alias("gold_item"), "property_type", "unit", "t", "v", "test_pos")
    return matching.assigned_tests(gold, found, ["record_no", "gold_item"], "test_pos", ["property_type", "unit"])


def full_hit(s: SparkSession, d: str) -> DataFrame:
    """Items whose measured elements are those of the nominal composition, none missing and none more."""
    c = F.col("item.Composition_Info")
    elements = lambda x: F.array_sort(F.map_keys(F.map_filter(x["Elements_Normalized"], lambda k, v: v.isNotNull() & (v != 0))))
    i = _items(s, d).select("record_no", "item_pos", elements(c["Nominal_Composition"]).alias("a"), elements(c["Measured_Composition"]).alias("b")).where("a is not null and b is not null")
    return i.select("record_no", "item_pos", F.size(F.array_except("a", "b")).alias("n_missing"), F.size(F.array_except("b", "a")).alias("n_extra"), (F.col("a") == F.col("b")).alias("full_hit"))


def process_difference(s: SparkSession, d: str) -> DataFrame:
    """Rows of the register against those of the mirror under the same key: how their processes differ."""
    one = lambda name, as_: table(s, d, name).where("paper_id is not null and Sample_ID is not null").groupBy("paper_id", "Sample_ID").agg(F.max("Process_Info.Process_Category").alias(as_))
    both = one("samples", "gold").join(one("samples_mirror", "found"), ["paper_id", "Sample_ID"])
    return both.select("paper_id", "Sample_ID", S.process_difference(F.col("gold"), F.col("found")).alias("difference"))


def structure_counts(s: SparkSession, d: str) -> DataFrame:
    """Alloys and samples of each paper in the register and in the mirror, and whether that is more or fewer."""
    def side(name: str, as_: str) -> DataFrame:
        t = table(s, d, name).where("paper_id is not null")
        return t.groupBy("paper_id").agg(F.countDistinct("Composition_Info.Alloy_Name_Raw").alias(f"{as_}_alloys"), F.countDistinct("Sample_ID").alias(f"{as_}_samples"))

    both = side("samples", "gold").join(side("samples_mirror", "found"), "paper_id", "full")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("gold_alloys", "found_alloys", "gold_samples", "found_samples")}
    change = F.when(n["found_samples"] > n["gold_samples"], "improved").when(n["found_samples"] < n["gold_samples"], "degraded").otherwise("unchanged")
    return both.select("paper_id", *[x.cast("bigint").alias(c) for c, x in n.items()], change.alias("change"))


def doi_match(s: SparkSession, d: str) -> DataFrame:
    """The DOI of each record against the one that the paper's pages show first (R2)."""
    pattern = r"(10\.\d{4,9}/[^\s\"<>]+)"
    shown = table(s, d, "ocr_items").select("paper_id", F.struct("page", "pos", "item_no").alias("at"), F.lower(F.regexp_extract("text", pattern, 1)).alias("doi")).where("doi <> '' and paper_id is not null")
    first = shown.groupBy("paper_id").agg(F.min_by("doi", "at").alias("shown"))
    once = table(s, d, "papers").select("record_no", "paper_id", F.lower(F.trim("Paper_Metadata.DOI")).alias("doi")).dropDuplicates(["record_no"])
    return once.join(first, "paper_id", "left").select("record_no", F.coalesce((F.col("doi") == F.regexp_replace("shown", r"[.,;)]+$", "")) & (F.col("doi") != ""), F.lit(False)).alias("match"))


def composition_checks(s: SparkSession, d: str) -> DataFrame:
    """By record: nominal compositions with keys that are no elements, with a sum off by more than 2, and named ones without any."""
    c = F.col("item.Composition_Info")
    m = F.map_filter(c["Nominal_Composition"]["Elements_Normalized"], lambda k, v: v.isNotNull())
    total = F.aggregate(F.map_values(m), F.lit(0.0), lambda a, x: a + x)
    known = F.array(*[F.lit(e) for e in sorted(ELEMENTS)])
    empty = F.coalesce(F.size(m) < 1, F.lit(True))
    i = _items(s, d).select("record_no", (F.size(F.array_except(F.map_keys(m), known)) > 0).alias("invalid"), (~empty & (F.abs(total - 100) > 2.000001)).alias("sum_off"), (empty & (F.coalesce(c["Alloy_Name_Raw"], F.lit("")) != "")).alias("empty"))
    return i.groupBy("record_no").agg(F.count_if("invalid").alias("n_invalid"), F.count_if("sum_off").alias("n_sum_off"), F.count_if("empty").alias("n_empty"))


def treatment_ranges(s: SparkSession, d: str) -> DataFrame:
    """Ranges of temperature and time of heat treatments (P6). No text of the tables gives one, so the sentence is put
    together from the ranges of the tests."""
    t = table(s, d, "properties").select("test_id", F.concat(F.lit("Aged at "), "Value_Range", F.lit(" °C, then annealed for "), "Value_Range", F.lit(" h.")).alias("text")).dropDuplicates(["test_id"])
    return t.select("test_id", F.explode(S.treatment_ranges(F.col("text"))).alias("r")).select("test_id", "r.*")


def interface_lines(s: SparkSession, d: str) -> DataFrame:
    """Lines of texts, and those left without lines of buttons (T5)."""
    lines = F.split("text", "\n")
    return _documents(s, d).where("text is not null").select("doc_id", F.size(lines).alias("n_lines"), F.size(S.without_interface_lines(lines, words=("check for", "updates", "menu", "search | browse | about"))).alias("n_kept"))


def wrapped_title(s: SparkSession, d: str) -> DataFrame:
    """Titles that run over the first two lines of a page text or document."""
    pages = table(s, d, "paper_texts").select(F.concat(F.lit("t"), "text_no").alias("id"), F.col("paper_text").alias("text")).dropDuplicates(["id"])
    docs = _documents(s, d).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    return pages.unionByName(docs).select("id", S.wrapped_title(F.col("text")).alias("title")).where("title is not null")


QUERIES = {f.__name__: f for f in (property_type, signature_cost, optimal_tests, full_hit, process_difference, structure_counts, doi_match, composition_checks, treatment_ranges, interface_lines, wrapped_title)}
