"""Queries of the operators for language-model training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm import canon, confusables, mixing, ocr, packing, residue, tokens
from ferrule.sources.tables import table

_TYPED = (
    ("properties", "Property_Name", "test_id", "Property_Name"),
    ("samples", "Process_Category", "row_id", "Process_Info.Process_Category"),
    ("samples", "Alloy_Name_Raw", "row_id", "Composition_Info.Alloy_Name_Raw"),
)


def _matched(spark: SparkSession, folder: str):
    terms = canon.read_canon(table(spark, folder, "canon_terms"))
    parts = [(f, canon.match(table(spark, folder, t), terms, f, i, F.col(c))) for t, f, i, c in _TYPED]
    return parts, terms


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The term meant by each freely entered value, 0 for none."""
    parts, terms = _matched(spark, folder)
    out = None
    for field, part in parts:
        part = part.where(~F.col("value").isin(*terms.spelled.get(field, ())))
        out = part if out is None else out.unionByName(part)
    return out.select("field_name", "row_id", "term_id").distinct()


def p2_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Values that the list doesn't have, with how often they occur."""
    parts, _ = _matched(spark, folder)
    out = None
    for _, part in parts:
        out = part if out is None else out.unionByName(part)
    return out.where("term_id = 0").groupBy("field_name", "value").agg(F.countDistinct("row_id").alias("n_rows"))


def _formed(spark: SparkSession, folder: str) -> DataFrame:
    info = F.col("Composition_Info")
    return confusables.unify(table(spark, folder, "samples"), ["row_id"], {"Alloy_Name_Raw": info["Alloy_Name_Raw"], "Note": info["Note"]})


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values with a character that can't be told from the one that belongs there."""
    return _formed(spark, folder).where("changed").select("row_id", "field_name").distinct()


def p3_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every value in its consistent form."""
    return _formed(spark, folder).select("row_id", "field_name", "value", "form", "changed").distinct()


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Values that read alike."""
    return confusables.groups(_formed(spark, folder))


def p7_noise(spark: SparkSession, folder: str) -> DataFrame:
    """Every case of noise with the word and what was meant."""
    return ocr.find_noise(table(spark, folder, "ocr_items"), table(spark, folder, "paper_texts"))[0].select("table_name", "row_no", "line_no", "noise_kind", "word", "meant")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with noise, by kind."""
    return p7_noise(spark, folder).select("table_name", "row_no", "line_no", "noise_kind").distinct()


def p7_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """The texts repaired and reflowed."""
    noise, marked, _ = ocr.find_noise(table(spark, folder, "ocr_items"), table(spark, folder, "paper_texts"))
    return ocr.paragraphs(noise, marked)


def p8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every text in containers of each capacity."""
    return packing.fill_containers(tokens.sized(table(spark, folder, "documents")), table(spark, folder, "pack_sizes"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_rates(p8_packing(spark, folder), table(spark, folder, "pack_sizes"))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The texts drawn, with their repeats."""
    return mixing.mix(tokens.sized(table(spark, folder, "documents"), keep=("source",)), table(spark, folder, "mix_targets"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share that each source reaches."""
    return mixing.shares(p9_mixture(spark, folder), table(spark, folder, "mix_targets"))


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its likeliest residue passage."""
    return residue.detect(table(spark, folder, "documents").select("doc_id", "text"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold residue in place of content."""
    return p10_scores(spark, folder).where("n_residue > 0").select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_unmatched, p3_found, p3_forms, p3_groups, p7_found, p7_noise, p7_paragraphs, p8_packing, p8_fill, p9_mixture, p9_shares, p10_found, p10_scores)}
