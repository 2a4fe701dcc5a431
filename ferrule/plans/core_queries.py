"""Queries of the general operators for training data over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.operators.diff import current_rows, diff_tables
from ferrule.operators.drift import canonical_names, changes, typed_tables, unified_values
from ferrule.operators.flatten import RecordTables
from ferrule.operators.unify_units import foreign_numbers, reference, unify
from ferrule.sources.tables import table

_KEYS = {"paper_id": F.col, "Sample_ID": F.col}
_FIELDS = {
    "Role": "Composition_Info.Role",
    "Alloy_Name_Raw": "Composition_Info.Alloy_Name_Raw",
    "Process_Category": "Process_Info.Process_Category",
    "Main_Phase": "Microstructure_Info.Main_Phase",
}


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of fields from file to file."""
    return changes(table(spark, folder, "snapshot_files"))


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of all files in one typed table."""
    files = table(spark, folder, "snapshot_files")
    return unified_values(files, canonical_names(changes(files)))


def _p1_level(spark: SparkSession, folder: str, level: str) -> DataFrame:
    tables = typed_tables(p1_records(spark, folder))
    empty = "file_no bigint, sample string, n int, pos string, failed_casts array<string>"
    return tables[level] if level in tables else spark.createDataFrame([], empty)


def p1_items(spark: SparkSession, folder: str) -> DataFrame:
    """The items of all files as rows of typed columns."""
    return _p1_level(spark, folder, "items[]")


def p1_properties(spark: SparkSession, folder: str) -> DataFrame:
    """The properties of all files as rows of typed columns."""
    return _p1_level(spark, folder, "items[].Properties_Info[]")


def _register(spark: SparkSession, folder: str, name: str, order: list[str]) -> DataFrame:
    fields = {n: F.col(p) for n, p in _FIELDS.items()}
    return current_rows(table(spark, folder, name), {k: F.col(k) for k in _KEYS}, fields, [F.col(c) for c in order])


def p5_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and fields that differ, with both values."""
    left = _register(spark, folder, "samples", ["loaded_at", "row_id"])
    right = _register(spark, folder, "samples_mirror", ["copied_at", "mirror_row"])
    return diff_tables(left, right, list(_KEYS), list(_FIELDS), "only_in_samples", "only_in_mirror")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_differences(spark, folder).select("paper_id", "Sample_ID", "diff_kind")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every flat row of the nested records."""
    return RecordTables(table(spark, folder, "papers")).rows()


def p6_properties(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of properties, linked to record and item."""
    return RecordTables(table(spark, folder, "papers")).listed("Properties_Info").distinct()


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of items with their scalars."""
    return RecordTables(table(spark, folder, "papers")).item().distinct()


def p6_elements(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of elements, nominal and measured."""
    t = RecordTables(table(spark, folder, "papers"))
    parts = [t.mapped(f"Composition_Info.{c}_Composition.Elements_Normalized").withColumn("composition", F.lit(c.lower())) for c in ("Nominal", "Measured")]
    return parts[0].unionByName(parts[1]).distinct()


def p6_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of process parameters, a row for each leaf."""
    return RecordTables(table(spark, folder, "papers")).leaves("Process_Info.Key_Params").distinct()


def p6_features(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of quantitative features, a row for each leaf."""
    return RecordTables(table(spark, folder, "papers")).leaves("Microstructure_Info.Advanced_Quantitative_Features").distinct()


def p6_precipitates(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of precipitates."""
    return RecordTables(table(spark, folder, "papers")).listed("Microstructure_Info.Precipitates").distinct()


def _units(spark: SparkSession, folder: str):
    lexicon, units = reference(table(spark, folder, "canon_terms"), table(spark, folder, "unit_codes"))
    columns = ["test_id", "Property_Name", "Unit", "Value_Numeric", "Test_Temperature_K", "Test_Condition", "Note", "Value_Range"]
    return unify(table(spark, folder, "properties").select(*columns), lexicon, units, keep=["test_id"]), units


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers not recorded in their common unit."""
    return foreign_numbers(*_units(spark, folder))


def p4_values(spark: SparkSession, folder: str) -> DataFrame:
    """All property values in common units."""
    columns = ["test_id", "term", "unit_code", "unit_source", "value_common", "likely_unit", "likely_p", "uncertain", "temperature_k"]
    return _units(spark, folder)[0].select(*columns).distinct()


QUERIES = {f.__name__: f for f in (p1_found, p1_records, p1_items, p1_properties, p4_found, p4_values, p5_found, p5_differences, p6_found, p6_items, p6_elements, p6_parameters, p6_features, p6_precipitates, p6_properties)}
