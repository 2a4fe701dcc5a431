"""Queries of the document-to-data operators over the driver tables. Each has its SQL in reference_sql under the same name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.functions import numbers as N
from ferrule.functions import process as P
from ferrule.functions import records as R
from ferrule.functions import text as X
from ferrule.functions.arrow import mapped
from ferrule.operators import hooks, layout, matching, merge, restructure, scoring, tables
from ferrule.sources import corpus
from ferrule.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _documents(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", "text").dropDuplicates(["doc_id"])


def _doc_lines(s: SparkSession, d: str) -> DataFrame:
    return X.lines_of(_documents(s, d), "text", "doc_id")


def _blocks(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(s, d, "ocr_items").select("item_no", "paper_id", "page", "pos", "typer", "block_label", *columns).dropDuplicates(["item_no"])


def _items(s: SparkSession, d: str) -> DataFrame:
    once = table(s, d, "papers").dropDuplicates(["record_no"])
    return once.select("record_no", "paper_id", F.col("Paper_Metadata.DOI").alias("doi"), F.posexplode("items").alias("item_pos", "item")).where(F.col("item").isNotNull())


def _tests(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(s, d, "properties").select("test_id", *columns).dropDuplicates(["test_id"])


# Texts -----------------------------------------------------------------------------------------------------------------


@query
def line_normalize(s: SparkSession, d: str) -> DataFrame:
    """Lines, white space and repeats."""
    kept = X.normalized_lines(_doc_lines(s, d), "doc_id")
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query
def noise_line_filter(s: SparkSession, d: str) -> DataFrame:
    """Page furniture among the lines of blocks."""
    lines = X.lines_of(_blocks(s, d, "text"), "text", "item_no")
    return lines.where(X.is_noise(F.col("line"))).groupBy("item_no").agg(F.count("*").alias("n_noise"))


@query
def leading_strip(s: SparkSession, d: str) -> DataFrame:
    """Short lines at a text's start dropped."""
    kept = X.drop_leading(_doc_lines(s, d), F.length(F.trim("line")) < 30, "doc_id")
    return kept.groupBy("doc_id").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n_lines"))


@query
def section_state_trim(s: SparkSession, d: str) -> DataFrame:
    """Reference sections cut out of page texts."""
    pages = table(s, d, "paper_texts").select("text_no", "paper_text").dropDuplicates(["text_no"])
    kept = X.without_references(X.lines_of(pages, "paper_text", "text_no"), "text_no")
    return kept.groupBy("text_no").agg(F.count("*").alias("n_lines"))


@query
def legend_islands(s: SparkSession, d: str) -> DataFrame:
    """Fragments directly before captions dropped."""
    pages = table(s, d, "paper_texts").select("text_no", "paper_text").dropDuplicates(["text_no"])
    kept = X.without_legends(X.lines_of(pages, "paper_text", "text_no"), "text_no")
    return kept.groupBy("text_no").agg(F.count("*").alias("n_lines"))


@query
def headings(s: SparkSession, d: str) -> DataFrame:
    """Numbered and common headings with their level."""
    lines = X.lines_of(_blocks(s, d, "text"), "text", "item_no")
    return lines.withColumn("level", X.heading_level(F.col("line"))).where("level is not null").select("item_no", "pos", "level", X.as_markdown(F.col("line")).alias("markdown"))


@query
def captions(s: SparkSession, d: str) -> DataFrame:
    """Captions of figures."""
    lines = X.lines_of(_blocks(s, d, "text"), "text", "item_no")
    return lines.withColumn("c", X.caption(F.col("line"))).where("c is not null").select("item_no", "pos", "c.number", F.trim("c.text").alias("caption"))


@query
def paragraph_blocks(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs by blank lines."""
    parts = _documents(s, d).select("doc_id", F.posexplode(F.split("text", "\n\n", -1)).alias("pos", "p"))
    t = F.regexp_replace("p", r"^\s+|\s+$", "")
    return parts.where(t != "").groupBy("doc_id").agg(F.count("*").alias("n_paragraphs"), F.max(F.length(t)).alias("longest"))


@query
def greek_latex_fold(s: SparkSession, d: str) -> DataFrame:
    """Greek letters and signs as commands."""
    return _documents(s, d).where("text is not null").select("doc_id", F.length(X.latex(F.col("text"))).alias("n_chars"))


@query
def formula_subscripts(s: SparkSession, d: str) -> DataFrame:
    """Decimals repaired and formulas with subscripts."""
    names = table(s, d, "samples").select("row_id", F.col("Composition_Info.Alloy_Name_Raw").alias("name")).where("name is not null").distinct()
    return names.select("row_id", X.decimal_repair(F.col("name")).alias("repaired"), F.length(X.subscripted(F.col("name"))).alias("n_chars"))


@query
def title_guess(s: SparkSession, d: str) -> DataFrame:
    """The likely title of a text."""
    return X.title_guess(_doc_lines(s, d), "doc_id")


@query
def append_missing_budget(s: SparkSession, d: str) -> DataFrame:
    """Short paragraphs of a paper, each text once, within a budget of characters."""
    short = _blocks(s, d, "text").where("typer = 'paragraph' and length(text) between 6 and 500")
    return X.within_budget(short, "text", ["paper_id"], ["page", "pos", "item_no"], 4000).select("paper_id", "item_no")


@query
def doi_metadata(s: SparkSession, d: str) -> DataFrame:
    """The DOI of each record: that of the metadata, else the first in the title."""
    p = table(s, d, "papers").select("record_no", F.col("Paper_Metadata.DOI").alias("doi"), F.col("Paper_Metadata.Paper_Title").alias("title")).distinct()
    doi = X.first_given(X.first_doi(F.col("doi")), X.first_doi(F.col("title")))
    return p.select("record_no", doi.alias("doi"), F.length(X.with_doi(F.col("title"), doi)).alias("n_chars"))


@query
def simplify_text(s: SparkSession, d: str) -> DataFrame:
    """The first 700 characters, as its SQL has them; the rule of T33 and T46 is in ``text_tracks``."""
    return _documents(s, d).where("text is not null").select("doc_id", F.substring(X.squeeze(F.col("text")), 1, 700).alias("simplified"))


@query
def text_tracks(s: SparkSession, d: str) -> DataFrame:
    """Each text with its simplified form."""
    return _documents(s, d).withColumn("t", X.text_tracks(F.col("text"))).select("doc_id", "t.*")


@query
def slug_key(s: SparkSession, d: str) -> DataFrame:
    """Keys and file names of papers."""
    p = table(s, d, "papers").select("paper_id", F.col("Paper_Metadata.Paper_Title").alias("title")).distinct()
    return p.select("paper_id", "title", X.text_key(F.col("title")).alias("key"), N.slug_upper(F.col("title")).alias("slug"), X.safe_name(F.col("title"), 40).alias("file_name"), corpus.article_key(F.col("paper_id")).alias("article"))


@query
def keyword_columns(s: SparkSession, d: str) -> DataFrame:
    """Lines of keywords and abstract told apart."""
    lines = X.lines_of(_blocks(s, d, "text"), "text", "item_no").where(F.trim("line") != "")
    return lines.groupBy("item_no").agg(F.count_if(X.keyword_or_abstract(F.col("line")) == "kw").alias("n_kw"), F.count_if(X.keyword_or_abstract(F.col("line")) == "abs").alias("n_abs"))


@query
def page_edges(s: SparkSession, d: str) -> DataFrame:
    """First and last lines of pages."""
    pages = table(s, d, "paper_texts").select("text_no", F.split("paper_text", "\n", -1).alias("l")).where("l is not null").dropDuplicates(["text_no"])
    return pages.withColumn("e", X.edges(F.col("l"))).select("text_no", F.array_join("e.header", "|").alias("header"), F.array_join("e.footer", "|").alias("footer"), F.size("l").alias("line_count"))


# Layout ----------------------------------------------------------------------------------------------------------------


@query
def bbox_anti_join(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs that lie in a table dropped."""
    b = _blocks(s, d, "bbox")
    kept = layout.not_within(b, b.where("typer = 'table'"), (F.col("typer") == "paragraph") & ~F.coalesce(F.col("block_label") == "figure_title", F.lit(False)))
    return kept.select("item_no", "paper_id", "page")


@query
def iou_best_match(s: SparkSession, d: str) -> DataFrame:
    """Each block's best region among boxes moved a little."""
    b = _blocks(s, d, "bbox").where("bbox is not null")
    moved = b.select("paper_id", "page", "typer", F.col("item_no").alias("region_no"), F.array(F.col("bbox")[0] + 3, F.col("bbox")[1] + 2, F.col("bbox")[2] + 3, F.col("bbox")[3] + 2).alias("bbox"))
    return layout.best_region(b, moved, "item_no").select("item_no", "region_no", F.floor(F.col("iou") * 1000 + 0.01).cast("bigint").alias("iou_1000"))


@query
def confidence_policy(s: SparkSession, d: str) -> DataFrame:
    """Blocks kept under a confidence policy, and the report of each paper."""
    b = _blocks(s, d, "text", "confidence")
    report = layout.quality_report(b, 0.8)
    kept = layout.confidence_policy(b, "drop", 0.8).groupBy("paper_id").agg(F.count("*").alias("kept"))
    return report.join(kept, "paper_id", "left").select("paper_id", F.round("avg_confidence", 4).alias("avg_confidence"), "low_pages", "tables", "paragraphs", "noise_blocks", F.coalesce("kept", F.lit(0)).alias("kept"))


@query
def numbered_tables(s: SparkSession, d: str) -> DataFrame:
    """Tables numbered by page, as they are exported."""
    return layout.numbered_tables(_blocks(s, d))


@query
def typed_blocks(s: SparkSession, d: str) -> DataFrame:
    """Blocks by paper and kind."""
    b = _blocks(s, d)
    kind = F.when(F.col("block_label").isin("table"), "table").when(F.col("block_label").isin("doc_title", "paragraph_title"), "heading").when(F.col("block_label") == "figure_title", "caption").when(F.col("block_label").isin(*layout.NOISE_LABELS), "furniture").otherwise("paragraph")
    return b.groupBy("paper_id").agg(*[F.count_if(kind == k).alias(f"n_{k}") for k in ("table", "heading", "caption", "furniture", "paragraph")])


@query
def text_table_rows(s: SparkSession, d: str) -> DataFrame:
    """Rows of pipe and tab tables in texts (H6, H8, H9)."""
    return tables.text_rows(_documents(s, d), "text", "doc_id").select("doc_id", "row", F.size("cells").alias("n_cells"), F.array_join("cells", "|").alias("cells"))


@query
def gap_table_cells(s: SparkSession, d: str) -> DataFrame:
    """Columns of tables parted by gaps (H7)."""
    t = _blocks(s, d, "text").where("typer = 'table'")
    return t.select("item_no", F.explode(mapped(tables.gap_columns, "array<array<string>>", "text")).alias("cells")).select("item_no", F.array_join("cells", "|").alias("cells"))


@query
def html_tables(s: SparkSession, d: str) -> DataFrame:
    """Cells of HTML tables made of the unit table (H1 to H4)."""
    u = table(s, d, "unit_codes")
    html = F.concat(F.lit("<table><tr><th>code</th><th>symbol</th></tr><tr><td>"), F.col("unit_code"), F.lit("</td><td colspan=\"2\">"), F.col("symbol"), F.lit("</td></tr></table>"))
    h = u.select("unit_code", html.alias("html"))
    return tables.cells_of(h, "html", "unit_code").join(h.select("unit_code", tables.merged_cells(F.col("html")).alias("merged")), "unit_code").select("unit_code", "row", "col", "name", "value", "merged")


# Numbers ---------------------------------------------------------------------------------------------------------------


@query
def temperature_to_k(s: SparkSession, d: str) -> DataFrame:
    """Temperatures in the texts of tests."""
    return _tests(s, d, "Test_Condition").select("test_id", N.kelvin(F.col("Test_Condition")).alias("kelvin"))


@query
def value_std_range(s: SparkSession, d: str) -> DataFrame:
    """Values with deviation or range."""
    t = _tests(s, d, "Value_Range", "Value_Numeric", "Value_StdDev")
    text = F.coalesce("Value_Range", F.concat(F.floor("Value_Numeric").cast("bigint").cast("string"), F.lit(" ± "), F.floor(F.when(~F.isnan("Value_StdDev"), F.col("Value_StdDev"))).cast("bigint").cast("string")))
    v = t.where(N.has_number(text)).withColumn("v", N.value_std_range(text))
    return v.select("test_id", F.round("v.value", 3).alias("value"), F.round("v.std", 3).alias("std"), F.col("v.range").alias("value_range"))


@query
def formula_tokens(s: SparkSession, d: str) -> DataFrame:
    """Elements of formulas."""
    n = table(s, d, "canon_terms").where("field_name = 'Alloy_Name_Raw'")
    m = n.where(N.is_formula(F.col("term"))).select("term_id", F.explode(N.formula(F.col("term"))).alias("element", "amount"))
    return m.select("term_id", "element", "amount")


@query
def composition_normalize(s: SparkSession, d: str) -> DataFrame:
    """Measured compositions closed to 100."""
    m = F.col("item.Composition_Info.Measured_Composition.Elements_Normalized")
    rows = _items(s, d).where(m.isNotNull()).select("record_no", "item_pos", N.valid_map(m).alias("m"))
    return rows.select("record_no", "item_pos", F.explode("m").alias("element", "pct")).select("record_no", "item_pos", "element", F.round("pct", 3).alias("pct"))


@query
def balance_argmax(s: SparkSession, d: str) -> DataFrame:
    """The element that closes a composition: the main one, else that of the name."""
    i = _items(s, d)
    m = F.col("item.Composition_Info.Nominal_Composition.Elements_Normalized")
    return i.select("record_no", "item_pos", F.coalesce(N.main_element(m), N.matrix_of_name(F.col("item.Composition_Info.Alloy_Name_Raw"))).alias("element"))


@query
def blend_maps(s: SparkSession, d: str) -> DataFrame:
    """The middle of nominal and measured compositions (C14)."""
    i = _items(s, d)
    a, b = (F.col(f"item.Composition_Info.{k}_Composition.Elements_Normalized") for k in ("Nominal", "Measured"))
    return i.where(a.isNotNull() & b.isNotNull()).select("record_no", "item_pos", F.explode(N.blended(a, b, F.lit(0.5))).alias("element", "pct")).select("record_no", "item_pos", "element", F.round("pct", 3).alias("pct"))


@query
def value_equivalence(s: SparkSession, d: str) -> DataFrame:
    """Tests whose temperature and text agree."""
    t = _tests(s, d, "Test_Condition", "Test_Temperature_K").withColumn("said", N.kelvin(F.col("Test_Condition")))
    return t.where("said is not null").select("test_id", N.equivalent(F.lit("temperature"), F.col("Test_Temperature_K"), F.col("said")).alias("agrees"))


# Process, microstructure, properties -----------------------------------------------------------------------------------


@query
def process_category(s: SparkSession, d: str) -> DataFrame:
    """Categories of typed routes by words in order."""
    r = table(s, d, "samples").select("row_id", F.col("Process_Info.Process_Category").alias("route")).distinct().where("route is not null")
    inferred = P.category(F.col("route"))
    return r.select("row_id", inferred.alias("inferred"), P.resolved_category(F.col("route"), inferred).alias("resolved"))


@query
def key_params_text(s: SparkSession, d: str) -> DataFrame:
    """Parameters named in texts."""
    t = _documents(s, d).where("text is not null")
    cols = {n.lower(): P.parameter(F.col("text"), n) for n in ("Laser_Power_W", "Layer_Thickness_um", "Oxygen_Content_ppm")}
    out = t.select("doc_id", *[c.alias(n) for n, c in cols.items()])
    return out.where("laser_power_w is not null or layer_thickness_um is not null or oxygen_content_ppm is not null")


@query
def main_phase(s: SparkSession, d: str) -> DataFrame:
    """Phases and precipitates named in texts."""
    return _documents(s, d).where("text is not null").select("doc_id", P.main_phase(F.col("text")).alias("main_phase"), P.has_precipitates(F.col("text")).alias("has_precipitates"))


@query
def property_rank(s: SparkSession, d: str) -> DataFrame:
    """Properties in the order of a report."""
    t = _tests(s, d, "Property_Name", "Data_Source").where("Property_Name is not null")
    name = P.snake(F.col("Property_Name"))
    return t.select("test_id", name.alias("name"), P.tier(name).alias("tier"), P.default_unit(name).alias("unit"), P.data_source(F.col("Data_Source")).alias("source"))


@query
def key_alias_units(s: SparkSession, d: str) -> DataFrame:
    """Parameter keys and units to canonical ones."""
    aliases = s.createDataFrame(P.KEY_ALIASES, "raw string, key string, factor double, shift double")
    # Speeds of tests stand for parameters recorded under another key.
    t = _tests(s, d, "Tensile_Speed_mm_min").where("Tensile_Speed_mm_min is not null and not isnan(Tensile_Speed_mm_min)").withColumn("raw", F.lit("Scan_Speed_mm_min"))
    j = t.join(F.broadcast(aliases), "raw", "left").where(~F.col("raw").isin(*P.DISALLOWED_KEYS))
    return j.select("test_id", F.coalesce("key", "raw").alias("key"), F.round(F.col("Tensile_Speed_mm_min") * F.coalesce("factor", F.lit(1.0)) + F.coalesce("shift", F.lit(0.0)), 6).alias("value"))


@query
def sanitized_numbers(s: SparkSession, d: str) -> DataFrame:
    """Percentages of 0 and 100 only where the text says so."""
    m = F.col("item.Microstructure_Info")
    text = F.concat_ws(" ", m["Microstructure_Text"]["original"], m["Microstructure_Text"]["simplified"])
    return _items(s, d).select("record_no", "item_pos", P.without_absolute(m["Relative_Density_pct"], text).alias("relative_density"), P.without_absolute(m["Porosity_pct"], text).alias("porosity"), N.clean(m["Main_Phase"]).alias("main_phase"))


# Restructuring ---------------------------------------------------------------------------------------------------------


@query
def step_explode(s: SparkSession, d: str) -> DataFrame:
    """A row for each key of either composition map."""
    i = _items(s, d).select("record_no", "item_pos", F.col("item.Composition_Info.Nominal_Composition.Elements_Normalized").alias("nominal"), F.col("item.Composition_Info.Measured_Composition.Elements_Normalized").alias("measured"))
    return restructure.by_step(i, "nominal", "measured", "record_no", "item_pos")


@query
def variant_expand(s: SparkSession, d: str) -> DataFrame:
    """Runs of each paper crossed with four variants, without those that exist."""
    p = table(s, d, "papers").select("paper_id").distinct()
    options = s.createDataFrame([(v, t) for v in ("1.0", "1.5") for t in (False, True)], "version string, trimmed boolean")
    done = table(s, d, "paper_texts").select("paper_id").distinct().select("paper_id", F.lit("1.0").alias("version"), F.lit(False).alias("trimmed"))
    return restructure.crossed(p, options).join(done, ["paper_id", "version", "trimmed"], "left_anti")


@query
def page_spec(s: SparkSession, d: str) -> DataFrame:
    """Page ranges to pages."""
    p = _blocks(s, d).groupBy("paper_id").agg(F.max("page").alias("last"))
    spec = F.concat(F.lit("3-2, 1,"), F.col("last").cast("string"), F.lit("-99,x"))
    return p.select("paper_id", F.array_join(restructure.pages_of(spec, F.col("last")), ",").alias("pages"), corpus.pages_key(F.lit(False), F.col("last"), spec).alias("key"))


@query
def graded_families(s: SparkSession, d: str) -> DataFrame:
    """Percentages in texts that make a graded family."""
    g = _documents(s, d).select("doc_id", restructure.graded_family(F.col("text")).alias("steps")).where("steps is not null")
    return g.select("doc_id", F.size("steps").alias("n_steps"), F.array_max("steps").alias("highest"))


@query
def item_flatten(s: SparkSession, d: str) -> DataFrame:
    """Properties on their items with names built from positions."""
    i = _items(s, d)
    name = F.format_string("S%03d_%s", F.col("item_pos") + 1, F.coalesce(N.slug_upper(F.col("item.Sample_ID")), F.lit("NA")))
    e = i.select("record_no", "item_pos", name.alias("sample"), F.posexplode_outer("item.Properties_Info").alias("prop_pos", "p"))
    return e.select("record_no", "item_pos", "sample", "prop_pos", F.col("p.Property_Name").alias("property"), F.col("p.Value_Numeric").alias("value"))


@query
def lists_zip(s: SparkSession, d: str) -> DataFrame:
    """Two lists side by side."""
    t = table(s, d, "canon_terms").select("term_id", F.split("term", "_").alias("parts"), "also_known_as")
    return restructure.zipped(t, F.col("parts"), F.col("also_known_as"), ("part", "alias"), "term_id")


# Runs ------------------------------------------------------------------------------------------------------------------


def _runs(s: SparkSession, d: str) -> DataFrame:
    """Events as runs: the user is the paper, the value the confidence."""
    e = table(s, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    return merge.ranked(e, ["user_id"], "value", "event_id")


@query
def run_merge_topk(s: SparkSession, d: str) -> DataFrame:
    """The best run of each key and the keys that only worse runs have."""
    return merge.base_and_new(_runs(s, d), ["user_id", "event_type"], "run_rank").select("user_id", "event_type", "event_id", "run_rank")


@query
def first_nonempty_merge(s: SparkSession, d: str) -> DataFrame:
    """The longest and the first filled text of each key (A3, A5)."""
    r = table(s, d, "samples").select("paper_id", "Sample_ID", "row_id", F.col("Composition_Info.Note").alias("note"), F.col("Process_Info.Equipment").alias("equipment")).distinct()
    return r.groupBy("paper_id", "Sample_ID").agg(merge.longest("note", "row_id").alias("note"), merge.first_filled("equipment", "row_id").alias("equipment"))


@query
def map_merge_longest(s: SparkSession, d: str) -> DataFrame:
    """Maps united, the longest value of each key (A4)."""
    r = table(s, d, "samples").select("paper_id", "row_id", F.col("Composition_Info.Role").alias("role"), F.col("Composition_Info.Alloy_Name_Raw").alias("name")).distinct().where("role is not null and name is not null")
    return merge.merged_entries(r.withColumn("m", F.create_map(F.coalesce("role", F.lit("")), "name")), ["paper_id"], "m", "row_id").select("paper_id", "key", "value")


@query
def signature_append(s: SparkSession, d: str) -> DataFrame:
    """Rows of the first user's runs and new signatures of others."""
    r = table(s, d, "events").select("event_id", F.col("event_type"), (F.col("user_id") % 10).alias("bin"), F.dense_rank().over(Window.partitionBy(F.col("user_id") % 10).orderBy("user_id")).alias("run_rank"))
    return merge.appended(r, ["bin", "event_type"], "run_rank").select("event_id", "bin", "event_type", "run_rank")


# Matching and scores -----------------------------------------------------------------------------------------------------


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nominal compositions as the gold side, measured ones as the found side, by record."""
    i = _items(s, d)
    side = lambda k, name: i.select("record_no", F.col("item_pos").alias(name), F.explode(f"item.Composition_Info.{k}_Composition.Elements_Normalized").alias("element", "pct")).where("pct is not null")
    return side("Nominal", "gold_pos"), side("Measured", "found_pos")


@query
def pair_cost(s: SparkSession, d: str) -> DataFrame:
    """Costs of pairs of compositions (V4)."""
    c = matching.composition_costs(*_sides(s, d), "record_no", "gold_pos", "found_pos")
    return c.select("record_no", "gold_pos", "found_pos", F.round("cost", 3).alias("cost"))


@query
def mutual_best_match(s: SparkSession, d: str) -> DataFrame:
    """Pairs that are each other's best (V7, relaxed)."""
    c = matching.composition_costs(*_sides(s, d), "record_no", "gold_pos", "found_pos").withColumn("cost", F.round("cost", 6))
    return matching.mutual_best(c, "record_no", "gold_pos", "found_pos").select("record_no", "gold_pos", "found_pos")


@query
def optimal_match(s: SparkSession, d: str) -> DataFrame:
    """The assignment of least cost in each record; an item left alone costs by its elements and tests."""
    gold, found = _sides(s, d)
    c = matching.composition_costs(gold, found, "record_no", "gold_pos", "found_pos")
    tests = _items(s, d).select("record_no", F.col("item_pos").alias("pos"), F.coalesce(F.size(F.filter("item.Properties_Info", lambda t: t.isNotNull())), F.lit(0)).alias("n_tests"))
    for side, pos, name in ((gold, "gold_pos", "gold_alone"), (found, "found_pos", "found_alone")):
        n = side.groupBy("record_no", pos).agg(F.count("*").alias("n")).join(tests.withColumnRenamed("pos", pos), ["record_no", pos])
        alone = F.col("n") * matching.UNMATCHED_ELEMENT + F.greatest("n_tests", F.lit(0)) * matching.UNMATCHED_TEST + matching.UNMATCHED
        c = c.join(n.select("record_no", pos, alone.alias(name)), ["record_no", pos])
    return matching.optimal(c, "record_no", "gold_pos", "found_pos", matching.UNMATCHED, "gold_alone", "found_alone")


@query
def greedy_match(s: SparkSession, d: str) -> DataFrame:
    """Items paired in order by a weighted score of names and elements."""
    i = _items(s, d).select("record_no", "item_pos", F.col("item.Composition_Info.Alloy_Name_Raw").alias("name"), F.map_keys("item.Composition_Info.Nominal_Composition.Elements_Normalized").alias("els"))
    a, b = i.alias("a"), i.alias("b")
    j = a.join(b, (F.col("a.record_no") == F.col("b.record_no")) & (F.col("a.item_pos") != F.col("b.item_pos")))
    none = F.array().cast("array<string>")
    score = 3 * mapped(matching.similarity, "double", F.col("a.name"), F.col("b.name")) + 4 * matching.jaccard(F.coalesce("a.els", none), F.coalesce("b.els", none))
    scores = j.select(F.col("a.record_no"), F.col("a.item_pos").alias("gold_pos"), F.col("b.item_pos").alias("found_pos"), score.alias("score"))
    return matching.greedy(scores, "record_no", "gold_pos", "found_pos", 2.0)


@query
def detection_metrics(s: SparkSession, d: str) -> DataFrame:
    """Precipitates told by words against those recorded."""
    m = F.col("item.Microstructure_Info")
    i = _items(s, d).select(F.coalesce(F.size(m["Precipitates"]) > 0, F.lit(False)).alias("truth"), P.has_precipitates(m["Microstructure_Text"]["original"]).alias("found"))
    return scoring.detection(i, F.col("truth"), F.col("found"))


@query
def score_by_grain(s: SparkSession, d: str) -> DataFrame:
    """Errors of discounts at several grains in one pass."""
    li = table(s, d, "lineitem").select("l_returnflag", "l_linestatus", F.round((F.col("l_discount") - F.col("l_tax")) * 100).alias("e"))
    return scoring.value_errors(li, F.col("e"), 3.0, [[], ["l_returnflag"], ["l_linestatus"], ["l_returnflag", "l_linestatus"]])


@query
def issue_topk(s: SparkSession, d: str) -> DataFrame:
    """The most frequent issues of records, and the three first examples of each."""
    i = _items(s, d)
    c, m = F.col("item.Composition_Info"), F.col("item.Microstructure_Info")
    issues = F.array_compact(F.array(F.when(c["Role"].isNull(), F.lit("no role")), F.when(c["Alloy_Name_Raw"].isNull(), F.lit("no name")), F.when(c["Measured_Composition"].isNull(), F.lit("not measured")), F.when(m["Main_Phase"].isNull(), F.lit("no phase")), F.when(F.coalesce(F.size("item.Properties_Info"), F.lit(0)) <= 0, F.lit("no properties"))))
    long = i.select("record_no", "item_pos", F.explode(issues).alias("issue"))
    w = Window.partitionBy("issue").orderBy("record_no", "item_pos")
    counts = long.groupBy("issue").agg(F.count("*").alias("n"))
    return long.withColumn("example", F.row_number().over(w)).where("example <= 3").join(counts, "issue").select("issue", "n", "example", "record_no", "item_pos")


def _paper_metrics(s: SparkSession, d: str) -> DataFrame:
    i = _items(s, d)
    c, m = F.col("item.Composition_Info"), F.col("item.Microstructure_Info")
    nominal = c["Nominal_Composition"]["Elements_Normalized"]
    ok = F.coalesce(F.abs(N.total(nominal) - 100) <= 2, F.lit(False))
    phase = N.clean(m["Main_Phase"]).isNotNull()
    unknown = F.coalesce(N.clean(F.col("item.Process_Info.Process_Category")), F.lit("Unknown")) == "Unknown"
    g = i.groupBy("record_no").agg(F.count("*").alias("materials"), F.sum(F.greatest(F.coalesce(F.size("item.Properties_Info"), F.lit(0)), F.lit(0))).alias("properties"), F.max(F.coalesce(F.trim("doi") != "", F.lit(False))).alias("has_doi"), F.count_if(phase).alias("phases"), F.count_if(unknown).alias("unknowns"), F.count_if(ok).alias("valid"), F.count(m["Grain_Size_avg_um"]).alias("grains"))
    share = lambda c: F.col(c) / F.col("materials")
    return g.select("record_no", "materials", "properties", "has_doi", share("phases").alias("phase_rate"), share("unknowns").alias("unknown_rate"), share("valid").alias("composition_rate"), share("grains").alias("grain_rate"))


@query
def record_quality(s: SparkSession, d: str) -> DataFrame:
    """Rates, red lines, score and status of each record."""
    m = _paper_metrics(s, d)
    score = scoring.quality_score(F.col("materials"), F.col("properties"), F.col("has_doi"), F.col("phase_rate"), F.col("unknown_rate"), F.col("composition_rate"))
    red = (F.when(~F.col("has_doi"), 1).otherwise(0) + F.when(F.col("unknown_rate") > 0.5, 1).otherwise(0) + F.when(F.col("properties") == 0, 1).otherwise(0)).cast("int")
    return m.withColumn("score", score).select("record_no", "materials", "properties", "score", red.alias("red_lines"), scoring.status(F.col("score")).alias("status"))


@query
def fill_rates_macro_micro(s: SparkSession, d: str) -> DataFrame:
    """Mean of the records' rates beside the pooled rate."""
    m = _paper_metrics(s, d)
    pooled = lambda c: F.round(F.sum(F.col(c) * F.col("materials")) / F.sum("materials"), 4)
    return m.agg(F.count("*").alias("records"), F.round(F.avg("phase_rate"), 4).alias("phase_macro"), pooled("phase_rate").alias("phase_micro"), F.round(F.avg("grain_rate"), 4).alias("grain_macro"), pooled("grain_rate").alias("grain_micro"))


@query
def snapshot_delta(s: SparkSession, d: str) -> DataFrame:
    """Papers extracted again: what changed between the first and the last record."""
    m = _paper_metrics(s, d).join(table(s, d, "papers").select("record_no", "paper_id", "ingested_at").distinct(), "record_no")
    o = F.struct("ingested_at", "record_no")
    g = m.groupBy("paper_id").agg(F.count("*").alias("n"), *[f(c, o).alias(f"{k}_{c}") for k, f in (("old", F.min_by), ("new", F.max_by)) for c in ("materials", "properties", "has_doi")]).where("n > 1")
    doi = F.when(~F.col("old_has_doi") & F.col("new_has_doi"), "added").when(F.col("old_has_doi") & ~F.col("new_has_doi"), "lost").otherwise("unchanged")
    change = F.when(F.col("new_properties") > F.col("old_properties"), "improved").when(F.col("new_properties") < F.col("old_properties"), "degraded").otherwise("unchanged")
    return g.select("paper_id", (F.col("new_materials") - F.col("old_materials")).alias("materials_delta"), (F.col("new_properties") - F.col("old_properties")).alias("properties_delta"), doi.alias("doi_status"), change.alias("change"))


@query
def positional_agreement(s: SparkSession, d: str) -> DataFrame:
    """Items of a record against those of the mirror by position."""
    w = lambda c: Window.partitionBy("paper_id").orderBy("Sample_ID", c)
    a = table(s, d, "samples").select("paper_id", "Sample_ID", "row_id", F.col("Process_Info.Process_Category").alias("a")).distinct().withColumn("pos", F.row_number().over(w("row_id")))
    b = table(s, d, "samples_mirror").select("paper_id", "Sample_ID", "mirror_row", F.col("Process_Info.Process_Category").alias("b")).distinct().withColumn("pos", F.row_number().over(w("mirror_row")))
    j = a.join(b.select("paper_id", "pos", "b"), ["paper_id", "pos"])
    low = F.lower("a"), F.lower("b")
    score = F.when(F.col("a") == F.col("b"), 2).when(F.contains(low[0], low[1]) | F.contains(low[1], low[0]), 1).otherwise(0)
    return j.groupBy("paper_id").agg(F.count("*").alias("n"), F.sum(score).cast("bigint").alias("half_points"))


@query
def leakage_window(s: SparkSession, d: str) -> DataFrame:
    """Lines of a page within five lines of a caption (A10)."""
    pages = table(s, d, "paper_texts").select("text_no", "paper_text").dropDuplicates(["text_no"])
    lines = X.lines_of(pages, "paper_text", "text_no")
    near = F.max(F.when(F.col("line").rlike(r"^Fig"), 1).otherwise(0)).over(Window.partitionBy("text_no").orderBy("pos").rowsBetween(-5, 5))
    return lines.withColumn("near", near).groupBy("text_no").agg(F.sum("near").cast("bigint").alias("n_near"))


@query
def temperature_offsets(s: SparkSession, d: str) -> DataFrame:
    """Distances of recorded from named temperatures, by property."""
    t = _tests(s, d, "Test_Condition", "Test_Temperature_K", "Data_Source").withColumn("said", N.kelvin(F.col("Test_Condition"))).where("said is not null and Test_Temperature_K is not null")
    dist = matching.temperature_distance(F.col("Test_Temperature_K"), F.col("said"))
    return t.groupBy("Data_Source").agg(F.count("*").alias("n"), F.count_if(dist > 1).alias("n_off"), F.round(F.max(dist), 2).alias("max_offset"))


# Corpus ----------------------------------------------------------------------------------------------------------------


@query
def content_hash_dedup(s: SparkSession, d: str) -> DataFrame:
    """One document of each content."""
    t = _documents(s, d).withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    g = t.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    return g.select("doc_id", "copies", corpus.cache_key(F.col("digest"), F.lit("v1")).alias("cache_key"))


@query
def missing_anti(s: SparkSession, d: str) -> DataFrame:
    """Papers with blocks, and those without."""
    p = table(s, d, "papers").select("paper_id").distinct()
    b = table(s, d, "ocr_items").select("paper_id").distinct()
    return p.join(b, "paper_id", "left_semi").select("paper_id", F.lit("has blocks").alias("state")).unionByName(p.join(b, "paper_id", "left_anti").select("paper_id", F.lit("no blocks").alias("state")))


@query
def envelope_union(s: SparkSession, d: str) -> DataFrame:
    """Two kinds of records under one schema."""
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    u = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return c.unionByName(u)


@query
def hook_calls(s: SparkSession, d: str) -> DataFrame:
    """A model hook called once for each distinct name."""
    t = table(s, d, "properties").select("Property_Name", "Unit").distinct()
    asked = hooks.ask_once(t, ["Property_Name"], hooks.prompt_of("Name: {name}", name=F.col("Property_Name")), hooks.stub)
    return asked.select("Property_Name", "Unit", "answer", "error")


@query
def doc_quality_report(s: SparkSession, d: str) -> DataFrame:
    """Documents by source: clean lines, red lines, score and status."""
    docs = table(s, d, "documents").select("doc_id", "source").dropDuplicates(["doc_id"])
    kept = X.normalized_lines(_doc_lines(s, d), "doc_id")
    per = kept.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(X.is_noise(F.col("line"))).alias("noise"), F.sum(F.length("line")).alias("chars"))
    j = docs.join(per, "doc_id", "left").fillna(0, ["n", "noise", "chars"])
    score = F.floor(F.least(F.col("n") * 5, F.lit(40)) + F.least(F.floor(F.col("chars") / 20), F.lit(60)) - F.least(F.col("noise") * 10, F.lit(40)))
    j = j.withColumn("score", score)
    return j.groupBy("source").agg(F.count("*").alias("docs"), F.sum("score").cast("bigint").alias("score_sum"), F.count_if(F.col("score") >= 70).alias("passed"), F.count_if((F.col("score") < 70) & (F.col("score") >= 40)).alias("warned"), F.count_if(F.col("score") < 40).alias("failed"), F.count_if(F.col("n") == 0).alias("empty"))


# Blocks of records ------------------------------------------------------------------------------------------------------


@query
def distinct_precipitates(s: SparkSession, d: str) -> DataFrame:
    """Precipitates of items, each phase once."""
    i = _items(s, d)
    return R.distinct_precipitates(i, F.col("item.Microstructure_Info.Precipitates"), "record_no", "item_pos").select("record_no", "item_pos", "pos", "phase", "fraction")


@query
def microstructure_texts(s: SparkSession, d: str) -> DataFrame:
    """The text of each microstructure by what there is."""
    m = F.col("item.Microstructure_Info")
    text = R.microstructure_text(m["Microstructure_Text"]["original"], m["Microstructure_Text"]["simplified"], m["Main_Phase"])
    return _items(s, d).select("record_no", "item_pos", text.alias("text"))


@query
def property_entries(s: SparkSession, d: str) -> DataFrame:
    """Tests that make entries of a property list, with default notes."""
    t = R.property_entries(_tests(s, d, "Property_Name", "Value_Numeric", "Unit", "Data_Source"))
    return t.select("test_id", R.default_note(F.col("Unit"), F.col("Data_Source")).alias("note"))


@query
def recovered_formula(s: SparkSession, d: str) -> DataFrame:
    """The formula that a text is most likely about."""
    return R.recovered_formula(_doc_lines(s, d), "doc_id")


@query
def alias_keys(s: SparkSession, d: str) -> DataFrame:
    """Names of characterisation methods in texts."""
    names = {"EBSD": ["electron backscatter diffraction", "ebsd"], "TEM": ["transmission electron microscopy"], "XRD": ["x-ray diffraction", "synchrotron scattering"], "APT": ["atom probe"]}
    return _documents(s, d).where("text is not null").select("doc_id", F.array_join(R.alias_keys(F.col("text"), names), ",").alias("methods"))


@query
def numeric_features(s: SparkSession, d: str) -> DataFrame:
    """Feature maps with only what bears numbers."""
    f = F.col("item.Microstructure_Info.Advanced_Quantitative_Features")
    return _items(s, d).where(f.isNotNull()).select("record_no", "item_pos", mapped(R.numeric_features, "string", f).alias("features"))


@query
def energy_densities(s: SparkSession, d: str) -> DataFrame:
    """Energy densities named near the words."""
    return _documents(s, d).select("doc_id", mapped(R.energy_density, "string", "text").alias("energy_density")).where("energy_density is not null")


@query
def front_matter(s: SparkSession, d: str) -> DataFrame:
    """First-page repairs: hanging marks, marks of authors, gated Greek, subscripts of commands."""
    pages = table(s, d, "paper_texts").select("text_no", X.no_empty_abstract(F.col("paper_text")).alias("t")).dropDuplicates(["text_no"])
    lines = X.hanging_merged(X.lines_of(pages, "t", "text_no"), "text_no")
    fixed = X.command_subscripts(X.latex(X.greek_repaired(X.author_marks(F.col("line")))))
    return lines.groupBy("text_no").agg(F.count("*").alias("n_lines"), F.sum(F.length(fixed)).alias("n_chars"))
