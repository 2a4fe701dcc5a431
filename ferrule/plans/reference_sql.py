"""SQL of the same results, for DuckDB over the same tables. Written from the definitions, not from the Spark plans."""

from __future__ import annotations

from ferrule.functions.numbers import ELEMENTS
from ferrule.functions.process import CATEGORY_PATTERNS, CATEGORY_WORDS, PARAMETERS, PRECIPITATE_WORDS, TIERS, _word
from ferrule.functions.process import PHASES as _PHASES
from ferrule.functions.text import AFTER_REFERENCES, COMMON_TITLES, LATEX, NOISE_LINE, REFERENCES
from ferrule.operators.layout import NOISE_LABELS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(names) -> str:
    return "(" + ", ".join(map(_q, names)) + ")"


DOCS = "docs as (select distinct on (doc_id) doc_id, text from documents)"
DOC_LINES = f"{DOCS}, lines as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from docs where text is not null)"
BLOCKS = "blocks as (select distinct on (item_no) item_no, paper_id, page, pos, typer, block_label, text, bbox, confidence from ocr_items)"
BLOCK_LINES = f"{BLOCKS}, lines as (select item_no, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from blocks where text is not null)"
PAGES = "pages as (select distinct on (text_no) text_no, paper_id, paper_text from paper_texts)"
PAGE_LINES = f"{PAGES}, lines as (select text_no, unnest(string_split(paper_text, chr(10))) as line, generate_subscripts(string_split(paper_text, chr(10)), 1) - 1 as pos from pages where paper_text is not null)"
ITEMS = """once as (select distinct on (record_no) record_no, paper_id, ingested_at, "Paper_Metadata"."DOI" as doi, items from papers),
  entries as (select record_no, paper_id, doi, unnest(items) as item, generate_subscripts(items, 1) - 1 as item_pos from once where items is not null),
  item as (select record_no, paper_id, doi, cast(item_pos as int) as item_pos, item from entries where item is not null)"""
TESTS = "tests as (select distinct on (test_id) * from properties)"


def _sq(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _noise(c: str) -> str:
    return f"(regexp_matches(lower(trim({c})), {_q(NOISE_LINE)}) and not regexp_matches(lower(trim({c})), '10\\.[0-9]{{4,9}}/'))"


_NORMAL = f"""n as (select doc_id, pos, {_sq('line')} as line from lines), k as (select *, lag(line) over (partition by doc_id order by pos) as b from n where line <> ''), kept as (select doc_id, pos, line from k where b is null or b <> line)"""
_N = "[0-9]+(?:\\.[0-9]+)?"


def _kelvin(c: str) -> str:
    low = f"lower({c})"
    cases = [(f"at\\s+({_N})\\s*k([^a-z]|$)", 0), (f"at\\s+({_N})\\s*(?:°\\s*c|℃|c)([^a-z]|$)", 273.15), (f"({_N})\\s*k([^a-z/]|$)", 0), (f"({_N})\\s*(?:°\\s*c|℃|deg c|c)([^a-z/]|$)", 273.15)]
    out = f"case when regexp_matches({low}, '(^|[^a-z])(room temperature|ambient temperature|rt)([^a-z]|$)') then 298.15 "
    for p, x in cases:
        out += f"when regexp_matches({low}, {_q(p)}) then round(cast(regexp_extract({low}, {_q(p)}, 1) as double) + {x}, 2) "
    return out + "end"


def _matches(c: str, category: str) -> str:
    return f"coalesce(regexp_matches(lower({c}), {_q(CATEGORY_PATTERNS[category])}), false)"


def _category(c: str) -> str:
    out = "case "
    for name in CATEGORY_WORDS:
        cond = _matches(c, name)
        if name == "Powder_Metallurgy":
            cond += f" and not {_matches(c, 'AM')}"
        out += f"when {cond} then {_q(name)} "
    return out + "else 'Unknown' end"


def _fold(c: str) -> str:
    for k, v in LATEX.items():
        c = f"replace({c}, {_q(k)}, {_q(v)})"
    return f"regexp_replace({c}, '([0-9](?:\\.[0-9]+)?)[eE]\\+?(-?[0-9]+)', '\\1 \\\\times 10^{{\\2}}', 'g')"


def _slug(c: str) -> str:
    return f"trim(regexp_replace({c}, '[^A-Za-z0-9]+', '_', 'g'), '_')"


def _clean(c: str) -> str:
    return f"case when lower(trim({c})) not in ('', 'not provided', 'n/a', 'none', 'null', 'unknown') then trim({c}) end"


_LEVEL = f"""case when length(trim(line)) <= 120 and not regexp_matches(trim(line), '[.;,]$') and regexp_matches(trim(line), '^[0-9]{{1,2}}\\.[0-9]{{1,2}}\\.[0-9]{{1,2}}\\.?\\s+[A-Z]') then 4
  when length(trim(line)) <= 120 and not regexp_matches(trim(line), '[.;,]$') and regexp_matches(trim(line), '^[0-9]{{1,2}}\\.[0-9]{{1,2}}\\.?\\s+[A-Z]') then 3
  when length(trim(line)) <= 120 and not regexp_matches(trim(line), '[.;,]$') and regexp_matches(trim(line), '^[0-9]{{1,2}}\\.?\\s+[A-Z][A-Za-z]') then 2
  when lower(regexp_replace(trim(line), '^#+\\s*', '')) in {_in(COMMON_TITLES)} then 2 end"""
_METRICS = f"""{ITEMS},
  m as (select record_no, paper_id, count(*) as materials, sum(coalesce(len(item."Properties_Info"), 0)) as properties, bool_or(coalesce(trim(doi) <> '', false)) as has_doi,
          count_if(({_clean('item."Microstructure_Info"."Main_Phase"')}) is not null) as phases,
          count_if(coalesce({_clean('item."Process_Info"."Process_Category"')}, 'Unknown') = 'Unknown') as unknowns,
          count_if(coalesce(abs(list_sum(map_values(item."Composition_Info"."Nominal_Composition"."Elements_Normalized")) - 100) <= 2, false)) as valid,
          count(item."Microstructure_Info"."Grain_Size_avg_um") as grains
        from item group by record_no, paper_id)"""
_VALID = """{items}, raw as (select record_no, item_pos, unnest(map_entries(item."Composition_Info"."Measured_Composition"."Elements_Normalized")) as e from item),
  kept as (select record_no, item_pos, e.key as element, e.value as v from raw where e.value is not null and abs(e.value) > 1e-12 and (e.key in {els} or e.key = 'other')),
  s as (select *, sum(v) over (partition by record_no, item_pos) as s from kept),
  g as (select *, round(100 - s, 6) as gap from s)
select record_no, item_pos, element, round(case when abs(gap) <= 1e-6 then v when abs(gap) > 2 or gap < 0 then round(v * 100 / s, 6) when element = 'other' then round(gap + v, 6) else v end, 3) as pct from g
union all
select record_no, item_pos, 'other', round(round(any_value(gap), 6), 3) from g group by record_no, item_pos having count_if(element = 'other') = 0 and abs(any_value(gap)) > 1e-6 and any_value(gap) > 0 and any_value(gap) <= 2"""
_SIDES = f"""{ITEMS},
  gold as (select record_no, item_pos as gold_pos, e.key as element, e.value as a from (select record_no, item_pos, unnest(map_entries(item."Composition_Info"."Nominal_Composition"."Elements_Normalized")) as e from item) where e.value is not null),
  found as (select record_no, item_pos as found_pos, e.key as element, e.value as b from (select record_no, item_pos, unnest(map_entries(item."Composition_Info"."Measured_Composition"."Elements_Normalized")) as e from item) where e.value is not null),
  pairs as (select distinct g.record_no, gold_pos, found_pos from (select distinct record_no, gold_pos from gold) g join (select distinct record_no, found_pos from found) f using (record_no)),
  x as (select p.*, element, a from pairs p join gold using (record_no, gold_pos)), y as (select p.*, element, b from pairs p join found using (record_no, found_pos)),
  cost as (select record_no, gold_pos, found_pos, sum(case when a is null or b is null then 100.0 else abs(a - b) end) as cost from x full join y using (record_no, gold_pos, found_pos, element) group by all)"""

SQL: dict[str, str] = {
    "line_normalize": f"with {DOC_LINES}, {_NORMAL} select doc_id, count(*) as n_lines, cast(sum(length(line)) as bigint) as n_chars from kept group by doc_id",
    "noise_line_filter": f"with {BLOCK_LINES} select item_no, count(*) as n_noise from lines where {_noise('line')} group by item_no",
    "leading_strip": f"with {DOC_LINES}, s as (select *, min(case when length(trim(line)) >= 30 then pos end) over (partition by doc_id) as s from lines) select doc_id, min(pos) as first_pos, count(*) as n_lines from s where pos >= s group by doc_id",
    "section_state_trim": f"with {PAGE_LINES}, m as (select *, case when regexp_matches(lower(trim(line)), {_q(REFERENCES)}) then 'refs' when regexp_matches(lower(trim(line)), {_q(AFTER_REFERENCES)}) then 'body' end as mark from lines), s as (select *, last_value(mark ignore nulls) over (partition by text_no order by pos rows unbounded preceding) as s from m) select text_no, count(*) as n_lines from s where coalesce(s, 'body') <> 'refs' group by text_no",
    "legend_islands": f"""with {PAGE_LINES}, c as (select *, regexp_matches(trim(line), '^(?:Fig\\.|Figure)\\s*[0-9]+') as c, regexp_matches(trim(line), '^(?:\\([a-z]\\)|[A-Za-z0-9]{{1,3}}|[0-9.]+\\s*[A-Za-zμ%]{{0,3}})?$') as f from lines),
      i as (select *, count_if(not (f and not c)) over (partition by text_no order by pos desc rows unbounded preceding) as g from c), h as (select *, max(case when not (f and not c) then (case when c then 1 else 0 end) end) over (partition by text_no, g) as ends from i)
      select text_no, count(*) as n_lines from h where not (f and not c and g > 0 and ends = 1) group by text_no""",
    "headings": f"with {BLOCK_LINES}, l as (select *, {_LEVEL} as level from lines) select item_no, pos, level, repeat('#', level) || ' ' || regexp_replace(trim(line), '^#+\\s*', '') as markdown from l where level is not null",
    "captions": f"with {BLOCK_LINES} select item_no, pos, regexp_extract(line, '^\\s*(Fig\\.|Figure|FIG\\.)\\s*([0-9]+[a-z]?)[.:]?\\s*(.*)$', 2) as number, trim(regexp_extract(line, '^\\s*(Fig\\.|Figure|FIG\\.)\\s*([0-9]+[a-z]?)[.:]?\\s*(.*)$', 3)) as caption from lines where regexp_matches(line, '^\\s*(Fig\\.|Figure|FIG\\.)\\s*([0-9]+[a-z]?)[.:]?\\s*(.*)$')",
    "paragraph_blocks": f"with {DOCS}, p as (select doc_id, regexp_replace(unnest(string_split(text, chr(10) || chr(10))), '^\\s+|\\s+$', '', 'g') as t from docs where text is not null) select doc_id, count(*) as n_paragraphs, max(length(t)) as longest from p where t <> '' group by doc_id",
    "greek_latex_fold": f"with {DOCS} select doc_id, length({_fold('text')}) as n_chars from docs where text is not null",
    "title_guess": f"""with {DOC_LINES}, t as (select doc_id, pos, {_sq('line')} as t from lines),
      c as (select *, row_number() over (partition by doc_id order by pos) as r from t where length(t) between 15 and 250 and not {_noise('t')} and not regexp_matches(lower(t), '^(abstract|keywords|introduction|fig|table|doi|http|received|accepted|#)') and not regexp_matches(t, '[.;,]$') and regexp_matches(t, '[A-Za-z]{{3}}'))
      select doc_id, arg_max(t, length(t) * 1000000 - pos) as title from c where r <= 8 group by doc_id""",
    "append_missing_budget": f"""with {BLOCKS}, s as (select *, row_number() over (partition by paper_id, text order by page, pos, item_no) as r from blocks where typer = 'paragraph' and length(text) between 6 and 500),
      b as (select *, coalesce(sum(length(text) + 2) over (partition by paper_id order by page, pos, item_no rows between unbounded preceding and 1 preceding), 0) as t from s where r = 1) select paper_id, item_no from b where t < 4000""",
    "doi_metadata": """with p as (select distinct on (record_no) record_no, "Paper_Metadata"."DOI" as d, "Paper_Metadata"."Paper_Title" as t from papers),
      e as (select *, coalesce(nullif(rtrim(regexp_extract(d, '10\\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+'), '.'), ''), nullif(rtrim(regexp_extract(t, '10\\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+'), '.'), '')) as doi from p)
      select record_no, doi, length(case when doi is not null and not contains(t, doi) then 'DOI: ' || doi || chr(10) || chr(10) || t else t end) as n_chars from e""",
    "simplify_text": f"with {DOCS} select doc_id, substring({_sq('text')}, 1, 700) as simplified from docs where text is not null",
    "keyword_columns": f"""with {BLOCK_LINES}, t as (select item_no, trim(line) as t from lines where trim(line) <> ''),
      k as (select *, case when regexp_matches(lower(t), '^keywords?\\b') then 'kw' when regexp_matches(lower(t), '^abstract\\b') then 'abs' when regexp_matches(t, '[.;:!?]$') then 'abs' when regexp_matches(t, '^[a-z]') then 'abs' when len(regexp_split_to_array(t, '\\s+')) > 6 then 'abs' when regexp_matches(t, '[0-9]{{2,}}') then 'abs' when len(regexp_split_to_array(t, '\\s+')) <= 4 and not contains(t, ',') then 'kw' else 'abs' end as c from t)
      select item_no, count_if(c = 'kw') as n_kw, count_if(c = 'abs') as n_abs from k group by item_no""",
    "page_edges": f"with {PAGES}, l as (select text_no, string_split(paper_text, chr(10)) as l from pages where paper_text is not null) select text_no, array_to_string(l[1:5], '|') as header, array_to_string(case when len(l) >= 3 then l[-3:] else l end, '|') as footer, len(l) as line_count from l",
    "bbox_anti_join": f"""with {BLOCKS}, t as (select paper_id, page, bbox as b from blocks where typer = 'table' and bbox is not null)
      select item_no, paper_id, page from blocks i where not exists (select 1 from t where t.paper_id = i.paper_id and t.page = i.page and i.typer = 'paragraph' and coalesce(i.block_label, '') <> 'figure_title' and i.bbox is not null and (
        (i.bbox[1] >= b[1] - 4 and i.bbox[2] >= b[2] - 4 and i.bbox[3] <= b[3] + 4 and i.bbox[4] <= b[4] + 4)
        or (greatest(0, i.bbox[3] - i.bbox[1]) * greatest(0, i.bbox[4] - i.bbox[2]) > 0 and greatest(0, least(i.bbox[3], b[3]) - greatest(i.bbox[1], b[1])) * greatest(0, least(i.bbox[4], b[4]) - greatest(i.bbox[2], b[2])) >= 0.6 * greatest(0, i.bbox[3] - i.bbox[1]) * greatest(0, i.bbox[4] - i.bbox[2]))))""",
    "iou_best_match": f"""with {BLOCKS}, i as (select item_no, paper_id, page, typer, bbox as a from blocks where bbox is not null), r as (select item_no as region_no, paper_id, page, typer, [a[1] + 3, a[2] + 2, a[3] + 3, a[4] + 2] as b from i),
      x as (select i.item_no, region_no, greatest(0, a[3] - a[1]) * greatest(0, a[4] - a[2]) as sa, greatest(0, b[3] - b[1]) * greatest(0, b[4] - b[2]) as sb, greatest(0, least(a[3], b[3]) - greatest(a[1], b[1])) * greatest(0, least(a[4], b[4]) - greatest(a[2], b[2])) as s from i join r using (paper_id, page, typer)),
      y as (select *, s / (sa + sb - s) as iou from x where sa >= 4000 and s > 0), z as (select *, row_number() over (partition by item_no order by iou desc, region_no) as k from y where iou > 0.1)
      select item_no, region_no, cast(floor(iou * 1000 + 0.01) as bigint) as iou_1000 from z where k = 1""",
    "confidence_policy": f"with {BLOCKS} select paper_id, ((sum(cast(round(confidence * 1000000) as bigint)) * 20000 + count(confidence) * 1000000) // (count(confidence) * 2000000)) / 10000.0 as avg_confidence, count(distinct case when confidence < 0.8 then page end) as low_pages, count_if(typer = 'table') as tables, count_if(typer = 'paragraph') as paragraphs, count_if(block_label in {_in(NOISE_LABELS)}) as noise_blocks, count_if(not (typer = 'paragraph' and coalesce(confidence < 0.8, false))) as kept from blocks group by paper_id",
    "numbered_tables": f"with {BLOCKS} select item_no, paper_id, page, row_number() over (partition by paper_id, page order by pos, item_no) as n from blocks where typer = 'table'",
    "typed_blocks": f"with {BLOCKS}, k as (select paper_id, case when block_label = 'table' then 't' when block_label in ('doc_title', 'paragraph_title') then 'h' when block_label = 'figure_title' then 'c' when block_label in {_in(NOISE_LABELS)} then 'f' else 'p' end as k from blocks) select paper_id, count_if(k = 't') as n_table, count_if(k = 'h') as n_heading, count_if(k = 'c') as n_caption, count_if(k = 'f') as n_furniture, count_if(k = 'p') as n_paragraph from k group by paper_id",
    "html_tables": """select unit_code, 0 as "row", c as col, ['code', 'symbol'][c + 1] as name, case c when 0 then unit_code else regexp_replace(trim(symbol), '\\s+', ' ', 'g') end as value, true as merged from unit_codes, (values (0), (1)) v(c)""",
    "temperature_to_k": f"with {TESTS} select test_id, {_kelvin(chr(34) + 'Test_Condition' + chr(34))} as kelvin from tests",
    "formula_tokens": f"""with t as (select term_id, term from canon_terms where field_name = 'Alloy_Name_Raw' and regexp_matches(term, '^(?:[A-Z][a-z]?(?:[0-9]+(?:\\.[0-9]+)?)?)+$')), p as (select term_id, unnest(regexp_extract_all(term, '[A-Z][a-z]?(?:[0-9]+(?:\\.[0-9]+)?)?')) as p from t),
      e as (select term_id, regexp_extract(p, '^[A-Z][a-z]?') as element, coalesce(try_cast(nullif(regexp_extract(p, '[0-9.]+$'), '') as double), 1.0) as n from p) select term_id, element, sum(n) as amount from e where element in {_in(ELEMENTS)} group by term_id, element""",
    "composition_normalize": "with " + _VALID.format(items=ITEMS, els=_in(ELEMENTS)),
    "balance_argmax": f"""with {ITEMS}, n as (select record_no, item_pos, e.key as k, e.value as v from (select record_no, item_pos, unnest(map_entries(item."Composition_Info"."Nominal_Composition"."Elements_Normalized")) as e from item) where e.value is not null and e.key <> 'other'),
      b as (select record_no, item_pos, k, row_number() over (partition by record_no, item_pos order by v desc, k) as r from n), w as (select record_no, item_pos, item."Composition_Info"."Alloy_Name_Raw" as name from item)
      select w.record_no, w.item_pos, coalesce(k, case when regexp_matches(lower(name), 'inconel|nimonic|hastelloy|nickel') then 'Ni' when regexp_matches(lower(name), 'steel|316|304|maraging') then 'Fe' when regexp_matches(lower(name), 'titanium|^ti-?6') then 'Ti' when regexp_matches(lower(name), 'aluminium|aluminum|alsi') then 'Al' when regexp_matches(lower(name), 'cobalt|stellite') then 'Co' when regexp_extract(name, '^([A-Z][a-z]?)', 1) in {_in(ELEMENTS)} then regexp_extract(name, '^([A-Z][a-z]?)', 1) end) as element
      from w left join b on b.record_no = w.record_no and b.item_pos = w.item_pos and r = 1""",
    "blend_maps": f"""with {ITEMS}, b as (select record_no, item_pos, item."Composition_Info"."Nominal_Composition"."Elements_Normalized" as x, item."Composition_Info"."Measured_Composition"."Elements_Normalized" as y from item), c as (select * from b where x is not null and y is not null),
      k as (select record_no, item_pos, x, y, unnest(list_distinct(list_concat(map_keys(x), map_keys(y)))) as element from c) select record_no, item_pos, element, round(round(0.5 * coalesce(x[element], 0) + 0.5 * coalesce(y[element], 0), 6), 3) as pct from k""",
    "value_equivalence": f"""with {TESTS}, s as (select test_id, "Test_Temperature_K" as t, {_kelvin(chr(34) + 'Test_Condition' + chr(34))} as said from tests) select test_id, case when t is null then false else abs(t - said) <= 0.05 * greatest(abs(t), abs(said), 1e-12) or abs(t + 273.15 - said) <= 1.5 or abs(said + 273.15 - t) <= 1.5 end as agrees from s where said is not null""",
    "process_category": f"""with r as (select distinct row_id, "Process_Info"."Process_Category" as route from samples), i as (select row_id, route, {_category('route')} as base from r where route is not null),
      j as (select row_id, trim(route) as route, case when base = 'AM_LPBF' then base || case when regexp_matches(lower(route), 'blend|premix|double hopper|mixing chamber') then ' + Powder_Blending' else '' end || case when regexp_matches(lower(route), 'graded|gradient|stepwise') then ' + Graded_Composition' else '' end else base end as inferred from i)
      select row_id, inferred, case when route in {_in(CATEGORY_WORDS)} then route when inferred <> 'Unknown' then inferred else coalesce(nullif(route, ''), 'Unknown') end as resolved from j""",
    "main_phase": f"""with {DOCS} select doc_id, nullif(array_to_string(list_distinct_ordered[1:3], ' + '), '') as main_phase, coalesce({' or '.join(f"contains(lower(text), {_q(w)})" for w in PRECIPITATE_WORDS)}, false) as has_precipitates
      from (select doc_id, text, list_filter([{', '.join((f"case when regexp_matches(lower(text), {_q(_word([w]))}) then {_q(p)} end") for w, p in _PHASES.items() if w != 'glassy')}], lambda x: x is not null) as list_distinct_ordered from (select doc_id, replace(text, 'lassy', 'lassy') as text from docs where text is not null))""",
    "property_rank": f"""with {TESTS}, n as (select test_id, trim(regexp_replace(trim("Property_Name"), '[^A-Za-z0-9]+', '_', 'g'), '_') as name, "Data_Source" as ds from tests where "Property_Name" is not null), l as (select *, lower(name) as low from n)
      select test_id, name, case when starts_with(low, {_q(TIERS[0][0])}) then 1 {' '.join(f"when contains(low, {_q(t)}) then {k}" for t, k in TIERS[1:])} else 99 end as tier,
        case when contains(low, 'hardness') then 'HV' when regexp_matches(low, 'strength|stress') then 'MPa' when contains(low, 'modulus') then 'GPa' when regexp_matches(low, 'elongation|strain|density_rel|relative_density') then '%' when contains(low, 'density') then 'g/cm3' when contains(low, 'grain_size') then 'um' end as unit,
        case when regexp_matches(lower(trim(ds)), 'fig|image|plot|curve|graph') then 'image' else 'text' end as source from l""",
    "key_alias_units": f"""with {TESTS} select test_id, 'Scanning_Speed_mm_s' as key, round("Tensile_Speed_mm_min" / 60, 6) as value from tests where "Tensile_Speed_mm_min" is not null and not isnan("Tensile_Speed_mm_min")""",
    "sanitized_numbers": f"""with {ITEMS}, m as (select record_no, item_pos, item."Microstructure_Info" as m, concat_ws(' ', item."Microstructure_Info"."Microstructure_Text"."original", item."Microstructure_Info"."Microstructure_Text"."simplified") as t from item),
      p as (select record_no, item_pos, t, m."Relative_Density_pct" as r, m."Porosity_pct" as p, m."Main_Phase" as f from m)
      select record_no, item_pos, case when r = 100 and not regexp_matches(t, '(^|[^0-9.])100(\\.0+)?\\s*%') then null when r = 0 and not regexp_matches(t, '(^|[^0-9.])0(\\.0+)?\\s*%') then null else r end as relative_density,
        case when p = 100 and not regexp_matches(t, '(^|[^0-9.])100(\\.0+)?\\s*%') then null when p = 0 and not regexp_matches(t, '(^|[^0-9.])0(\\.0+)?\\s*%') then null else p end as porosity, {_clean('f')} as main_phase from p""",
    "step_explode": f"""with {ITEMS}, b as (select record_no, item_pos, item."Composition_Info"."Nominal_Composition"."Elements_Normalized" as x, item."Composition_Info"."Measured_Composition"."Elements_Normalized" as y from item), k as (select *, unnest(list_distinct(list_concat(coalesce(map_keys(x), []), coalesce(map_keys(y), [])))) as step from b) select record_no, item_pos, step, x[step] as nominal, y[step] as measured from k""",
    "variant_expand": "with p as (select distinct paper_id from papers), v as (select * from (values ('1.0', false), ('1.0', true), ('1.5', false), ('1.5', true)) v(version, trimmed)) select paper_id, version, trimmed from p, v where not (version = '1.0' and not trimmed and paper_id in (select paper_id from paper_texts where paper_id is not null))",
    "page_spec": f"""with {BLOCKS}, p as (select paper_id, max(page) as last from blocks group by paper_id) select paper_id, array_to_string(list_filter(range(1, 1000), lambda n: n <= last and (n between 2 and 3 or n = 1 or n between last and 99)), ',') as pages, substring(md5('3-2, 1,' || last || '-99,x'), 1, 16) as key from p""",
    "graded_families": f"""with {DOCS}, s as (select doc_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:wt|at)?\\.?\\s*%', 1), lambda x: cast(x as double)), lambda x: x between 0 and 60))) as steps from docs where text is not null)
      select doc_id, len(steps) as n_steps, list_max(steps) as highest from s where len(list_filter(steps, lambda x: x > 0)) >= 2""",
    "item_flatten": f"""with {ITEMS}, n as (select record_no, item_pos, 'S' || lpad(cast(item_pos + 1 as varchar), 3, '0') || '_' || coalesce(upper({_slug('item."Sample_ID"')}), 'NA') as sample, item."Properties_Info" as p from item),
      e as (select record_no, item_pos, sample, unnest(p) as p, generate_subscripts(p, 1) - 1 as prop_pos from n where len(p) > 0) select record_no, item_pos, sample, prop_pos, p."Property_Name" as property, p."Value_Numeric" as value from e union all select record_no, item_pos, sample, null, null, null from n where coalesce(len(p), 0) = 0""",
    "lists_zip": """with t as (select term_id, string_split(term, '_') as a, coalesce(also_known_as, []) as b from canon_terms), k as (select term_id, a, b, unnest(range(greatest(len(a), len(b)))) as pos from t) select term_id, pos, a[pos + 1] as part, b[pos + 1] as alias from k""",
    "run_merge_topk": "with r as (select event_id, user_id, event_type, row_number() over (partition by user_id order by value desc nulls last, event_id) as run_rank from events), b as (select *, min(run_rank) over (partition by user_id, event_type) as b from r) select user_id, event_type, event_id, run_rank from b where run_rank = b",
    "first_nonempty_merge": """with r as (select distinct paper_id, "Sample_ID", row_id, "Composition_Info"."Note" as note, "Process_Info"."Equipment" as equipment from samples),
      n as (select *, row_number() over (partition by paper_id, "Sample_ID" order by (note is null), length(note) desc, row_id) as a, row_number() over (partition by paper_id, "Sample_ID" order by (coalesce(trim(equipment), '') = ''), row_id) as b from r)
      select paper_id, "Sample_ID", max(case when a = 1 then note end) as note, max(case when b = 1 and trim(equipment) <> '' then equipment end) as equipment from n group by paper_id, "Sample_ID" """,
    "map_merge_longest": """with r as (select distinct paper_id, row_id, "Composition_Info"."Role" as key, "Composition_Info"."Alloy_Name_Raw" as value from samples), k as (select *, row_number() over (partition by paper_id, key order by length(value) desc, row_id) as n from r where key is not null and value is not null) select paper_id, key, value from k where n = 1""",
    "signature_append": """with r as (select event_id, event_type, user_id % 10 as bin, dense_rank() over (partition by user_id % 10 order by user_id) as run_rank from events), own as (select * from r where run_rank = 1),
      new as (select r.*, row_number() over (partition by bin, event_type order by run_rank, event_id) as n from r where run_rank > 1 and not exists (select 1 from own where own.bin = r.bin and own.event_type = r.event_type)) select event_id, bin, event_type, run_rank from own union all select event_id, bin, event_type, run_rank from new where n = 1""",
    "pair_cost": f"with {_SIDES} select record_no, gold_pos, found_pos, round(cost, 3) as cost from cost",
    "mutual_best_match": f"""with {_SIDES}, c as (select record_no, gold_pos, found_pos, round(cost, 6) as cost from cost), r as (select *, row_number() over (partition by record_no, gold_pos order by cost, found_pos) as a, row_number() over (partition by record_no, found_pos order by cost, gold_pos) as b from c) select record_no, gold_pos, found_pos from r where a = 1 and b = 1""",
    "detection_metrics": f"""with {ITEMS}, d as (select coalesce(len(item."Microstructure_Info"."Precipitates") > 0, false) as t, coalesce({' or '.join(f'contains(lower(item."Microstructure_Info"."Microstructure_Text"."original"), {_q(w)})' for w in PRECIPITATE_WORDS)}, false) as f from item),
      n as (select count_if(t and f) as tp, count_if(not t and f) as fp, count_if(t and not f) as fn from d) select tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1 from n""",
    "score_by_grain": "with e as (select l_returnflag, l_linestatus, abs(round((l_discount - l_tax) * 100)) as e from lineitem) select l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus) as grain, count(e) as n, round(avg(e), 4) as mae, round(max(e), 4) as max_error, count_if(e = 0) as n_exact, count_if(e <= 3) as n_within from e group by grouping sets ((), (l_returnflag), (l_linestatus), (l_returnflag, l_linestatus))",
    "issue_topk": f"""with {ITEMS}, l as (select record_no, item_pos, unnest([case when item."Composition_Info"."Role" is null then 'no role' end, case when item."Composition_Info"."Alloy_Name_Raw" is null then 'no name' end, case when item."Composition_Info"."Measured_Composition" is null then 'not measured' end, case when item."Microstructure_Info"."Main_Phase" is null then 'no phase' end, case when coalesce(len(item."Properties_Info"), 0) = 0 then 'no properties' end]) as issue from item),
      r as (select *, row_number() over (partition by issue order by record_no, item_pos) as example, count(*) over (partition by issue) as n from l where issue is not null) select issue, n, example, record_no, item_pos from r where example <= 3""",
    "record_quality": f"""with {_METRICS}, s as (select *, cast(floor(least(5 * materials, 10) + least(2 * properties, 20) + case when has_doi then 10 else 0 end + 20.0 * phases / materials + 20.0 * (1 - unknowns / materials) + 20.0 * valid / materials + 1e-9) as int) as score from m)
      select record_no, materials, cast(properties as bigint) as properties, score, (case when not has_doi then 1 else 0 end + case when unknowns > 0.5 * materials then 1 else 0 end + case when properties = 0 then 1 else 0 end) as red_lines, case when score >= 70 then 'pass' when score >= 40 then 'warning' else 'fail' end as status from s""",
    "fill_rates_macro_micro": f"with {_METRICS} select count(*) as records, round(avg(phases / materials), 4) as phase_macro, round(sum(phases) / sum(materials), 4) as phase_micro, round(avg(grains / materials), 4) as grain_macro, round(sum(grains) / sum(materials), 4) as grain_micro from m",
    "snapshot_delta": f"""with {_METRICS}, j as (select m.*, o.ingested_at, row_number() over (partition by m.paper_id order by o.ingested_at, m.record_no) as a, row_number() over (partition by m.paper_id order by o.ingested_at desc, m.record_no desc) as z, count(*) over (partition by m.paper_id) as n from m join once o using (record_no)),
      p as (select o.paper_id, o.materials as om, n.materials as nm, o.properties as op, n.properties as np, o.has_doi as od, n.has_doi as nd from j o join j n using (paper_id) where o.a = 1 and n.z = 1 and o.n > 1)
      select paper_id, nm - om as materials_delta, cast(np - op as bigint) as properties_delta, case when not od and nd then 'added' when od and not nd then 'lost' else 'unchanged' end as doi_status, case when np > op then 'improved' when np < op then 'degraded' else 'unchanged' end as change from p""",
    "positional_agreement": """with a as (select paper_id, row_number() over (partition by paper_id order by "Sample_ID", row_id) as pos, v as a from (select distinct paper_id, "Sample_ID", row_id, "Process_Info"."Process_Category" as v from samples)),
      b as (select paper_id, row_number() over (partition by paper_id order by "Sample_ID", mirror_row) as pos, v as b from (select distinct paper_id, "Sample_ID", mirror_row, "Process_Info"."Process_Category" as v from samples_mirror))
      select paper_id, count(*) as n, cast(sum(case when a = b then 2 when contains(lower(a), lower(b)) or contains(lower(b), lower(a)) then 1 else 0 end) as bigint) as half_points from a join b using (paper_id, pos) group by paper_id""",
    "leakage_window": f"with {PAGE_LINES}, n as (select text_no, max(case when regexp_matches(line, '^Fig') then 1 else 0 end) over (partition by text_no order by pos rows between 5 preceding and 5 following) as near from lines) select text_no, cast(sum(near) as bigint) as n_near from n group by text_no",
    "temperature_offsets": f"""with {TESTS}, s as (select "Data_Source", "Test_Temperature_K" as t, {_kelvin(chr(34) + 'Test_Condition' + chr(34))} as said from tests), d as (select "Data_Source", least(abs(t - said), abs(t + 273.15 - said), abs(t - said - 273.15)) as d from s where said is not null and t is not null) select "Data_Source", count(*) as n, count_if(d > 1) as n_off, round(max(d), 2) as max_offset from d group by all""",
    "content_hash_dedup": f"with {DOCS}, h as (select doc_id, md5(coalesce(text, '')) as h from docs) select min(doc_id) as doc_id, count(*) as copies, substring(sha256(h || '|v1'), 1, 24) as cache_key from h group by h",
    "missing_anti": "with p as (select distinct paper_id from papers) select paper_id, case when paper_id in (select paper_id from ocr_items where paper_id is not null) then 'has blocks' else 'no blocks' end as state from p",
    "envelope_union": "select c_custkey as id, c_name as name, 'customer' as kind from customer union all select s_suppkey, s_name, 'supplier' from supplier",
    "hook_calls": """with t as (select distinct "Property_Name", "Unit" from properties), p as (select *, 'Name: ' || coalesce("Property_Name", '') as p from t) select "Property_Name", "Unit", '{"length": ' || length(p) || ', "words": ' || len(list_filter(regexp_split_to_array(p, '\\s+'), lambda x: x <> '')) || '}' as answer, cast(null as varchar) as error from p""",
    "doc_quality_report": f"""with {DOC_LINES}, {_NORMAL}, k2 as (select doc_id, count(*) as n, count_if({_noise('line')}) as noise, sum(length(line)) as chars from kept group by doc_id), src as (select distinct on (doc_id) doc_id, source from documents),
      s as (select source, coalesce(n, 0) as n, least(coalesce(n, 0) * 5, 40) + least(floor(coalesce(chars, 0) / 20), 60) - least(coalesce(noise, 0) * 10, 40) as score from src left join k2 using (doc_id))
      select source, count(*) as docs, cast(sum(score) as bigint) as score_sum, count_if(score >= 70) as passed, count_if(score < 70 and score >= 40) as warned, count_if(score < 40) as failed, count_if(n = 0) as "empty" from s group by source""",
}

SQL |= {
    "distinct_precipitates": f"""with {ITEMS}, e as (select record_no, item_pos, unnest(item."Microstructure_Info"."Precipitates") as p, generate_subscripts(item."Microstructure_Info"."Precipitates", 1) - 1 as pos from item), t as (select record_no, item_pos, pos, trim(p."Phase_Type") as phase, p."Volume_Fraction_pct" as fraction from e where p is not null),
      r as (select *, row_number() over (partition by record_no, item_pos, lower(phase) order by pos) as r from t where phase is not null and phase <> '') select record_no, item_pos, pos, phase, fraction from r where r = 1""",
    "microstructure_texts": f"""with {ITEMS} select record_no, item_pos, coalesce(nullif(trim(item."Microstructure_Info"."Microstructure_Text"."original"), ''), nullif(trim(item."Microstructure_Info"."Microstructure_Text"."simplified"), ''), 'Main phase: ' || nullif(trim(item."Microstructure_Info"."Main_Phase"), '')) as text from item""",
    "property_entries": f"""with {TESTS} select test_id, case when "Data_Source" = 'image' then 'digitised from a figure' when "Unit" is null or trim("Unit") = '' then 'unit not given' end as note from tests where "Value_Numeric" is not null and not isnan("Value_Numeric") and "Property_Name" is not null and not regexp_matches(lower("Property_Name"), '(^|_| )(density|porosity|crack)')""",
    "recovered_formula": f"""with {DOC_LINES}, w as (select doc_id, pos, regexp_split_to_array(line, '[\\s,;:()]+') as w from lines), t as (select doc_id, pos, regexp_replace(unnest(w), '\\.$', '') as t, generate_subscripts(w, 1) as i from w),
      f as (select *, regexp_extract_all(t, '[A-Z][a-z]?') as e from t where regexp_matches(t, '^(?:[A-Z][a-z]?(?:[0-9]+(?:\\.[0-9]+)?)?)+$')), r as (select doc_id, t, row_number() over (partition by doc_id order by len(e) desc, pos, i) as r from f where len(e) >= 2 and len(list_filter(e, lambda x: x not in {_in(ELEMENTS)})) = 0) select doc_id, t as formula from r where r = 1""",
    "alias_keys": f"""with {DOCS} select doc_id, array_to_string(list_filter([case when contains(lower(text), 'atom probe') then 'APT' end, case when contains(lower(text), 'electron backscatter diffraction') or contains(lower(text), 'ebsd') then 'EBSD' end, case when contains(lower(text), 'transmission electron microscopy') then 'TEM' end, case when contains(lower(text), 'x-ray diffraction') or contains(lower(text), 'synchrotron scattering') then 'XRD' end], lambda x: x is not null), ',') as methods from docs where text is not null""",
}


def _parameter(name: str) -> str:
    return "coalesce(" + ", ".join(f"try_cast(nullif(regexp_extract(lower(text), {_q(p)}, 1), '') as double)" for p in PARAMETERS[name]) + ")"


SQL |= {
    "slug_key": """with p as (select distinct paper_id, "Paper_Metadata"."Paper_Title" as title from papers), t as (select *, trim(regexp_replace(regexp_replace(title, '[<>:"/\\\\|?*]', '', 'g'), '[_\\s]+', '_', 'g'), '_') as t from p), c as (select *, substring(t, 1, 40) as cut, 41 - strpos(reverse(substring(t, 1, 40)), '_') as last from t)
      select paper_id, title, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') as key, upper(trim(regexp_replace(title, '[^A-Za-z0-9]+', '_', 'g'), '_')) as slug, case when length(t) <= 40 then t when last <= 40 and last > 20 then substring(cut, 1, last - 1) else cut end as file_name,
        trim(regexp_replace(regexp_replace(lower(paper_id), '_fixed$', ''), '[^a-z0-9]+', '-', 'g'), '-') as article from c""",
    "key_params_text": f"with {DOCS}, v as (select doc_id, {_parameter('Laser_Power_W')} as laser_power_w, {_parameter('Layer_Thickness_um')} as layer_thickness_um, {_parameter('Oxygen_Content_ppm')} as oxygen_content_ppm from docs where text is not null) select * from v where laser_power_w is not null or layer_thickness_um is not null or oxygen_content_ppm is not null",
}
