"""SQL of the score queries, with fixed values of its own: a wrong one in the engine shows as a difference."""

from __future__ import annotations

from ferrule.plans.reference_sql import DOCS, ITEMS

_TYPE = """case regexp_replace(lower(trim({c})), '[^a-z0-9]+', '', 'g')
    when 'yieldstrengthys' then 'yield_strength' when 'yieldstrength' then 'yield_strength'
    when 'ultimatetensilestrengthuts' then 'ultimate_tensile_strength' when 'ultimatetensilestrength' then 'ultimate_tensile_strength'
    when 'uniformelongationufe' then 'uniform_elongation' when 'uniformelongation' then 'uniform_elongation'
    when 'totalelongationte' then 'total_elongation' when 'totalelongation' then 'total_elongation'
    when 'youngsmodulus' then 'youngs_modulus' when 'fracturestrain' then 'fracture_strain'
    when 'latticeparameter' then 'lattice_parameter' when 'locallatticestrain' then 'local_lattice_strain'
    when 'yieldstrengthcompressive' then 'yield_strength_compressive' when 'ultimatestrengthcompressive' then 'ultimate_strength_compressive'
    when 'elongationcompressive' then 'elongation_compressive' when 'hardnesshv' then 'microhardness'
    when 'microhardness' then 'microhardness' when 'hardness' then 'microhardness'
    else coalesce(nullif(regexp_replace(lower(trim({c})), '[^a-z0-9]+', '', 'g'), ''), 'unknown') end"""

_SLUG = "lower(regexp_replace(trim(coalesce({c}, '')), '\\s+', ' ', 'g'))"
_ONE = """case {c} when 'laser powder bed fusion (lpbf)' then 'laser powder bed fusion' when 'laser powder bed fusion (pbf-lb)' then 'laser powder bed fusion'
    when 'selective laser melting (slm)' then 'laser powder bed fusion' when 'selective laser melting' then 'laser powder bed fusion' when 'lpbf' then 'laser powder bed fusion'
    when 'electron beam powder bed fusion (pbf-eb)' then 'electron beam powder bed fusion' when 'electron beam melting (ebm)' then 'electron beam melting'
    when 'additive manufacturing - electron beam melting' then 'electron beam melting' when 'laser-aided additive manufacturing (laam)' then 'directed energy deposition'
    when 'directed energy deposition (ded)' then 'directed energy deposition' when 'laam' then 'directed energy deposition' when 'ded' then 'directed energy deposition' else {c} end"""


def _key(c: str) -> str:
    out = _ONE.format(c=_SLUG.format(c=c))
    for t in ("heat treatment", "annealing", "thermal stabilization", "aging", "solution treatment"):
        out = f"regexp_replace({out}, ' \\+ {t}$', '')"
    return f"trim({out})"


_TREATED = {
    "Solution_Temperature_K": r"(?i)solution(?:\s+treatment)?[^.;\n]{0,80}?(\d+(?:\.\d+)?)\s*(?:-|to|~)\s*(\d+(?:\.\d+)?)\s*(k|°?\s*c)\b",
    "Solution_Time_h": r"(?i)solution(?:\s+treatment)?[^.;\n]{0,80}?(\d+(?:\.\d+)?)\s*(?:-|to|~)\s*(\d+(?:\.\d+)?)\s*(h)\b",
    "Aging_Temperature_K": r"(?i)ag(?:ing|ed)?[^.;\n]{0,80}?(\d+(?:\.\d+)?)\s*(?:-|to|~)\s*(\d+(?:\.\d+)?)\s*(k|°?\s*c)\b",
    "Aging_Time_h": r"(?i)ag(?:ing|ed)?[^.;\n]{0,80}?(\d+(?:\.\d+)?)\s*(?:-|to|~)\s*(\d+(?:\.\d+)?)\s*(h)\b",
    "Annealing_Temperature_K": r"(?i)anneal(?:ed|ing)?[^.;\n]{0,80}?(\d+(?:\.\d+)?)\s*(?:-|to|~)\s*(\d+(?:\.\d+)?)\s*(k|°?\s*c)\b",
    "Annealing_Time_h": r"(?i)anneal(?:ed|ing)?[^.;\n]{0,80}?(\d+(?:\.\d+)?)\s*(?:-|to|~)\s*(\d+(?:\.\d+)?)\s*(h)\b",
}
_RANGES = " union all ".join(f"select test_id, '{k}' as key, try_cast(regexp_extract(text, '{p}', 1) as double) as a, try_cast(regexp_extract(text, '{p}', 2) as double) as b, case when contains(lower(regexp_extract(text, '{p}', 3)), 'c') then 273.15 else 0.0 end as shift from t" for k, p in _TREATED.items())
_SIDE = """(select paper_id, count(distinct "Composition_Info"."Alloy_Name_Raw") as alloys, count(distinct "Sample_ID") as samples from {t} where paper_id is not null group by paper_id)"""
_SYMBOLS = "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi"

SQL = {
    "property_type": f"""select "Property_Name", {_TYPE.format(c='"Property_Name"')} as property_type, count(*) as n from (select distinct test_id, "Property_Name" from properties) group by "Property_Name" """,
    "signature_cost": f"""with {ITEMS}, p as (select record_no, item_pos, unnest(item."Properties_Info") as p from item), s as (select record_no, item_pos, {_TYPE.format(c='p."Property_Name"')} as k, coalesce(lower(trim(p."Unit")), '') as u, count(*) as n from p where p is not null group by all),
      b as (select record_no, item_pos as gold_pos, k, u, n from s union all select record_no, item_pos - 1, k, u, -n from s), r as (select record_no, gold_pos, k, u, abs(sum(n)) as rest from b where gold_pos >= 0 group by all)
      select record_no, gold_pos, cast(2 * sum(rest) as bigint) as cost from r group by all""",
    "full_hit": f"""with {ITEMS}, e as (select record_no, item_pos, map_entries(item."Composition_Info"."Nominal_Composition"."Elements_Normalized") as x, map_entries(item."Composition_Info"."Measured_Composition"."Elements_Normalized") as y from item),
      k as (select record_no, item_pos, list_transform(list_filter(x, lambda e: e.value is not null and e.value <> 0), lambda e: e.key) as a, list_transform(list_filter(y, lambda e: e.value is not null and e.value <> 0), lambda e: e.key) as b from e where x is not null and y is not null)
      select record_no, item_pos, cast(len(list_filter(a, lambda v: not list_contains(b, v))) as int) as n_missing, cast(len(list_filter(b, lambda v: not list_contains(a, v))) as int) as n_extra, list_sort(a) = list_sort(b) as full_hit from k""",
    "process_difference": f"""with g as (select paper_id, "Sample_ID", max("Process_Info"."Process_Category") as gold from samples where paper_id is not null and "Sample_ID" is not null group by all), f as (select paper_id, "Sample_ID", max("Process_Info"."Process_Category") as found from samples_mirror where paper_id is not null and "Sample_ID" is not null group by all),
      j as (select paper_id, "Sample_ID", {_SLUG.format(c='gold')} as sa, {_SLUG.format(c='found')} as sb, {_key('gold')} as a, {_key('found')} as b from g join f using (paper_id, "Sample_ID"))
      select paper_id, "Sample_ID", case when sa = sb then 'equal' when a = b and a <> '' then 'vocabulary' when a <> '' and b <> '' and (contains(a, b) or contains(b, a)) then 'post_treatment' else 'substantive' end as difference from j""",
    "structure_counts": f"""select paper_id, coalesce(g.alloys, 0) as gold_alloys, coalesce(f.alloys, 0) as found_alloys, coalesce(g.samples, 0) as gold_samples, coalesce(f.samples, 0) as found_samples,
      case when coalesce(f.samples, 0) > coalesce(g.samples, 0) then 'improved' when coalesce(f.samples, 0) < coalesce(g.samples, 0) then 'degraded' else 'unchanged' end as change from {_SIDE.format(t='samples')} g full join {_SIDE.format(t='samples_mirror')} f using (paper_id)""",
    "doi_match": """with once as (select distinct on (record_no) record_no, paper_id, lower(trim("Paper_Metadata"."DOI")) as doi from papers),
      shown as (select paper_id, page, pos, item_no, lower(regexp_extract(text, '(10\\.\\d{4,9}/[^\\s"<>]+)', 1)) as doi from ocr_items where paper_id is not null),
      first as (select paper_id, regexp_replace(doi, '[.,;)]+$', '') as shown from (select paper_id, doi, row_number() over (partition by paper_id order by page nulls first, pos nulls first, item_no) as r from shown where doi <> '') where r = 1)
      select record_no, coalesce(doi = shown and doi <> '', false) as match from once left join first using (paper_id)""",
    "composition_checks": f"""with {ITEMS}, e as (select record_no, item_pos, item."Composition_Info"."Alloy_Name_Raw" as name, list_filter(map_entries(item."Composition_Info"."Nominal_Composition"."Elements_Normalized"), lambda e: e.value is not null) as x from item),
      c as (select record_no, coalesce(len(list_filter(x, lambda e: not list_contains(string_split('{_SYMBOLS}', ' '), e.key))) > 0, false) as invalid, coalesce(len(x) > 0 and abs(list_sum(list_transform(x, lambda e: e.value)) - 100) > 2.000001, false) as sum_off, coalesce(len(x), 0) = 0 and coalesce(name, '') <> '' as empty from e)
      select record_no, count_if(invalid) as n_invalid, count_if(sum_off) as n_sum_off, count_if(empty) as n_empty from c group by record_no""",
    "treatment_ranges": f"with t as (select distinct on (test_id) test_id, 'Aged at ' || \"Value_Range\" || ' °C, then annealed for ' || \"Value_Range\" || ' h.' as text from properties), r as ({_RANGES}) select test_id, key, round(least(a, b) + shift, 6) as low, round(greatest(a, b) + shift, 6) as high from r where a is not null",
    "interface_lines": f"""with {DOCS}, l as (select doc_id, string_split(text, chr(10)) as ls from docs where text is not null)
      select doc_id, cast(len(ls) as int) as n_lines, cast(len(ls) - len(list_filter(ls[1:48], lambda x: lower(trim(x)) in ('check for', 'updates', 'menu', 'search | browse | about'))) as int) as n_kept from l""",
    "wrapped_title": f"""with {DOCS}, t as (select distinct on (text_no) 't' || text_no as id, paper_text as text from paper_texts), u as (select id, text from t union all select 'd' || doc_id, text from docs),
      l as (select id, trim(string_split(regexp_replace(text, '^(?:[ \\t]*\\n)+', ''), chr(10))[1]) as a, trim(string_split(regexp_replace(text, '^(?:[ \\t]*\\n)+', ''), chr(10))[2]) as b from u)
      select id, a || ' ' || b as title from l where not starts_with(a, '#') and not contains(a, '$') and not contains(b, '$') and length(a) >= 18 and regexp_matches(b, '^\\p{{Ll}}')""",
}
