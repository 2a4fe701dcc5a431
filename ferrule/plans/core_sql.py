"""SQL of the general operators' results, where SQL can express them."""

_CURRENT = """
  select * from (
    select {id} as id, paper_id, "Sample_ID", "Composition_Info"."Role" as "Role", "Composition_Info"."Alloy_Name_Raw" as "Alloy_Name_Raw",
           "Process_Info"."Process_Category" as "Process_Category", "Microstructure_Info"."Main_Phase" as "Main_Phase",
           row_number() over (partition by paper_id, "Sample_ID" order by {at} desc nulls last, {id} desc nulls last) as rn
    from {table}) where rn = 1"""

P5 = f"""
with l as ({_CURRENT.format(id="row_id", at="loaded_at", table="samples")}),
     r as ({_CURRENT.format(id="mirror_row", at="copied_at", table="samples_mirror")}),
     j as (select coalesce(l.paper_id, r.paper_id) as paper_id, coalesce(l."Sample_ID", r."Sample_ID") as "Sample_ID", l.id as lid, r.id as rid,
                  l."Role" as l1, r."Role" as r1, l."Alloy_Name_Raw" as l2, r."Alloy_Name_Raw" as r2,
                  l."Process_Category" as l3, r."Process_Category" as r3, l."Main_Phase" as l4, r."Main_Phase" as r4
           from l full outer join r on l.paper_id is not distinct from r.paper_id and l."Sample_ID" is not distinct from r."Sample_ID")
select paper_id, "Sample_ID", 'only_in_samples' as diff_kind from j where rid is null
union all select paper_id, "Sample_ID", 'only_in_mirror' from j where lid is null
union all select paper_id, "Sample_ID", 'Role' from j where lid is not null and rid is not null and l1 is distinct from r1
union all select paper_id, "Sample_ID", 'Alloy_Name_Raw' from j where lid is not null and rid is not null and l2 is distinct from r2
union all select paper_id, "Sample_ID", 'Process_Category' from j where lid is not null and rid is not null and l3 is distinct from r3
union all select paper_id, "Sample_ID", 'Main_Phase' from j where lid is not null and rid is not null and l4 is distinct from r4
"""

P6 = """
with recursive
  once as (select distinct on (record_no) record_no, items from papers),
  entry as (select record_no, unnest(items) as item, generate_subscripts(items, 1) - 1 as item_pos from once where items is not null),
  kept as (select record_no, cast(item_pos as int) as item_pos, item from entry where item is not null),
  texts as (
    select record_no, item_pos, 'param' as child_kind, item."Process_Info"."Key_Params" as t from kept
    union all select record_no, item_pos, 'feature', item."Microstructure_Info"."Advanced_Quantitative_Features" from kept),
  parsed as (select record_no, item_pos, child_kind, case when json_type(try_cast(t as json)) = 'VARCHAR' then try_cast(try_cast(t as json) ->> '$' as json) else try_cast(t as json) end as j from texts where t is not null),
  tree as (
    select record_no, item_pos, child_kind, '' as path, j, 0 as depth from parsed where json_type(j) in ('OBJECT', 'ARRAY')
    union all
    select record_no, item_pos, child_kind,
           case when is_object then case when path = '' then k else path || '.' || k end else path || '[' || k || ']' end, v, depth + 1
    from (
      select record_no, item_pos, child_kind, path, depth, json_type(j) = 'OBJECT' as is_object,
             unnest(case when json_type(j) = 'OBJECT' then json_keys(j) else list_transform(range(cast(json_array_length(j) as bigint)), lambda x: cast(x as varchar)) end) as k,
             unnest(case when json_type(j) = 'OBJECT' then list_transform(json_keys(j), lambda x: json_extract(j, '$."' || x || '"')) else list_transform(range(cast(json_array_length(j) as bigint)), lambda x: json_extract(j, '$[' || x || ']')) end) as v
      from tree where json_type(j) in ('OBJECT', 'ARRAY'))),
  out as (
    select record_no, item_pos, 'item' as child_kind, '' as child_key from kept
    union all select record_no, item_pos, 'property', cast(i - 1 as varchar) from (select record_no, item_pos, unnest(item."Properties_Info") as p, generate_subscripts(item."Properties_Info", 1) as i from kept) where p is not null
    union all select record_no, item_pos, 'precipitate', cast(i - 1 as varchar) from (select record_no, item_pos, unnest(item."Microstructure_Info"."Precipitates") as p, generate_subscripts(item."Microstructure_Info"."Precipitates", 1) as i from kept) where p is not null
    union all select record_no, item_pos, 'nominal_element', e.key from (select record_no, item_pos, unnest(map_entries(item."Composition_Info"."Nominal_Composition"."Elements_Normalized")) as e from kept) where e.value is not null
    union all select record_no, item_pos, 'measured_element', e.key from (select record_no, item_pos, unnest(map_entries(item."Composition_Info"."Measured_Composition"."Elements_Normalized")) as e from kept) where e.value is not null
    union all select record_no, item_pos, child_kind, path from tree where json_type(j) not in ('OBJECT', 'ARRAY', 'NULL') and path <> '')
select distinct record_no, item_pos, child_kind, child_key from out
"""

P5_DIFFERENCES = P5.partition("select paper_id, \"Sample_ID\", 'only_in_samples'")[0] + "\nunion all ".join([
    "select paper_id, \"Sample_ID\", 'only_in_samples' as diff_kind, cast(null as varchar) as left_value, cast(null as varchar) as right_value from j where rid is null",
    "select paper_id, \"Sample_ID\", 'only_in_mirror', null, null from j where lid is null",
    *(f"select paper_id, \"Sample_ID\", '{f}', l{i}, r{i} from j where lid is not null and rid is not null and l{i} is distinct from r{i}" for i, f in enumerate(("Role", "Alloy_Name_Raw", "Process_Category", "Main_Phase"), 1)),
])

P6_PROPERTIES = """
with once as (select distinct on (record_no) record_no, items from papers),
  entry as (select record_no, unnest(items) as item, generate_subscripts(items, 1) - 1 as item_pos from once where items is not null),
  entries as (select record_no, item_pos, unnest(item."Properties_Info") as entry_, generate_subscripts(item."Properties_Info", 1) - 1 as pos from entry where item is not null)
select distinct * from (select record_no, item_pos, pos, unnest(entry_) from entries where entry_ is not null)
"""

SQL = {"p5_found": P5, "p5_differences": P5_DIFFERENCES, "p6_found": P6, "p6_properties": P6_PROPERTIES}
