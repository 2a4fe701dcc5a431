"""Schemas that drift between the files of a stream.

Each JSON file is loaded as path-value rows with raw types; path-type statistics are aggregated by file and
compared with those of the file before it in its stream; a path that goes and one that comes are one renamed path
when the samples in both files keep their values under it. All records come out in one table whose columns follow
the renames, typed by the most frequent raw type, with each failed cast reported.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.functions.arrow import each
from ferrule.operators.ordered import with_previous
from ferrule.session import cut

#: Keys whose object counts as one field, because its own keys are data.
OPAQUE = ("Elements_Normalized", "Key_Params")
#: Raw types and their bits in a file's statistics; 0 is null, CONTAINER an object or array of objects.
TYPES = {"string": 1, "number": 2, "boolean": 4, "array": 8, "object": 16}
CONTAINER = 32
#: The share of samples in both files that must keep their value under the new path.
KEPT = 0.9

CELL = "struct<sample:string, n:int, pos:string, path:string, bit:int, value:string>"


def _type(v: object) -> str:
    return "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object" if isinstance(v, dict) else "number"


def plain(v: object) -> str | None:
    """A value's form that doesn't depend on how its type is written: 1.50, '1.5' and ['1.5'] are the same."""
    if isinstance(v, str):
        try:
            inner = json.loads(v)
        except ValueError:
            return v.strip()
        return v.strip() if inner is None else plain(inner)
    if isinstance(v, list) and len(v) == 1:
        return plain(v[0])
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(float(v))
    return None if v is None else json.dumps(v, sort_keys=True)


def _cells(v: object, path: str, pos: str) -> Iterator[tuple[str, str, int, object]]:
    """(path, ordinals, type bit, value) of a value and all below it."""
    stack = [(v, path, pos)]
    while stack:
        v, path, pos = stack.pop()
        if v is None:
            yield path, pos, 0, None
        elif isinstance(v, dict) and path.rpartition(".")[2] not in OPAQUE:
            yield path, pos, CONTAINER, None
            stack.extend((x, f"{path}.{k}", pos) for k, x in v.items())
        elif isinstance(v, list) and any(isinstance(x, dict) for x in v):
            yield path, pos, CONTAINER, None
            stack.extend((x, f"{path}[].{k}", f"{pos}/{i}") for i, e in enumerate(v) if isinstance(e, dict) for k, x in e.items())
        else:
            yield path, pos, TYPES[_type(v)], v


def file_cells(body: str | None, root: str = "items", key: str = "Sample_ID") -> list[dict]:
    """The path-value rows of one file; nothing for a null, empty or unreadable body or one without the root."""
    try:
        items = json.loads(body)[root]
    except (TypeError, ValueError, KeyError, IndexError):
        return []
    out, seen = [], Counter()
    for item in items if isinstance(items, list) else []:
        if not isinstance(item, dict):
            continue
        sample = item.get(key)
        sample = None if sample is None else str(sample)
        seen[sample] += 1
        for name, v in item.items():
            for path, pos, bit, value in _cells(v, f"{root}[].{name}", ""):
                out.append({"sample": sample, "n": seen[sample], "pos": pos, "path": path, "bit": bit, "value": plain(value)})
    return out


def path_values(files: DataFrame) -> DataFrame:
    """(file_no, sample, n, pos, path, bit, value): one row for each value; repeated files count once."""
    once = files.select("file_no", "body").dropDuplicates(["file_no"])
    return once.select("file_no", F.explode(each(file_cells, f"array<{CELL}>", "body")).alias("c")).select("file_no", "c.*")


def path_statistics(values: DataFrame) -> DataFrame:
    """(file_no, path, bits, n): the raw types of each leaf path of each file. Containers are left out."""
    stats = values.groupBy("file_no", "path").agg(F.bit_or("bit").alias("bits"), F.count("*").alias("n"))
    return stats.where(F.col("bits").bitwiseAND(CONTAINER) == 0)


def changes(files: DataFrame) -> DataFrame:
    """(stream_id, file_no, change_kind, old_path, new_path): each file against the one before it.

    Files of a stream are ordered by exported_at, then file_no. A file that can't be read has no fields.
    """
    order = files.select("stream_id", "exported_at", "file_no").dropDuplicates(["file_no"])
    pairs = with_previous(order, ["stream_id"], ["exported_at", "file_no"], "file_no", "before").where(F.col("before").isNotNull())
    pairs = cut(pairs.select("stream_id", "file_no", "before"))  # narrow, and used by three joins
    stats = path_statistics(path_values(files)).select(F.col("file_no").alias("f"), "path", "bits")

    roles = F.array(F.struct(F.col("file_no").alias("f"), F.lit(1).alias("now")), F.struct(F.col("before").alias("f"), F.lit(0).alias("now")))
    both = pairs.select("stream_id", "file_no", F.explode(roles).alias("r")).select("stream_id", "file_no", "r.*").join(stats, "f")
    pick = lambda i: F.max(F.when(F.col("now") == i, F.col("bits")))
    compared = both.groupBy("stream_id", "file_no", "path").agg(pick(0).alias("old"), pick(1).alias("new"))
    kind = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when((F.col("old") > 0) & (F.col("new") > 0) & (F.col("old") != F.col("new")), "retyped")
    )
    found = cut(compared.withColumn("kind", kind).where(F.col("kind").isNotNull()).select("stream_id", "file_no", "path", "kind"))
    renamed = cut(renames(found, pairs, path_values(files)))

    ends = F.array(F.struct(F.lit("removed").alias("kind"), F.col("old_path").alias("path")), F.struct(F.lit("added").alias("kind"), F.col("new_path").alias("path")))
    rest = found.join(renamed.select("file_no", F.explode(ends).alias("r")).select("file_no", "r.*"), ["file_no", "kind", "path"], "left_anti")
    old = F.when(F.col("kind") == "added", "").otherwise(F.col("path"))
    new = F.when(F.col("kind") == "removed", "").otherwise(F.col("path"))
    plainly = rest.select("stream_id", "file_no", F.col("kind").alias("change_kind"), old.alias("old_path"), new.alias("new_path"))
    return plainly.unionByName(renamed.select("stream_id", "file_no", F.lit("renamed").alias("change_kind"), "old_path", "new_path"))


def renames(found: DataFrame, pairs: DataFrame, values: DataFrame) -> DataFrame:
    """(stream_id, file_no, old_path, new_path): the removed and added paths under which samples keep their values.

    Only values of paths that went or came are joined, by file, sample and ordinals: a bounded set for each file.
    Of several partners the one with the most kept values counts; each path has one partner.
    """
    own = F.when(F.col("kind") == "removed", F.col("before")).otherwise(F.col("file_no"))
    wanted = found.where("kind != 'retyped'").join(pairs.select("file_no", "before"), "file_no").select("stream_id", F.col("file_no").alias("pair"), "kind", own.alias("file_no"), "path")
    cells = cut(values.where("bit > 0 and value is not null").join(wanted, ["file_no", "path"]).select("stream_id", "pair", "kind", "sample", "n", "pos", "path", "value"))
    side = lambda kind, p, v: cells.where(F.col("kind") == kind).select("stream_id", F.col("pair").alias("file_no"), "sample", "n", "pos", F.col("path").alias(p), F.col("value").alias(v))
    on = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("stream_id", "file_no", "sample", "n", "pos")])
    gone, come = side("removed", "old_path", "old").alias("a"), side("added", "new_path", "new").alias("b")
    both = gone.join(come, on).select("a.stream_id", "a.file_no", "old_path", "old", "new_path", "new")
    pair = both.groupBy("stream_id", "file_no", "old_path", "new_path").agg(F.count("*").alias("n"), F.count_if(F.col("old") == F.col("new")).alias("same"), F.countDistinct("old").alias("kinds"))
    pair = pair.where(F.col("same") >= F.col("n") * KEPT)
    rank = [F.col("same").desc(), F.col("kinds").desc(), F.levenshtein("old_path", "new_path"), F.col("old_path"), F.col("new_path")]
    best = lambda side: F.row_number().over(Window.partitionBy("file_no", side).orderBy(*rank))
    chosen = pair.withColumn("i", best("old_path")).withColumn("j", best("new_path")).where("i = 1 and j = 1")
    return chosen.select("stream_id", "file_no", "old_path", "new_path")


def canonical_names(found: DataFrame, most: int = 10_000) -> dict[str, str]:
    """Path -> the name under which it goes in the one table: of all paths linked by renames, the most linked one.

    Works on distinct path pairs, a property of the schema and not of the rows; more than ``most`` is an error.
    """
    links = found.where("change_kind = 'renamed'").groupBy("old_path", "new_path").count().limit(most + 1).collect()
    if len(links) > most:
        raise ValueError(f"more than {most} distinct renames: not a drifting schema")
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    weight: Counter[str] = Counter()
    for r in links:
        weight[r.old_path] += r["count"]
        weight[r.new_path] += r["count"]
        parent[root(r.old_path)] = root(r.new_path)
    groups: dict[str, list[str]] = {}
    for p in parent:
        groups.setdefault(root(p), []).append(p)
    return {p: max(g, key=lambda x: (weight[x], x)) for g in groups.values() for p in g}


def unified_values(files: DataFrame, names: dict[str, str]) -> DataFrame:
    """One consistent table of all records, a row for each value, with its type and failed casts.

    Columns: file_no, sample, n, pos, path (the canonical one), raw_path, raw_type, value, as_type, number, boolean,
    cast_failed. ``as_type`` is the most frequent raw type of the canonical path over all files; a value that cannot
    be read as that type stays as text and is reported in ``cast_failed``. Fields written as null stay, with null type and
    value; objects and arrays of objects are no values of their own.
    """
    values = path_values(files).where("bit < 32")
    entries = [F.lit(x) for kv in names.items() for x in kv]
    path: Column = F.coalesce(F.try_element_at(F.create_map(*entries), F.col("path")), F.col("path")) if entries else F.col("path")
    kind = F.try_element_at(F.create_map(*[F.lit(x) for k, v in TYPES.items() for x in (v, k)]), F.col("bit"))
    values = values.select("file_no", "sample", "n", "pos", path.alias("path"), F.col("path").alias("raw_path"), kind.alias("raw_type"), "value")
    counts = values.groupBy("path", "raw_type").count()
    # Null has no type: it counts last, so only a path that is always null has none.
    seen = F.struct(F.col("raw_type").isNotNull(), "count", "raw_type")
    as_type = counts.groupBy("path").agg(F.max_by("raw_type", seen).alias("as_type"))
    number = F.when(F.col("as_type") == "number", F.col("value").try_cast("double"))
    boolean = F.when(F.col("as_type") == "boolean", F.col("value").try_cast("boolean"))
    compound = F.col("as_type").isin("array", "object") & (F.col("raw_type") != F.col("as_type"))
    unread = ((F.col("as_type") == "number") & number.isNull()) | ((F.col("as_type") == "boolean") & boolean.isNull()) | compound
    failed = F.coalesce(F.col("raw_type").isNotNull() & unread, F.lit(False))
    # as_type has one row for each path of the schema: small, and Spark broadcasts it only where its measured size allows.
    return values.join(as_type, "path").select("file_no", "sample", "n", "pos", "path", "raw_path", "raw_type", "value", "as_type", number.alias("number"), boolean.alias("boolean"), failed.alias("cast_failed"))


#: Paths that one level may have as columns; more are an error.
MOST_COLUMNS = 10_000


def typed_tables(unified: DataFrame) -> dict[str, DataFrame]:
    """By array level, as ``items[]`` or ``items[].Properties_Info[]``: its records as rows of typed columns.

    ``unified``: the values of :func:`unified_values`. A row is (file_no, sample, n, pos) with a column for each canonical
    path below the level, named by its keys joined by underscores: double for numbers, boolean, else text. A value that
    can't be read as its column's type is null there and listed as ``path: value`` in ``failed_casts``. What comes to the
    driver are the paths of the schema with their types.
    """
    unified = cut(unified.withColumn("level", F.regexp_extract("path", r"^(.*\[\])\.", 1)))
    paths = unified.groupBy("level", "path").agg(F.max("as_type").alias("as_type")).orderBy("path").limit(MOST_COLUMNS + 1).collect()
    if len(paths) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} paths: not a schema")
    out = {}
    for level in sorted({r.level for r in paths}):
        columns, taken = [], {"file_no", "sample", "n", "pos", "failed_casts"}
        for r in (r for r in paths if r.level == level):
            name = base = r.path[len(level) + 1 :].replace(".", "_")
            k = 2
            while name.lower() in taken:
                name, k = f"{base}_{k}", k + 1
            taken.add(name.lower())
            value = {"number": "number", "boolean": "boolean"}.get(r.as_type, "value")
            columns.append(F.first(F.when(F.col("path") == r.path, F.col(value)), ignorenulls=True).alias(name))
        failed = F.array_sort(F.collect_list(F.when(F.col("cast_failed"), F.concat_ws(": ", "path", "value")))).alias("failed_casts")
        out[level] = unified.where(F.col("level") == level).groupBy("file_no", "sample", "n", "pos").agg(*columns, failed)
    return out
