"""Nested records to related flat tables.

The merged schema of a source says where arrays, maps and JSON texts lie. Every array level becomes a child table
that carries the parent's key and the ordinal of the entry (from 0, null entries counted but giving no row); maps and
JSON texts become child tables keyed by map key or leaf path.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.functions.arrow import each

LEAF = "array<struct<path:string, kind:string, value:string>>"


def json_root(text: str | None) -> object:
    """The parsed text, unwrapped where a JSON text holds another JSON text; None where it isn't JSON."""
    value: object = text
    while isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
    return value if isinstance(value, (dict, list)) else None


def walk(value: object, path: str = "") -> Iterator[tuple[str, str, str]]:
    """Non-null leaves as (path, kind, text), e.g. ('Stages[0].Name', 'string', 'aging'). Without recursion, so depth is no matter."""
    stack = [(path, value)]
    while stack:
        at, v = stack.pop()
        if isinstance(v, dict):
            stack.extend((f"{at}.{k}" if at else k, x) for k, x in reversed(v.items()))
        elif isinstance(v, list):
            stack.extend((f"{at}[{i}]", x) for i, x in reversed(list(enumerate(v))))
        elif v is not None:
            kind = "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number"
            yield at, kind, v if isinstance(v, str) else json.dumps(v)


def text_leaves(text: str | None) -> list[dict]:
    """Leaves of a JSON text; none for null, empty and unreadable texts."""
    return [{"path": p, "kind": k, "value": v} for p, k, v in walk(json_root(text))]


def json_leaves(text: Column) -> Column:
    """The leaves as an array of (path, kind, value)."""
    return each(text_leaves, LEAF, text)


def merged_schema(df: DataFrame, column: str) -> DataFrame:
    """The merged schema of a JSON text column: (path, kind, n) with array ordinals left out, aggregated before the shuffle."""
    leaf = df.select(F.explode(json_leaves(F.col(column))).alias("l"))
    return leaf.groupBy(F.regexp_replace("l.path", r"\[\d+\]", "[]").alias("path"), F.col("l.kind").alias("kind")).agg(F.count("*").alias("n"))


def children(df: DataFrame, array: Column, keys: list[str], pos: str, entry: str, carry: list[str] | None = None) -> DataFrame:
    """One row for each entry of ``array`` that is not null, with the parent's ``keys`` and the ordinal ``pos``."""
    return df.select(*keys, *(carry or []), F.posexplode(array).alias(pos, entry)).where(F.col(entry).isNotNull())


def array_levels(schema: T.StructType, prefix: str = "") -> list[str]:
    """Paths of all arrays of structs of a schema, outermost first: where child tables begin."""
    found = []
    for f in schema.fields:
        kind, path = f.dataType, f"{prefix}{f.name}"
        if isinstance(kind, T.StructType):
            found += array_levels(kind, path + ".")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found += [path, *array_levels(kind.elementType, path + "[].")]
    return found


def map_levels(schema: T.StructType, prefix: str = "") -> list[str]:
    """Paths of all maps of a schema, those inside arrays of structs included."""
    found = []
    for f in schema.fields:
        kind, path = f.dataType, f"{prefix}{f.name}"
        if isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        if isinstance(kind, T.StructType):
            found += map_levels(kind, path + ".")
        elif isinstance(kind, T.MapType) and not path.endswith("[]"):
            found.append(path)
    return found


def _has(schema: T.DataType, path: str) -> bool:
    for part in path.split("."):
        if part.endswith("[]") and isinstance(schema, T.StructType) and part[:-2] in schema.names:
            schema = schema[part[:-2]].dataType.elementType
            continue
        if not isinstance(schema, T.StructType) or part not in schema.names:
            return False
        schema = schema[part].dataType
    return True


class RecordTables:
    """The flat tables of a table of papers whose ``items`` are nested records.

    Blocks that the file's schema lacks give empty tables. Rows with the same ``record_no`` repeat a record; their
    flat rows are the same and :meth:`rows` gives each once.
    """

    KEYS = ("record_no", "item_pos")
    # What the child tables are called, by path; and the paths that hold JSON text, which no schema shows.
    NAMES = {"Properties_Info": "property", "Microstructure_Info.Precipitates": "precipitate", "Composition_Info.Nominal_Composition.Elements_Normalized": "nominal_element", "Composition_Info.Measured_Composition.Elements_Normalized": "measured_element"}
    TEXTS = {"Process_Info.Key_Params": "param", "Microstructure_Info.Advanced_Quantitative_Features": "feature"}

    def __init__(self, papers: DataFrame) -> None:
        self.items = children(papers, F.col("items"), ["record_no"], "item_pos", "item")
        self.schema = self.items.schema["item"].dataType

    def _entries(self, path: str) -> tuple[DataFrame, list[str], Column | None]:
        """(rows, keys, column) of a path, with the arrays around it exploded level by level; no column where the schema lacks it."""
        if not _has(self.schema, path):
            return self.items, [*self.KEYS], None
        df, keys, at = self.items, [*self.KEYS], "item"
        *outer, last = path.split("[].")
        for k, part in enumerate(outer):
            df = children(df, F.col(f"{at}.{part}"), keys, f"pos_{k}", f"entry_{k}")
            keys, at = [*keys, f"pos_{k}"], f"entry_{k}"
        return df, keys, F.col(f"{at}.{last}")

    def item(self) -> DataFrame:
        """Scalars and lists of scalars of each item, of all structs inside it."""

        def flat(schema: T.StructType, at: str, name: str) -> list[Column]:
            out = []
            for f in schema.fields:
                if isinstance(f.dataType, T.StructType):
                    out += flat(f.dataType, f"{at}.{f.name}", f"{name}{f.name}_")
                elif isinstance(f.dataType, T.AtomicType) or isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.AtomicType):
                    out.append(F.col(f"{at}.{f.name}").alias(f"{name}{f.name}"))
            return out

        return self.items.select(*self.KEYS, *flat(self.schema, "item", ""))

    def listed(self, path: str) -> DataFrame:
        """An array level: its entries' fields with their ordinal ``pos``, after those of the arrays around it."""
        df, keys, array = self._entries(path)
        if array is None:
            return df.select(*keys, F.lit(0).alias("pos")).where(F.lit(False))
        return children(df, array, keys, "pos", "e").select(*keys, "pos", "e.*")

    def mapped(self, path: str) -> DataFrame:
        """A map: one row (key, value) for each key whose value is not null."""
        df, keys, m = self._entries(path)
        if m is None:
            return df.select(*keys, F.lit("").alias("key"), F.lit(0.0).alias("value")).where(F.lit(False))
        return df.select(*keys, F.explode(m).alias("key", "value")).where(F.col("value").isNotNull())

    def leaves(self, path: str) -> DataFrame:
        """A JSON text: one row (path, kind, value) for each leaf that is not null."""
        df, keys, text = self._entries(path)
        if text is None:
            return df.select(*keys, F.lit("").alias("path"), F.lit("").alias("kind"), F.lit("").alias("value")).where(F.lit(False))
        found = df.where(text.isNotNull()).select(*keys, F.explode(json_leaves(text)).alias("l"))
        return found.select(*keys, "l.*")

    def tables(self) -> dict[str, tuple[DataFrame, str]]:
        """The flat tables by child kind, each with the column of its last key: every array level and map that the schema
        has, under its path where it has no name in :attr:`NAMES`, and the JSON texts of :attr:`TEXTS`."""
        out = {"item": (self.item(), "")}
        out |= {self.NAMES.get(p, p): (self.listed(p), "pos") for p in array_levels(self.schema)}
        out |= {self.NAMES.get(p, p): (self.mapped(p), "key") for p in map_levels(self.schema)}
        return out | {kind: (self.leaves(p), "path") for p, kind in self.TEXTS.items()}

    def rows(self) -> DataFrame:
        """Every flat row once: (record_no, item_pos, child_kind, child_key)."""
        out: DataFrame | None = None
        for kind, (df, key) in self.tables().items():
            outer = [c for c in df.columns[len(self.KEYS) :] if re.fullmatch(r"pos_\d+", c)]
            parts = [F.col(c).cast("string") for c in ([*outer, key] if key else [])]
            part = df.select(*self.KEYS, F.lit(kind).alias("child_kind"), F.concat_ws("/", *parts).alias("child_key"))
            out = part if out is None else out.unionByName(part)
        return out.distinct()
