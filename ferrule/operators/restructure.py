"""Operators that make rows: step maps, variants, clones, pages, pairs of lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_step(df: DataFrame, a: str, b: str, *keys: str) -> DataFrame:
    """(keys, step, a, b): a row for each step that either of two step-keyed maps has."""
    none = F.array().cast("array<string>")
    steps = F.array_sort(F.array_union(F.coalesce(F.map_keys(a), none), F.coalesce(F.map_keys(b), none)))
    e = df.select(*keys, F.explode(steps).alias("step"), a, b)
    return e.select(*keys, "step", F.try_element_at(F.col(a), F.col("step")).alias(a), F.try_element_at(F.col(b), F.col("step")).alias(b))


def zipped(df: DataFrame, a: Column, b: Column, names: tuple[str, str], *keys: str) -> DataFrame:
    """(keys, pos, names): two lists side by side; the shorter one is filled with nulls."""
    z = F.arrays_zip(a.alias(names[0]), b.alias(names[1]))
    return df.select(*keys, F.posexplode(z).alias("pos", "z")).select(*keys, "pos", *[F.col("z")[n].alias(n) for n in names])


def variants(df: DataFrame, codes: Column, existing: DataFrame, *keys: str) -> DataFrame:
    """(keys, code): a clone for each code that isn't there yet."""
    return df.select(*keys, F.explode(F.array_distinct(codes)).alias("code")).join(existing.select(*keys, "code"), [*keys, "code"], "left_anti")


def crossed(df: DataFrame, options: DataFrame) -> DataFrame:
    """Every row with every option of a small fixed table (some rows, checked here)."""
    n = options.limit(1001).count()
    if n > 1000:
        raise ValueError("options are a table of at most 1000 rows")
    return df.crossJoin(F.broadcast(options))


def pages_of(spec: Column, last: Column) -> Column:
    """The pages that '1-3,5' names: sorted, each once, within 1 and the last."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p.rlike(r"^[0-9]+(\s*-\s*[0-9]+)?$"))
    ends = lambda p: (F.regexp_extract(p, r"^([0-9]+)", 1).cast("int"), F.regexp_extract(p, r"([0-9]+)$", 1).cast("int"))
    listed = F.flatten(F.transform(parts, lambda p: F.sequence(F.least(*ends(p)), F.least(F.greatest(*ends(p)), F.least(*ends(p)) + last))))
    return F.array_sort(F.array_distinct(F.filter(listed, lambda n: (n >= 1) & (n <= last))))


def graded_family(text: Column) -> Column:
    """The distinct percentages from 0 to 60 that a text names, where at least two are above 0; null otherwise."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"([0-9]+(?:\.[0-9]+)?)\s*(?:wt|at)?\.?\s*%"), F.lit(1)), lambda x: x.try_cast("double"))
    steps = F.array_sort(F.array_distinct(F.filter(found, lambda x: (x >= 0) & (x <= 60))))
    return F.when(F.size(F.filter(steps, lambda x: x > 0)) >= 2, steps)


def linked(edges: DataFrame, rounds: int = 20) -> DataFrame:
    """(node, root): connected components of (a, b) by label propagation with pointer jumping, cut each round.

    All steps are joins and aggregations; nothing is gathered. Raises if components are wider than 2 ** rounds.
    """
    from ferrule.session import cut

    e = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = cut(e)
    labels = cut(e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    for _ in range(rounds):
        near = e.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("r"))
        least = labels.join(near, "node").select("node", F.least("root", "r").alias("root"), F.col("root").alias("was"))
        jumped = least.join(labels.select(F.col("node").alias("root"), F.col("root").alias("far")), "root", "left").select("node", F.least("root", F.coalesce("far", "root")).alias("root"), "was")
        new = cut(jumped)
        if not new.where("root <> was").head(1):
            return new.select("node", "root")
        labels = new.select("node", "root")
    raise ValueError("components wider than the rounds allow")
