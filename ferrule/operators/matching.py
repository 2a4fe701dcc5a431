"""Matching of two sides within groups: costs, optimal assignment and greedy pairing."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING, UNMATCHED_ELEMENT, UNMATCHED_TEST, UNMATCHED = 100.0, 120.0, 3.0, 300.0


def composition_costs(gold: DataFrame, found: DataFrame, group: str, gold_id: str, found_id: str) -> DataFrame:
    """(group, gold_id, found_id, cost) of all pairs within a group: 100 for an element of one side only, else the difference.

    Both frames are long: (group, id, element, pct). The pairs are those of one group, which is one article.
    """
    g, f = gold.select(group, gold_id).distinct(), found.select(group, found_id).distinct()
    pairs = g.join(f, group)
    a = pairs.join(gold.select(group, gold_id, "element", F.col("pct").alias("a")), [group, gold_id])
    b = pairs.join(found.select(group, found_id, "element", F.col("pct").alias("b")), [group, found_id])
    keys = [group, gold_id, found_id]
    both = a.join(b, [*keys, "element"], "full")
    cost = F.when(F.col("a").isNull() | F.col("b").isNull(), MISSING).otherwise(F.abs(F.col("a") - F.col("b")))
    return both.groupBy(*keys).agg(F.sum(cost).alias("cost"))


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of least total cost of a matrix with as many columns as rows or more; by shortest augmenting paths."""
    n, m = cost.shape
    if not n or not m:
        return []
    if n > m:
        return sorted((i, j) for j, i in assignment(cost.T))
    u, v, p, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        p[0], j0 = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while True:
            used[j0] = True
            free = ~used
            free[0] = False
            reduced = np.concatenate([[np.inf], cost[p[j0] - 1] - u[p[j0]] - v[1:]])
            better = free & (reduced < least)
            least[better], way[better] = reduced[better], j0
            j1 = int(np.where(free, least, np.inf).argmin())
            delta = least[j1]
            u[p[used]] += delta
            v[used] -= delta
            least[free] -= delta
            j0 = j1
            if p[j0] == 0:
                break
        while j0:
            p[j0], j0 = p[way[j0]], way[j0]
    return sorted((int(p[j]) - 1, j - 1) for j in range(1, m + 1) if p[j])


def optimal(costs: DataFrame, group: str, gold_id: str, found_id: str, unmatched: float, gold_alone: str | None = None, found_alone: str | None = None) -> DataFrame:
    """(group, gold_id, found_id, cost): the assignment of least total cost in each group; a pair dearer than leaving both
    unmatched is not made. What leaving one costs is ``unmatched``, or stands in the columns ``gold_alone`` and
    ``found_alone``. Ties go to lower ids. A group is one article, so it is bounded by what an article holds."""
    kinds = dict(costs.dtypes)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cols = sorted(pdf[gold_id].unique()), sorted(pdf[found_id].unique())
        alone = (pdf[gold_alone] if gold_alone else unmatched) + (pdf[found_alone] if found_alone else unmatched)
        saved = np.zeros((len(rows), len(cols)))
        cost: dict[tuple[int, int], float] = {}
        r, k = {x: i for i, x in enumerate(rows)}, {x: i for i, x in enumerate(cols)}
        for g, f, x, spared in zip(pdf[gold_id], pdf[found_id], pdf["cost"], pdf["cost"] - alone):
            saved[r[g], k[f]] = min(spared, 0.0)
            cost[r[g], k[f]] = x
        made = [(rows[i], cols[j], cost[i, j]) for i, j in assignment(saved - saved.min()) if saved[i, j] < 0]
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(made), gold_id: [x[0] for x in made], found_id: [x[1] for x in made], "cost": [x[2] for x in made]})

    return costs.groupBy(group).applyInPandas(solve, f"`{group}` {kinds[group]}, `{gold_id}` {kinds[gold_id]}, `{found_id}` {kinds[found_id]}, cost double")


def mutual_best(costs: DataFrame, group: str, gold_id: str, found_id: str) -> DataFrame:
    """Pairs that are each other's cheapest partner; ties go to the lower id."""
    g = costs.groupBy(group, gold_id).agg(F.min(F.struct("cost", found_id)).alias("m")).select(group, gold_id, F.col(f"m.{found_id}").alias(found_id), "m.cost")
    f = costs.groupBy(group, found_id).agg(F.min(F.struct("cost", gold_id)).alias("m")).select(group, F.col(f"m.{gold_id}").alias(gold_id), found_id)
    return g.join(f, [group, gold_id, found_id])


def greedy(scores: DataFrame, group: str, gold_id: str, found_id: str, least: float = 4.0) -> DataFrame:
    """Each gold row in its order takes the free row of the highest score, of equal ones the last; below ``least`` none."""
    kinds = dict(scores.dtypes)

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        free, out = set(pdf[found_id]), []
        for g, rows in pdf.sort_values(gold_id).groupby(gold_id, sort=True):
            open_ = rows[rows[found_id].isin(free)]
            if len(open_):
                best = open_.sort_values(["score", found_id]).iloc[-1]
                if best["score"] >= least:
                    free.discard(best[found_id])
                    out.append((pdf[group].iloc[0], g, best[found_id], float(best["score"])))
        return pd.DataFrame(out, columns=[group, gold_id, found_id, "score"])

    return scores.groupBy(group).applyInPandas(take, f"`{group}` {kinds[group]}, `{gold_id}` {kinds[gold_id]}, `{found_id}` {kinds[found_id]}, score double")


def similarity(a: str | None, b: str | None) -> float:
    """Twice the matching letters by all letters, matching blocks longest first; 0 where a side is missing."""
    return SequenceMatcher(None, a.lower(), b.lower()).ratio() if a and b else 0.0


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.size(F.array_union(a, b)))


def temperature_distance(a: Column, b: Column) -> Column:
    """The least difference of two temperatures of which either may be in Celsius; 0 where both are unknown, null where one is."""
    d = F.least(F.abs(a - b), F.abs(a + 273.15 - b), F.abs(a - b - 273.15))
    return F.when(a.isNull() & b.isNull(), 0.0).otherwise(d)


def nearest_tests(gold: DataFrame, found: DataFrame, group: list[str], key: str, tolerance: float = 1.0) -> DataFrame:
    """(gold key, found key): of each gold test the found test of its group whose temperature is nearest within a tolerance,
    then whose value is, then the first."""
    g = gold.select(*group, F.col(key).alias("g"), F.col("t").alias("gt"), F.col("v").alias("gv"))
    f = found.select(*group, F.col(key).alias("f"), F.col("t").alias("ft"), F.col("v").alias("fv"))
    d = F.when(F.col("gt").isNull() & F.col("ft").isNull(), 0.0).when(F.col("gt").isNull() | F.col("ft").isNull(), tolerance).otherwise(F.abs(F.col("gt") - F.col("ft")))
    pairs = g.join(f, group).withColumn("d", d).where(F.col("d") <= tolerance)
    best = pairs.groupBy("g").agg(F.min(F.struct("d", F.abs(F.col("gv") - F.col("fv")).alias("e"), "f")).alias("m"))
    return best.select("g", F.col("m.f").alias("f"), F.col("m.d").alias("d"), F.col("m.e").alias("e"))


#: What a gold test without partner costs, what a pair of which one has no temperature does, and how many units of value
#: weigh as one kelvin.
NO_PARTNER, ONE_UNKNOWN, VALUE_SCALE = 1000.0, 10.0, 1000.0


def assigned_tests(gold: DataFrame, found: DataFrame, group: list[str], key: str, kinds: list[str] | None = None, tolerance: float = 1.0) -> DataFrame:
    """(group, gold_test, found_test): gold tests assigned one to one to the found tests of their group at least cost.

    ``gold`` and ``found`` have ``t`` (temperature) and ``v`` (value, null as 0); only tests equal in the columns ``kinds``
    meet. As many as can be are matched: a pair costs its difference of temperature, which must be within ``tolerance``, and
    a little for that of the values. A group is one item, so it is bounded by what an article says of it.
    """
    kinds, types = kinds or [], dict(gold.dtypes)

    def some(g: pd.DataFrame, f: pd.DataFrame) -> list[tuple[int, int]]:
        gt, ft = g["t"].to_numpy(dtype=float)[:, None], f["t"].to_numpy(dtype=float)[None, :]
        apart = np.abs(gt - ft)
        away = np.where(np.isnan(gt) & np.isnan(ft), 0.0, np.where(np.isnan(gt) | np.isnan(ft), ONE_UNKNOWN, apart))
        gv, fv = (x["v"].fillna(0.0).to_numpy(dtype=float) for x in (g, f))
        cost = away + np.abs(gv[:, None] - fv[None, :]) / VALUE_SCALE
        saved = np.where(apart > tolerance, 0.0, np.minimum(cost - NO_PARTNER, 0.0))
        return [(int(g[key].iloc[i]), int(f[key].iloc[j])) for i, j in assignment(saved - saved.min()) if saved[i, j] < 0]

    def solve(_, g: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        made: list[tuple[int, int]] = []
        if len(g) and len(f):
            g, f = g.sort_values(key, kind="stable"), f.sort_values(key, kind="stable")
            parts = {k: p for k, p in f.groupby(kinds)} if kinds else {}
            for k, p in g.groupby(kinds) if kinds else [(None, g)]:
                other = parts.get(k) if kinds else f
                made += some(p, other) if other is not None else []
        out = {c: [g[c].iloc[0]] * len(made) if made else [] for c in group}
        return pd.DataFrame({**out, "gold_test": [x for x, _ in made], "found_test": [y for _, y in made]})

    schema = ", ".join(f"`{c}` {types[c]}" for c in group) + f", gold_test {types[key]}, found_test {types[key]}"
    # Columns of their own: both sides may come from one table, which a cogroup would not tell apart.
    sides = [x.select(*[F.col(c).alias(c) for c in dict.fromkeys([*group, *kinds, key, "t", "v"])]) for x in (gold, found)]
    return sides[0].groupBy(*group).cogroup(sides[1].groupBy(*group)).applyInPandas(solve, schema)
