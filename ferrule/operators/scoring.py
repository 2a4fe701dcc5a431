"""Scores: detection, value errors at several grains, fill rates, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n, d), F.lit(0.0))


def detection(df: DataFrame, truth: Column, found: Column, *grain: str) -> DataFrame:
    """True and false positives, misses, precision, recall and F1; 0 where a denominator is."""
    n = df.groupBy(*grain).agg(F.count_if(truth & found).alias("tp"), F.count_if(~truth & found).alias("fp"), F.count_if(truth & ~found).alias("fn"))
    p, r = rate(F.col("tp"), F.col("tp") + F.col("fp")), rate(F.col("tp"), F.col("tp") + F.col("fn"))
    return n.select(*grain, "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(rate(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 6).alias("f1"))


def value_errors(df: DataFrame, error: Column, tolerance: float, grains: list[list[str]]) -> DataFrame:
    """Count, mean and greatest error, exact ones and those within a tolerance, at several grains in one pass."""
    columns = list(dict.fromkeys(c for g in grains for c in g))
    e = F.abs(error)
    sets = [[F.col(c) for c in g] for g in grains]
    return df.groupingSets(sets, *columns).agg(F.grouping_id().alias("grain"), F.count(e).alias("n"), F.round(F.avg(e), 4).alias("mae"), F.round(F.max(e), 4).alias("max_error"), F.count_if(e == 0).alias("n_exact"), F.count_if(e <= tolerance).alias("n_within"))


def quality_score(materials: Column, properties: Column, doi: Column, phase: Column, unknown: Column, composition: Column) -> Column:
    """A score of 0 to 100, cut to a whole number, from counts and rates of a paper."""
    s = F.least(5 * materials, F.lit(10)) + F.least(2 * properties, F.lit(20)) + F.when(doi, 10).otherwise(0) + 20 * phase + 20 * (1 - unknown) + 20 * composition
    return F.floor(s + 1e-9).cast("int")


def status(score: Column) -> Column:
    return F.when(score >= 70, "pass").when(score >= 40, "warning").otherwise("fail")
