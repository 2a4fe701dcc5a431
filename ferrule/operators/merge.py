"""Repeated extraction runs to one record: ranking, key merge, longest and first values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(runs: DataFrame, keys: Sequence[str], confidence: str, position: str) -> DataFrame:
    """``run_rank`` of each run, by confidence from the highest, of equal ones the earlier first; unknown confidence last."""
    return runs.withColumn("run_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(confidence).desc_nulls_last(), position)))


def base_and_new(rows: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """All rows of the base run, and of other runs those whose key no better run has."""
    best = F.min(rank).over(Window.partitionBy(*keys))
    return rows.withColumn("_b", best).where(F.col(rank) == F.col("_b")).drop("_b")


def longest(value: str | Column, rank: str | Column) -> Column:
    """An aggregate: the longest text, of equally long ones that of the better run."""
    v = F.col(value) if isinstance(value, str) else value
    r = F.col(rank) if isinstance(rank, str) else rank
    return F.max_by(v, F.struct(F.length(v), -r))


def first_filled(value: str, rank: str) -> Column:
    """An aggregate: the value of the best run that has one; blanks count as none."""
    filled = F.nullif(F.trim(F.col(value).cast("string")), F.lit("")).isNotNull()
    return F.min_by(F.when(filled, F.col(value)), F.when(filled, F.col(rank)))


def merged_entries(rows: DataFrame, keys: Sequence[str], map_column: str, rank: str, how: str = "longest") -> DataFrame:
    """(keys, key, value): the entries of maps united, by key the longest value or that of the best run."""
    e = rows.select(*keys, rank, F.explode(map_column).alias("key", "value"))
    if how == "first":
        e = e.where(F.nullif(F.trim(F.col("value").cast("string")), F.lit("")).isNotNull())
        return e.groupBy(*keys, "key").agg(F.min_by("value", rank).alias("value"))
    return e.groupBy(*keys, "key").agg(longest("value", rank).alias("value"))


def appended(rows: DataFrame, signature: Sequence[str], rank: str, base: int = 1) -> DataFrame:
    """Rows of the base run as they are, and of each new signature the first row of the best other run."""
    own = rows.where(F.col(rank) == base)
    others = rows.where(F.col(rank) > base)
    cond = [F.col(f"o.{c}").eqNullSafe(F.col(f"b.{c}")) for c in signature]
    new = others.alias("o").join(own.select(*signature).distinct().alias("b"), cond, "left_anti")
    new = new.withColumn("_r", F.row_number().over(Window.partitionBy(*signature).orderBy(rank))).where("_r = 1").drop("_r")
    return own.unionByName(new)
