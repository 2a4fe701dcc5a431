"""The row before, within hot groups too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrule.session import cut


def with_previous(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: ``value`` of the row before by ``order`` in the same ``group``, null for the first.

    Rows are range-partitioned by group and order, so that a group holding a third of all rows is spread over
    many tasks; each range finds its own predecessors, and the one row at each range's start takes the last of
    the group's range before. The table of range ends has at most one row for each range and group that spans it.
    ``order`` must tell rows of a group apart. Nulls sort first.
    """
    # Written once: the number of a row's range must be the same in both uses below.
    ranged = cut(df.repartitionByRange(*([partitions] if partitions else []), *group, *order).withColumn("_range", F.spark_partition_id()))
    within = Window.partitionBy("_range", *group).orderBy(*order)
    rows = ranged.withColumn(name, F.lag(value).over(within)).withColumn("_first", F.row_number().over(within) == 1)
    ends = ranged.groupBy("_range", *group).agg(F.max_by(F.col(value), F.struct(*order)).alias("_last"))
    ends = ends.withColumn("_before", F.lag("_last").over(Window.partitionBy(*group).orderBy("_range"))).where(F.col("_before").isNotNull())
    on = (F.col("l._range") == F.col("r._range")) & F.col("l._first")
    for g in group:
        on = on & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    joined = rows.alias("l").join(ends.select("_range", *group, "_before").alias("r"), on, "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], F.coalesce(F.col(f"l.{name}"), F.col("r._before")).alias(name))
