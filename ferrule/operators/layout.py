"""Relations between layout blocks: containment, overlap, best matches, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NOISE_LABELS = ("header", "footer", "number", "page_number", "aside_text", "header_image", "footer_image", "footnote")


def area(b: Column) -> Column:
    """The area of a box [x0, y0, x1, y1], 0 where it is turned around."""
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def shared(a: Column, b: Column) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def inside(a: Column, b: Column, margin: float = 4.0) -> Column:
    return (a[0] >= b[0] - margin) & (a[1] >= b[1] - margin) & (a[2] <= b[2] + margin) & (a[3] <= b[3] + margin)


def iou(a: Column, b: Column) -> Column:
    union = area(a) + area(b) - shared(a, b)
    return F.when(union > 0, shared(a, b) / union).otherwise(0.0)


def not_within(items: DataFrame, containers: DataFrame, droppable: Column, overlap: float = 0.6) -> DataFrame:
    """``items`` without droppable ones inside a container of their page or overlapping one; items without a box stay.

    An anti-join on paper and page with the boxes as residual, so no Cartesian product.
    """
    c = containers.select(F.col("paper_id").alias("_p"), F.col("page").alias("_g"), F.col("bbox").alias("_b")).where("_b is not null")
    hit = inside(F.col("bbox"), F.col("_b")) | ((area(F.col("bbox")) > 0) & (shared(F.col("bbox"), F.col("_b")) >= overlap * area(F.col("bbox"))))
    on = (F.col("paper_id") == F.col("_p")) & (F.col("page") == F.col("_g")) & droppable & F.col("bbox").isNotNull() & hit
    return items.join(c, on, "left_anti")


def best_region(items: DataFrame, regions: DataFrame, key: str, least_iou: float = 0.1, least_area: float = 4000.0) -> DataFrame:
    """(key, region_no, iou): of each item the region of its page and class that overlaps most; of equal ones the first."""
    large = items.where(area(F.col("bbox")) >= least_area)
    j = large.alias("i").join(regions.alias("r"), (F.col("i.paper_id") == F.col("r.paper_id")) & (F.col("i.page") == F.col("r.page")) & (F.col("i.typer") == F.col("r.typer")))
    scored = j.select(F.col(f"i.{key}").alias(key), "r.region_no", iou(F.col("i.bbox"), F.col("r.bbox")).alias("iou")).where(F.col("iou") > least_iou)
    return scored.groupBy(key).agg(F.max(F.struct("iou", (-F.col("region_no")).alias("n"))).alias("m")).select(key, (-F.col("m.n")).alias("region_no"), "m.iou")


def confidence_policy(items: DataFrame, policy: str, least: float) -> DataFrame:
    """Paragraphs below a confidence dropped, marked, or left alone; an unknown confidence passes."""
    low = (F.col("typer") == "paragraph") & F.coalesce(F.col("confidence") < least, F.lit(False))
    if policy == "drop":
        return items.where(~low)
    return items.withColumn("text", F.when(low, F.concat(F.lit("[low confidence] "), F.col("text"))).otherwise(F.col("text"))) if policy == "tag" else items


def _mean4(x: Column) -> Column:
    """The mean to four places, rounded half up in whole millionths, so that no order of summing shows."""
    n, s = F.count(x), F.sum(F.round(x * 1_000_000).cast("bigint"))
    return F.when(n > 0, F.floor((s * 20_000 + n * 1_000_000) / (n * 2_000_000).cast("decimal(20,0)")) / 10_000.0)


def quality_report(items: DataFrame, least: float) -> DataFrame:
    """By paper: mean confidence, pages with a block below ``least``, and blocks by kind."""
    low = F.col("confidence") < least
    return items.groupBy("paper_id").agg(_mean4(F.col("confidence")).alias("avg_confidence"), F.countDistinct(F.when(low, F.col("page"))).alias("low_pages"), F.count_if(F.col("typer") == "table").alias("tables"), F.count_if(F.col("typer") == "paragraph").alias("paragraphs"), F.count_if(F.col("block_label").isin(*NOISE_LABELS)).alias("noise_blocks"))


def numbered_tables(items: DataFrame) -> DataFrame:
    """(item_no, paper_id, page, n): tables numbered within their page, as their export files are."""
    w = Window.partitionBy("paper_id", "page").orderBy("pos", "item_no")
    return items.where("typer = 'table'").select("item_no", "paper_id", "page", F.row_number().over(w).alias("n"))
