"""Corpus files: scans, deduplication, incremental skip, content keys, JSON records, sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EXCLUDED = ("_ocr_cache", "_bad_txt", "processed")


def scan(spark: SparkSession, root: str, suffixes: Iterable[str] = ("txt", "md")) -> DataFrame:
    """(path, name, stem, ext, text, digest) of all text files below a folder, without excluded folders.

    Bytes that are no UTF-8 are dropped. Order by ``lower(name)`` where an order is needed.
    """
    glob = "*.{" + ",".join(suffixes) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.where(~F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(x) for x in EXCLUDED])))
    from ferrule.functions.arrow import each

    text = each(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"), "string", "content")
    return kept.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]+$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("ext"), text.alias("text"), F.md5("content").alias("digest"))


def one_per_stem(files: DataFrame, preferred: str = "md") -> DataFrame:
    """One file of each stem: a preferred suffix first, then by name."""
    w = Window.partitionBy("stem").orderBy((F.col("ext") != preferred).cast("int"), F.lower("name"), "path")
    return files.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def only(files: DataFrame, names: DataFrame) -> DataFrame:
    """Files whose stem or name is wanted: (wanted)."""
    return files.join(names, (F.col("stem") == F.col("wanted")) | (F.col("name") == F.col("wanted")), "left_semi")


def not_done(files: DataFrame, done: DataFrame, key: str = "stem") -> DataFrame:
    """Files without a result yet."""
    return files.join(done.select(key).distinct(), key, "left_anti")


def with_sidecar(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Files with the parsed JSON of the sidecar of their stem; null where there is none or it can't be read."""
    return files.join(sidecars.select("stem", F.try_parse_json("json").alias("sidecar")), "stem", "left")


def cache_key(*parts: Column) -> Column:
    """The key of a result: by the file's digest and the settings."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24)


def pages_key(all_pages: Column, n: Column, listed: Column) -> Column:
    return F.when(all_pages, F.concat(F.lit("all_"), n.cast("string"))).otherwise(F.substring(F.md5(listed), 1, 16))


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Multi-line JSON records, unreadable ones in ``_corrupt_record``; root ``items`` or, where it is missing, ``Materials``."""
    return spark.read.schema(schema + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def article_key(name: Column) -> Column:
    """The key under which two names of an article meet: without a '_fixed' at the end, signs as one dash."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"_fixed$", ""), r"[^a-z0-9]+", "-"), F.lit("-"))


def article_order(name: Column) -> list[Column]:
    """Numbers first and by value, then names."""
    n = F.regexp_extract(name, r"^([0-9]+)", 1).try_cast("bigint")
    return [n.isNull(), n, name]


def write_papers(df: DataFrame, path: str, form: str = "json") -> None:
    """A folder for each paper."""
    df.write.mode("overwrite").partitionBy("paper_id").format(form).save(path)


def write_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    """Append a snapshot; its manifest is :func:`manifest`."""
    df.withColumn("snapshot_id", F.lit(snapshot)).write.mode("append").partitionBy("snapshot_id").parquet(path)


def manifest(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("snapshot_id").agg(F.countDistinct("paper_id").alias("n_papers"), F.count("*").alias("n_rows"))
