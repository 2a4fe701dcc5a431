"""Incremental ingest with Structured Streaming: new files only, windows with late data, and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of files that arrive in a folder; the checkpoint remembers those that are done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(folder)


def windowed_counts(events: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """Counts by window and key; rows later than ``late`` are left out of closed windows."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n")


def upsert_latest(stream: DataFrame, target: str, key: list[str], order: list[str], checkpoint: str) -> StreamingQuery:
    """Keep the latest row of each key in Parquet; each batch reads the last version and writes the next, so it can be run again."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        last = f"{target}/v={epoch - 1}"
        path = spark._jvm.org.apache.hadoop.fs.Path(last)
        # Only a version that was never written is nothing; one that can't be read is an error, and the batch comes again.
        exists = epoch > 0 and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        before = spark.read.parquet(last) if exists else None
        rows = batch if before is None else before.unionByName(batch)
        w = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").write.mode("overwrite").parquet(f"{target}/v={epoch}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
