"""Detections as a stream: new result rows keep a per-tile summary up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_results(spark: SparkSession, folder: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Detections of Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def fresh(results: DataFrame, key: str = "detection_id", at: str = "detected_at", late: str = "30 days") -> DataFrame:
    """Each detection once: a row delivered again within `late` is dropped, and so is one that comes later than that."""
    typed = results.withColumn(at, F.col(at).cast("timestamp"))
    return typed.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def daily_areas(results: DataFrame, at: str = "detected_at") -> DataFrame:
    """(window, tile_id, polygon_count, total_area_m2) per day and tile of a stream with a watermark."""
    return results.groupBy(F.window(at, "1 day"), "tile_id").agg(F.count("*").alias("polygon_count"), F.sum("area_m2").alias("total_area_m2"))


def keep_summary(results: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Writes each micro-batch's per-tile counts and areas under its number, so a repeated batch replaces itself; `summary` adds them up."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.groupBy("tile_id").agg(F.count("*").alias("polygon_count"), F.sum("area_m2").alias("total_area_m2"))
        rows.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def summary(spark: SparkSession, folder: str) -> DataFrame:
    """Per-tile counts and areas over all batches so far."""
    return spark.read.parquet(folder).groupBy("tile_id").agg(F.sum("polygon_count").alias("polygon_count"), F.sum("total_area_m2").alias("total_area_m2"))
