"""Structured Streaming variants of the trail operators: an addition beyond the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.trails import upsert


def latest_status(entries: DataFrame, key: str = "trail_id") -> DataFrame:
    """Latest status of each key of a stream; run with output mode ``update`` or ``complete``.  The state is one row a key."""
    return entries.where("entry_type = 'status'").groupBy(key).agg(F.max_by(F.struct("value", "created_at"), F.struct("created_at", "id")).alias("e")).select(key, "e.*")


def hourly_entries(entries: DataFrame, late: str = "1 hour") -> DataFrame:
    """Entries by hour and kind; those later than ``late`` are left out once their hour is closed."""
    return entries.withWatermark("created_at", late).groupBy(F.window("created_at", "1 hour"), "entry_type").agg(F.count("*").alias("n"))


def upsert_sink(path: str, *keys: str):
    """A foreachBatch function that keeps the newest row of each key in a table folder, one generation a batch."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{path}/{number - 1}") if number else batch.limit(0)
        upsert(old, batch, *keys).write.mode("overwrite").parquet(f"{path}/{number}")

    return write
