"""Run records: one row per item and run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keep import keep_one

RECORD = "item string, status string, rows bigint, finished_at timestamp"


def append(records: DataFrame, path: str) -> None:
    """Add the records of a run to the stored table."""
    records.select("item", "status", "rows", "finished_at").write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """Latest record of every item over all stored runs."""
    return merged(spark.read.schema(RECORD).parquet(path))


def due(items: DataFrame, item: str, path: str, done: tuple[str, ...] = ("ok", "skipped")) -> DataFrame:
    """Items without a finished latest record, so that a next run goes on where the last one stopped."""
    finished = stored(items.sparkSession, path).filter(F.col("status").isin(*done))
    return items.join(finished.select(F.col("item").alias(item)), item, "left_anti")


def merged(records: DataFrame) -> DataFrame:
    """Latest record of every item over all runs."""
    return keep_one(records, ["item"], [F.col("finished_at").desc_nulls_last()])


def status_totals(records: DataFrame) -> DataFrame:
    """Items and rows per status, from the latest record of each item."""
    return (
        merged(records)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"))
    )
