"""Lookups by equi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_or_default(df: DataFrame, table: DataFrame, key: str, value: str, default: str = "Unknown") -> DataFrame:
    """``value`` of ``table`` by ``key``, or the default where the key is absent or the value null.

    No broadcast hint: Spark broadcasts the table when its size allows and otherwise
    joins by shuffle with adaptive skew splitting.
    """
    small = table.select(key, value)
    return df.join(small, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def pending(items: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Items that the manifest does not list yet."""
    return items.join(manifest.select(key).distinct(), key, "left_anti")
