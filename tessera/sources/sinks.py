"""Writers. Row counts come from the write itself, not from a second scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.nested import array_to_json
from tessera.operators.keep import keep_one


def write_parquet(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Overwrite ``path`` and continue from the written files; also the rows written.

    With ``sort_by`` files hold ranges in that order, so a filter on the first of these columns skips
    files and row groups by their statistics. Ranges split a hot value by the later columns.
    """
    seen = Observation()
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def arrays_as_json(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, for stores without array types."""
    return df.select(
        *[
            array_to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def publish(
    df: DataFrame,
    table: str,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    buckets: int = 0,
    bucket_by: list[str] | None = None,
) -> int:
    """Replace a table and return the rows written.

    Goes to the catalog, or with ``jdbc`` options (url, driver, user, ...) to a database
    through parallel connections; list columns become JSON text there. Catalog tables
    that are joined on one key again and again can be bucketed and sorted by it, which
    spares those joins their shuffle.
    """
    seen = Observation()
    out = arrays_as_json(df) if jdbc else df
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if jdbc:
        writer.format("jdbc").options(**{"batchsize": "10000", **jdbc}).option("dbtable", table).save()
        return seen.get["rows"]
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return seen.get["rows"]


def reload_published(spark: SparkSession, gold_path: str, tables: list[str], prefix: str = "", jdbc=None) -> dict[str, int]:
    """Publish gold Parquet folders again, in the given order (dimensions first)."""
    return {t: publish(spark.read.parquet(f"{gold_path}/{t}"), prefix + t, jdbc=jdbc) for t in tables}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) in one plan."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def write_index(documents: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Rebuild a vector index: one row per id stays, and the stored count is returned."""
    return write_parquet(keep_one(documents, ["id"]), path)
