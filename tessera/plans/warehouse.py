"""SQL over the published star schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import gold
from tessera.plans.guard import guarded

# What is published: the star schema and the daily weather.
STAR_TABLES = (*gold.LOAD_ORDER, "weather")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query_views(
    spark: SparkSession, sql: str, limit: int | None = None, tables: Iterable[str] = STAR_TABLES
) -> DataFrame:
    """Run one query over the published views: all rows, or the first ``limit`` (one at least).

    The text is checked as ``guard`` describes before it runs, and refused with ``guard.Refused``. The cap lies
    over the whole query, so a larger LIMIT inside does not lift it.
    """
    rows = guarded(spark, sql, tables)
    return rows if limit is None else rows.limit(max(1, int(limit)))
