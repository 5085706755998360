"""Registration of queries, each with its DuckDB twin.

Results are shown in a form both engines share: dates as text, whole numbers as
bigint, doubles to six digits, string arrays joined by "|".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import warehouse
from tessera.workload import roles
from tessera.workload.oracle import with_roles

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """The shared form of a result."""
    def shown(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType)):
            column = column.cast("string")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "|")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` may use the role names of the oracle."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return present(build(spark, sf))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_roles(sql)
        return build

    return register


def star_query(name: str, sql: str):
    """A query whose builder takes the star schema."""
    def register(build):
        query(name, sql)(lambda spark, sf: build(roles.star(spark, sf)))
        return build

    return register


def sql_query(name: str, statement: str, oracle: str, limit: int | None = None):
    def run(spark, sf):
        warehouse.register_views(roles.star(spark, sf))
        return warehouse.query_views(spark, statement, limit)

    query(name, oracle)(run)
