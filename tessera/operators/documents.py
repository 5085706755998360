"""Find and group over document tables (places, neighbourhood boundaries)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(*predicates: Column | None) -> Column | None:
    """Conjunction of the predicates that are given; none when all are None."""
    given = [p for p in predicates if p is not None]
    return reduce(lambda a, b: a & b, given) if given else None


def find(
    documents: DataFrame,
    where: Column | None = None,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    sort: list[tuple[str, int]] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Documents that satisfy a predicate, sorted; all of them, or the first ``limit`` (one at least).

    Sort directions are 1 and -1; missing values sort first ascending and last
    descending. Either the included columns are kept or the excluded ones dropped.
    """
    found = documents if where is None else documents.filter(where)
    if sort:
        found = found.orderBy(
            *[F.col(c).asc_nulls_first() if way > 0 else F.col(c).desc_nulls_last() for c, way in sort]
        )
    if limit is not None:
        found = found.limit(max(1, int(limit)))
    if include:
        return found.select(*include)
    return found.drop(*exclude) if exclude else found


def group(
    documents: DataFrame,
    by: str,
    measures: dict[str, Column],
    where: Column | None = None,
    sort: list[tuple[str, int]] | None = None,
) -> DataFrame:
    """Match, group and sort: ``measures`` maps result names to aggregates."""
    chosen = documents if where is None else documents.filter(where)
    grouped = chosen.groupBy(by).agg(*[m.alias(name) for name, m in measures.items()])
    if not sort:
        return grouped
    return grouped.orderBy(*[F.col(c).asc_nulls_first() if way > 0 else F.col(c).desc_nulls_last() for c, way in sort])


def places_find(
    places: DataFrame,
    place_type: str | None = None,
    borough: str | None = None,
    neighbourhood: str | None = None,
    min_rating: float | None = None,
    rated_only: bool = False,
    **options,
) -> DataFrame:
    """``find`` with the usual predicates on places; ``place_type`` matches any entry of ``types``."""
    where = all_of(
        None if place_type is None else F.array_contains("types", place_type),
        None if borough is None else F.col("borough") == borough,
        None if neighbourhood is None else F.col("neighbourhood") == neighbourhood,
        F.col("rating").isNotNull() if rated_only else None,
        None if min_rating is None else F.col("rating") > min_rating,
    )
    return find(places, where, **options)


def places_group(places: DataFrame, by: str, place_type: str | None = None, rated_only: bool = True) -> DataFrame:
    """Mean rating and number of places per group, best first."""
    where = all_of(
        None if place_type is None else F.array_contains("types", place_type),
        F.col("rating").isNotNull() if rated_only else None,
    )
    measures = {"avg_rating": F.avg("rating"), "place_count": F.count(F.lit(1))}
    return group(places, by, measures, where, [("avg_rating", -1), (by, 1)])
