"""All registered queries and their twins, in the order of the modules below."""

from __future__ import annotations

from tessera.workload import (  # noqa: F401
    source_queries,
    cleaning_queries,
    star_queries,
    space_queries,
    sql_queries,
    sampling_queries,
    search_queries,
    scoring_queries,
    question_queries,
)
from tessera.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
