"""Arrays, maps, structs and JSON text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_lookup(pairs: dict[str, str], key: Column) -> Column:
    """Value of a small literal map; a missing or null key gives null."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])[key]


def worked_out(value: Column) -> Column:
    """``value`` as a generated column, which Spark makes once per row.

    A plain column is pasted into every filter and column that uses it, and then made anew at each place.
    """
    return F.explode(F.array(value))


def array_to_json(value: Column) -> Column:
    return F.to_json(value)


def shared_fraction(found: Column, wanted: Column) -> Column:
    """Distinct members of ``wanted`` that were found, over all members of ``wanted``."""
    return F.size(F.array_intersect(found, wanted)) / F.size(wanted)


def parse_or_null(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})
