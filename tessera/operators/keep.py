"""Keep-one and keep-n per key.

All of these are ``row_number() <= n`` filters over a total order. Spark plans them
with a per-task group limit before the shuffle, so a key that holds a large share of
the rows sends at most n rows per map task, not its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank_as: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in the given order, optionally with their rank."""
    place = rank_as or "_place"
    ranked = df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(place) <= n)
    return kept if rank_as else kept.drop(place)


def keep_one(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, then by a hash of the remaining columns, then by their values.

    The hash holds which columns are null, since nulls by themselves leave it unchanged. Values
    are compared only where order and hash are equal, so the choice never depends on file or
    task order. Maps have no order and take part in the hash alone.
    """
    rest = [f for f in df.schema.fields if f.name not in keys]
    names = [F.col(f"`{f.name}`") for f in rest]
    hashed = [n for n, f in zip(names, rest) if "map<" not in f.dataType.simpleString()]
    tie = [F.xxhash64(*hashed, *[n.isNull() for n in names]), *hashed] if rest else [F.lit(1)]
    return keep_first(df, keys, [*(order or []), *tie])


def last_writer_wins(df: DataFrame, key: str, file: str, position: str) -> DataFrame:
    """Upsert semantics: per key the row of the last file, and within it the last position."""
    return keep_first(df, [key], [F.col(file).desc(), F.col(position).desc()])


def first_seen(df: DataFrame, keys: list[str], type_column: str, type_order: list[str], position: str) -> DataFrame:
    """Per key the row of the earliest type in a fixed order, and within it the first position."""
    turn = F.array_position(F.array(*[F.lit(t) for t in type_order]), F.col(type_column))
    return keep_first(
        df.filter(turn > 0), keys, [turn.asc(), F.col(position).asc()]
    )


def newly_seen_counts(df: DataFrame, item: str, file: str) -> DataFrame:
    """Per file, how many items appear there first when files are read in name order.

    Files that bring nothing new are reported with 0.
    """
    debut = df.filter(F.col(item).isNotNull()).groupBy(item).agg(F.min(file).alias(file))
    fresh = debut.groupBy(file).agg(F.count(F.lit(1)).alias("new_items"))
    files = df.select(file).distinct()
    return files.join(fresh, file, "left").fillna(0, ["new_items"])


def upsert(stored: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """Stored rows with incoming rows laid over them, the highest version of a key staying."""
    both = stored.withColumn("_source", F.lit(0)).unionByName(incoming.withColumn("_source", F.lit(1)))
    return keep_one(both, [key], [F.col(version).desc_nulls_last(), F.col("_source").desc()]).drop("_source")
