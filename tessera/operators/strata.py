"""Two-level stratified systematic sampling.

Level 1 shares the sample between neighbourhoods, level 2 shares each neighbourhood's
part between its listings, and the rows of a listing are then taken at even steps
through their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import settle

# Fixed value: no neighbourhood is given fewer than this many rows.
LEAST_PER_AREA = 10


def stratum_counts(keys: DataFrame, area: str, unit: str) -> DataFrame:
    """Rows per (area, unit)."""
    return keys.groupBy(area, unit).agg(F.count(F.lit(1)).alias("n_unit"))


def quotas(counts: DataFrame, area: str, unit: str, sample_size: int, least: int = LEAST_PER_AREA) -> DataFrame:
    """Quota of every (area, unit), from the counts of ``stratum_counts``.

    Area: max(least, floor(M * n_area / N)); when these add up to more than M each is
    scaled to max(least, floor(quota * (M / sum))). Unit: min(n, max(1, share of the
    area quota)). The floors may take the sample above M. Products are exact in
    bigint; only the scale factor is a double.
    """
    size = F.lit(sample_size).cast("bigint")
    areas = counts.groupBy(area).agg(F.sum("n_unit").alias("n_area"))
    all_rows = areas.select(F.sum("n_area")).scalar()
    wanted = areas.withColumn("_total", all_rows).withColumn(
        "_raw", F.greatest(F.lit(least).cast("bigint"), F.expr(f"(bigint({sample_size}) * n_area) div _total"))
    )
    asked = wanted.select(F.sum("_raw")).scalar()
    scaled = F.greatest(
        F.lit(least).cast("bigint"), F.floor(F.col("_raw") * (size.cast("double") / F.col("_asked")))
    )
    area_quota = (
        wanted.withColumn("_asked", asked)
        .withColumn("area_quota", F.when(F.col("_asked") > size, scaled).otherwise(F.col("_raw")))
        .select(area, "n_area", "area_quota")
    )
    share = F.greatest(F.lit(1).cast("bigint"), F.expr("(area_quota * n_unit) div n_area"))
    return counts.join(area_quota, area).withColumn("quota", F.least(F.col("n_unit"), share))


def ranked_slices(keys: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rank rows within groups of any size without putting a group into one task.

    Rows are range-partitioned by group and order, so a large group lies across many
    slices; the slice number is written down with each row. A row's rank is its place
    within its slice plus the group's rows in earlier slices. Returns the rows with
    their place, and per (group, slice) the offset to add; join them on
    ``[*group, "_slice"]``, which is how the rows are partitioned already.
    """
    sliced = settle(
        keys.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*group, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    place = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
    return sliced.withColumn("_place", place), offsets


def systematic_keys(
    keys: DataFrame, area: str, unit: str, order: list[str], sample_size: int, least: int = LEAST_PER_AREA
) -> DataFrame:
    """The sampled rows of a narrow key table: (area, unit, *order), order unique.

    The k-th of n rows stays when floor(k * q / n) is above floor((k - 1) * q / n),
    which keeps exactly q rows at even steps. Settles the keys and their counts, so
    the source is scanned once however wide its text is.
    """
    narrow = settle(keys.select(area, unit, *order), "sample-keys")
    counts = settle(stratum_counts(narrow, area, unit), "stratum-counts")
    shares = quotas(counts, area, unit, sample_size, least).select(area, unit, "n_unit", "quota")
    placed, offsets = ranked_slices(narrow, [area, unit], order)
    steps = offsets.join(shares, [area, unit])
    rank = F.col("_before") + F.col("_place")
    return (
        placed.join(steps, [area, unit, "_slice"])
        .withColumn("_rank", rank)
        .filter("(_rank * quota) div n_unit > ((_rank - 1) * quota) div n_unit")
        .select(area, unit, *order)
    )


def sample_rows(
    rows: DataFrame, area: str, unit: str, order: list[str], sample_size: int, least: int = LEAST_PER_AREA
) -> DataFrame:
    """The sampled rows with all their columns.

    The chosen keys are settled, so Spark broadcasts them when their files are small
    (the usual case: about ``sample_size`` rows) and the text is not shuffled.
    """
    chosen = settle(systematic_keys(rows, area, unit, order, sample_size, least), "sample-chosen")
    return rows.join(chosen, [area, unit, *order], "left_semi")


