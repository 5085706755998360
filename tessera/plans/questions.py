"""The question bank over the star schema, as DataFrame plans.

Measures are reduced to the key of a dimension before the dimension is joined, so
that only groups, not rows, meet it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.documents import places_find, places_group
from tessera.operators.keep import keep_first
from tessera.operators.lookback import lookback_means

Tables = Mapping[str, DataFrame]


def _rows() -> Column:
    return F.count(F.lit(1))


def _parts(*measures: str) -> list[Column]:
    """Sum and count of each measure, from which a mean of any coarser group follows."""
    return [c for m in measures for c in (F.sum(m).alias(f"_sum_{m}"), F.count(m).alias(f"_n_{m}"))]


def _mean(measure: str) -> Column:
    return F.sum(f"_sum_{measure}") / F.nullif(F.sum(f"_n_{measure}"), F.lit(0))


def _by_borough(t: Tables, *measures: str) -> DataFrame:
    """Listing measures reduced per neighbourhood, with the borough attached."""
    per_area = t["dim_listing"].groupBy("neighbourhood_id").agg(_rows().alias("_listings"), *_parts(*measures))
    return per_area.join(t["dim_neighbourhood"].select("neighbourhood_id", "borough"), "neighbourhood_id")


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; null when either measure does not vary."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def listing_count(t: Tables) -> DataFrame:
    return t["dim_listing"].agg(_rows().alias("listings"))


def mean_score(t: Tables) -> DataFrame:
    return t["dim_listing"].agg(F.avg("review_scores_rating").alias("avg_score"))


def top_places(places: DataFrame, place_type: str, borough: str, n: int = 5) -> DataFrame:
    return places_find(
        places,
        place_type=place_type,
        borough=borough,
        include=["place_id", "name", "neighbourhood", "rating"],
        sort=[("rating", -1), ("place_id", 1)],
        limit=n,
    )


def superhost_count(t: Tables) -> DataFrame:
    return t["dim_host"].filter("host_is_superhost").agg(_rows().alias("superhosts"))


def occupancy_by_borough(t: Tables) -> DataFrame:
    """Mean occupied days of the last 365 per borough, and the same as a ratio."""
    days = _mean("estimated_occupancy_l365d")
    return (
        _by_borough(t, "estimated_occupancy_l365d")
        .groupBy("borough")
        .agg(F.sum("_listings").alias("listings"), days.alias("avg_days"), (days / 365).alias("avg_ratio"))
        .orderBy(F.col("avg_days").desc())
    )


def rating_by_borough(places: DataFrame, place_type: str) -> DataFrame:
    return places_group(places, "borough", place_type)


def score_by_room_type(t: Tables) -> DataFrame:
    return (
        t["dim_listing"]
        .groupBy("room_type")
        .agg(_rows().alias("listings"), F.avg("review_scores_rating").alias("avg_score"))
        .orderBy(F.col("avg_score").desc())
    )


def peak_months(t: Tables, n: int = 3) -> DataFrame:
    """The ``n`` months with most complaints in the borough that has most of them overall."""
    monthly = t["noise_borough_month"].groupBy("borough", "month").agg(F.sum("complaint_count").alias("complaints"))
    totals = monthly.groupBy("borough").agg(F.sum("complaints").alias("borough_total"))
    loudest = totals.orderBy(F.col("borough_total").desc(), "borough").limit(1)
    peaks = keep_first(
        monthly.join(loudest, "borough"), ["borough"], [F.col("complaints").desc(), F.col("month")], n, "place"
    )
    return peaks.select("borough", "borough_total", "month", "complaints", "place")


def occupancy_by_bookable(t: Tables) -> DataFrame:
    """Listings without the flag are a group of their own."""
    return (
        t["dim_listing"]
        .groupBy("instant_bookable")
        .agg(_rows().alias("listings"), F.avg("estimated_occupancy_l365d").alias("avg_days"))
    )


def reviews_by_date(t: Tables) -> DataFrame:
    return t["fact_review"].groupBy("date_id").agg(_rows().alias("_reviews"))


def mean_monthly_reviews(t: Tables) -> DataFrame:
    dated = reviews_by_date(t).join(t["dim_date"].select("date_id", "year", "month", "month_name"), "date_id")
    per_month = dated.groupBy("year", "month", "month_name").agg(F.sum("_reviews").alias("_reviews"))
    return (
        per_month.groupBy("month", "month_name")
        .agg(F.avg("_reviews").alias("avg_reviews"), _rows().alias("years"))
        .orderBy(F.col("avg_reviews").desc())
    )


def density_and_score(t: Tables, places: DataFrame, place_type: str) -> DataFrame:
    """Places of a type per borough, beside listings and their mean score."""
    found = (
        places.filter(F.array_contains("types", place_type))
        .groupBy("borough")
        .agg(_rows().alias("places"), F.avg("rating").alias("avg_rating"))
    )
    scored = (
        _by_borough(t, "review_scores_rating")
        .groupBy("borough")
        .agg(F.sum("_listings").alias("listings"), _mean("review_scores_rating").alias("avg_score"))
    )
    return (
        found.join(scored, "borough")
        .withColumn("places_per_100_listings", F.col("places") * 100.0 / F.col("listings"))
        .orderBy(F.col("places").desc())
    )


def poi_and_score(t: Tables) -> DataFrame:
    """Points of interest and mean score per neighbourhood, with their correlation over all of them."""
    scored = t["dim_listing"].groupBy("neighbourhood_id").agg(F.avg("review_scores_rating").alias("avg_score"))
    rows = t["dim_neighbourhood"].join(scored, "neighbourhood_id").filter(F.col("avg_score").isNotNull())
    related = rows.select(correlation("poi_total", "avg_score")).scalar()
    return rows.select("neighbourhood", "borough", "poi_total", "avg_score", related.alias("correlation"))


def reviews_by_season(t: Tables) -> DataFrame:
    dated = reviews_by_date(t).join(t["dim_date"].select("date_id", "season"), "date_id")
    return dated.groupBy("season").agg(F.sum("_reviews").alias("reviews")).orderBy(F.col("reviews").desc())


def superhost_comparison(t: Tables) -> DataFrame:
    """Occupancy and score of listings by whether their host is a superhost; unknown is its own group."""
    measures = ("estimated_occupancy_l365d", "review_scores_rating")
    per_host = t["dim_listing"].groupBy("host_id").agg(_rows().alias("_listings"), *_parts(*measures))
    return (
        per_host.join(t["dim_host"].select("host_id", "host_is_superhost"), "host_id")
        .groupBy("host_is_superhost")
        .agg(
            F.sum("_listings").alias("listings"),
            _mean("estimated_occupancy_l365d").alias("avg_days"),
            _mean("review_scores_rating").alias("avg_score"),
        )
    )


def complaints_and_score(t: Tables) -> DataFrame:
    """Complaints (from the monthly table, never from the fact) and mean score per borough, with correlation."""
    noise = t["noise_borough_month"].groupBy("borough").agg(F.sum("complaint_count").alias("complaints"))
    scored = (
        _by_borough(t, "review_scores_rating")
        .groupBy("borough")
        .agg(F.sum("_listings").alias("listings"), _mean("review_scores_rating").alias("avg_score"))
    )
    rows = noise.join(scored, "borough").withColumn(
        "complaints_per_listing", F.col("complaints") / F.col("listings")
    )
    related = rows.select(correlation("complaints_per_listing", "avg_score")).scalar()
    return rows.select("borough", "complaints", "listings", "complaints_per_listing", "avg_score", related.alias("correlation"))


def best_value(t: Tables, places: DataFrame, transit_type: str) -> DataFrame:
    """Neighbourhoods by the sum of their ranks in score (high), minimum nights (low) and transit (high)."""
    listed = t["dim_listing"].groupBy("neighbourhood_id").agg(
        F.avg("review_scores_rating").alias("avg_score"), F.avg("minimum_nights").alias("avg_nights")
    )
    transit = (
        places.filter(F.array_contains("types", transit_type))
        .groupBy("neighbourhood", "borough")
        .agg(_rows().alias("transit_places"))
    )
    rows = (
        t["dim_neighbourhood"]
        .select("neighbourhood_id", "neighbourhood", "borough")
        .join(listed, "neighbourhood_id")
        .join(transit, ["neighbourhood", "borough"], "left")
        .fillna(0, ["transit_places"])
        .drop("neighbourhood_id")
    )
    # one row per neighbourhood from here on, so a window over all of them is small
    ranked = rows.withColumns(
        {
            "score_rank": F.rank().over(Window.orderBy(F.col("avg_score").desc_nulls_last())),
            "nights_rank": F.rank().over(Window.orderBy(F.col("avg_nights").asc_nulls_last())),
            "transit_rank": F.rank().over(Window.orderBy(F.col("transit_places").desc())),
        }
    )
    return ranked.withColumn("value_rank", F.col("score_rank") + F.col("nights_rank") + F.col("transit_rank")).orderBy(
        "value_rank", "borough", "neighbourhood"
    )


def reviews_by_weather(t: Tables, wet: list[float], warm: list[float]) -> DataFrame:
    """Reviews by bands of the mean rain and temperature of the ten days before them.

    ``wet`` and ``warm`` are ascending band edges. Every review of a day has the same
    ten days, so bands are found per day and reviews counted per day: the bridge of
    ten rows per review is not built for this.
    """
    means = lookback_means(t["weather"], "weather_date", "review_date", ["precipitation_sum", "temperature_max"])
    daily = t["fact_review"].groupBy("review_date").agg(_rows().alias("_reviews"))
    banded = daily.join(means, "review_date").select(
        band(F.col("precipitation_sum"), wet).alias("rain_band"),
        band(F.col("temperature_max"), warm).alias("temperature_band"),
        "_reviews",
    )
    return banded.groupBy("rain_band", "temperature_band").agg(
        F.sum("_reviews").alias("reviews"), _rows().alias("days")
    )


def band(value: Column, edges: list[float]) -> Column:
    """Number of edges at or below the value; null stays null.

    The value is rounded to nine digits first, so that a mean that falls on an edge
    lands on the same side whatever order it was summed in.
    """
    steps = ((F.round(value, 9) >= F.lit(e)).cast("int") for e in edges)
    return F.when(value.isNotNull(), sum(steps, F.lit(0)))
