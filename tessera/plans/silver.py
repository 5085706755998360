"""Cleaned tables: typed, filtered on their keys, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import casts
from tessera.functions.nested import literal_lookup, worked_out
from tessera.operators.keep import keep_one

# Borough names as complaints write them and as listings write them.
BOROUGHS = {
    "MANHATTAN": "Manhattan",
    "BROOKLYN": "Brooklyn",
    "QUEENS": "Queens",
    "BRONX": "Bronx",
    "STATEN ISLAND": "Staten Island",
}

SCORES = [
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
]


def clean_listings(raw: DataFrame) -> DataFrame:
    """33 typed columns of the all-text listing scan, one row per listing.

    Rows without a listing or host id are dropped.
    """
    text = {
        "host_name": "host_name",
        "host_response_time": "host_response_time",
        "neighbourhood": "neighbourhood_cleansed",
        "borough": "neighbourhood_group_cleansed",
        "room_type": "room_type",
        "property_type": "property_type",
    }
    whole = [
        "host_total_listings_count",
        "accommodates",
        "bedrooms",
        "beds",
        "minimum_nights",
        "estimated_occupancy_l365d",
        "number_of_reviews",
    ]
    typed = raw.select(
        casts.to_whole_long("id").alias("listing_id"),
        casts.to_whole_long("host_id").alias("host_id"),
        *[F.col(source).alias(name) for name, source in text.items()],
        *[casts.to_date(c).alias(c) for c in ("host_since", "first_review", "last_review")],
        *[casts.flag(c).alias(c) for c in ("host_is_superhost", "host_identity_verified", "instant_bookable")],
        *[casts.percent(c).alias(c) for c in ("host_response_rate", "host_acceptance_rate")],
        *[casts.to_int(c).alias(c) for c in whole],
        *[casts.to_double(c).alias(c) for c in ("latitude", "longitude", *SCORES)],
        casts.first_number("bathrooms_text").alias("bathrooms"),
    )
    keyed = typed.filter(F.col("listing_id").isNotNull() & F.col("host_id").isNotNull())
    return keep_one(keyed, ["listing_id"], [F.col("last_review").desc_nulls_last(), F.col("number_of_reviews").desc_nulls_last()])


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Distinct (listing_id, review_date); two guests on one day are one row."""
    return (
        raw.select(casts.to_whole_long("listing_id").alias("listing_id"), casts.to_date("date").alias("review_date"))
        .filter(F.col("listing_id").isNotNull() & F.col("review_date").isNotNull())
        .distinct()
    )


def clean_weather(raw: DataFrame) -> DataFrame:
    measures = ["temperature_max", "temperature_min", "precipitation_sum", "windspeed_max"]
    return raw.select(
        F.col("weather_date").try_cast("date").alias("weather_date"),
        *[F.col(m).try_cast("double").alias(m) for m in measures],
        F.col("weathercode").try_cast("double").try_cast("int").alias("weathercode"),
    ).filter(F.col("weather_date").isNotNull())


def clean_complaints(raw: DataFrame, boroughs: dict[str, str] = BOROUGHS, unique: bool = False) -> DataFrame:
    """Complaints with a readable date and a known borough.

    ``unique`` also drops repeats of a complaint key, which overlapping pulls bring.
    """
    date = casts.iso_millis_to_date("created_date").alias("date")
    borough = literal_lookup(boroughs, F.upper("borough")).alias("borough")
    rows = raw.withColumn("_read", worked_out(F.struct(date, borough))).select(
        "unique_key",
        F.col("_read.date").alias("complaint_date"),
        F.col("_read.borough").alias("borough"),
        "complaint_type",
        "descriptor",
        casts.to_double("latitude").alias("latitude"),
        casts.to_double("longitude").alias("longitude"),
    ).filter(F.col("complaint_date").isNotNull() & F.col("borough").isNotNull())
    dated = rows.withColumn("year", F.year("complaint_date")).withColumn("month", F.month("complaint_date"))
    return keep_one(dated, ["unique_key"], [F.col("complaint_date").desc()]) if unique else dated


def clean_places(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        "neighbourhood",
        "place_type",
        "place_id",
        "name",
        *[F.col(c).try_cast("double").alias(c) for c in ("rating", "lat", "lng")],
    ).filter(F.col("place_id").isNotNull())
    return keep_one(rows, ["neighbourhood", "place_type", "place_id"], [F.col("name").asc_nulls_last()])
