"""The star schema, its bridge, lookups and keep-one operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import keep, lookup
from tessera.plans import gold
from tessera.workload import roles
from tessera.workload.registry import query


@query(
    "dim_date",
    """SELECT full_date::VARCHAR AS full_date, date_id, year, month, month_name, quarter, day_of_week, day_name, is_weekend, season
    FROM dim_date""",
)
def dim_date(spark, sf):
    return gold.dim_date(roles.reviews(spark, sf))


@query("poi_counts", "SELECT neighbourhood, place_type, count(DISTINCT place_id) AS places FROM place GROUP BY 1, 2")
def poi_counts(spark, sf):
    return gold.poi_counts(roles.clean_places(spark, sf))


@query("dim_neighbourhood", "SELECT * FROM dim_neighbourhood")
def dim_neighbourhood(spark, sf):
    return gold.dim_neighbourhood(roles.listings(spark, sf), roles.clean_places(spark, sf), roles.PLACE_TYPES)


@query(
    "dim_host",
    """SELECT host_id, host_name, host_since::VARCHAR AS host_since, host_is_superhost, host_response_time,
        host_response_rate, host_acceptance_rate, host_total_listings_count, host_identity_verified FROM dim_host""",
)
def dim_host(spark, sf):
    return gold.dim_host(roles.listings(spark, sf))


@query(
    "dim_listing",
    """SELECT listing_id, host_id, neighbourhood_id, room_type, property_type, accommodates, bedrooms, beds, bathrooms,
        minimum_nights, estimated_occupancy_l365d, instant_bookable, review_scores_rating, review_scores_accuracy,
        review_scores_cleanliness, review_scores_checkin, review_scores_communication, review_scores_location,
        review_scores_value, first_review::VARCHAR AS first_review, last_review::VARCHAR AS last_review, number_of_reviews,
        latitude, longitude FROM dim_listing""",
)
def dim_listing(spark, sf):
    return roles.star_plans(spark, sf)["dim_listing"]


@query(
    "noise_borough_month",
    "SELECT borough, year, month, complaint_count, array_to_string(complaint_types, '|') AS complaint_types FROM noise",
)
def noise_borough_month(spark, sf):
    return gold.noise_borough_month(roles.complaints(spark, sf))


@query(
    "fact_review",
    "SELECT review_id, listing_id, host_id, neighbourhood_id, date_id, review_date::VARCHAR AS review_date, complaint_count FROM fact_review",
)
def fact_review(spark, sf):
    return roles.star_plans(spark, sf)["fact_review"]


@query(
    "lookback_bridge",
    """SELECT review_id, weather_date::VARCHAR AS weather_date, days_before_review, temperature_max, temperature_min,
        precipitation_sum, windspeed_max, weathercode FROM bridge""",
)
def lookback_bridge(spark, sf):
    """Every review with the ten days of weather before it."""
    return roles.star_plans(spark, sf)["fact_review_weather"]


@query(
    "dimension_keys",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, count(*) AS row_count, count(DISTINCT {key}) AS keys, 0::BIGINT AS duplicated FROM {name}"
        for name, key in gold.DIMENSION_KEYS.items()
    ),
)
def dimension_keys(spark, sf):
    """Rows, keys and keys that occur more than once, per dimension."""
    star = roles.star(spark, sf)
    return gold.key_report({name: star[name] for name in gold.DIMENSION_KEYS})


@query("lookup_default", "SELECT doc_id, coalesce(quality::VARCHAR, 'Unknown') AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def lookup_default(spark, sf):
    table = roles.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return lookup.lookup_or_default(roles.table(spark, sf, "documents").select("doc_id"), table, "doc_id", "quality")


@query(
    "dedupe_keep_one",
    """SELECT o_custkey, o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def dedupe_keep_one(spark, sf):
    """Newest row per key; remaining columns break ties."""
    rows = roles.table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return keep.keep_one(rows, ["o_custkey"], [F.col("day").desc(), F.col("o_orderkey")])


@query(
    "upsert_last_wins",
    """SELECT place_id, file, position, name FROM place_hit
    QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY file DESC, position DESC) = 1""",
)
def upsert_last_wins(spark, sf):
    """A place found from two files keeps the row of the later file."""
    hits = roles.place_hits(spark, sf).select("place_id", "file", "position", "name")
    return keep.last_writer_wins(hits, "place_id", "file", "position")


@query(
    "first_seen_dedupe",
    f"""SELECT file, vicinity, place_type, position FROM (
        SELECT h.*, p_brand AS vicinity, list_position({roles.PLACE_TYPES}, h.place_type) AS turn
        FROM place_hit h JOIN part ON h.place_id = 'place-' || p_partkey)
    QUALIFY row_number() OVER (PARTITION BY file, vicinity ORDER BY turn, position) = 1""",
)
def first_seen_dedupe(spark, sf):
    """Per file and street the hit of the earliest type, types taken in a fixed order."""
    brands = roles.table(spark, sf, "part").select(
        F.concat(F.lit("place-"), F.col("p_partkey").cast("string")).alias("place_id"), F.col("p_brand").alias("vicinity")
    )
    hits = roles.place_hits(spark, sf).join(brands, "place_id").select("file", "vicinity", "place_type", "position")
    return keep.first_seen(hits, ["file", "vicinity"], "place_type", roles.PLACE_TYPES, "position")


@query(
    "new_global_unique",
    """SELECT file, count(DISTINCT place_id) FILTER (file = debut)::BIGINT AS new_items
    FROM (SELECT *, min(file) OVER (PARTITION BY place_id) AS debut FROM place_hit) GROUP BY 1""",
)
def new_global_unique(spark, sf):
    return keep.newly_seen_counts(roles.place_hits(spark, sf), "place_id", "file")


@query(
    "coverage_counts",
    "SELECT count(DISTINCT place_id) AS places, count(DISTINCT file) AS neighbourhoods, count(*) AS hits FROM place_hit",
)
def coverage_counts(spark, sf):
    return roles.place_hits(spark, sf).agg(
        F.countDistinct("place_id").alias("places"),
        F.countDistinct("file").alias("neighbourhoods"),
        F.count(F.lit(1)).alias("hits"),
    )
