"""Statements and frames that several groups of queries use."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import search
from tessera.sources import landing, readers
from tessera.workload import roles
from tessera.workload.roles import ARTICLE_WORDS

LISTING_SQL = """
    SELECT listing_id, host_id, host_name, host_since::VARCHAR AS host_since, host_is_superhost, host_response_time,
        round(host_response_rate, 6) AS host_response_rate, round(host_acceptance_rate, 6) AS host_acceptance_rate,
        host_total_listings_count, host_identity_verified, neighbourhood, borough, round(latitude, 6) AS latitude,
        round(longitude, 6) AS longitude, room_type, property_type, accommodates, bedrooms, beds,
        round(bathrooms, 6) AS bathrooms, minimum_nights, estimated_occupancy_l365d, instant_bookable,
        round(review_scores_rating, 6) AS review_scores_rating, round(review_scores_accuracy, 6) AS review_scores_accuracy,
        round(review_scores_cleanliness, 6) AS review_scores_cleanliness, round(review_scores_checkin, 6) AS review_scores_checkin,
        round(review_scores_communication, 6) AS review_scores_communication,
        round(review_scores_location, 6) AS review_scores_location, round(review_scores_value, 6) AS review_scores_value,
        first_review::VARCHAR AS first_review, last_review::VARCHAR AS last_review, number_of_reviews
    FROM listing"""


WEATHER_SQL = """
    SELECT weather_date::VARCHAR AS weather_date, round(temperature_max, 6) AS temperature_max,
        round(temperature_min, 6) AS temperature_min, round(precipitation_sum, 6) AS precipitation_sum,
        round(windspeed_max, 6) AS windspeed_max, weathercode FROM weather"""



def paragraphs(spark, sf):
    return search.paragraph_documents(accepted_articles(spark, sf), roles.page_boroughs(spark, sf))


def accepted_articles(spark, sf):
    """Articles that pass the keyword guard; the others are not stored."""
    return landing.accepted(landing.articles_from_pages(roles.pages(spark, sf), "html", ARTICLE_WORDS))


def valid_texts(spark, sf):
    rows = readers.review_texts(roles.raw_texts(spark, sf)).withColumn("review_date", F.col("review_date").cast("date"))
    return search.placed_reviews(rows, roles.listings(spark, sf))
