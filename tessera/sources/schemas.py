"""Read schemas. Nothing is inferred from the data."""

from __future__ import annotations

LISTING_COLUMNS = [
    "id",
    "host_id",
    "host_name",
    "host_since",
    "host_is_superhost",
    "host_response_time",
    "host_response_rate",
    "host_acceptance_rate",
    "host_total_listings_count",
    "host_identity_verified",
    "neighbourhood_cleansed",
    "neighbourhood_group_cleansed",
    "latitude",
    "longitude",
    "room_type",
    "property_type",
    "accommodates",
    "bedrooms",
    "beds",
    "bathrooms_text",
    "minimum_nights",
    "estimated_occupancy_l365d",
    "instant_bookable",
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
    "first_review",
    "last_review",
    "number_of_reviews",
]

WEATHER = """
    meta struct<start_date:string, end_date:string>,
    daily struct<
        time:array<string>,
        temperature_2m_max:array<double>,
        temperature_2m_min:array<double>,
        precipitation_sum:array<double>,
        windspeed_10m_max:array<double>,
        weathercode:array<double>>
"""

COMPLAINT = """struct<
    unique_key:string, created_date:string, complaint_type:string, descriptor:string,
    incident_zip:string, borough:string, community_board:string,
    latitude:string, longitude:string, status:string, resolution_description:string>"""
COMPLAINTS = f"meta struct<start_date:string, end_date:string, record_count:bigint>, records array<{COMPLAINT}>"

PLACE = """struct<
    place_id:string, name:string, rating:double, user_ratings_total:bigint, types:array<string>,
    vicinity:string, price_level:bigint, business_status:string,
    geometry:struct<location:struct<lat:double, lng:double>>>"""
PLACES = f"""
    neighbourhood string, fetched_at string, search_radius_m bigint,
    results_by_type map<string, array<{PLACE}>>, results_deduped array<{PLACE}>
"""

# Coordinates nest to different depths by geometry type, so they are read as text first.
BOUNDARIES = """
    type string,
    features array<struct<
        properties:struct<neighbourhood:string, neighbourhood_group:string>,
        geometry:struct<type:string, coordinates:string>>>
"""

ARTICLES = """
    neighbourhood string, borough string, wikipedia_title string, wikipedia_url string, fetched_at string,
    intro_paragraphs array<string>, intro_text string, paragraph_count bigint, char_count bigint
"""
