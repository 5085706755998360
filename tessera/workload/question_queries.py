"""The question bank."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import search
from tessera.plans import questions
from tessera.workload import roles
from tessera.workload.oracle import bands, season
from tessera.workload.registry import query, star_query
from tessera.workload.search_queries import published_review_index, review_search_sql

_AVG_SCORE = "round(avg(review_scores_rating), 6) AS avg_score"
_AVG_DAYS = "round(avg(estimated_occupancy_l365d), 6) AS avg_days"

star_query("q01_listing_count", "SELECT count(*) AS listings FROM dim_listing")(questions.listing_count)
star_query("q02_mean_score", f"SELECT {_AVG_SCORE} FROM dim_listing")(questions.mean_score)
query(
    "q03_top_restaurants",
    """SELECT place_id, name, neighbourhood, rating FROM place WHERE place_type = 'ECONOMY' AND borough = 'EUROPE'
    ORDER BY rating DESC NULLS LAST, place_id LIMIT 5""",
)(lambda spark, sf: questions.top_places(roles.places(spark, sf), "ECONOMY", "EUROPE"))
star_query("q05_superhosts", "SELECT count(*) AS superhosts FROM dim_host WHERE host_is_superhost")(questions.superhost_count)
star_query(
    "q06_occupancy_by_borough",
    f"SELECT borough, count(*) AS listings, {_AVG_DAYS}, round(avg(estimated_occupancy_l365d) / 365, 6) AS avg_ratio FROM dim_listing GROUP BY 1",
)(questions.occupancy_by_borough)
query(
    "q07_rating_by_borough",
    "SELECT borough, round(avg(rating), 6) AS avg_rating, count(*) AS place_count FROM place WHERE place_type = 'ECONOMY' AND rating IS NOT NULL GROUP BY 1",
)(lambda spark, sf: questions.rating_by_borough(roles.places(spark, sf), "ECONOMY"))
star_query("q08_score_by_room_type", f"SELECT room_type, count(*) AS listings, {_AVG_SCORE} FROM dim_listing GROUP BY 1")(
    questions.score_by_room_type
)
star_query(
    "q09_peak_months",
    """SELECT borough, borough_total, month, complaints, place FROM (
        SELECT borough, month, sum(complaint_count)::BIGINT AS complaints, row_number() OVER (ORDER BY sum(complaint_count) DESC, month) AS place
        FROM noise WHERE borough = (SELECT borough FROM noise GROUP BY 1 ORDER BY sum(complaint_count) DESC, borough LIMIT 1) GROUP BY 1, 2)
    JOIN (SELECT borough, sum(complaint_count)::BIGINT AS borough_total FROM noise GROUP BY 1) USING (borough) WHERE place <= 3""",
)(questions.peak_months)
star_query(
    "q11_occupancy_by_bookable", f"SELECT instant_bookable, count(*) AS listings, {_AVG_DAYS} FROM dim_listing GROUP BY 1"
)(questions.occupancy_by_bookable)
star_query(
    "q12_monthly_reviews",
    """SELECT month, strftime(make_date(2000, month, 1), '%B') AS month_name, round(avg(n), 6) AS avg_reviews, count(*) AS years
    FROM (SELECT year(review_date) AS y, month(review_date) AS month, count(*) AS n FROM fact_review GROUP BY 1, 2) GROUP BY 1""",
)(questions.mean_monthly_reviews)
query(
    "q13_density_and_score",
    """SELECT borough, places, round(avg_rating, 6) AS avg_rating, listings, round(avg_score, 6) AS avg_score,
        round(places * 100.0::DOUBLE / listings, 6) AS places_per_100_listings
    FROM (SELECT borough, count(*) AS places, avg(rating) AS avg_rating FROM place WHERE place_type = 'ECONOMY' GROUP BY 1)
    JOIN (SELECT borough, count(*) AS listings, avg(review_scores_rating) AS avg_score FROM dim_listing GROUP BY 1) USING (borough)""",
)(lambda spark, sf: questions.density_and_score(roles.star(spark, sf), roles.places(spark, sf), "ECONOMY"))
star_query(
    "q15_poi_and_score",
    """SELECT neighbourhood, borough, poi_total, round(avg_score, 6) AS avg_score, round(corr(poi_total, avg_score) OVER (), 6) AS correlation
    FROM dim_neighbourhood JOIN (SELECT neighbourhood_id, avg(review_scores_rating) AS avg_score FROM dim_listing GROUP BY 1) USING (neighbourhood_id)""",
)(questions.poi_and_score)
star_query(
    "q16_reviews_by_season", f"SELECT {season('month(review_date)')} AS season, count(*) AS reviews FROM fact_review GROUP BY 1"
)(questions.reviews_by_season)
star_query(
    "q17_superhost_comparison",
    f"""SELECT h.host_is_superhost, count(*) AS listings, {_AVG_DAYS}, {_AVG_SCORE}
    FROM dim_listing l JOIN dim_host h USING (host_id) GROUP BY 1""",
)(questions.superhost_comparison)
SUPERHOST = "responsive superhost, spotless and thoughtful extras"


@query("q17_superhost_texts", review_search_sql(SUPERHOST, 5))
def q17_superhost_texts(spark, sf):
    hits = search.search_reviews(published_review_index(spark, sf), SUPERHOST, search.LetterProfile(), 5)
    return hits.withColumn("text_md5", F.md5("document")).drop("document")


star_query(
    "q18_complaints_and_score",
    """SELECT borough, complaints, listings, round(rate, 6) AS complaints_per_listing, round(score, 6) AS avg_score,
        round(corr(rate, score) OVER (), 6) AS correlation
    FROM (SELECT borough, complaints, listings, complaints / listings AS rate, avg_score AS score
        FROM (SELECT borough, sum(complaint_count)::BIGINT AS complaints FROM noise GROUP BY 1)
        JOIN (SELECT borough, count(*) AS listings, avg(review_scores_rating) AS avg_score FROM dim_listing GROUP BY 1) USING (borough))""",
)(questions.complaints_and_score)
query(
    "q19_best_value",
    """SELECT neighbourhood, borough, round(avg_score, 6) AS avg_score, round(avg_nights, 6) AS avg_nights, transit_places, score_rank, nights_rank,
        transit_rank, score_rank + nights_rank + transit_rank AS value_rank
    FROM (SELECT *, rank() OVER (ORDER BY avg_score DESC NULLS LAST) AS score_rank, rank() OVER (ORDER BY avg_nights NULLS LAST) AS nights_rank,
            rank() OVER (ORDER BY transit_places DESC) AS transit_rank
        FROM (SELECT neighbourhood, borough, avg(review_scores_rating) AS avg_score, avg(minimum_nights) AS avg_nights FROM dim_listing GROUP BY 1, 2)
        JOIN (SELECT d.neighbourhood, d.borough, count(place_id) AS transit_places FROM dim_neighbourhood d
              LEFT JOIN place p ON p.neighbourhood = d.neighbourhood AND p.borough = d.borough AND p.place_type = 'PROMO' GROUP BY 1, 2)
        USING (neighbourhood, borough))""",
)(lambda spark, sf: questions.best_value(roles.star(spark, sf), roles.places(spark, sf), "PROMO"))

WET, WARM = [0.0945, 0.0965, 0.0985], [47.55, 48.35, 48.95]
star_query(
    "q20_reviews_by_weather",
    f"""SELECT {bands('rain', WET)} AS rain_band, {bands('warmth', WARM)} AS temperature_band, count(*) AS reviews, count(DISTINCT review_date) AS days
    FROM (SELECT review_id, avg(precipitation_sum) AS rain, avg(temperature_max) AS warmth FROM bridge GROUP BY 1)
    JOIN fact_review USING (review_id) GROUP BY 1, 2""",
)(lambda star: questions.reviews_by_weather(star, WET, WARM))
