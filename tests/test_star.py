from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.plans import gold, questions, warehouse
from tessera.workload import roles


@pytest.fixture(scope="module")
def star(spark):
    return roles.star(spark, "/root/testdata/sf0.001")


def test_dimension_keys_are_unique(star):
    report = gold.key_report({n: star[n] for n in gold.DIMENSION_KEYS})
    assert all(r.row_count == r["keys"] and r.duplicated == 0 for r in report.collect())


def test_same_name_in_two_boroughs_stays_apart(spark):
    listings = spark.createDataFrame(
        [(1, "Bay", "Queens"), (2, "Bay", "Bronx"), (3, None, "Bronx"), (4, "Bay", None)], "listing_id bigint, neighbourhood string, borough string"
    )
    for column in ("host_id", *gold.SCORES):
        listings = listings.withColumn(column, F.lit(1))
    for column in (
        "room_type property_type accommodates bedrooms beds bathrooms minimum_nights estimated_occupancy_l365d"
        " instant_bookable first_review last_review number_of_reviews latitude longitude"
    ).split():
        listings = listings.withColumn(column, F.lit(None).cast("int"))
    places = spark.createDataFrame([("Bay", "bar", "p"), ("Bay", "bar", "q"), ("Bay", "bar", "q")], "neighbourhood string, place_type string, place_id string")
    areas = gold.dim_neighbourhood(listings, places)
    assert rows(areas.select("neighbourhood", "borough", "poi_bar", "poi_lodging", "poi_total")) == [
        ("Bay", "Bronx", 2, 0, 2),
        ("Bay", "Queens", 2, 0, 2),
        ("Bay", None, 2, 0, 2),
    ]
    joined = gold.dim_listing(listings)
    assert joined.count() == 4
    ids = {r.listing_id: r.neighbourhood_id for r in joined.collect()}
    assert ids[3] is None and len({ids[1], ids[2], ids[4]}) == 3 and None not in (ids[1], ids[2], ids[4])


def test_fact_is_reviews_of_known_listings(spark, star, data):
    known = roles.reviews(spark, data).join(star["dim_listing"].select("listing_id"), "listing_id", "left_semi")
    fact = star["fact_review"]
    assert fact.count() == known.count() == fact.select("review_id").distinct().count()
    assert fact.filter("date_id IS NULL OR neighbourhood_id IS NULL").isEmpty()


def test_unknown_listing_is_dropped_and_missing_month_is_null(spark):
    reviews = spark.sql("SELECT explode(array(1L, 9L)) AS listing_id, DATE'2024-01-02' AS review_date")
    listing = spark.sql("SELECT 1L AS listing_id, 'N' AS neighbourhood, 2L AS host_id, 'X' AS borough")
    noise = spark.sql("SELECT 'X' AS borough, 2024 AS year, 2 AS month, 7L AS complaint_count")
    got = gold.fact_review(reviews, listing, noise).collect()
    assert [(r.review_id, r.date_id, r.complaint_count) for r in got] == [("1-20240102", 20240102, None)]


def test_bridge_bounds(star):
    bridge = star["fact_review_weather"]
    assert bridge.filter("days_before_review NOT BETWEEN 1 AND 10").isEmpty()
    assert bridge.groupBy("review_id").count().filter("count > 10").isEmpty()


def test_weather_question_equals_bridge_form(star):
    wet, warm = [0.05, 0.08], [40.0, 46.0]
    per_review = star["fact_review_weather"].groupBy("review_id").agg(
        F.avg("precipitation_sum").alias("p"), F.avg("temperature_max").alias("t")
    )
    slow = per_review.groupBy(questions.band(F.col("p"), wet).alias("rain_band"), questions.band(F.col("t"), warm).alias("temperature_band")).agg(
        F.countDistinct("review_id").alias("reviews")
    )
    assert rows(questions.reviews_by_weather(star, wet, warm).drop("days")) == rows(slow)


def test_complaint_totals_come_from_the_monthly_table(spark, star, data):
    whole = roles.complaints(spark, data).count()
    rates = questions.complaints_and_score(star)
    assert rates.agg(F.sum("complaints")).first()[0] == whole
    fanned_out = star["fact_review"].agg(F.sum("complaint_count")).first()[0]
    assert fanned_out != whole


def test_seasons_and_rooms_add_up_to_all_reviews(star):
    n = star["fact_review"].count()
    assert questions.reviews_by_season(star).agg(F.sum("reviews")).first()[0] == n
    by_room = star["fact_review"].join(star["dim_listing"], "listing_id").groupBy("room_type").count()
    assert by_room.agg(F.sum("count")).first()[0] == n


def test_null_flag_is_a_group(star):
    assert {r.instant_bookable for r in questions.occupancy_by_bookable(star).collect()} == {True, False, None}


def test_flat_measure_has_no_correlation(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert frame.select(questions.correlation("x", "y")).first()[0] is None
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, y double")
    assert frame.select(questions.correlation("x", "y")).first()[0] == pytest.approx(1.0)


def test_sql_is_capped_and_read_only(spark, star):
    warehouse.register_views(star)
    assert warehouse.query_views(spark, "SELECT * FROM fact_review LIMIT 5000;", 7).count() == 7
    assert warehouse.query_views(spark, "SELECT 1 AS x", 0).count() == 1
    everything = star["fact_review"].count()
    assert warehouse.query_views(spark, "SELECT * FROM fact_review").count() == everything > 1000
    assert warehouse.query_views(spark, "SELECT * FROM fact_review", 10**9).count() == everything
    top = warehouse.query_views(spark, "WITH d AS (SELECT date_id FROM dim_date) SELECT date_id FROM d ORDER BY date_id DESC", 2).collect()
    assert top[0].date_id > top[1].date_id
    for bad in ("DROP VIEW dim_date", "INSERT INTO dim_date SELECT * FROM dim_date", "SELECT 1; SELECT 2", "CREATE TABLE x (a int)"):
        with pytest.raises(Exception):
            warehouse.query_views(spark, bad)


def test_same_result_for_any_number_of_shuffle_partitions(spark, data):
    def digest():
        tables = roles.star_plans(spark, data)
        return [
            tables[n].select(F.xxhash64(*tables[n].columns).alias("h")).agg(F.sum(F.col("h").cast("decimal(38,0)")), F.count("*")).first()
            for n in ("fact_review", "dim_listing", "dim_host")
        ]

    first = digest()
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert digest() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
