"""SQL over the published star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans import warehouse
from tessera.plans.guard import Refused
from tessera.workload import roles
from tessera.workload.registry import query, sql_query

sql_query(
    "sql_star_join",
    """SELECT d.season, n.borough, count(*) AS reviews FROM fact_review f JOIN dim_date d USING (date_id)
    JOIN dim_neighbourhood n ON f.neighbourhood_id = n.neighbourhood_id GROUP BY d.season, n.borough""",
    """SELECT d.season, n.borough, count(*) AS reviews FROM fact_review f JOIN dim_date d USING (date_id)
    JOIN dim_neighbourhood n ON f.neighbourhood_id = n.neighbourhood_id GROUP BY d.season, n.borough""",
)
sql_query(
    "sql_aggregates",
    """SELECT room_type, count(*) AS listings, avg(review_scores_rating) AS avg_score,
        min(review_scores_rating) AS least, max(review_scores_rating) AS most, sum(number_of_reviews) AS reviews
    FROM dim_listing GROUP BY room_type
    UNION ALL SELECT 'all', count(*), avg(review_scores_rating), min(review_scores_rating), max(review_scores_rating),
        sum(number_of_reviews) FROM dim_listing""",
    """SELECT coalesce(room_type, 'all') AS room_type, count(*) AS listings, round(avg(review_scores_rating), 6) AS avg_score,
        min(review_scores_rating) AS least, max(review_scores_rating) AS most, sum(number_of_reviews)::BIGINT AS reviews
    FROM dim_listing GROUP BY GROUPING SETS ((room_type), ())""",
)
sql_query(
    "sql_in_subquery",
    """SELECT room_type, count(*) AS listings FROM dim_listing WHERE neighbourhood_id IN
        (SELECT neighbourhood_id FROM dim_neighbourhood WHERE poi_economy > poi_promo) GROUP BY room_type""",
    """SELECT room_type, count(*) AS listings FROM dim_listing WHERE neighbourhood_id IN
        (SELECT neighbourhood_id FROM dim_neighbourhood WHERE poi_economy > poi_promo) GROUP BY room_type""",
)
sql_query(
    "sql_union",
    "SELECT borough AS name FROM noise_borough_month UNION SELECT season FROM dim_date UNION SELECT borough FROM dim_neighbourhood",
    "SELECT borough AS name FROM noise UNION SELECT season FROM dim_date UNION SELECT borough FROM dim_neighbourhood",
)
sql_query(
    "sql_date_trunc",
    """SELECT CAST(date_trunc('MONTH', review_date) AS DATE) AS month_start, count(*) AS reviews FROM fact_review
    WHERE review_date >= DATE '1996-06-15' + INTERVAL 1 YEAR GROUP BY 1""",
    """SELECT date_trunc('month', review_date)::DATE::VARCHAR AS month_start, count(*) AS reviews FROM fact_review
    WHERE review_date >= DATE '1996-06-15' + INTERVAL 1 YEAR GROUP BY 1""",
)
sql_query(
    "sql_capped",
    """WITH busy AS (SELECT listing_id, count(*) AS reviews FROM fact_review GROUP BY listing_id)
    SELECT listing_id, reviews FROM busy ORDER BY reviews DESC, listing_id LIMIT 5000;""",
    "SELECT listing_id, count(*) AS reviews FROM fact_review GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
    limit=25,
)

ACCEPTED = {
    "plain": "SELECT * FROM fact_review",
    "cte": "WITH busy AS (SELECT listing_id, count(*) AS n FROM fact_review GROUP BY listing_id HAVING count(*) > 1) SELECT * FROM busy",
    "subquery": "SELECT * FROM dim_listing WHERE listing_id IN (SELECT listing_id FROM fact_review WHERE review_id IS NOT NULL)",
    "union": "SELECT season AS name FROM dim_date UNION SELECT borough FROM dim_neighbourhood",
    "window": "SELECT listing_id, rank() OVER (PARTITION BY room_type ORDER BY number_of_reviews) AS place FROM dim_listing",
}
REFUSED = {
    "reflect": "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM fact_review",
    "file": "SELECT * FROM parquet.`/any/path`",
    "brackets": "SELECT 1) UNION ALL (SELECT 2",
    "unpublished": "SELECT * FROM some_other_table",
    "command": "DROP VIEW dim_date",
    "two statements": "SELECT 1; SELECT 2",
    "script": "SELECT TRANSFORM (listing_id) USING 'cat' AS (x) FROM dim_listing",
    "range": "SELECT * FROM range(1000000000000)",
    "hidden": "SELECT * FROM dim_date ORDER BY java_method('java.lang.System', 'getProperty', season)",
}


@query(
    "sql_guarded",
    """SELECT 'plain' AS statement, true AS accepted, count(*) AS row_count FROM fact_review
    UNION ALL SELECT 'cte', true, count(*) FROM (SELECT listing_id FROM fact_review GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'subquery', true, count(*) FROM dim_listing WHERE listing_id IN (SELECT listing_id FROM fact_review)
    UNION ALL SELECT 'union', true, count(*) FROM (SELECT season FROM dim_date UNION SELECT borough FROM dim_neighbourhood)
    UNION ALL SELECT 'window', true, count(*) FROM dim_listing
    UNION ALL SELECT s, false, 0 FROM (SELECT unnest(["""
    + ", ".join(f"'{name}'" for name in REFUSED)
    + "]) AS s)",
)
def sql_guarded(spark, sf):
    """Statements that the guard lets through, with their rows, and those that it refuses."""
    warehouse.register_views(roles.star(spark, sf))

    def verdict(name: str, text: str) -> DataFrame:
        try:
            counted = warehouse.query_views(spark, text).agg(F.count(F.lit(1)).alias("row_count"))
            return counted.select(F.lit(name).alias("statement"), F.lit(True).alias("accepted"), "row_count")
        except Refused:
            return spark.range(1).select(F.lit(name).alias("statement"), F.lit(False).alias("accepted"), F.lit(0).cast("bigint").alias("row_count"))

    return reduce(DataFrame.unionByName, [verdict(*s) for s in (ACCEPTED | REFUSED).items()])
