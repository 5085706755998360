"""Strata, quotas and the systematic sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import search, strata
from tessera.workload.oracle import after_roles
from tessera.workload.registry import ORACLES, query
from tessera.workload.shared import valid_texts

SAMPLE_SIZE = 200

_QUOTA_CTES = f"""
    counts AS (SELECT neighbourhood, listing_id, count(*) AS n_unit FROM valid_text GROUP BY 1, 2),
    areas AS (SELECT neighbourhood, sum(n_unit)::BIGINT AS n_area FROM counts GROUP BY 1),
    raw_quota AS (SELECT *, greatest(10, {SAMPLE_SIZE} * n_area // (SELECT sum(n_area)::BIGINT FROM areas)) AS q FROM areas),
    area_quotas AS (SELECT neighbourhood, n_area, CASE WHEN (SELECT sum(q) FROM raw_quota) > {SAMPLE_SIZE}
        THEN greatest(10, floor(q * ({SAMPLE_SIZE}::DOUBLE / (SELECT sum(q) FROM raw_quota)::DOUBLE)))::BIGINT ELSE q END::BIGINT AS area_quota FROM raw_quota),
    unit_quotas AS (SELECT neighbourhood, listing_id, n_unit, n_area, area_quota,
        least(n_unit, greatest(1, area_quota * n_unit // n_area)) AS quota FROM counts JOIN area_quotas USING (neighbourhood))"""


@query("stratum_counts", "SELECT neighbourhood, listing_id, count(*) AS n_unit FROM valid_text GROUP BY 1, 2")
def stratum_counts(spark, sf):
    return strata.stratum_counts(valid_texts(spark, sf), "neighbourhood", "listing_id")


@query("stratified_quotas")
def stratified_quotas(spark, sf):
    """Quotas of both levels with the scale-down active."""
    counts = strata.stratum_counts(valid_texts(spark, sf), "neighbourhood", "listing_id")
    return strata.quotas(counts, "neighbourhood", "listing_id", SAMPLE_SIZE).select(
        "neighbourhood", "listing_id", "n_unit", "n_area", "area_quota", "quota"
    )


ORACLES["stratified_quotas"] = after_roles(_QUOTA_CTES, "SELECT * FROM unit_quotas")

_SAMPLE_SQL = """SELECT neighbourhood, listing_id, review_date::VARCHAR AS review_date, review_key, md5(comments) AS text_md5
    FROM (SELECT *, row_number() OVER (PARTITION BY neighbourhood, listing_id ORDER BY review_date, review_key) AS rn FROM valid_text)
    JOIN unit_quotas USING (neighbourhood, listing_id)
    WHERE rn * quota // n_unit > (rn - 1) * quota // n_unit"""


def _sample(spark, sf):
    return strata.sample_rows(
        valid_texts(spark, sf), "neighbourhood", "listing_id", ["review_date", "review_key"], SAMPLE_SIZE
    )


@query("stratified_sample")
def stratified_sample(spark, sf):
    """Evenly spaced texts of every listing, up to its quota."""
    return _sample(spark, sf).select(
        "neighbourhood", "listing_id", "review_date", "review_key", F.md5("comments").alias("text_md5")
    )


ORACLES["stratified_sample"] = after_roles(_QUOTA_CTES, _SAMPLE_SQL)


@query(
    "review_docs",
    """SELECT id, md5(document) AS text_md5, listing_id, review_date::VARCHAR AS review_date, neighbourhood FROM review_document""",
)
def review_docs(spark, sf):
    """Index documents of all valid texts, ids numbered within a listing's day."""
    return search.review_documents(valid_texts(spark, sf)).withColumn("text_md5", F.md5("document")).drop("document")
