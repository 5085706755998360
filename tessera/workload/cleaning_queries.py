"""Cleaned tables, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import calendar, casts, geo, nested, text
from tessera.functions.vectors import dot
from tessera.operators import documents, lookback, search
from tessera.plans import silver
from tessera.sources import landing, readers
from tessera.workload import roles
from tessera.workload.oracle import area_key, contains_any, haversine, numbers_in, season, strip
from tessera.workload.registry import query
from tessera.workload.shared import ARTICLE_WORDS, LISTING_SQL, WEATHER_SQL


@query("silver_listings", LISTING_SQL)
def silver_listings(spark, sf):
    """33 typed columns from all-text input."""
    return roles.listings(spark, sf)


@query("silver_reviews", "SELECT listing_id, review_date::VARCHAR AS review_date FROM review")
def silver_reviews(spark, sf):
    return roles.reviews(spark, sf)


@query("silver_weather", WEATHER_SQL)
def silver_weather(spark, sf):
    return roles.weather(spark, sf)


@query(
    "silver_noise",
    """SELECT unique_key, complaint_date::VARCHAR AS complaint_date, year, month, borough, complaint_type, descriptor,
        round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM complaint""",
)
def silver_noise(spark, sf):
    return roles.complaints(spark, sf)


@query(
    "silver_places",
    """SELECT file AS neighbourhood, place_type, place_id, min(name) AS name, rating, round(lat, 6) AS lat, round(lng, 6) AS lng
    FROM place_hit GROUP BY file, place_type, place_id, rating, lat, lng""",
)
def silver_places(spark, sf):
    """Search hits typed and reduced to one row per (neighbourhood, type, place)."""
    return silver.clean_places(roles.place_hits(spark, sf).withColumnRenamed("file", "neighbourhood"))


@query(
    "first_number",
    r"""SELECT p_partkey, nullif(regexp_extract(p_brand, '([\d.]+)', 1), '')::DOUBLE AS brand_number,
        nullif(regexp_extract(p_name, '([\d.]+)', 1), '')::DOUBLE AS name_number FROM part""",
)
def first_number(spark, sf):
    return roles.table(spark, sf, "part").select(
        "p_partkey",
        casts.first_number("p_brand").alias("brand_number"),
        casts.first_number("p_name").alias("name_number"),
    )


@query(
    "prefix_and_range_filter",
    """SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, o_orderpriority FROM orders
    WHERE o_orderpriority LIKE '1%' AND o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1998-06-30 23:59:59'""",
)
def prefix_and_range_filter(spark, sf):
    """Type prefix and closed time range, both pushed to the scan."""
    start, end = (F.to_timestamp(F.lit(t)) for t in ("1996-03-01 00:00:00", "1998-06-30 23:59:59"))
    rows = landing.prefix_and_range(
        roles.table(spark, sf, "orders"), "o_orderpriority", "1", "o_orderdate", start, end,
        ["o_orderkey", "o_orderdate", "o_orderpriority"],
    )
    return rows.withColumn("day", F.col("o_orderdate").cast("date")).drop("o_orderdate")


@query("min_length_filter", f"SELECT doc_id, n_chars FROM documents WHERE length({strip('text')}) >= 20")
def min_length_filter(spark, sf):
    rows = roles.table(spark, sf, "documents")
    return rows.filter(text.long_enough(F.col("text"), search.LEAST_REVIEW_CHARS)).select("doc_id", "n_chars")


@query(
    "keyword_guard",
    f"SELECT doc_id, CASE WHEN {contains_any('text', ARTICLE_WORDS)} THEN 'ok' ELSE 'wrong_location' END AS status FROM documents",
)
def keyword_guard(spark, sf):
    """Whole texts tested, ignoring case, for any of a set of words."""
    status = F.when(text.contains_any(F.col("text"), ARTICLE_WORDS), "ok").otherwise("wrong_location")
    return roles.table(spark, sf, "documents").select("doc_id", status.alias("status"))


@query(
    "places_find",
    """SELECT place_id, name, neighbourhood, rating FROM place
    WHERE place_type = 'ECONOMY' AND borough = 'ASIA' AND rating > 2.0 ORDER BY rating DESC, place_id LIMIT 50""",
)
def places_find(spark, sf):
    return documents.places_find(
        roles.places(spark, sf), place_type="ECONOMY", borough="ASIA", min_rating=2.0,
        include=["place_id", "name", "neighbourhood", "rating"], sort=[("rating", -1), ("place_id", 1)], limit=50,
    )


@query(
    "neighbourhoods_find",
    """SELECT neighbourhood, borough, round(x + 0.055, 6) AS lon, round(y + 0.04, 6) AS lat FROM shape
    WHERE borough = 'ASIA' AND y + 0.04 > 40.6 ORDER BY neighbourhood DESC LIMIT 20""",
)
def neighbourhoods_find(spark, sf):
    """Boundary documents of one borough north of a line, without their geometry."""
    stored = readers.boundary_documents(roles.shapes(spark, sf)).select("*", "area_centroid.lon", "area_centroid.lat")
    return documents.find(
        stored,
        documents.all_of(F.col("borough") == "ASIA", F.col("shape").isNotNull(), F.col("area_centroid.lat") > 40.6),
        exclude=["shape", "vertex_centroid", "area_centroid", "loaded_at"],
        sort=[("neighbourhood", -1)],
    )


@query(
    "places_group",
    """SELECT neighbourhood, max(rating) AS best, sum(user_ratings_total)::BIGINT AS votes, count(*) AS places FROM place
    WHERE rating > 3 GROUP BY 1""",
)
def places_group(spark, sf):
    """Match, group and sort over whole places."""
    measures = {"best": F.max("rating"), "votes": F.sum("user_ratings_total"), "places": F.count(F.lit(1))}
    return documents.group(roles.places(spark, sf), "neighbourhood", measures, F.col("rating") > 3, [("votes", -1)])


@query(
    "lookback_range",
    "SELECT (min(review_date) - 10)::DATE::VARCHAR AS start_date, max(review_date)::VARCHAR AS end_date, true AS refetch FROM review",
)
def lookback_range(spark, sf):
    """Days an outside daily source must cover, and whether a stored copy falls short."""
    wanted = lookback.lookback_range(roles.reviews(spark, sf), "review_date")
    return landing.coverage_changed(wanted, "1996-01-01", "1996-12-31")


@query(
    "date_scalars",
    f"""SELECT o_orderkey, strftime(d, '%Y%m%d')::BIGINT AS date_id, year(d) AS year, month(d) AS month, quarter(d) AS quarter,
        strftime(d, '%B') AS month_name, dayname(d) AS day_name, dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
        {season('month(d)')} AS season, (d - 10)::DATE::VARCHAR AS ten_before, date_diff('day', DATE '1995-01-01', d) AS day_number,
        date_trunc('month', d)::DATE::VARCHAR AS month_start, (d + INTERVAL 1 YEAR)::DATE::VARCHAR AS next_year, NULL::VARCHAR AS bad_date
    FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
)
def date_scalars(spark, sf):
    day = F.col("d")
    rows = roles.table(spark, sf, "orders").select(
        "o_orderkey", casts.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"), "o_orderpriority"
    )
    return rows.select(
        "o_orderkey",
        *[column.alias(name) for name, column in calendar.calendar_columns(day).items()],
        F.date_sub(day, 10).alias("ten_before"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("day_number"),
        F.date_trunc("month", day).cast("date").alias("month_start"),
        (day + F.expr("INTERVAL 1 YEAR")).cast("date").alias("next_year"),
        casts.to_date("o_orderpriority").alias("bad_date"),
    )


@query(
    "text_scalars",
    f"""SELECT page_id, md5(replace(replace(url, ' ', '_'), '/', '-')) AS safe_url, upper(substr(url, 1, 12)) AS head,
        length({strip('html')}) AS chars, starts_with(url, 'https') AS secure, contains(lower(html), 'nicht') AS mentions,
        md5(regexp_replace(url || ' [1] and [ 22 ]', '\\[\\s*\\d+\\s*\\]', '', 'g')) AS without_markers,
        array_to_string(list_sort({numbers_in("url || ' 12,345 or 6.5'")}), '|') AS numbers,
        least(greatest(page_id, 10), 100) AS clamped, round(page_id * 100 / 365.0, 2)::DOUBLE AS rounded, {area_key("'x'", 'url')} AS url_key
    FROM pages""",
)
def text_scalars(spark, sf):
    url = F.col("url")
    return roles.table(spark, sf, "pages").select(
        "page_id",
        F.md5(text.safe_name(url)).alias("safe_url"),
        F.upper(F.substring(url, 1, 12)).alias("head"),
        F.length(text.strip(F.col("html"))).alias("chars"),
        url.startswith("https").alias("secure"),
        text.contains_any(F.col("html"), ["NICHT"]).alias("mentions"),
        F.md5(text.strip_citations(F.concat(url, F.lit(" [1] and [ 22 ]")))).alias("without_markers"),
        F.array_sort(text.numbers_in(F.concat(url, F.lit(" 12,345 or 6.5")))).alias("numbers"),
        F.least(F.greatest(F.col("page_id"), F.lit(10)), F.lit(100)).alias("clamped"),
        F.round(F.col("page_id") * 100 / 365.0, 2).alias("rounded"),
        text.stable_key(F.lit("x"), url).alias("url_key"),
    )


@query(
    "nested_scalars",
    """SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, json_extract_string(props, '$.k') AS k_text, NULL::BIGINT AS missing,
        NULL::BIGINT AS unparsed, 'VIEW' = upper(event_type) AS is_view,
        CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'used' ELSE 'Unknown' END AS label,
        CASE event_type WHEN 'error' THEN 0 ELSE event_id END AS filled,
        to_json([event_type, 'x'])::VARCHAR AS pair_json, 2::BIGINT AS pair_size
    FROM events""",
)
def nested_scalars(spark, sf):
    kind, pair = F.col("event_type"), F.array("event_type", F.lit("x"))
    parsed = nested.parse_or_null(F.col("props"), "k bigint, other bigint")
    return roles.table(spark, sf, "events").select(
        "event_id",
        parsed["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        parsed["other"].alias("missing"),
        nested.parse_or_null(kind, "k bigint")["k"].alias("unparsed"),
        F.array_contains(F.array(F.upper(kind)), "VIEW").alias("is_view"),
        F.coalesce(nested.literal_lookup({"view": "seen", "click": "used"}, kind), F.lit("Unknown")).alias("label"),
        F.coalesce(F.when(kind != "error", F.col("event_id")), F.lit(0)).alias("filled"),
        nested.array_to_json(pair).alias("pair_json"),
        F.size(pair).alias("pair_size"),
    )


@query(
    "centroids",
    f"""SELECT neighbourhood, 15::BIGINT AS vertices_before, 15::BIGINT AS vertices_after,
        round(x + {roles.CELL_LON}::DOUBLE * 0.4375, 6) AS vertex_lon, round(y + {roles.CELL_LAT}::DOUBLE * 0.4375, 6) AS vertex_lat,
        round(x + {roles.CELL_LON}::DOUBLE / 2, 6) AS area_lon, round(y + {roles.CELL_LAT}::DOUBLE / 2, 6) AS area_lat
    FROM shape""",
)
def centroids(spark, sf):
    """Both centroids, and repeated vertices put in and removed again."""
    rows = roles.shapes(spark, sf).withColumn(
        "_repeated", F.expr("transform(shape, polygon -> transform(polygon, ring -> concat(slice(ring, 1, 1), ring)))")
    )
    found = rows.select(
        "neighbourhood",
        F.size(F.flatten(F.flatten("shape"))).alias("vertices_before"),
        F.size(F.flatten(F.flatten(geo.tidy_shape("_repeated")))).alias("vertices_after"),
        geo.vertex_centroid("shape").alias("_vertex"),
        geo.area_centroid("shape").alias("_area"),
    )
    return found.select(
        "neighbourhood",
        "vertices_before",
        "vertices_after",
        F.col("_vertex.lon").alias("vertex_lon"),
        F.col("_vertex.lat").alias("vertex_lat"),
        F.col("_area.lon").alias("area_lon"),
        F.col("_area.lat").alias("area_lat"),
    )


@query(
    "geo_distance",
    f"SELECT place_id, round({haversine('-73.9857::DOUBLE', '40.7484::DOUBLE', 'lon', 'lat')}, 3) AS metres FROM place",
)
def geo_distance(spark, sf):
    metres = geo.distance_m(F.lit(-73.9857), F.lit(40.7484), F.col("lon"), F.col("lat"))
    return roles.places(spark, sf).select("place_id", F.round(metres, 3).alias("metres"))


@query(
    "dot_product",
    """SELECT vec_id, round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS squared_norm,
        round(list_inner_product(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS with_reversed FROM embeddings""",
)
def dot_product(spark, sf):
    vector = F.col("embedding")
    return roles.table(spark, sf, "embeddings").select(
        "vec_id", dot(vector, vector).alias("squared_norm"), dot(vector, F.reverse(vector)).alias("with_reversed")
    )
