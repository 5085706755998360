"""DuckDB statements of the roles, as named subqueries that query oracles build on."""

from __future__ import annotations

import re

from tessera.functions import text
from tessera.functions.geo import EARTH_RADIUS_M
from tessera.operators import scoring
from tessera.operators.search import LetterProfile
from tessera.workload.roles import ARTICLE_WORDS, CELL_LAT, CELL_LON, PLACE_TYPES, SOUTH, WEST


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SPACES = " || ".join(f"chr({p})" for p in text.WHITESPACE_POINTS)


def strip(value: str) -> str:
    return f"trim({value}, {SPACES})"


def decode(value: str) -> str:
    for name, char in text.ENTITIES.items():
        value = f"replace({value}, {quoted(name)}, {quoted(char)})"
    return value


def letters(value: str) -> str:
    """The 26 letter counts of a text as a list of doubles."""
    counts = ", ".join(
        f"(length({value}) - length(replace({value}, '{c}', '')))::DOUBLE" for c in LetterProfile.letters
    )
    return f"[{counts}]"


def letter_dot(value: str, query: str) -> str:
    weights = ", ".join(f"{query.count(c)}::DOUBLE" for c in LetterProfile.letters)
    return f"list_inner_product({letters(value)}, [{weights}])"


def area_key(borough: str, neighbourhood: str) -> str:
    return (
        f"('0x' || substr(md5(coalesce({borough}, '') || chr(31) || coalesce({neighbourhood}, '')), 1, 15))::BIGINT"
    )


def haversine(lon_a: str, lat_a: str, lon_b: str, lat_b: str) -> str:
    h = (
        f"sin(radians({lat_b} - {lat_a}) / 2) ** 2 + cos(radians({lat_a})) * cos(radians({lat_b}))"
        f" * sin(radians({lon_b} - {lon_a}) / 2) ** 2"
    )
    return f"{2 * EARTH_RADIUS_M} * asin(sqrt(least({h}, 1.0)))"


def contains_any(value: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({value}), {quoted(w.lower())})" for w in words) + ")"


def numbers_in(value: str) -> str:
    plain = rf"regexp_replace({value}, '(\d),(\d{{3}})\b', '\1\2', 'g')"
    return rf"list_distinct(regexp_extract_all({plain}, '\b\d+(?:\.\d+)?\b'))"


def bands(value: str, edges) -> str:
    steps = " + ".join(f"({value} >= {e})::BIGINT" for e in edges)
    return f"CASE WHEN {value} IS NOT NULL THEN {steps} END"


def season(month: str) -> str:
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring'"
        f" WHEN {month} IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"
    )


def _tools(*names: str) -> str:
    return "([" + ", ".join(quoted(n) for n in names) + "]::VARCHAR[])"


W, G, S, C = scoring.WAREHOUSE_TOOL, scoring.GEODATA_TOOL, scoring.REVIEW_TOOL, scoring.CONTEXT_TOOL

_POI = ", ".join(
    f"count(DISTINCT place_id) FILTER (place_type = '{t}') AS poi_{t.lower()}" for t in PLACE_TYPES
)
_POI_ZERO = ", ".join(f"coalesce(poi_{t.lower()}, 0) AS poi_{t.lower()}" for t in PLACE_TYPES)
_POI_SUM = " + ".join(f"coalesce(poi_{t.lower()}, 0)" for t in PLACE_TYPES)

CTES: dict[str, str] = {
    "borough": """
        SELECT n_nationkey, n_name AS neighbourhood, r_name AS borough
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "listing": """
        SELECT k AS listing_id, h AS host_id,
            'Host "' || h || '"' || chr(10) || ' of ' || neighbourhood AS host_name,
            DATE '2008-01-01' + (h % 4000)::INT AS host_since,
            CASE WHEN h % 11 = 5 THEN NULL ELSE h % 3 = 0 END AS host_is_superhost,
            ['within an hour', 'within a few hours', 'within a day', 'N/A'][(h % 4)::INT + 1] AS host_response_time,
            CASE WHEN h % 5 = 0 THEN NULL ELSE (h % 101)::DOUBLE END AS host_response_rate,
            CASE WHEN h % 7 = 0 THEN NULL ELSE (h % 89)::DOUBLE + 0.5 END AS host_acceptance_rate,
            h % 40 AS host_total_listings_count,
            h % 4 <> 1 AS host_identity_verified,
            neighbourhood, borough,
            ('40.' || lpad((k * 7 % 10000)::VARCHAR, 4, '0'))::DOUBLE AS latitude,
            ('-73.' || lpad((k * 13 % 10000)::VARCHAR, 4, '0'))::DOUBLE AS longitude,
            c_mktsegment AS room_type, 'Entire ' || lower(c_mktsegment) AS property_type,
            k % 16 + 1 AS accommodates,
            CASE WHEN k % 9 = 0 THEN NULL ELSE k % 6 END AS bedrooms,
            CASE WHEN k % 13 = 0 THEN NULL ELSE k % 8 END AS beds,
            CASE k % 4 WHEN 0 THEN (k % 5)::DOUBLE + 0.5 WHEN 1 THEN (k % 5)::DOUBLE END AS bathrooms,
            k % 30 + 1 AS minimum_nights, k * 37 % 366 AS estimated_occupancy_l365d,
            CASE WHEN k % 3 = 0 THEN NULL ELSE k % 2 = 0 END AS instant_bookable,
            c_acctbal AS review_scores_rating,
            ((k % 5) || '.' || lpad((k % 100)::VARCHAR, 2, '0'))::DOUBLE AS review_scores_accuracy,
            ((k * 3 % 5) || '.' || lpad((k * 3 % 100)::VARCHAR, 2, '0'))::DOUBLE AS review_scores_cleanliness,
            CASE WHEN k % 17 = 0 THEN NULL ELSE (k % 5)::DOUBLE + 0.5 END AS review_scores_checkin,
            (k * 2 % 5)::DOUBLE + 0.25 AS review_scores_communication,
            (k % 6)::DOUBLE AS review_scores_location,
            (k * 7 % 5)::DOUBLE + 0.75 AS review_scores_value,
            CASE WHEN k % 19 = 0 THEN NULL ELSE DATE '2010-01-01' + (k % 2000)::INT END AS first_review,
            DATE '2016-01-01' + (k % 2000)::INT AS last_review,
            k % 300 AS number_of_reviews
        FROM (SELECT *, c_custkey AS k, c_custkey // 15 AS h FROM customer) JOIN borough ON c_nationkey = n_nationkey""",
    "review": """
        SELECT DISTINCT o_custkey AS listing_id, o_orderdate::DATE AS review_date FROM orders""",
    "weather": """
        SELECT l_shipdate::DATE AS weather_date, max(l_quantity) AS temperature_max, min(l_quantity) AS temperature_min,
            max(l_discount) AS precipitation_sum, max(l_tax) AS windspeed_max, count(*) % 100 AS weathercode
        FROM lineitem GROUP BY 1""",
    "complaint": """
        SELECT l_orderkey || '-' || l_linenumber AS unique_key, l_shipdate::DATE AS complaint_date,
            year(l_shipdate) AS year, month(l_shipdate) AS month, r_name AS borough,
            'Noise - ' || l_returnflag AS complaint_type, l_linestatus AS descriptor,
            ('40.' || lpad((l_partkey % 10000)::VARCHAR, 4, '0'))::DOUBLE AS latitude,
            ('-73.' || lpad((l_partkey % 9973)::VARCHAR, 4, '0'))::DOUBLE AS longitude
        FROM lineitem JOIN region ON l_suppkey % 5 = r_regionkey WHERE l_linenumber <> 7""",
    "place": """
        SELECT 'place-' || p_partkey AS place_id, p_name AS name, neighbourhood, borough, p_type AS place_type,
            CASE WHEN p_size = 50 THEN NULL ELSE (p_size % 41 + 10) / 10.0::DOUBLE END AS rating,
            p_partkey * 3 AS user_ratings_total, p_brand || ' Street' AS vicinity, (p_size % 5)::BIGINT AS price_level,
            -74.25::DOUBLE + (p_partkey * 7919 % 10000)::DOUBLE * 0.000055::DOUBLE AS lon,
            40.5::DOUBLE + (p_partkey * 104729 % 10000)::DOUBLE * 0.000040::DOUBLE AS lat, p_partkey, n_nationkey
        FROM part JOIN borough ON p_partkey % 7 * p_size % 25 = n_nationkey""",
    "place_hit": """
        SELECT b.neighbourhood AS file, p.p_partkey * 2 + shift AS position, place_id, name || ' #' || shift AS name,
            place_type, rating, lat, lon AS lng
        FROM place p, (VALUES (0), (1)) t(shift), borough b
        WHERE b.n_nationkey = CASE shift WHEN 0 THEN p.n_nationkey ELSE (p.p_partkey * 7 + 3) % 25 END""",
    "shape": f"""
        SELECT n_nationkey, neighbourhood, borough,
            {WEST}::DOUBLE + (n_nationkey % 5)::DOUBLE * {CELL_LON}::DOUBLE AS x,
            {SOUTH}::DOUBLE + (n_nationkey // 5)::DOUBLE * {CELL_LAT}::DOUBLE AS y
        FROM borough""",
    "review_text": f"""
        SELECT d.listing_id, review_date, comments, review_key, coalesce(l.neighbourhood, 'Unknown') AS neighbourhood
        FROM (SELECT substr(source, 4)::BIGINT AS listing_id, DATE '2020-01-01' + (doc_id % 1461)::INT AS review_date,
            {strip('text')} AS comments, doc_id AS review_key FROM documents) d
        LEFT JOIN listing l ON l.listing_id = d.listing_id""",
    "valid_text": "SELECT * FROM review_text WHERE length(comments) >= 20",
    "review_document": """
        SELECT listing_id || '_' || review_date || CASE WHEN seq = 1 THEN '' ELSE '_' || seq END AS id,
            comments AS document, listing_id, review_date, neighbourhood
        FROM (SELECT *, row_number() OVER (PARTITION BY listing_id, review_date ORDER BY review_key) AS seq FROM valid_text)""",
    "article": f"""
        SELECT coalesce(n_name, 'PAGE_' || page_id) AS neighbourhood, page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE r_name END AS borough,
            url AS wikipedia_url,
            list_filter(list_transform(
                regexp_split_to_array(
                    regexp_replace(regexp_replace(html, {quoted(text.UNSEEN_PATTERN)}, '', 'g'), {quoted(text.HEADING_PATTERN)}, ''),
                    {quoted(text.PARAGRAPH_PATTERN)})[2:],
                lambda body: array_to_string(list_filter(list_transform(
                    regexp_split_to_array(regexp_replace(body, {quoted(text.PARAGRAPH_END_PATTERN)}, ''), {quoted(text.TAG_PATTERN)}),
                    lambda node: {strip(decode('node'))}), lambda node: node <> ''), ' ')),
                lambda t: t <> '') AS intro_paragraphs
        FROM pages JOIN region ON page_id % 5 = r_regionkey LEFT JOIN nation ON page_id = n_nationkey""",
    "paragraph": rf"""
        SELECT a.neighbourhood || '_para_' || paragraph_index AS id, document, a.neighbourhood,
            coalesce(a.borough, 'LABEL_' || quality, 'Unknown') AS borough, wikipedia_url, paragraph_index
        FROM (SELECT neighbourhood, borough, wikipedia_url, i - 1 AS paragraph_index,
                {strip(r"regexp_replace(intro_paragraphs[i], '\[\s*\d+\s*\]', '', 'g')")} AS document
              , page_id FROM article, unnest(generate_series(1, len(intro_paragraphs))) u(i)
              WHERE {contains_any("array_to_string(intro_paragraphs, ' ')", ARTICLE_WORDS)}) a
        LEFT JOIN labels ON a.page_id = doc_id
        WHERE length(document) >= 30""",
    "dim_neighbourhood": f"""
        SELECT neighbourhood, borough, {_POI_ZERO}, {_POI_SUM} AS poi_total,
            {area_key('borough', 'neighbourhood')} AS neighbourhood_id
        FROM (SELECT DISTINCT neighbourhood, borough FROM listing)
        LEFT JOIN (SELECT neighbourhood, {_POI} FROM place GROUP BY 1) USING (neighbourhood)""",
    "dim_date": f"""
        SELECT review_date AS full_date, strftime(review_date, '%Y%m%d')::BIGINT AS date_id, year(review_date) AS year,
            month(review_date) AS month, strftime(review_date, '%B') AS month_name, quarter(review_date) AS quarter,
            dayofweek(review_date) + 1 AS day_of_week, dayname(review_date) AS day_name,
            dayofweek(review_date) IN (0, 6) AS is_weekend, {season('month(review_date)')} AS season
        FROM (SELECT DISTINCT review_date FROM review)""",
    "dim_host": """
        SELECT host_id, min(host_name) AS host_name, min(host_since) AS host_since,
            bool_and(host_is_superhost) AS host_is_superhost, min(host_response_time) AS host_response_time,
            min(host_response_rate) AS host_response_rate, min(host_acceptance_rate) AS host_acceptance_rate,
            min(host_total_listings_count) AS host_total_listings_count,
            bool_and(host_identity_verified) AS host_identity_verified
        FROM listing GROUP BY 1""",
    "dim_listing": f"SELECT *, {area_key('borough', 'neighbourhood')} AS neighbourhood_id FROM listing",
    "noise": """
        SELECT borough, year, month, count(*) AS complaint_count, list_sort(list_distinct(list(complaint_type))) AS complaint_types
        FROM complaint GROUP BY 1, 2, 3""",
    "fact_review": """
        SELECT r.listing_id || '-' || strftime(review_date, '%Y%m%d') AS review_id, r.listing_id, host_id,
            neighbourhood_id, strftime(review_date, '%Y%m%d')::BIGINT AS date_id, review_date, complaint_count
        FROM review r JOIN dim_listing l ON r.listing_id = l.listing_id
        LEFT JOIN noise n ON n.borough = l.borough AND n.year = year(review_date) AND n.month = month(review_date)""",
    "bridge": """
        SELECT review_id, weather_date, date_diff('day', weather_date, review_date) AS days_before_review,
            temperature_max, temperature_min, precipitation_sum, windspeed_max, weathercode
        FROM fact_review JOIN weather ON weather_date >= review_date - 10 AND weather_date < review_date""",
    "run": f"""
        SELECT conv_id * 100 + turn AS id, question, conv_id % 4 + 1 AS difficulty,
            {_tools(*scoring.ROUTES)}[(conv_id % 5)::INT + 1] AS expected_route,
            CASE conv_id % 5 WHEN 0 THEN {_tools(W)} WHEN 1 THEN {_tools(G)} WHEN 2 THEN {_tools(S, C)}
                WHEN 3 THEN {_tools(G, W)} ELSE {_tools(W, S)} END AS expected_tools,
            CASE (conv_id + turn) % 7 WHEN 0 THEN {_tools(W)} WHEN 1 THEN {_tools(G, G)} WHEN 2 THEN {_tools(S, C)}
                WHEN 3 THEN {_tools(G, W)} WHEN 4 THEN {_tools(W, C)} WHEN 5 THEN {_tools(G, S)} ELSE []::VARCHAR[] END AS tools_called,
            CASE WHEN conv_id % 4 = 0 THEN {_tools(G)} ELSE []::VARCHAR[] END AS failed_tools,
            'rows ' || (conv_id * 1234 + turn) || ' value ' || (conv_id * 10) || '.50' AS context,
            CASE WHEN answer IS NULL THEN '' ELSE answer || ' Total ' || format('{{:,}}', conv_id * 1234 + turn) || ' of ' || (conv_id * 10) || '.5'
                || CASE WHEN conv_id % 3 = 0 THEN ' and 7' ELSE '' END END AS answer,
            CASE WHEN conv_id % 10 = 9 THEN NULL ELSE (conv_id % 11)::DOUBLE / 10 END AS judge_score,
            (conv_id * 37 % 100)::DOUBLE / 10 AS elapsed_seconds
        FROM (SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
              FROM conversations q LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
              WHERE q.role = 'user')""",
    "score": f"""
        SELECT *, CASE WHEN route_taken = expected_route THEN 1.0 ELSE 0.0 END::DOUBLE AS route_accuracy,
            round_even(CASE WHEN len(expected_tools) = 0 THEN 1.0::DOUBLE
                ELSE len(list_intersect(list_distinct(tools_called), list_distinct(expected_tools)))::DOUBLE / len(expected_tools) END, 2) AS tool_coverage,
            CASE WHEN expected_route IN ('semantic', 'warehouse+semantic') THEN coalesce(judge_score, -1) ELSE grounding END::DOUBLE AS faithfulness,
            CASE WHEN len(tools_called) = 0 THEN 0 ELSE
                len(list_filter(tools_called, lambda t: NOT list_contains(failed_tools, t)))::DOUBLE / len(tools_called) END::DOUBLE AS tool_success
        FROM (SELECT *,
                CASE WHEN g AND w AND NOT s THEN 'geodata+warehouse' WHEN w AND s AND NOT g THEN 'warehouse+semantic'
                    WHEN g AND NOT w THEN 'geodata' WHEN w AND NOT g THEN 'warehouse' WHEN s AND NOT w AND NOT g THEN 'semantic'
                    ELSE 'mixed' END AS route_taken
              FROM (SELECT *, list_contains(tools_called, '{G}') AS g, list_contains(tools_called, '{W}') AS w,
                        list_contains(tools_called, '{S}') OR list_contains(tools_called, '{C}') AS s,
                        CASE WHEN len({numbers_in('answer')}) = 0 THEN -1 ELSE round_even(
                            len(list_intersect({numbers_in('answer')}, {numbers_in('context')}))::DOUBLE / len({numbers_in('answer')}), 2) END AS grounding
                    FROM run))""",
    "tool_result": f"""
        SELECT conv_id AS id, turn AS position, turn % 4 AS call, {_tools(W, G, S, C)}[(turn % 4)::INT + 1] AS tool,
            turn // 4 + 1 AS rank, text AS result, CASE WHEN conv_id % 7 = 0 AND turn % 4 = 1 THEN 'timeout' END AS error,
            role AS label, conv_id * 1.23456::DOUBLE + turn AS amount, text AS document
        FROM conversations""",
    "record": """
        SELECT 'item-' || user_id AS item, event_type AS status, floor(value)::BIGINT AS rows, ts AS finished_at FROM events""",
    "latest_record": """
        SELECT * FROM record QUALIFY row_number() OVER (PARTITION BY item ORDER BY finished_at DESC, status, rows) = 1""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", sql)]


def with_roles(sql: str) -> str:
    """The statement with every role it uses, directly or through another, in front."""
    wanted: list[str] = []
    pending = _needs(sql)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.append(name)
            pending.extend(n for n in _needs(CTES[name]) if n != name)
    if not wanted:
        return sql
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in wanted)
    return f"WITH {parts}\n{sql}"


def after_roles(ctes: str, sql: str) -> str:
    """Role names are resolved over the whole text, then the extra subqueries follow them."""
    whole = with_roles(ctes + sql)
    head = whole[: len(whole) - len(ctes + sql)].rstrip()
    return f"{head},{ctes}\n{sql}"
