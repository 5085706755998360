from __future__ import annotations

import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.operators import documents, keep, lookback, lookup, nearby, search, strata
from tessera.sources import landing
from tessera.workload import roles


def haversine(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    a += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(a)))


# --- keep ---


def test_keep_one_does_not_depend_on_input_order(spark):
    values = [(k, v, f"x{v}") for k in range(5) for v in range(20)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame(values, "k int, v int, s string").repartition(3 + seed)
        picks.add(tuple(rows(keep.keep_one(df, ["k"]))))
    assert len(picks) == 1 and len(picks.pop()) == 5


def test_first_seen_follows_type_order(spark):
    df = spark.createDataFrame([("f", "p", "bar", 1), ("f", "p", "restaurant", 9), ("f", "q", "bar", 2), ("f", "r", "other", 0)], "file string, id string, t string, pos int")
    got = keep.first_seen(df, ["file", "id"], "t", ["restaurant", "bar"], "pos")
    assert rows(got) == [("f", "p", "restaurant", 9), ("f", "q", "bar", 2)]


def test_newly_seen(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", "3"), ("c", "1"), ("b", None)], "file string, id string")
    assert rows(keep.newly_seen_counts(df, "id", "file")) == [("a", 2), ("b", 0), ("c", 1)]


def test_upsert_prefers_newer_then_incoming(spark):
    stored = spark.createDataFrame([("a", 1, "old"), ("b", 3, "old")], "id string, version int, v string")
    incoming = spark.createDataFrame([("a", 1, "new"), ("b", 2, "new"), ("c", 1, "new")], "id string, version int, v string")
    assert rows(keep.upsert(stored, incoming, "id", "version").select("id", "v")) == [("a", "new"), ("b", "old"), ("c", "new")]


def test_lookup_default_and_pending(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    table = spark.createDataFrame([(1, "x"), (2, None)], "k int, name string")
    assert rows(lookup.lookup_or_default(df, table, "k", "name")) == [(1, "x"), (2, "Unknown"), (3, "Unknown")]
    assert rows(lookup.pending(df, table, "k")) == [(3,)]


# --- look-back ---


def test_lookback_edges(spark):
    events = spark.sql("SELECT 'r' AS id, DATE'2024-03-11' AS day")
    daily = spark.sql("SELECT explode(sequence(DATE'2024-02-25', DATE'2024-03-15')) AS d").withColumn("v", F.dayofmonth("d"))
    got = rows(lookback.lookback_bridge(events, daily, "id", "day", "d"))
    assert [str(r[1]) for r in got] == [f"2024-03-{n:02d}" for n in range(1, 11)]
    assert sorted(r[2] for r in got) == list(range(1, 11))


def test_lookback_equals_cross_join(spark, data):
    reviews = roles.reviews(spark, data).withColumn("review_id", F.concat_ws("-", "listing_id", "review_date"))
    weather = roles.weather(spark, data)
    got = lookback.lookback_bridge(reviews, weather, "review_id", "review_date", "weather_date")
    slow = (
        reviews.crossJoin(weather)
        .filter("weather_date >= date_sub(review_date, 10) AND weather_date < review_date")
        .withColumn("days_before_review", F.datediff("review_date", "weather_date"))
        .select(*got.columns)
    )
    assert got.count() == slow.count() > 0
    assert got.exceptAll(slow).isEmpty() and slow.exceptAll(got).isEmpty()


def test_lookback_range(spark):
    got = lookback.lookback_range(spark.sql("SELECT explode(array(DATE'2024-01-05', DATE'2024-02-01')) AS d"), "d").first()
    assert (str(got.start_date), str(got.end_date)) == ("2023-12-26", "2024-02-01")


# --- space ---


@pytest.mark.parametrize("lat, lon, radius", [(40.7, -74.0, 1500.0), (0.0, 179.999, 3000.0), (0.0, -180.0, 3000.0), (89.99, 10.0, 4000.0), (-60.0, 0.0, 900.0)])
def test_radius_join_equals_brute_force(spark, lat, lon, radius):
    rng = random.Random(7)
    reach = math.degrees(radius / geo.EARTH_RADIUS_M) * 2
    stretch = reach / max(math.cos(math.radians(lat)), 0.01)
    wrap = lambda x: (x + 180.0) % 360.0 - 180.0
    points = [(i, wrap(lon + rng.uniform(-stretch, stretch)), max(-90.0, min(90.0, lat + rng.uniform(-reach, reach)))) for i in range(400)]
    centres = [(f"c{i}", wrap(lon + rng.uniform(-stretch / 3, stretch / 3)), max(-90.0, min(90.0, lat + rng.uniform(-reach, reach) / 3))) for i in range(5)]
    expected = {(c, p) for c, clon, clat in centres for p, plon, plat in points if haversine(clon, clat, plon, plat) <= radius}
    got = nearby.radius_join(
        spark.createDataFrame(centres, "c string, lon double, lat double"),
        spark.createDataFrame(points, "p int, lon double, lat double"),
        radius,
        "c",
        "p",
    )
    pairs = [(r.c, r.p) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected and expected


def test_near_is_sorted_and_bounded(spark, data):
    places = roles.places(spark, data)
    got = nearby.near(places, -74.0, 40.7, 9000.0, 5).collect()
    everything = sorted((haversine(-74.0, 40.7, r.lon, r.lat), r.place_id) for r in places.select("lon", "lat", "place_id").collect())
    assert [r.place_id for r in got] == [p for d, p in everything if d <= 9000][:5]


def test_points_in_shapes_equals_brute_force(spark, data):
    places, shapes = roles.places(spark, data), roles.shapes(spark, data)
    got = nearby.points_in_shapes(places, shapes, "place_id", "neighbourhood", cell_degrees=0.03)
    edged = shapes.select(F.col("neighbourhood").alias("s"), geo.shape_edges("shape").alias("edges"))
    slow = places.select("place_id", "lon", "lat").crossJoin(edged).filter(geo.inside("lon", "lat", "edges"))
    assert rows(got) == rows(slow.select("s", "place_id"))


def test_places_find_clamps_and_sorts(spark):
    places = spark.createDataFrame([(str(i), ["bar"], float(i % 5) if i % 7 else None, "X") for i in range(300)], "place_id string, types array<string>, rating double, borough string")
    assert documents.places_find(places, limit=10_000).count() == documents.places_find(places).count() == places.count()
    assert documents.places_find(places, limit=0).count() == 1
    got = documents.places_find(places, place_type="bar", sort=[("rating", 1), ("place_id", 1)], limit=1).first()
    assert got.rating is None
    assert documents.places_find(places, min_rating=3.0, limit=200).filter("rating <= 3").isEmpty()
    assert documents.places_group(places, "borough", "bar").first().place_count == sum(1 for i in range(300) if i % 7)


# --- sampling ---


def loop_sample(items, size, least=10):
    """Plain statement of the sampling rule over (area, unit, order) tuples."""
    items = sorted(items)
    unit_n, area_n = {}, {}
    for a, u, _ in items:
        unit_n[a, u] = unit_n.get((a, u), 0) + 1
        area_n[a] = area_n.get(a, 0) + 1
    total = len(items)
    asked = {a: max(least, size * n // total) for a, n in area_n.items()}
    whole = sum(asked.values())
    if whole > size:
        factor = size / whole
        asked = {a: max(least, math.floor(q * factor)) for a, q in asked.items()}
    quota = {k: min(n, max(1, asked[k[0]] * n // area_n[k[0]])) for k, n in unit_n.items()}
    seen, kept = {}, []
    for item in items:
        key = item[:2]
        seen[key] = seen.get(key, 0) + 1
        if seen[key] * quota[key] // unit_n[key] > (seen[key] - 1) * quota[key] // unit_n[key]:
            kept.append(item)
    return quota, kept


@pytest.mark.parametrize("size", [30, 100, 400])
def test_sample_equals_loop_with_a_hot_unit(spark, size):
    rng = random.Random(size)
    items = [("hot", 1, i) for i in range(700)]
    items += [(rng.choice("abc"), rng.randrange(9), 1000 + i) for i in range(800)] + [("rare", 5, 5000)]
    keys = spark.createDataFrame(items, "area string, unit int, pos bigint").repartition(6)
    quota, kept = loop_sample(items, size)
    counts = strata.stratum_counts(keys, "area", "unit")
    got = {(r.area, r.unit): r.quota for r in strata.quotas(counts, "area", "unit", size).collect()}
    assert got == quota
    assert rows(strata.systematic_keys(keys, "area", "unit", ["pos"], size)) == sorted(kept, key=lambda r: tuple((False, str(x)) for x in r))
    chosen = strata.sample_rows(keys.withColumn("text", F.lit("t")), "area", "unit", ["pos"], size)
    per_unit = {(r.area, r.unit): r["count"] for r in chosen.groupBy("area", "unit").count().collect()}
    assert per_unit == quota


def test_a_large_group_lies_across_slices(spark):
    keys = spark.range(20_000).select(F.lit("a").alias("area"), F.lit(1).alias("unit"), F.col("id").alias("pos"))
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed, offsets = strata.ranked_slices(keys, ["area", "unit"], ["pos"])
        assert offsets.count() == 4
        ranked = placed.join(offsets, ["area", "unit", "_slice"])
        assert ranked.filter(F.col("_before") + F.col("_place") != F.col("pos") + 1).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)


# --- search ---


def vectors(spark, n, dim, seed, name="id"):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in rng.integers(-3, 4, dim)]) for i in range(n)]
    return data, spark.createDataFrame(data, f"{name} bigint, embedding array<float>").repartition(3)


def brute(queries, items, k):
    out = set()
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in items)
        out |= {(q, i, -s, place + 1) for place, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block", [50_000, 7])
def test_batch_top_k_with_many_ties(spark, block):
    items, index = vectors(spark, 60, 4, 1)
    asked, queries = vectors(spark, 20, 4, 2, "q")
    got = search.batch_top_k(queries, index, 6, "q", "id", block_rows=block)
    assert {tuple(r) for r in got.select("query_id", "item_id", "similarity", "place").collect()} == brute(asked, items, 6)


def test_batch_top_k_with_text_ids_and_short_index(spark):
    index = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "id string, embedding array<float>")
    queries = spark.createDataFrame([("q", [2.0, 0.0])], "q string, embedding array<float>")
    got = search.batch_top_k(queries, index, 5, "q", "id").orderBy("place").collect()
    assert [(r.item_id, r.similarity) for r in got] == [("a", 2.0), ("b", 2.0)]
    assert search.batch_top_k(queries.limit(0), index, 5, "q", "id").count() == 0


def test_top_k_filters_before_ranking(spark):
    index = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(10)], "id int, embedding array<float>, odd int")
    got = search.top_k(index, [1.0], 3, "id", F.col("odd") == 0).collect()
    assert [r.id for r in got] == [8, 6, 4] and got[0].distance == 1 - got[0].similarity


def test_documents_on_one_day_get_numbers(spark):
    day = "DATE'2024-01-01'"
    texts = spark.sql(f"SELECT 5L AS listing_id, {day} AS review_date, k AS review_key, 'A' AS neighbourhood, concat(' t', k) AS comments FROM VALUES (3), (1), (2) AS t(k)")
    got = search.review_documents(texts)
    assert rows(got.select("id", "document")) == [("5_2024-01-01", "t1"), ("5_2024-01-01_2", "t2"), ("5_2024-01-01_3", "t3")]


def test_paragraph_documents(spark):
    long = "x" * 30
    articles = spark.createDataFrame(
        [("A", None, "u", [f"{long}[1]", "y" * 29, f" {long}[ 5 ]z"]), ("B", "Queens", "u", [long]), ("C", None, "u", [])],
        "neighbourhood string, borough string, wikipedia_url string, intro_paragraphs array<string>",
    )
    got = search.paragraph_documents(articles, spark.createDataFrame([("Z", "?")], "neighbourhood string, borough string"))
    assert rows(got.select("id", "document", "borough")) == [
        ("A_para_0", long, "Unknown"),
        ("A_para_2", long + "z", "Unknown"),
        ("B_para_0", long, "Queens"),
    ]


def test_same_encoder_for_index_and_question(spark):
    texts = spark.createDataFrame([("1", "quiet street", "A"), ("2", "zzz", "A"), ("3", "quiet", "B")], "id string, document string, neighbourhood string")
    index = search.embed(texts, "document", search.LetterProfile, batch=2)
    got = search.search_reviews(index, "quiet street", search.LetterProfile(), 1000)
    assert [r.id for r in got.collect()] == ["1", "3", "2"]
    assert search.neighbourhood_context(index, "quiet", search.LetterProfile(), 5, "B").count() == 1
    both = search.dual_search(index, index, "quiet", search.LetterProfile(), n_reviews=1, n_context=1)
    assert rows(both.select("source", "id")) == [("get_neighbourhood_context", "1"), ("search_reviews", "1")] or both.count() == 2


def test_task_functions_need_no_installed_package(tmp_path):
    payload = cloudpickle.dumps((search.LetterProfile(), search._score_block))
    code = (
        "import sys, pickle, numpy as np\n"
        "encode, score = pickle.load(sys.stdin.buffer)\n"
        "assert 'tessera' not in sys.modules\n"
        "v = encode(['ab', 'b']).astype(float)\n"
        "print(len(score(v, np.array([1, 2]), v, np.array([1, 2]), 1)))\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=payload, capture_output=True, cwd=tmp_path, env=environment)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[-1] == b"2"


def test_keep_one_tells_nulls_apart(spark):
    pair = [(1, None, "a"), (1, "a", None)]
    kept = {
        tuple(keep.keep_one(spark.createDataFrame(rows_in, "k int, x string, y string"), ["k"]).first())
        for rows_in in (pair, pair[::-1])
    }
    assert len(kept) == 1


def test_batch_top_k_makes_many_groups(spark):
    vectors_in = spark.range(6000).selectExpr("id", "array(cast(id % 97 AS float), cast(id % 89 AS float), 1.0F) AS embedding")
    got = search.batch_top_k(vectors_in, vectors_in, 2, "id", "id")
    assert got.count() == 12_000
    assert "block_rows" in search.batch_top_k.__code__.co_varnames and 6000 / search.BLOCK_ROWS > 1


def test_all_texts_are_indexed(spark):
    texts = spark.range(60_000).selectExpr(
        "id % 50 AS listing_id", "date_add(DATE'2020-01-01', cast(id % 900 AS int)) AS review_date", "id AS review_key",
        "concat('a text long enough ', id) AS comments",
    )
    listings = spark.range(1, 50).selectExpr("id AS listing_id", "concat('N', id % 7) AS neighbourhood")
    placed = search.placed_reviews(texts, listings)
    index = search.build_review_index(placed, search.LetterProfile)
    assert index.count() == index.select("id").distinct().count() == 60_000
    assert index.filter("neighbourhood = 'Unknown'").count() == 1200
    plan = search.review_documents(placed)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # texts are numbered by their keys, before they are read


def test_only_accepted_pages_are_indexed(spark):
    pages = spark.createDataFrame(
        [("A", "<p>A paragraph about the old town and its harbour.</p>"), ("B", "<p>Another paragraph of some length here.</p>"), ("C", "<div></div>")],
        "neighbourhood string, html string",
    ).selectExpr("*", "'X' AS borough", "'u' AS wikipedia_url")
    articles = landing.articles_from_pages(pages, "html", ("harbour",))
    assert {r.neighbourhood: r.status for r in articles.collect()} == {"A": "ok", "B": "wrong_location", "C": "error"}
    assert [r.id for r in search.paragraph_documents(landing.accepted(articles)).collect()] == ["A_para_0"]


def test_a_large_shape_has_few_cells(spark):
    ring = [(-20.0, -10.0), (30.0, -10.0), (30.0, 25.0), (-20.0, 25.0), (-20.0, -10.0)]
    small = [(0.001, 0.001), (0.002, 0.001), (0.002, 0.002), (0.001, 0.002), (0.001, 0.001)]
    shapes = spark.createDataFrame(
        [("big", [[ring]]), ("small", [[small]])], "name string, shape array<array<array<struct<lon:double, lat:double>>>>"
    )
    points = spark.createDataFrame([(1, 0.0015, 0.0015), (2, 29.0, 24.0), (3, 31.0, 0.0)], "id int, lon double, lat double")
    assert rows(nearby.points_in_shapes(points, shapes, "id", "name")) == [("big", 1), ("big", 2), ("small", 1)]
    assert nearby.points_in_shapes(points, shapes.limit(0), "id", "name").count() == 0


def test_batch_top_k_meets_few_pairs_on_clusters(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(20, 16)) * 5
    vectors = np.concatenate([m + rng.normal(size=(150, 16)) * 0.3 for m in middles]).astype(np.float32)
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, embedding array<float>")
    report = {}
    got = search.batch_top_k(index.filter("id % 3 = 0"), index, 5, "id", "id", block_rows=200, report=report)
    found = {(r.query_id, r.item_id, r.place) for r in got.collect()}
    exact = set()
    for q, scores in zip(range(0, 3000, 3), np.round(vectors[::3].astype(float) @ vectors.T.astype(float), search.SCORE_DIGITS)):
        order = np.lexsort((np.arange(len(scores)), -scores))[:5]
        exact |= {(q, int(i), n + 1) for n, i in enumerate(order)}
    assert found == exact
    assert report["all"] == 3_000_000 and report["scored"] < 0.25 * report["all"]


@pytest.mark.parametrize("pivots", [1, 3, 50])
def test_batch_top_k_is_exact_for_any_pivots(spark, pivots):
    rng = np.random.default_rng(pivots)
    vectors = np.round(rng.normal(size=(120, 3)), 1).astype(np.float32)
    vectors[40:80] = vectors[0]
    vectors[80:85] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(500, None)]
    index = spark.createDataFrame(rows, "id long, embedding array<float>")
    got = search.batch_top_k(index, index, 7, "id", "id", block_rows=9, pivots=pivots)
    found = {(r.query_id, r.item_id, r.place) for r in got.collect()}
    exact = set()
    for q, scores in enumerate(np.round(vectors.astype(float) @ vectors.T.astype(float), search.SCORE_DIGITS)):
        order = np.lexsort((np.arange(len(scores)), -scores))[:7]
        exact |= {(q, int(i), n + 1) for n, i in enumerate(order)}
    assert found == exact


def test_only_border_cells_need_a_ray(spark):
    def ring(points):
        return [{"lon": float(x), "lat": float(y)} for x, y in points]

    wavy = [(3 + (2 + 0.4 * math.sin(9 * t)) * math.cos(t), 1 + (2 + 0.4 * math.sin(9 * t)) * math.sin(t)) for t in np.linspace(0, 2 * math.pi, 400)]
    hole = [(2.5, 0.5), (3.5, 0.5), (3.5, 1.5), (2.5, 1.5)]
    square = [(10.0, 10.0), (10.2, 10.0), (10.2, 10.2), (10.0, 10.2), (10.0, 10.0)]
    shapes = spark.createDataFrame(
        [("wavy", [[ring(wavy), ring(hole)]]), ("square", [[ring(square)]]), ("none", [])], f"name string, shape {geo.SHAPE_TYPE}"
    )
    cover = nearby.shape_cells(shapes, "name").collect()
    inner = [c for c in cover if not c.border]
    assert len(inner) > 1000 and all(c.edges is None for c in inner)
    border = [c for c in cover if c.border and c.name == "wavy"]
    assert len(border) < len(inner) and max(len(c.edges) for c in border) < 60
    rng = random.Random(6)
    points = [(i, rng.uniform(0, 6), rng.uniform(-2, 4)) for i in range(3000)]
    points += [(5000 + i, 10 + x / 20, 10 + y / 20) for i, (x, y) in enumerate((x, y) for x in range(-1, 6) for y in range(-1, 6))]
    points += [(9000, None, 1.0)]

    def inside(x, y, rings):
        crossings = 0
        for r in rings:
            for (x1, y1), (x2, y2) in zip(r, [*r[1:], r[0]]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    crossings += 1
        return crossings % 2 == 1

    expected = {("wavy", i) for i, x, y in points if x is not None and inside(x, y, [wavy, hole])}
    expected |= {("square", i) for i, x, y in points if x is not None and inside(x, y, [square])}
    found = nearby.points_in_shapes(spark.createDataFrame(points, "id long, lon double, lat double"), shapes, "id", "name")
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 1000
