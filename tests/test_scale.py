"""Tables at size: what a plan does once, and what one task is given."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import search
from tessera.plans import gold, silver
from tessera.session import BATCH_BYTES, BATCH_SETTING, scratch_path
from tessera.sources import landing
from tessera.sources.index_store import IndexStore


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_taken_apart_once(spark):
    pages = spark.createDataFrame(
        [("A", "<p>One about the town.</p><p>Two</p>"), ("B", "no paragraph"), ("D", "<p>One of the town</p><h2>x</h2><p>late</p>")],
        "neighbourhood string, html string",
    )
    articles = landing.accepted(landing.articles_from_pages(pages, "html", ("the",)))
    assert optimized(articles).count("<!--") + optimized(articles).count("(?:!--") == 1
    assert {r.neighbourhood: r.intro_paragraphs for r in articles.collect()} == {"A": ["One about the town.", "Two"], "D": ["One of the town"]}
    assert landing.articles_from_pages(pages, "html", ("the",)).count() == 3


def test_texts_do_not_move_to_be_placed(spark):
    texts = spark.range(200).selectExpr("CASE WHEN id % 10 = 9 THEN id ELSE 1 END AS listing_id", "concat('a text long enough ', id) AS comments", "id AS review_key")
    listings = silver.keep_one(spark.range(100).selectExpr("id % 50 AS listing_id", "concat('N', id % 50) AS neighbourhood"), ["listing_id"])
    placed = search.placed_reviews(texts, listings)
    assert "Window" not in optimized(placed)  # listings are cleaned before, not along with the texts
    shown = {r.review_key: r.neighbourhood for r in placed.collect()}
    assert len(shown) == 200 and shown[0] == "N1" and shown[9] == "N9" and shown[59] == "Unknown"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
        plan = search.placed_reviews(texts, listings)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_products_below_the_floor_stay_in_their_task():
    items, numbers = np.arange(20, dtype=float)[:, None], np.arange(20)
    found = search._score_block(np.array([[1.0], [1.0]]), np.array([7, 8]), items, numbers, 5, np.array([18.0, -np.inf]))
    assert [tuple(r) for r in found.itertuples(index=False)] == [(7, 19, 19.0), (7, 18, 18.0), *[(8, i, float(i)) for i in (19, 18, 17, 16, 15)]]


@pytest.mark.parametrize(("kind", "of"), [("<f4", pa.float32()), ("<f8", pa.float64())])
def test_packed_vectors_are_the_same(kind, of):
    given = [[1.5, -0.1], [3e-30, 2.0], [0.0, 7.25]]
    lists = pa.chunked_array([pa.array(given[:1], pa.list_(of)), pa.array(given[1:], pa.list_(of))])
    plain = search._vectors(lists, kind)
    assert plain.tolist() == np.array(given, dtype=kind).astype(float).tolist()
    assert search._vectors(search._packed(plain, kind), kind).tolist() == plain.tolist()
    with pytest.raises(ValueError):
        search._vectors(pa.array([[1.0], [1.0, 2.0], [1.0, 2.0, 3.0]], pa.list_(of)), kind)


def test_batch_top_k_of_doubles_is_exact(spark):
    values = np.random.default_rng(3).normal(size=(80, 5))
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id long, embedding array<double>")
    queries = index.selectExpr("id AS q", "cast(embedding AS array<float>) AS embedding")
    found = {(r.query_id, r.item_id, r.place) for r in search.batch_top_k(queries, index, 4, "q", "id", block_rows=16).collect()}
    scores = np.round(values.astype(np.float32).astype(float) @ values.T, search.SCORE_DIGITS)
    assert found == {(q, int(i), n + 1) for q, row in enumerate(scores) for n, i in enumerate(np.lexsort((np.arange(80), -row))[:4])}


def test_complaints_are_read_once_and_counted_by_type(spark):
    day = "2024-05-06T01:02:03.000"
    given = [("a", day, "X"), ("b", day, None), (None, day, "Y"), ("c", day, "X"), ("d", "2024-05-06", "X"), ("e", None, "X")]
    raw = spark.createDataFrame(given, "unique_key string, created_date string, complaint_type string").selectExpr(
        "*", "'queens' AS borough", "'' AS descriptor", "'1' AS latitude", "'2' AS longitude"
    )
    raw = raw.unionByName(raw.withColumn("borough", F.lit("Elsewhere")))
    complaints = silver.clean_complaints(raw)
    assert complaints.columns == ["unique_key", "complaint_date", "borough", "complaint_type", "descriptor", "latitude", "longitude", "year", "month"]
    monthly = gold.noise_borough_month(complaints)
    plan = optimized(monthly)
    assert plan.count("RLIKE") == 1 and plan.count("Aggregate [") == 2
    assert [tuple(r) for r in monthly.collect()] == [("Queens", 2024, 5, 3, ["X", "Y"])]
    assert gold.noise_borough_month(complaints.filter("complaint_type IS NULL")).first().complaint_types == []


def test_a_large_bucket_is_written_by_many_tasks(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    store = IndexStore(spark, scratch_path(spark, "one-bucket"), buckets=1)
    given = spark.range(0, 20_000, 1, 8).selectExpr("cast(id AS string) AS id", "sha2(cast(id AS string), 512) AS document")
    try:
        spark.conf.set(name, "256k")
        _, written = store.replace(given)
        store.apply(given.filter("id < 10000").withColumn("document", F.lit("new")), given.select("id").filter("id >= 19000"))
    finally:
        spark.conf.set(name, before)
    base, _ = list(store.version().bases), store.version().deltas
    files = spark.read.parquet(base[0]).select(F.input_file_name().alias("f")).distinct().count()
    assert written == 20_000 and files > 2
    assert store.read().count() == 19_000 and store.read().filter("document = 'new'").count() == 10_000
    store.compact()
    assert store.read().count() == 19_000 and store.read().select("id").distinct().count() == 19_000


def test_texts_reach_the_encoder_in_batches_of_bytes(spark):
    class Sizes:
        """Encodes every text of a call as the number of characters of all of them."""

        def __call__(self, texts):
            return np.full((len(texts), 1), sum(map(len, texts)), dtype=np.float32)

    before = spark.conf.get(BATCH_SETTING)
    try:
        spark.conf.unset(BATCH_SETTING)
        texts = spark.range(0, 300, 1, 1).selectExpr("id", "repeat('x', 100000) AS text")
        widest = search.embed(texts, "text", Sizes, batch=100_000).agg(F.max(F.col("embedding")[0])).first()[0]
        assert 100_000 <= widest <= 2 * BATCH_BYTES
        spark.conf.set(BATCH_SETTING, "12345678")
        search.embed(texts, "text", Sizes)
        assert spark.conf.get(BATCH_SETTING) == "12345678"  # a setting of the caller stays
    finally:
        spark.conf.set(BATCH_SETTING, before)
