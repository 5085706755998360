"""Embedding, top-k and the two text indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import refresh, search
from tessera.session import scratch_path, settle
from tessera.sources import sinks
from tessera.sources.index_store import IndexStore
from tessera.workload import roles
from tessera.workload.oracle import letter_dot, letters
from tessera.workload.registry import query
from tessera.workload.shared import accepted_articles, valid_texts


def _vector(spark, sf, vec_id: int) -> list[float]:
    row = roles.table(spark, sf, "embeddings").filter(F.col("vec_id") == vec_id).select("embedding").first()
    return row["embedding"]


def _ranked_vectors(where: str) -> str:
    score = "round(list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9)"
    return f"""SELECT e.vec_id, e.label::BIGINT AS label, round({score}, 6) AS similarity, round(1 - {score}, 6) AS distance
        FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q WHERE {where}
        ORDER BY {score} DESC, e.vec_id LIMIT 10"""


@query("vector_topk", _ranked_vectors("true"))
def vector_topk(spark, sf):
    """The ten vectors with the largest inner product with one of them."""
    index = roles.table(spark, sf, "embeddings")
    return search.top_k(index, _vector(spark, sf, 7), 10, "vec_id").drop("embedding")


@query("vector_topk_filtered", _ranked_vectors("e.label = 3 AND e.vec_id >= 50"))
def vector_topk_filtered(spark, sf):
    """The same among rows that pass an equality and a lower bound on their metadata."""
    where = (F.col("label") == 3) & (F.col("vec_id") >= 50)
    index = roles.table(spark, sf, "embeddings")
    return search.top_k(index, _vector(spark, sf, 7), 10, "vec_id", where).drop("embedding")


@query(
    "batch_vector_topk",
    """SELECT query_id, item_id, round(s, 6) AS similarity, place FROM (
        SELECT q.vec_id AS query_id, e.vec_id AS item_id, s, row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, e.vec_id) AS place
        FROM embeddings q, embeddings e, LATERAL (SELECT round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS s) t)
    WHERE place <= 5""",
)
def batch_vector_topk(spark, sf):
    """Top five for every vector as a question, scored block by block."""
    vectors = roles.table(spark, sf, "embeddings")
    return search.batch_top_k(vectors, vectors, 5, "vec_id", "vec_id")


@query(
    "embed_documents",
    "SELECT doc_id, "
    + ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::BIGINT AS n_{c}" for c in "aeiourst")
    + " FROM documents",
)
def embed_documents(spark, sf):
    """Whole texts through an encoder loaded once per task."""
    rows = roles.table(spark, sf, "documents").select("doc_id", "text")
    vectors = search.embed(rows, "text", search.LetterProfile)
    position = search.LetterProfile.letters.index
    return vectors.select(
        "doc_id", *[F.col("embedding")[position(c)].cast("bigint").alias(f"n_{c}") for c in "aeiourst"]
    )


def _digest(index: DataFrame) -> DataFrame:
    """Index rows with text and vector reduced to what both engines can show."""
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return index.select(
        "id", "neighbourhood", F.md5("document").alias("text_md5"), total.alias("letters"), F.col("embedding")[4].alias("letter_e")
    )


def _digest_sql(role: str) -> str:
    return f"""SELECT id, neighbourhood, md5(document) AS text_md5, list_sum({letters('document')}) AS letters,
        (length(document) - length(replace(document, 'e', '')))::DOUBLE AS letter_e FROM {role}"""


def _build_review_index(spark, sf):
    return search.build_review_index(valid_texts(spark, sf), search.LetterProfile)


def _build_context_index(spark, sf):
    return search.build_context_index(accepted_articles(spark, sf), search.LetterProfile, roles.page_boroughs(spark, sf))


@query("review_index", _digest_sql("review_document"))
def review_index(spark, sf):
    """The review index of all valid texts, written with one row per id."""
    stored, _ = sinks.write_index(_build_review_index(spark, sf), scratch_path(spark, "review-index"))
    return _digest(stored)


@query("context_index", _digest_sql("paragraph"))
def context_index(spark, sf):
    stored, _ = sinks.write_index(_build_context_index(spark, sf), scratch_path(spark, "context-index"))
    return _digest(stored)


@query(
    "index_refresh",
    f"""SELECT id, neighbourhood, md5(document) AS text_md5, list_sum({letters('document')}) AS letters FROM (
        SELECT id, neighbourhood, CASE WHEN listing_id % 50 = 3 THEN document || ' revised' ELSE document END AS document
        FROM review_document WHERE listing_id % 50 <> 7)""",
)
def index_refresh(spark, sf):
    """A stored review index brought in step with texts of which some changed and some left."""
    documents = search.review_documents(valid_texts(spark, sf)).select("id", "document", "neighbourhood", "listing_id")
    first = settle(documents, "first-texts")
    turn = F.col("listing_id") % 50
    text = F.when(turn == 3, F.concat("document", F.lit(" revised"))).otherwise(F.col("document"))
    later = first.filter(turn != 7).withColumn("document", text)
    store = IndexStore(spark, scratch_path(spark, "review-index"), buckets=8)
    for state in (first, later):
        refresh.refresh_index(store, state, search.LetterProfile)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return store.read().select("id", "neighbourhood", F.md5("document").alias("text_md5"), total.alias("letters"))


def published_review_index(spark, sf):
    return roles.once(spark, sf, "review_index", lambda: _build_review_index(spark, sf))


def published_context_index(spark, sf):
    return roles.once(spark, sf, "context_index", lambda: _build_context_index(spark, sf))


def review_search_sql(words: str, k: int, where: str = "true") -> str:
    score = letter_dot("document", words)
    return f"""SELECT id, md5(document) AS text_md5, listing_id, review_date::VARCHAR AS review_date, neighbourhood,
        {score} AS similarity, 1 - {score} AS distance FROM review_document WHERE {where} ORDER BY similarity DESC, id LIMIT {k}"""


CHECK_IN = "smooth self check-in with clear instructions"


@query("q04_checkin_texts", review_search_sql(CHECK_IN, 10))
def q04_checkin_texts(spark, sf):
    """Texts closest to a question, over all valid texts."""
    hits = search.search_reviews(published_review_index(spark, sf), CHECK_IN, search.LetterProfile())
    return hits.withColumn("text_md5", F.md5("document")).drop("document")


CHARACTER = "the character and history of the area"


@query(
    "context_topk",
    f"""SELECT id, md5(document) AS text_md5, neighbourhood, borough, {letter_dot('document', CHARACTER)} AS similarity
    FROM paragraph ORDER BY similarity DESC, id LIMIT 5""",
)
def context_topk(spark, sf):
    hits = search.neighbourhood_context(published_context_index(spark, sf), CHARACTER, search.LetterProfile())
    return hits.select("id", F.md5("document").alias("text_md5"), "neighbourhood", "borough", "similarity")


def _dual_sql(words: str, review_where: str, context_where: str) -> str:
    def part(source: str, role: str, where: str, k: int) -> str:
        return f"""(SELECT '{source}' AS source, id, md5(document) AS text_md5, neighbourhood,
            {letter_dot('document', words)} AS similarity FROM {role} WHERE {where} ORDER BY similarity DESC, id LIMIT {k})"""

    return (
        part("search_reviews", "review_document", review_where, 5)
        + " UNION ALL "
        + part("get_neighbourhood_context", "paragraph", context_where, 3)
    )


def _dual(spark, sf, words: str, neighbourhood: str | None = None):
    reviews, context = published_review_index(spark, sf), published_context_index(spark, sf)
    hits = search.dual_search(reviews, context, words, search.LetterProfile(), neighbourhood)
    return hits.select("source", "id", F.md5("document").alias("text_md5"), "neighbourhood", "similarity")


@query("dual_search", _dual_sql(CHARACTER, "true", "true"))
def dual_search(spark, sf):
    """Both indexes for one question, labelled by source."""
    return _dual(spark, sf, CHARACTER)


STAYING = "what do guests say about staying here"


@query("q10_area_texts", _dual_sql(STAYING, "neighbourhood = 'NATION_19'", "neighbourhood = 'NATION_19'"))
def q10_area_texts(spark, sf):
    """Texts of one neighbourhood, with context where the encyclopaedia has it."""
    return _dual(spark, sf, STAYING, "NATION_19")


@query("q14_context_and_texts", _dual_sql(STAYING, "neighbourhood = 'NATION_17'", "neighbourhood = 'NATION_17'"))
def q14_context_and_texts(spark, sf):
    return _dual(spark, sf, STAYING, "NATION_17")
