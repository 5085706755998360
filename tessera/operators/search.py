"""Embedding hook, top-k by dot product (one query or many), document tables."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import long_enough, strip, strip_citations
from tessera.operators.keep import keep_first
from tessera.operators.lookup import lookup_or_default
from tessera.operators.strata import ranked_slices, sample_rows
from tessera.session import bound_batches, settle

# The functions that run inside tasks travel by value: executors need numpy and pandas,
# but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Encoder = Callable[[list[str]], np.ndarray]

# Texts per encoder call, least characters, default result counts.
ENCODE_BATCH = 64
LEAST_REVIEW_CHARS = 20
LEAST_PARAGRAPH_CHARS = 30
REVIEW_RESULTS = 10
CONTEXT_RESULTS = 5

# Rows of a block of the many-question search, on either side; most pivots, and rings around each.
BLOCK_ROWS = 4000
MOST_PIVOTS = 256
PIVOT_SAMPLE = 4096
RINGS = 4

# Scores are compared after rounding to this many digits, so that equal vectors tie
# whatever order their products were summed in; ties go to the smaller id.
SCORE_DIGITS = 9
SCORE_SLACK = 1e-8


class LetterProfile:
    """Small deterministic encoder for tests and examples: counts of the letters a to z."""

    letters = "abcdefghijklmnopqrstuvwxyz"

    def __call__(self, texts: list[str]) -> np.ndarray:
        counts = [np.bincount(np.frombuffer(t.encode("utf-8"), np.uint8), minlength=256)[97:123] for t in texts]
        return np.array(counts, dtype=np.float32).reshape(-1, 26)


def embed(
    documents: DataFrame, text: str, load_encoder: Callable[[], Encoder], batch: int = ENCODE_BATCH
) -> DataFrame:
    """Add an ``embedding`` column. ``load_encoder`` runs once per task, not per row.

    Texts reach the encoder whole, ``batch`` at a time; only they leave the JVM, in batches bounded by bytes.
    """
    bound_batches(documents.sparkSession)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for column in columns:
            texts = column.fillna("").tolist()
            parts = [np.asarray(encoder(texts[i : i + batch]), dtype=np.float32) for i in range(0, len(texts), batch)]
            yield pd.Series([vector for part in parts for vector in part], dtype=object)

    return documents.withColumn("embedding", encode(F.col(text)))


def top_k(index: DataFrame, query_vector, k: int | None, id_column: str, where: Column | None = None) -> DataFrame:
    """The ``k`` most similar rows among those that pass ``where``; all of them, ranked, when k is None.

    The filter sits below the scoring. Only embeddings leave the JVM, a batch is scored by one matrix
    product, and the last ranking is a top-k per task before rows move.
    """
    pool = index if where is None else index.filter(where)
    asked = np.asarray(query_vector, dtype=np.float64)

    @F.pandas_udf(T.DoubleType())
    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            yield pd.Series(np.round(_matrix(column) @ asked, SCORE_DIGITS) if len(column) else [], dtype="float64")

    scored = pool.withColumn("similarity", score("embedding")).withColumn("distance", 1 - F.col("similarity"))
    ranked = scored.orderBy(F.col("similarity").desc(), F.col(id_column))
    return ranked if k is None else ranked.limit(k)


def search_reviews(
    index: DataFrame, query: str, encoder: Encoder, n_results: int | None = REVIEW_RESULTS, where: Column | None = None
) -> DataFrame:
    """Reviews most similar to a question; the encoder must be the index's own."""
    hits = top_k(index, encoder([query])[0], n_results, "id", where)
    return hits.drop("embedding")


def neighbourhood_context(
    index: DataFrame,
    query: str,
    encoder: Encoder,
    n_results: int | None = CONTEXT_RESULTS,
    neighbourhood: str | None = None,
) -> DataFrame:
    """Encyclopaedia paragraphs most similar to a question, optionally of one neighbourhood."""
    where = None if neighbourhood is None else F.col("neighbourhood") == neighbourhood
    hits = top_k(index, encoder([query])[0], n_results, "id", where)
    return hits.drop("embedding")


def dual_search(
    reviews: DataFrame,
    context: DataFrame,
    query: str,
    encoder: Encoder,
    neighbourhood: str | None = None,
    n_reviews: int = 5,
    n_context: int = 3,
) -> DataFrame:
    """Both indexes for one question, each result labelled with where it came from."""
    where = None if neighbourhood is None else F.col("neighbourhood") == neighbourhood
    shown = ["source", "id", "document", "neighbourhood", "similarity", "distance"]
    said = search_reviews(reviews, query, encoder, n_reviews, where)
    written = neighbourhood_context(context, query, encoder, n_context, neighbourhood)
    return (
        said.withColumn("source", F.lit("search_reviews"))
        .select(*shown)
        .unionByName(written.withColumn("source", F.lit("get_neighbourhood_context")).select(*shown))
    )


def _best_per_query(query_ids, item_ids, scores, k: int) -> pd.DataFrame:
    """Cut candidate triples to the k best of each query, ties to the smaller item."""
    _, item_code = np.unique(item_ids, return_inverse=True)
    _, query_code = np.unique(query_ids, return_inverse=True)
    order = np.lexsort((item_code, -scores, query_code))
    sorted_code = query_code[order]
    starts = np.r_[0, np.flatnonzero(np.diff(sorted_code)) + 1]
    lengths = np.diff(np.r_[starts, len(order)])
    place = np.arange(len(order)) - np.repeat(starts, lengths)
    kept = order[place < k]
    columns = {"query_id": query_ids, "item_id": item_ids, "similarity": scores}
    # text ids stay plain objects
    return pd.DataFrame({name: pd.Series(values[kept], dtype=values.dtype) for name, values in columns.items()})


def _score_block(
    queries: np.ndarray, query_ids: np.ndarray, items: np.ndarray, item_ids: np.ndarray, k: int, least: np.ndarray | None = None
) -> pd.DataFrame:
    """k best items of one block for each query, scored by matrix products of bounded size; none below its ``least``."""
    step = max(k, 4_000_000 // max(len(queries), 1))
    found = []
    for start in range(0, len(items), step):
        scores = np.round(queries @ items[start : start + step].T, SCORE_DIGITS)
        keep = np.ones_like(scores, dtype=bool) if least is None else scores >= least[:, None]
        if scores.shape[1] > k and np.count_nonzero(keep) > k * len(queries):
            keep &= scores >= np.partition(scores, -k, axis=1)[:, -k][:, None]
        rows, cols = np.nonzero(keep)
        found.append((query_ids[rows], item_ids[start + cols], scores[rows, cols]))
    return _best_per_query(*(np.concatenate(part) for part in zip(*found)), k)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


@dataclass(frozen=True)
class Regions:
    """Where the index rows lie: rings around pivots, each with its radius and number of rows."""

    pivots: np.ndarray
    pivot: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def best_and_bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per vector and region: the product with the pivot, and a bound that no row's product passes."""
        middle = (vectors @ self.pivots.T)[:, self.pivot]
        # Cauchy-Schwarz: q.x = q.c + q.(x - c) and |x - c| <= radius
        return middle, middle + np.linalg.norm(vectors, axis=1)[:, None] * self.radius

    def first(self, vectors: np.ndarray, k: int) -> np.ndarray:
        """Per vector the regions with the closest pivots that hold ``k`` rows together."""
        middle, _ = self.best_and_bounds(vectors)
        order = np.argsort(-middle, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1)
        needed = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(needed, order, held - self.rows[order] < k, axis=1)
        return needed

    def rest(self, vectors: np.ndarray, k: int, least: np.ndarray) -> np.ndarray:
        """Per vector the other regions that may hold a product of ``least`` or more."""
        _, bound = self.best_and_bounds(vectors)
        slack = SCORE_SLACK * (1 + np.abs(bound))
        return (bound + slack >= least[:, None]) & ~self.first(vectors, k)


def _vectors(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Rows of lists, or of the bytes that ``_packed`` made of them, as a matrix of doubles."""
    many = len(column)
    if not many:
        return np.zeros((0, 0))
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        values, widths = np.frombuffer(b"".join(column.to_pylist()), dtype=kind), pc.binary_length(column)
        width = pc.max(widths).as_py() // np.dtype(kind).itemsize
    else:
        values, widths = column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column)
        width = pc.max(widths).as_py()
    if pc.min(widths) != pc.max(widths):
        raise ValueError("all vectors must have the same length")
    return values.astype(np.float64).reshape(many, width)


def _packed(vectors: np.ndarray, kind: str) -> pa.Array:
    """One value of bytes per vector: between JVM and workers a list would pass element by element."""
    return pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())


def _kind(rows: DataFrame) -> str:
    """How the numbers of ``embedding`` are packed: floats stay floats, all others are doubles."""
    return "<f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"


def _spread(sample: np.ndarray, many: int) -> np.ndarray:
    """At most ``many`` different vectors of a sample, each the one farthest from those before it."""
    chosen, away = [0], np.full(len(sample), np.inf)
    while len(chosen) < many:
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if away.max() <= 0:
            break
        chosen.append(int(np.argmax(away)))
    return sample[chosen]


def _near_pivots(items: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """Items, packed, with their nearest pivot and the distance to it."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (pivots**2).sum(axis=1) / 2
        for batch in batches:
            if batch.num_rows:
                vectors = _vectors(batch.column("embedding"), kind)
                pivot = np.argmax(vectors @ pivots.T - half, axis=1)
                away = np.linalg.norm(vectors - pivots[pivot], axis=1)
                columns = [batch.column("item_id"), _packed(vectors, kind), pa.array(pivot.astype(np.int32)), pa.array(away)]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "embedding", "_pivot", "_away"])

    added = T._parse_datatype_string("embedding binary, _pivot int, _away double").fields
    return items.mapInArrow(near, T.StructType([items.schema["item_id"], *added]))


def _aimed(queries: DataFrame, regions: Regions, k: int, kind: str, second: bool) -> DataFrame:
    """Queries, packed, with the regions that they have to meet; ``second`` takes ``_least`` into account."""

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _vectors(batch.column("embedding"), kind)
                if second:
                    least = batch.column("_least")
                    needed = regions.rest(vectors, k, least.to_numpy(zero_copy_only=False))
                else:
                    least = pa.array(np.full(batch.num_rows, -np.inf))
                    needed = regions.first(vectors, k)
                rows, targets = np.nonzero(needed)
                upto = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(upto), pa.array(targets.astype(np.int32)))
                columns = [batch.column("query_id"), _packed(vectors, kind), least, lists]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "embedding", "_least", "_targets"])

    added = T._parse_datatype_string("embedding binary, _least double, _targets array<int>").fields
    return queries.mapInArrow(aim, T.StructType([queries.schema["query_id"], *added]))


def _scored_pairs(aimed: DataFrame, items: DataFrame, k: int, block_rows: int, kinds: tuple[str, str]) -> tuple[DataFrame, int]:
    """The k best of every query within the regions it aims at; and the number of pairs that this scores.

    Products below a query's ``_least`` do not leave a task. A region's rows come in pieces and its queries in slices of about ``block_rows``; a piece and a slice
    are one group, scored by one matrix product.
    """
    pairs = aimed.select("query_id", "embedding", "_least", F.explode("_targets").alias("_region"))
    asked = {r["_region"]: r["count"] for r in pairs.groupBy("_region").count().collect()}
    held = {r["_region"]: (r["n"], r["pieces"]) for r in items.groupBy("_region").agg(F.count(F.lit(1)).alias("n"), (F.max("_piece") + 1).alias("pieces")).collect()}
    # one row per region: a bounded number
    plan = items.sparkSession.createDataFrame(
        [(g, -(-n // block_rows), held[g][1]) for g, n in sorted(asked.items())], "_region int, _slices int, _pieces int"
    )
    plan = F.broadcast(plan)
    left = (
        pairs.join(plan, "_region")
        .withColumn("_slice", F.pmod(F.xxhash64("query_id"), F.col("_slices")).cast("int"))
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .select("_region", "_piece", "_slice", "query_id", "embedding", "_least")
    )
    right = (
        items.join(plan, "_region")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .select("_region", "_piece", "_slice", "item_id", "embedding")
    )
    fields = [aimed.schema["query_id"], items.schema["item_id"], T.StructField("similarity", T.DoubleType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def pair(asked: pa.Table, held: pa.Table) -> pa.Table:
        types = [asked.schema.field("query_id").type, held.schema.field("item_id").type, pa.float64()]
        columns = [[], [], []]
        if asked.num_rows and held.num_rows:
            ids = [side.column(name).to_numpy(zero_copy_only=False) for side, name in ((asked, "query_id"), (held, "item_id"))]
            sides = [_vectors(side.column("embedding"), kind) for side, kind in zip((asked, held), kinds)]
            best = _score_block(sides[0], ids[0], sides[1], ids[1], k, asked.column("_least").to_numpy())
            columns = [best[name].to_numpy() for name in ("query_id", "item_id", "similarity")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "item_id", "similarity"])

    group = ["_region", "_piece", "_slice"]
    scored = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(pair, schema)
    return scored, sum(n * held[g][0] for g, n in asked.items())


def _best(scored: DataFrame, k: int) -> DataFrame:
    return keep_first(scored, ["query_id"], [F.col("similarity").desc(), F.col("item_id")], k, rank_as="place")


def batch_top_k(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    query_id: str,
    item_id: str,
    block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
    report: dict[str, int] | None = None,
) -> DataFrame:
    """The k best index rows of every query vector: (query_id, item_id, similarity, place). Exact.

    Both sides carry an ``embedding``; rows without one are left out, and query ids are unique. Index rows belong to their nearest pivot and
    to a ring around it; the pivots are at most ``MOST_PIVOTS`` of a sample of ``PIVOT_SAMPLE`` rows, far apart, so what
    every task is sent does not grow with the data. A query first meets the regions with the closest pivots,
    as many as hold k rows. Their k-th product is a floor: of the other regions only those are
    met whose bound (Cauchy-Schwarz on the ring's radius) reaches it. How many pairs that
    leaves depends on how the vectors cluster; without clusters it is all of them, which an exact
    search cannot avoid. No pair of rows is ever a row; k rows per query leave a group.
    ``report`` is given the numbers of pairs ``scored`` and ``all``.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col("embedding").alias("embedding")).filter("embedding IS NOT NULL")
    items = index.select(F.col(item_id).alias("item_id"), F.col("embedding").alias("embedding")).filter("embedding IS NOT NULL")
    n = items.count()
    many = min(MOST_PIVOTS, math.isqrt(n) // 2 + 1) if pivots is None else min(pivots, MOST_PIVOTS)
    sample = items.orderBy(F.xxhash64("item_id"), "item_id").select("embedding").limit(PIVOT_SAMPLE).collect()
    if not sample:
        fields = [q.schema["query_id"], items.schema["item_id"]]
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        return items.sparkSession.createDataFrame([], f"{kinds}, similarity double, place int")
    centres = _spread(np.array([r["embedding"] for r in sample], dtype=np.float64), many)
    kinds = (_kind(q), _kind(items))
    placed = settle(_near_pivots(items, centres, kinds[1]), "near-pivots")
    widest = F.broadcast(placed.groupBy("_pivot").agg(F.max("_away").alias("_widest")))
    # ring 0 holds what lies on the pivot, the others equal parts of its reach
    ring = F.when(F.col("_away") == 0, 0).otherwise(F.least(F.ceil(F.col("_away") / F.col("_widest") * RINGS), F.lit(RINGS)))
    ringed = placed.join(widest, "_pivot").withColumn("_region", (F.col("_pivot") * (RINGS + 1) + ring).cast("int"))
    summary = ringed.groupBy("_region").agg(F.max("_away").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("_region").collect()
    number = {r["_region"]: i for i, r in enumerate(summary)}
    regions = Regions(
        centres,
        np.array([r["_region"] // (RINGS + 1) for r in summary]),
        np.array([r["radius"] for r in summary]),
        np.array([r["n"] for r in summary]),
    )
    listed = F.broadcast(
        items.sparkSession.createDataFrame(
            [(r["_region"], number[r["_region"]], -(-r["n"] // block_rows)) for r in summary], "_region int, _number int, _pieces int"
        )
    )
    dealt = settle(
        ringed.join(listed, "_region").select(
            "item_id", "embedding", F.col("_number").alias("_region"), F.pmod(F.xxhash64("item_id"), F.col("_pieces")).cast("int").alias("_piece")
        ),
        "index-regions",
    )
    aimed = settle(_aimed(q, regions, k, kinds[0], False), "first-regions")
    scored, near_pairs = _scored_pairs(aimed, dealt, k, block_rows, kinds)
    found = settle(_best(scored, k), "first-found")
    floor = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("similarity")).otherwise(F.lit(float("-inf"))).alias("_least"))
    again = settle(_aimed(aimed.select("query_id", "embedding").join(floor, "query_id"), regions, k, kinds[0], True), "other-regions")
    more, far_pairs = _scored_pairs(again, dealt, k, block_rows, kinds)
    if report is not None:
        report |= {"scored": near_pairs + far_pairs, "all": n * aimed.count()}
    return _best(found.drop("place").unionByName(more), k)


def numbered_keys(reviews: DataFrame) -> DataFrame:
    """(review_key, seq): the place of each text among those of its listing and day.

    Made from narrow keys, without the text, and without gathering a listing's day in one task. The keys
    are settled, since ranges are found by a first pass over them, which would read the texts as well.
    """
    day = ["listing_id", "review_date"]
    keys = settle(reviews.select(*day, "review_key"), "review-keys")
    placed, offsets = ranked_slices(keys, day, ["review_key"])
    numbered = placed.join(offsets, [*day, "_slice"])
    return settle(numbered.select("review_key", (F.col("_before") + F.col("_place")).alias("seq")), "review-numbers")


def review_documents(reviews: DataFrame) -> DataFrame:
    """Index documents of review texts: id, document and metadata columns.

    The id is listing and date; from the second text of a listing on one day a
    sequence number follows, so that no text overwrites another. Expects listing_id,
    review_date, review_key (unique), neighbourhood, comments. Texts move at most once, by their
    own key, and not at all where the numbers are few enough to be broadcast.
    """
    base = F.concat_ws("_", F.col("listing_id").cast("string"), F.col("review_date").cast("string"))
    numbered = reviews.join(numbered_keys(reviews), "review_key")
    return numbered.select(
        F.when(F.col("seq") == 1, base).otherwise(F.concat_ws("_", base, F.col("seq").cast("string"))).alias("id"),
        strip(F.col("comments")).alias("document"),
        "listing_id",
        "review_date",
        "neighbourhood",
    )


def placed_reviews(texts: DataFrame, listings: DataFrame) -> DataFrame:
    """Review texts long enough to index, with the neighbourhood of their listing or "Unknown".

    The listings that have texts are settled first, by their ids alone: the texts themselves need not
    be gathered by listing where these are few enough to be broadcast, and a listing is cleaned once.
    """
    named = listings.select("listing_id", "neighbourhood").join(texts.select("listing_id").distinct(), "listing_id", "left_semi")
    enough = texts.filter(long_enough(F.col("comments"), LEAST_REVIEW_CHARS))
    return lookup_or_default(enough, settle(named, "named-listings"), "listing_id", "neighbourhood")


def build_review_index(
    reviews: DataFrame, load_encoder: Callable[[], Encoder], sample_size: int | None = None
) -> DataFrame:
    """Numbered and embedded review documents of all texts, or of a stratified sample of ``sample_size``.

    Expects neighbourhood (see ``placed_reviews``), listing_id, review_date, review_key, comments.
    """
    chosen = reviews
    if sample_size is not None:
        chosen = sample_rows(reviews, "neighbourhood", "listing_id", ["review_date", "review_key"], sample_size)
    return embed(review_documents(chosen), "document", load_encoder)


def build_context_index(
    articles: DataFrame, load_encoder: Callable[[], Encoder], boroughs: DataFrame | None = None
) -> DataFrame:
    """Embedded paragraphs of all articles."""
    return embed(paragraph_documents(articles, boroughs), "document", load_encoder)


def paragraph_documents(articles: DataFrame, boroughs: DataFrame | None = None) -> DataFrame:
    """One index document per intro paragraph, numbered by its place in the article.

    Citation markers are removed; paragraphs under 30 characters are dropped but keep
    their number. Expects neighbourhood, borough, wikipedia_url, intro_paragraphs; a
    missing borough is looked up, and is "Unknown" when the lookup has none.
    """
    rows = articles.select(
        "neighbourhood", "borough", "wikipedia_url", F.posexplode("intro_paragraphs").alias("paragraph_index", "_raw")
    ).withColumn("document", strip(strip_citations(F.col("_raw"))))
    rows = rows.filter(long_enough(F.col("document"), LEAST_PARAGRAPH_CHARS))
    known = F.nullif(F.col("borough"), F.lit(""))
    if boroughs is not None:
        names = boroughs.select("neighbourhood", F.col("borough").alias("_looked_up"))
        rows = rows.join(names, "neighbourhood", "left")
        known = F.coalesce(known, F.col("_looked_up"))
    return rows.select(
        F.concat(F.col("neighbourhood"), F.lit("_para_"), F.col("paragraph_index").cast("string")).alias("id"),
        "document",
        "neighbourhood",
        F.coalesce(known, F.lit("Unknown")).alias("borough"),
        "wikipedia_url",
        "paragraph_index",
    )
