"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

1. A text is read in windows of as many words as an item of the benchmark has. A window can only
   be similar enough if that share of its shingles occurs in items of its size, so windows are
   first tested against a fixed bit set of shingles and sizes. The test drops no window that could
   pass the last step. A text with fewer words than an item is its own one window for it, as it can still
   be similar enough; it is joined with the item by the item's size.
2. What is left gets a 128-bit SimHash of its shingles, each weighted by how often it occurs.
3. Fingerprints are cut into ten blocks of 13 or 12 bits. Within 39 bits of each other, two of them differ by
   at most three bits in some block; items are posted under each block's value and all values up to three bits
   away (at most 378), so an equi-join on (window size, block, value) finds all within the radius. At a similarity
   of 0.8 the expected distance is 19 bits with a deviation of 4: the radius lies five deviations above it.
4. The exact similarity decides: the sum of the smaller weights of each shingle over the sum of the
   larger ones.

Equal windows (copies of one leak) are compared once and joined back to their texts.

Defined cases: null and empty texts and items match nothing; an item with fewer words than a
shingle is one shingle; of several windows that match an item in one text, the most similar,
then the earliest, is reported; repeated rows are reported once; rows without id are not
reported; an empty table or benchmark gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import dense
from tessera.llm.registry import register, table
from tessera.llm.words import WordReader, give_back, mix, rolling
from tessera.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, NUM, DEN = 5, 80, 100
WIDTHS = (13, 13, 13, 13, 12) * 2
APART = 3
RADIUS = (APART + 1) * len(WIDTHS) - 1
WINDOW_BYTES = 8 << 20
SHINGLE_BITS = 1 << 24
SECOND = np.uint64(0xA0761D6478BD642F)


def simhash(held: np.ndarray) -> tuple[int, int]:
    """128 bits: the sign of the sum of every bit over all shingles, repeats counted."""
    both = np.stack([held, mix(held + SECOND)], axis=1)
    bits = np.unpackbits(both.view(np.uint8).reshape(len(held), 16), axis=1)
    made = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(held)).view("<i8")
    return int(made[0]), int(made[1])


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(sum of smaller weights, sum of larger weights) of two bags of shingles."""
    x, cx = np.unique(a, return_counts=True)
    y, cy = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    smaller = int(np.minimum(cx[i], cy[j]).sum())
    return smaller, len(a) + len(b) - smaller


def digest_of(held: np.ndarray) -> int:
    """Digest of a bag of shingles, in whatever order."""
    return int(mix(held).sum(dtype=np.uint64).view(np.int64))


def sized(held: np.ndarray, n: int) -> np.ndarray:
    """Keys of shingles in items of ``n`` words."""
    return mix(held + np.uint64(n) * SECOND).view(np.int64)


def scan_items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, n, high, low, held) of every item with words."""

    def scan(batches):
        reader = WordReader(fold_case=True)
        for batch in batches:
            rows = []
            for item, words in zip(batch.column(0).to_pylist(), reader.rows(batch.column(1))):
                if len(words) and item is not None:
                    held = rolling(words, min(SHINGLE, len(words)))
                    rows.append((item, len(words), *simhash(held), held.tobytes()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "n", "high", "low", "held"])
        give_back()

    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))
    return settle(items.mapInArrow(scan, "item_id bigint, n bigint, high bigint, low bigint, held binary"), "benchmark_items")


def shingle_bits(items: DataFrame) -> np.ndarray:
    """Bits of all shingles of the benchmark, and of all shingles with the size of an item they are in."""

    def each(batches):
        for batch in batches:
            for n, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shingles = np.frombuffer(held, np.uint64)
                keys = np.concatenate([shingles.view(np.int64), sized(shingles, n)])
                yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])

    return dense.bit_set(items.select("n", "held").mapInArrow(each, "key bigint"), SHINGLE_BITS)


def scan_windows(documents: DataFrame, sizes: list[int], packed: np.ndarray) -> DataFrame:
    """(doc_id, start, n, words, high, low, digest, held) of windows that enough benchmark shingles occur in.

    ``n`` is the size of the items to compare with, ``words`` that of the window: less than ``n``
    where the whole text is shorter.
    """
    shared = documents.sparkSession.sparkContext.broadcast(packed)
    names = ["doc_id", "start", "n", "words", "high", "low", "digest", "held"]

    def windows(doc: int, words: np.ndarray, bits: np.ndarray):
        for width in sorted({min(SHINGLE, n) for n in sizes}):
            held = rolling(words, width)
            hits = np.flatnonzero(dense.holds(bits, held.view(np.int64)))
            for n in sizes:
                count = n - width + 1
                if min(SHINGLE, n) != width or len(hits) * DEN < NUM * count:
                    continue
                whole = min(count, len(held))
                own = np.zeros(len(held) + 1, dtype=np.int64)
                own[hits + 1] = dense.holds(bits, sized(held[hits], n))
                upto = np.cumsum(own)
                found = upto[whole:] - upto[:-whole]
                for start in np.flatnonzero(found * DEN >= NUM * count).tolist():
                    inside = held[start : start + whole]
                    yield doc, start, n, whole + width - 1, *simhash(inside), digest_of(inside), inside.tobytes()

    def scan(batches):
        reader, bits = WordReader(fold_case=True), shared.value
        for batch in batches:
            rows, held = [], 0
            for doc, words in zip(batch.column(0).to_pylist(), reader.rows(batch.column(1))):
                if doc is None or not len(words):
                    continue
                for row in windows(doc, words, bits):
                    rows.append(row)
                    held += len(row[-1])
                    if held >= WINDOW_BYTES:
                        yield packed_rows(rows)
                        rows, held = [], 0
            yield packed_rows(rows)
        give_back()

    def packed_rows(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return documents.mapInArrow(scan, "doc_id bigint, start bigint, n bigint, words bigint, high bigint, low bigint, digest bigint, held binary")


def block_value(block: int):
    half = len(WIDTHS) // 2
    word, first = ("high", 0) if block < half else ("low", half)
    return F.shiftrightunsigned(word, sum(WIDTHS[first:block])).bitwiseAND((1 << WIDTHS[block]) - 1).cast("int")


def blocks(rows: DataFrame, spread: bool) -> DataFrame:
    """A row per block with its value; with ``spread`` also all values up to ``APART`` bits away."""
    each = F.array(*[F.struct(F.lit(b).alias("block"), block_value(b).alias("value")) for b in range(len(WIDTHS))])
    cut = rows.select("*", F.explode(each).alias("_b")).select("*", "_b.block", "_b.value").drop("_b")
    if not spread:
        return cut
    flips = [x for x in range(1 << max(WIDTHS)) if x.bit_count() <= APART]
    past = F.element_at(F.array(*[F.lit(1 << w) for w in WIDTHS]), F.col("block") + 1)
    flipped = cut.withColumn("_flip", F.explode(F.lit(flips))).filter(F.col("_flip") < past)
    return flipped.withColumn("value", F.col("value").bitwiseXOR(F.col("_flip"))).drop("_flip")


def contaminated(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity: each text's best window for every item in it."""
    items = scan_items(benchmark, item_id, text)
    # as many numbers as items differ in length
    sizes = [r["n"] for r in items.select("n").distinct().orderBy("n").collect()]
    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    windows = settle(scan_windows(texts, sizes, shingle_bits(items)), "simhash_windows")
    classes = settle(windows.groupBy("n", "digest", "high", "low").agg(F.min("held").alias("held")), "window_classes")

    asked = blocks(classes.select("n", "digest", "high", "low"), spread=False)
    posted = blocks(items.select("item_id", "n", F.col("high").alias("i_high"), F.col("low").alias("i_low"), "high", "low"), spread=True)
    posted = settle(posted.drop("high", "low"), "item_blocks")
    distance = F.bit_count(F.col("high").bitwiseXOR(F.col("i_high"))) + F.bit_count(F.col("low").bitwiseXOR(F.col("i_low")))
    near = asked.join(posted, ["n", "block", "value"]).filter(distance <= RADIUS).select("n", "digest", "item_id").distinct()
    near = settle(near, "hamming_pairs")

    def compare(batches):
        for batch in batches:
            made = []
            for a, b in zip(batch.column(3), batch.column(4)):
                smaller, larger = weighted_similarity(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64))
                made.append(smaller / larger if smaller * DEN >= NUM * larger else None)
            done = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.float64())], names=["n", "digest", "item_id", "similarity"])
            yield done.filter(pa.array([x is not None for x in made], pa.bool_()))

    sides = near.join(classes.select("n", "digest", "held"), ["n", "digest"]).join(
        items.select("item_id", F.col("n").alias("i_n"), F.col("held").alias("i_held")), "item_id"
    )
    alike = sides.filter("n = i_n").select("n", "digest", "item_id", "held", "i_held")
    alike = settle(alike.mapInArrow(compare, "n bigint, digest bigint, item_id bigint, similarity double"), "similar_windows")
    hits = windows.select("doc_id", "start", "n", "words", "digest").join(alike, ["n", "digest"])
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "words")).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        (-F.col("best.back")).alias("start_word"),
        F.col("best.words").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``documents`` without the rows that hold an item of the benchmark."""
    leaks = settle(contaminated(documents, benchmark, doc_id).select(F.col("doc_id").alias(doc_id)).distinct(), "leaks")
    return documents.join(leaks, doc_id, "left_anti")


@register("op3_decontamination")
def op3_decontamination(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
