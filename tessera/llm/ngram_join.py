"""N-gram Jaccard self-join: rare-first prefix filtering, verified once per pair.

1. One pass hashes the shingles of every whole text. Texts with the same shingle set are one class
   (set digest and size), so copies never meet as pairs.
2. Shingles are ordered rare first: by the number of texts in their bucket of a fixed table of 2^20
   counters filled from all texts, then by hash. Any total order keeps the join exact; this one
   puts what few texts share into the prefixes.
3. Each text posts its prefix, as long as the threshold asks. Of a posted n-gram's texts, the
   one with it earliest (the least edited) is the hub; every other is compared with the hub
   it shares most n-grams with, after the length, positional and suffix filters. Suffix filter: texts are cut at seven fixed
   hashes and the differences of the eight parts' sizes bound the difference of the sets.
4. Pairs are made distinct and verified on the full sets. Components follow from the links.
5. What hubs left apart is compared exactly: where an n-gram joins several components, each text
   outside the hub's component meets all texts of other components, under the same filters, so no
   link between components is lost.
6. Links exist only inside components, which are now exact. To count them, the classes of a component
   are dealt into blocks of bounded size by their hash, and every two blocks are one group, in which
   all pairs that the length filter leaves are verified on the full sets. Only counts leave a group,
   but the work on a component is the square of its classes, as is the number of links it may hold.

Defined cases: a null or empty text, or one of separators only, has an empty set and links with nothing;
fewer words than a shingle make one shingle of all; equal sets link; repeated rows are equal
sets; a row without id links with nothing; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import dense
from tessera.llm.components import components
from tessera.llm.registry import register, table
from tessera.llm.words import WordReader, give_back, mix, shingles
from tessera.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 20
SKETCH_BITS = 2048
MEMBER_BITS = 1 << 24
TOKEN_BITS = 1 << 26
PARTS = 8
BLOCK_TEXTS, BLOCK_SHINGLES = 128, 1 << 16


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for words in WordReader(fold_case=True).rows(column):
        yield np.unique(shingles(words, size))


def set_digest(held: np.ndarray) -> int:
    return int(mix(held + np.uint64(0x51ED270B)).sum(dtype=np.uint64).view(np.int64)) if len(held) else 0


def buckets_of(held: np.ndarray) -> np.ndarray:
    return (held >> np.uint64(44)).astype(np.int64)


def prefix_length(n: int, num: int, den: int) -> int:
    """Tokens of which any set similar enough must share one: all but the least overlap, plus one."""
    return n - -(-num * n // den) + 1


def part_sizes(held: np.ndarray) -> int:
    """Sizes of the eight parts of a set, a byte each, topped at 255 (which keeps the bound)."""
    sizes = np.minimum(np.bincount((held >> np.uint64(61)).astype(np.int64), minlength=PARTS), 255)
    return int(sizes.astype(np.uint8).view("<i8")[0])


def sketch(held: np.ndarray) -> bytes:
    """A bit per slot that some member falls into; two sets differ in at least as many members as bits."""
    bits = np.zeros(SKETCH_BITS, dtype=bool)
    bits[(held & np.uint64(SKETCH_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def scan_sets(documents: DataFrame, size: int) -> DataFrame:
    """Written once: a row (doc_id, n, cls) per text, and rows (chunk, blob) of the n-gram counters."""

    def scan(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            ns, digests = [], []
            for held in shingle_sets(batch.column(1), size):
                ns.append(len(held))
                digests.append(set_digest(held))
                np.add.at(counts, buckets_of(held), 1)
            empty = pa.nulls(len(ns), pa.int32()), pa.nulls(len(ns), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.int64()), *empty],
                names=["doc_id", "n", "cls", "chunk", "blob"],
            )
        chunks, blobs = dense.count_rows(counts)
        absent = pa.nulls(len(chunks), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [absent, absent, absent, pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())],
            names=["doc_id", "n", "cls", "chunk", "blob"],
        )
        give_back()

    schema = "doc_id bigint, n bigint, cls bigint, chunk int, blob binary"
    return settle(documents.mapInArrow(scan, schema), "shingle_scan")


def posted(documents: DataFrame, counts, size: int, num: int, den: int, only=None) -> DataFrame:
    """The rare-first prefix of every text as (token, cls, n, pos, parts).

    Without ``only``, just (token, cls); with it, a bit set of n-grams, the postings of those.
    Both are broadcast tables of a fixed size.
    """
    names = ["token", "cls"] if only is None else ["token", "cls", "n", "pos", "parts"]

    def post(batches):
        rank = counts.value
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in names]
            for held in shingle_sets(batch.column(1), size):
                n = len(held)
                if not n:
                    continue
                p = prefix_length(n, num, den)
                first = held[np.lexsort((held, rank[buckets_of(held)]))[:p]]
                place = np.arange(p)
                if only is not None:
                    place = np.flatnonzero(dense.holds(only.value, first.view(np.int64)))
                    first = first[place]
                made = [first.view(np.int64), np.full(len(place), set_digest(held))]
                if only is not None:
                    made += [np.full(len(place), n), place + 1, np.full(len(place), part_sizes(held))]
                for column, values in zip(columns, made):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)
        give_back()

    return documents.mapInArrow(post, ", ".join(f"{name} bigint" for name in names))


def may_link(a: str, b: str, num: int, den: int) -> Column:
    """Length, positional and suffix filters for two postings of one n-gram, by column prefix."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    length = F.least(na, nb) * den >= F.greatest(na, nb) * num
    most = F.least(na - F.col(f"{a}pos"), nb - F.col(f"{b}pos")) + 1
    position = most * (num + den) >= (na + nb) * num
    gap = sum(
        F.abs(F.shiftrightunsigned(f"{a}parts", 8 * k).bitwiseAND(255) - F.shiftrightunsigned(f"{b}parts", 8 * k).bitwiseAND(255))
        for k in range(PARTS)
    )
    return length & position & (gap * (num + den) <= (na + nb) * (den - num))


def verified(documents: DataFrame, pairs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs (u, v) of document ids whose full shingle sets are similar enough, written.

    Sets are made again for the documents of the pairs only; a fixed bit set of their ids lets
    the scan skip most others, and the join drops the rest. Pairs first meet with small sketches,
    which bound the difference from below, so that whole sets move for likely links only.
    """
    wanted = settle(pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct(), "wanted_ids")
    shared = documents.sparkSession.sparkContext.broadcast(dense.bit_set(wanted, MEMBER_BITS))

    def build(batches):
        bits = shared.value
        for batch in batches:
            ids = batch.column(0).fill_null(-1)
            kept = batch.filter(pa.array(dense.holds(bits, np.asarray(ids))))
            # the text of an id stays apart from its set until both are written
            sets = [(len(held), sketch(held), held.tobytes()) for held in shingle_sets(kept.column(1), size)]
            columns = list(zip(*sets)) or [()] * 3
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([kept.column(0), *made], names=["doc_id", "n", "bits", "held"])
        give_back()

    sets = settle(documents.mapInArrow(build, "doc_id bigint, n bigint, bits binary, held binary"), "pair_sets")
    shared.unpersist()

    def likely(batches):
        for batch in batches:
            keep = []
            for na, nb, a, b in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                gap = int(np.bitwise_count(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).sum())
                keep.append(gap * (num + den) <= (na + nb) * (den - num))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["u", "v"])

    def side(key: str, held: str, *columns: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(key), *[F.col(c).alias(f"{held}_{c}") for c in columns])

    met = pairs.join(side("u", "a", "n", "bits"), "u").join(side("v", "b", "n", "bits"), "v")
    met = met.select("u", "v", "a_n", "b_n", "a_bits", "b_bits")
    pairs = settle(met.mapInArrow(likely, "u bigint, v bigint").distinct(), "likely_pairs")

    def compare(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both * den >= num * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["u", "v"])

    sides = pairs.join(side("u", "a", "held"), "u").join(side("v", "b", "held"), "v").select("u", "v", "a_held", "b_held")
    return settle(sides.mapInArrow(compare, "u bigint, v bigint").distinct(), "verified_links")


def block_links(sizes: np.ndarray, block: np.ndarray, within: bool, sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """How many links each set has to the others of its block (``within``) or of the other block."""
    order = np.argsort(sizes, kind="stable")
    n, block = sizes[order], block[order]
    tokens, slot = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    # a shingle of one set only is in no overlap
    several = np.bincount(slot, minlength=len(tokens)) > 1
    column = np.cumsum(several) - 1
    member = np.zeros((len(n), -(-int(several.sum()) // 64) * 64), dtype=bool)
    kept = several[slot]
    member[np.repeat(np.arange(len(n)), n)[kept], column[slot[kept]]] = True
    bits = np.packbits(member, axis=1).view(np.uint64)
    last = np.searchsorted(n, n * den // num, side="right")
    degree = np.zeros(len(n), dtype=np.int64)
    for a in range(len(n)):
        others = np.arange(a + 1, last[a])
        if not within:
            others = others[block[others] != block[a]]
        both = np.bitwise_count(bits[a] & bits[others]).sum(axis=1, dtype=np.int64)
        others = others[both * den >= num * (n[a] + n[others] - both)]
        degree[a] += len(others)
        degree[others] += 1
    found = np.zeros(len(n), dtype=np.int64)
    found[order] = degree
    return found


def link_counts(documents: DataFrame, placed: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(cls, n, n_links): for every linked class of ``placed`` (cls, n, node, component), its links to other classes."""
    members = placed.groupBy("component").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("classes") / BLOCK_TEXTS, F.col("shingles") / BLOCK_SHINGLES)).cast("bigint").alias("blocks")
    members = members.filter("classes > 1").select("component", blocks)
    members = placed.join(members, "component").withColumn("block", F.pmod(F.xxhash64("cls", "n"), "blocks"))
    members = settle(members, "component_classes")
    shared = documents.sparkSession.sparkContext.broadcast(dense.bit_set(members.select(F.col("node").alias("key")), MEMBER_BITS))

    def build(batches):
        bits = shared.value
        for batch in batches:
            kept = batch.filter(pa.array(dense.holds(bits, np.asarray(batch.column(0)))))
            sets = [(len(held), set_digest(held), held.tobytes()) for held in shingle_sets(kept.column(1), size)]
            columns = list(zip(*sets)) or [()] * 3
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([kept.column(0), *made], names=["node", "n", "cls", "held"])
        give_back()

    # rows repeated with their id give one set
    sets = documents.filter("doc_id IS NOT NULL").mapInArrow(build, "node bigint, n bigint, cls bigint, held binary")
    sets = sets.join(members, ["node", "n", "cls"]).groupBy("cls", "n", "component", "blocks", "block").agg(F.first("held").alias("held"))
    sets = settle(sets, "component_sets")
    shared.unpersist()

    # a block meets every block of its component, itself once
    dealt = sets.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    key = ["component", "i", "j"]
    dealt = dealt.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "n", "held")

    def counted(rows: list) -> pa.RecordBatch:
        sizes, block = np.array([r[5] for r in rows]), np.array([r[3] for r in rows])
        sets = [np.frombuffer(r[6], np.uint64) for r in rows]
        made = block_links(sizes, block, rows[0][1] == rows[0][2], sets, num, den)
        columns = [[r[4] for r in rows], sizes, made]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cls", "n", "n_links"])

    def count(batches):
        held, last = [], None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:3] != last and held:
                    yield counted(held)
                    held = []
                held.append(row)
                last = row[:3]
        if held:
            yield counted(held)

    # rows of two blocks follow each other, so only these are held at a time
    grouped = dealt.repartition(*key).sortWithinPartitions(*key)
    made = grouped.mapInArrow(count, "cls bigint, n bigint, n_links bigint")
    return settle(made.groupBy("cls", "n").agg(F.sum("n_links").alias("n_links")), "degrees")


def placed_classes(texts: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls) of every text (doc_id, text), and (cls, n, node, component) of every class of texts with an id."""
    spark = texts.sparkSession
    scan = scan_sets(texts, size)
    rows = scan.filter("chunk IS NULL").select("doc_id", "n", "cls")
    counts = dense.summed_counts(scan.filter("chunk IS NOT NULL"), BUCKETS)
    classes = settle(
        rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("cls", "n").agg(F.min("doc_id").alias("node")), "shingle_classes"
    )

    # a text without id is in no class, so it may not be the hub of others either
    texts = texts.filter("doc_id IS NOT NULL")
    held = spark.sparkContext.broadcast(np.minimum(counts, 1 << 31).astype(np.uint32))
    narrow = posted(texts, held, size, num, den).groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
    several = settle(narrow.filter("lo <> hi").select("token"), "shared_tokens")
    only = spark.sparkContext.broadcast(dense.bit_set(several.select(F.col("token").alias("key")), TOKEN_BITS))
    # copies post the same rows, which are one here
    post = posted(texts, held, size, num, den, only).distinct().join(several, "token", "left_semi")
    post = settle(post, "postings")
    held.unpersist()
    only.unpersist()
    earliest = F.min(F.struct("pos", "n", "cls", "parts")).alias("hub")
    hubs = post.groupBy("token").agg(earliest).select("token", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("pos", "n", "cls", "parts")])
    shared = post.join(settle(hubs, "hubs"), "token")
    shared = shared.join(classes, ["cls", "n"])
    hub_node = classes.select(F.col("cls").alias("hub_cls"), F.col("n").alias("hub_n"), F.col("node").alias("hub_node"))
    shared = settle(shared.join(hub_node, ["hub_cls", "hub_n"]).drop("cls", "hub_cls"), "shared_nodes")

    def ordered(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]

    to_hub = shared.filter("node <> hub_node").filter(may_link("", "hub_", num, den))
    # one hub for each text, the one it shares most with; what that leaves apart is compared below
    counted = to_hub.groupBy("node", "hub_node").agg(F.count(F.lit(1)).alias("shared"))
    best = counted.groupBy("node").agg(F.max(F.struct("shared", (-F.col("hub_node")).alias("back"))).alias("best"))
    chosen = best.select("node", (-F.col("best.back")).alias("hub_node"))
    first = settle(chosen.select(*ordered("node", "hub_node")).distinct(), "hub_pairs")
    links = verified(texts, first, size, num, den)
    known = components(links)

    # n-grams whose texts are still in several components
    label = known.select("node", "component")
    hub_label = known.select(F.col("node").alias("hub_node"), F.col("component").alias("hub_component"))
    placed = shared.join(label, "node", "left").join(hub_label, "hub_node", "left")
    placed = settle(
        placed.select(
            "token", "node", "n", "pos", "parts",
            F.coalesce("component", "node").alias("component"),
            F.coalesce("hub_component", "hub_node").alias("hub_component"),
        ),
        "placed_postings",
    )
    outside = placed.filter("component <> hub_component").drop("hub_component")
    others = placed.select("token", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "pos", "parts", "component")])
    apart = outside.join(others, "token").filter((F.col("component") != F.col("o_component")) & may_link("", "o_", num, den))
    second = apart.select(*ordered("node", "o_node")).distinct().join(first, ["u", "v"], "left_anti")
    second = settle(second, "apart_pairs")
    if not second.isEmpty():
        links = links.unionByName(verified(texts, second, size, num, den))
        known = components(links)

    placed = classes.join(known, "node", "left").select("cls", "n", "node", F.coalesce("component", "node").alias("component"))
    return rows, settle(placed, "class_components")


def own_texts(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))


def component_of() -> Column:
    return F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id")


def similar_groups(
    documents: DataFrame, size: int = 3, num: int = 90, den: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) per row of ``documents``; links where similarity is at least num / den.

    ``n_links`` is the number of other classes that the row's class links with: all of them, each
    verified. Texts with an equal set are one class, so copies neither link nor count twice.
    """
    texts = own_texts(documents, doc_id, text)
    rows, placed = placed_classes(texts, size, num, den)
    degree = link_counts(texts, placed, size, num, den)
    named = rows.join(placed.join(degree, ["cls", "n"], "left"), ["cls", "n"], "left")
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component_of(),
        F.when(F.col("doc_id").isNotNull() & F.col("n_links").isNotNull(), F.col("n_links")).otherwise(F.lit(0).cast("bigint")).alias("n_links"),
    )


def drop_similar(
    documents: DataFrame, size: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``documents`` with one document of each group of similar texts: the one with the smallest id.

    Rows without id stay, and so do all rows that share the id that stays.
    """
    rows, placed = placed_classes(own_texts(documents, doc_id, text), size, num, den)
    groups = rows.join(placed, ["cls", "n"], "left").select("doc_id", component_of())
    losers = settle(groups.filter("component_id <> doc_id").select(F.col("doc_id").alias(doc_id)).distinct(), "near_copies")
    return documents.join(losers, doc_id, "left_anti")


@register("op10_ngram_join")
def op10_ngram_join(spark, sf_dir) -> DataFrame:
    groups = similar_groups(table(spark, sf_dir, "documents"), size=3, num=90, den=100)
    return groups.select("doc_id", "n_shingles", "component_id", "n_links")
