"""Stupid-backoff scores of texts by n-gram counts of the whole corpus.

A text is scored against all other texts: its own n-grams are taken out of the counts, as otherwise
every n-gram would have been seen and none would back off. With c the counts so reduced, a word
after its context scores c(context, word) / c(context) where the former was seen, else 0.4 times the
score with a shorter context; a word by itself scores c(word) / words of other texts, and a word never seen
counts as seen once. Natural logarithms are summed per text.

Texts are packed, as they are read, into blocks of bounded size, which are written once. A block sends
each of its different n-grams once, with its count, to the partition of the n-gram's hash: that message is the block's
share of the count table and its question to it. A partition adds the shares up, which makes its part of
the table, and answers every block with the totals in the order asked. A block then
joins its exploded n-grams to these totals and sums per text. However often an n-gram occurs, a block sends it once.

Defined cases: null and empty texts have no words and score 0; the first words of a text have the
contexts there are; repeated rows are texts of their own; A-Z are lower-cased; with no other text
every word counts as seen once among one; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.llm.words import WordReader, chunks, rolling, text_buffer
from tessera.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 2
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20
PART_GRAMS = 1 << 21


def block_texts(texts: list[np.ndarray]):
    """Word hashes of a block's texts in one array, with the text of each word and its place in it."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(texts)), size)
    place = np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
    return words, text, place, size


def grams_ending(words: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Positions of words at which an n-gram of their own text ends."""
    return np.flatnonzero(place >= n - 1)


def gram_hash(words: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each position; the order is part of it."""
    held = rolling(words, n) if len(words) >= n else np.zeros(0, np.uint64)
    return held[ends - n + 1] + np.uint64(n)


def block_grams(words: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different n-grams of all orders, how often each occurs in the block)."""
    every = [gram_hash(words, grams_ending(words, place, n), n) for n in range(1, order + 1)]
    return np.unique(np.concatenate(every), return_counts=True)


def part_bounds(grams: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash partition begins in sorted n-grams."""
    cuts = np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64)
    return np.r_[0, np.searchsorted(grams, cuts), len(grams)]


def pack_hashes(hashes: np.ndarray) -> bytes:
    """Sorted hashes as steps, byte by byte, so that the upper bytes nearly vanish."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_hashes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack(values: np.ndarray) -> bytes:
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return kind.char.encode() + zlib.compress(values.astype(kind).tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob[1:]), dtype=blob[:1].decode()).astype(np.int64)


def score_block(words, text, place, size, grams, totals, all_words: int, order: int) -> np.ndarray:
    """Sum of log scores of each text of a block."""
    n_texts = len(size)
    left = np.full(len(words), -1, dtype=np.int64)
    score = np.zeros(len(words))
    seen = np.zeros(len(words), dtype=bool)
    counts = {}
    for n in range(1, order + 1):
        ends = grams_ending(words, place, n)
        hashes = gram_hash(words, ends, n)
        # a text's own occurrences of each of its n-grams
        where = np.searchsorted(grams, hashes)
        pair = where * n_texts + text[ends]
        _, inverse, own = np.unique(pair, return_inverse=True, return_counts=True)
        held = left.copy()
        held[ends] = totals[where] - own[inverse]
        counts[n] = held
    for n in range(order, 1, -1):
        ends = grams_ending(words, place, n)
        whole, context = counts[n][ends], counts[n - 1][ends - 1]
        hit = (whole > 0) & ~seen[ends]
        at = ends[hit]
        score[at] += np.log(whole[hit]) - np.log(context[hit])
        seen[at] = True
        miss = ends[~seen[ends]]
        score[miss] += np.log(BACKOFF)
    rest = np.flatnonzero(~seen)
    others = np.maximum(all_words - size, 1)[text[rest]]
    score[rest] += np.log(np.maximum(counts[1][rest], 1)) - np.log(others)
    return np.bincount(text, weights=score, minlength=n_texts)


def packed_blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """(block, ids, ends, n_words, body): texts in the order read, a row for about ``block_bytes`` of them, written."""

    def blocks(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            ids = pa.chunked_array([part[0] for part in held], pa.int64()).combine_chunks()
            body = b"".join(part[1] for part in held)
            ends = np.cumsum(np.concatenate([part[2] for part in held]))
            n_words = len(reader.spans(np.frombuffer(body, np.uint8), np.r_[0, ends])[0])
            columns = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends)),
                pa.array([n_words], pa.int64()),
                pa.array([zlib.compress(body, 1)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "ends", "n_words", "body"])

        reader = WordReader()
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for first, last in chunks(offsets, max(1, block_bytes // 8)):
                part = raw[offsets[first] : offsets[last]].tobytes()
                held.append((batch.column(0).slice(first, last - first), part, np.diff(offsets[first : last + 1])))
                size += len(part)
                if size >= block_bytes:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    return settle(rows.mapInArrow(blocks, "block bigint, ids array<bigint>, ends array<bigint>, n_words bigint, body binary"), "text_blocks")


def unpacked_words(ends: np.ndarray, body: bytes):
    """What ``block_texts`` makes of a written block."""
    raw, offsets, reader = np.frombuffer(zlib.decompress(body), np.uint8), np.r_[0, ends], WordReader(fold_case=True)
    texts = []
    for first, last in chunks(offsets):
        part = raw[offsets[first] : offsets[last]]
        starts, over, bounds = reader.spans(part, offsets[first : last + 1] - offsets[first])
        hashes = reader.hashes(part, starts, over)
        texts += [hashes[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return block_texts(texts)


def lm_scores(
    documents: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text",
    block_bytes: int = BLOCK_BYTES, part_grams: int = PART_GRAMS,
) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logarithms) and mean_log_score of every row."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    blocks = packed_blocks(rows, block_bytes)
    all_words = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(1, -(-all_words * order // part_grams))

    def ask(batches):
        for batch in batches:
            for block, ends, body in zip(*batch.columns):
                words, _, place, _ = unpacked_words(np.asarray(ends.values), body.as_py())
                grams, count = block_grams(words, place, order)
                bounds = part_bounds(grams, parts)
                for part, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    made = [[part], [block.as_py()], [pack_hashes(grams[a:b])], [pack(count[a:b])]]
                    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(m, k) for m, k in zip(made, kinds)], names=["part", "block", "grams", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        asked = [unpack_hashes(x.as_py()) for x in group.column("grams")]
        count = np.concatenate([unpack(x.as_py()) for x in group.column("counts")])
        every = np.concatenate(asked)
        order_of = np.argsort(every)
        fresh = np.r_[True, every[order_of][1:] != every[order_of][:-1]][: len(every)]
        which = np.empty(len(every), dtype=np.int64)
        which[order_of] = np.cumsum(fresh) - 1
        table_counts = np.bincount(which, weights=count).astype(np.int64)
        found = np.split(table_counts[which], np.cumsum([len(a) for a in asked])[:-1])
        return pa.table({"block": group.column("block"), "part": group.column("part"), "totals": pa.array([pack(f) for f in found], pa.binary())})

    def score(key, group: pa.Table, answers: pa.Table) -> pa.Table:
        words, text_of, place, size = unpacked_words(np.asarray(group.column("ends").combine_chunks().values), group.column("body")[0].as_py())
        grams, _ = block_grams(words, place, order)
        by_part = sorted(zip(answers.column("part").to_pylist(), answers.column("totals").to_pylist()))
        found = np.concatenate([unpack(blob) for _, blob in by_part])
        sums = score_block(words, text_of, place, size, grams, found, all_words, order)
        ids = group.column("ids").combine_chunks().flatten()
        return pa.table({"doc_id": ids, "n_words": pa.array(size), "log_score": pa.array(sums, pa.float64())})

    asked = blocks.select("block", "ends", "body").mapInArrow(ask, "part int, block bigint, grams binary, counts binary")
    answers = settle(asked.groupBy("part").applyInArrow(answer, "block bigint, part int, totals binary"), "gram_totals")
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id bigint, n_words bigint, log_score double"
    )
    return scored.withColumn("mean_log_score", F.col("log_score") / F.nullif(F.col("n_words"), F.lit(0)))


@register(
    "op7_lm_score",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws FROM documents),
    t AS (SELECT doc_id, unnest(ws) AS b, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
    g AS (SELECT doc_id, i, b, CASE WHEN i > 1 THEN ws[i - 1] END AS a FROM t),
    n AS (SELECT count(*) AS total FROM g),
    d AS (SELECT doc_id, count(*) AS size FROM g GROUP BY 1),
    c1 AS (SELECT b, count(*) AS n FROM g GROUP BY 1), o1 AS (SELECT doc_id, b, count(*) AS n FROM g GROUP BY ALL),
    c2 AS (SELECT a, b, count(*) AS n FROM g WHERE a IS NOT NULL GROUP BY ALL),
    o2 AS (SELECT doc_id, a, b, count(*) AS n FROM g WHERE a IS NOT NULL GROUP BY ALL),
    s AS (SELECT g.doc_id, CASE WHEN c2.n - o2.n > 0 THEN ln(c2.n - o2.n) - ln(ca.n - oa.n)
            ELSE CASE WHEN g.a IS NULL THEN 0 ELSE ln(0.4) END + ln(greatest(cb.n - ob.n, 1)) - ln(greatest((SELECT total FROM n) - size, 1)) END AS s
        FROM g JOIN d USING (doc_id) JOIN c1 cb ON cb.b = g.b JOIN o1 ob ON ob.doc_id = g.doc_id AND ob.b = g.b
        LEFT JOIN c1 ca ON ca.b = g.a LEFT JOIN o1 oa ON oa.doc_id = g.doc_id AND oa.b = g.a
        LEFT JOIN c2 ON c2.a = g.a AND c2.b = g.b LEFT JOIN o2 ON o2.doc_id = g.doc_id AND o2.a = g.a AND o2.b = g.b)
    SELECT documents.doc_id, CAST(coalesce(any_value(size), 0) AS BIGINT) AS n_words, round(coalesce(sum(s), 0), 3) AS log_score
    FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN d USING (doc_id) GROUP BY 1
    """,
)
def op7_lm_score(spark, sf_dir) -> DataFrame:
    scored = lm_scores(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"))
