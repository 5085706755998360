"""Windows of a fixed length that occur more than once in a corpus, of bytes or of words.

What suffix_dedup and substring_dedup share: finding where repeats can be, dealing the suffixes
there out to groups, and taking the removed windows out of texts.

Texts are told apart by (doc_id, tie): a tie is 0 where an id occurs once, else a number from the text, so
that rows which share an id, or have none, are texts of their own. Such rows come in the order of their
ties; rows equal in id and text are one text that occurs twice, and neither is earlier than the other.

1. Every window of ``length`` symbols has one anchor, the run of ``gram`` symbols in it with the least
   hash. Equal windows have equal anchors, so no repeat is lost, and about one position in
   half a window is an anchor. A row per anchor holds the windows it stands for (all
   those starting from ``lo`` to ``hi``) and a digest of the text that they cover.
2. Anchors that occur once are dropped: counted with map-side combine, joined back.
3. Anchors with the same covered text need no look inside: all but the first hold later copies.
   Only one representative of each different covered text goes on.
4. Representatives are dealt out by anchor, a group to a task at most in part: groups are packed into
   pieces of bounded size and each piece is sorted as suffixes (see ``suffix_ranks``). A group with more
   than ``hot`` representatives is not gathered: its windows are counted by digest with map-side combine.
"""

from __future__ import annotations

import sys
from hashlib import blake2b
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import dense
from tessera.llm.words import BASE, WordReader, chunks, mix, text_buffer
from tessera.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACE_BITS = 30
MEMBER_BITS = 1 << 26
SCAN_BYTES = 1 << 20
PIECE_BYTES = 2 << 20
HOT_GROUP = 20_000
NO_ID = -(1 << 63)
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, by doubling."""
    size, held = 1, values
    while size * 2 <= width:
        held = np.minimum(held[:-size], held[size:])
        size *= 2
    rest = width - size
    return np.minimum(held[:-rest], held[rest:]) if rest else held


class Sequences:
    """Symbols of a buffer of texts: ``bounds`` cuts them into texts, ``total`` holds running hashes."""

    def __init__(self, unit: str):
        self.unit, self.reader = unit, WordReader()

    def __call__(self, raw: np.ndarray, offsets: np.ndarray):
        if self.unit == "bytes":
            symbols, bounds = self.reader.values[raw], offsets
        else:
            starts, ends, bounds = self.reader.spans(raw, offsets)
            symbols = self.reader.hashes(raw, starts, ends)
        powers = self.reader.powers.upto(len(symbols) + 1)
        total = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * powers.up[: len(symbols)], out=total[1:])
        return symbols, bounds, total, powers.down


def anchors_of(bounds: np.ndarray, total: np.ndarray, down: np.ndarray, length: int, gram: int):
    """(row, anchor hash, lo, hi) of all anchors; positions are in the buffer."""
    n = len(total) - 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    grams = (total[gram:] - total[:-gram]) * down[: n - gram + 1]
    key = (grams ^ (grams >> np.uint64(32))) * SPREAD
    key = (key >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(key), dtype=np.uint64)
    least = sliding_minimum(key, length - gram + 1)
    size = n - length + 1
    step = np.zeros(n + 2, dtype=np.int32)
    starts, ends = bounds[:-1], np.maximum(bounds[1:] - length + 1, bounds[:-1])
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    valid = np.cumsum(step[:size]) > 0
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    heads = starts[(starts < size) & (ends > starts)]
    begin[heads] = True
    over = valid.copy()
    over[:-1] &= ~valid[1:] | begin[1:]
    lo, hi = np.flatnonzero(begin), np.flatnonzero(over)
    place = (least[lo] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    row = np.searchsorted(bounds, lo, side="right") - 1
    return row, mix(grams[place]).view(np.int64), lo, hi


def digests(data: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64 bits of a cryptographic digest of each slice of ``data``; equality is decided on them, never on a rolling hash."""
    made = [blake2b(data[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), last.tolist())]
    return np.frombuffer(b"".join(made), dtype=np.int64)


def each_chunk(batch: pa.RecordBatch, read: Sequences) -> Iterator:
    """(ids, ties, bytes, what ``read`` makes of them) of consecutive texts."""
    raw, offsets = text_buffer(batch.column(2))
    ids, ties = np.asarray(batch.column(0)), np.asarray(batch.column(1))
    for first, last in chunks(offsets, SCAN_BYTES):
        part = raw[offsets[first] : offsets[last]]
        yield ids[first:last], ties[first:last], part, read(part, offsets[first : last + 1] - offsets[first])


def content_source(unit: str, part: np.ndarray, symbols: np.ndarray) -> tuple[bytes, int]:
    """(bytes, bytes per symbol) from which covered texts are cut: the text itself, or its words' hashes."""
    return (part.tobytes(), 1) if unit == "bytes" else (symbols.tobytes(), symbols.itemsize)


def scan_anchors(texts: DataFrame, unit: str, length: int, gram: int) -> DataFrame:
    """(anchor, covered, doc_id, tie, lo, hi) of every anchor; lo and hi count from the text's start."""
    names = ["anchor", "covered", "doc_id", "tie", "lo", "hi"]

    def scan(batches):
        read = Sequences(unit)
        for batch in batches:
            for ids, ties, part, (symbols, bounds, total, down) in each_chunk(batch, read):
                row, anchor, lo, hi = anchors_of(bounds, total, down, length, gram)
                data, width = content_source(unit, part, symbols)
                covered = digests(data, lo * width, (hi + length) * width)
                at = bounds[row]
                columns = [anchor, covered, ids[row], ties[row], lo - at, hi - at]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return texts.mapInArrow(scan, ", ".join(f"{n} bigint" for n in names))


def place_key(doc_id: np.ndarray, tie: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """One 64-bit key for a place in a text."""
    parts = [x.astype(np.int64).view(np.uint64) for x in (doc_id, tie, lo)]
    return mix(parts[0] * np.uint64(BASE) + parts[1] * SPREAD + parts[2]).view(np.int64)


def scan_contexts(texts: DataFrame, places: DataFrame, unit: str, length: int, gram: int) -> DataFrame:
    """(anchor, doc_id, tie, lo, hi, content) of the anchors at ``places``: the covered text itself.

    The scan finds them by a fixed bit set of their keys. A few others pass it; they are true
    occurrences too, and change no result.
    """

    def keys(batches):
        for batch in batches:
            made = place_key(*[np.asarray(column) for column in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(made)], names=["key"])

    wanted = dense.bit_set(places.select("doc_id", "tie", "lo").mapInArrow(keys, "key bigint"), MEMBER_BITS)
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def scan(batches):
        read, bits = Sequences(unit), shared.value
        for batch in batches:
            for ids, ties, part, (symbols, bounds, total, down) in each_chunk(batch, read):
                row, anchor, lo, hi = anchors_of(bounds, total, down, length, gram)
                at = bounds[row]
                kept = np.flatnonzero(dense.holds(bits, place_key(ids[row], ties[row], lo - at)))
                data, width = content_source(unit, part, symbols) if len(kept) else (b"", 1)
                spans = zip((lo[kept] * width).tolist(), ((hi[kept] + length) * width).tolist())
                content = [data[a:b] for a, b in spans]
                columns = [anchor[kept], ids[row][kept], ties[row][kept], (lo - at)[kept], (hi - at)[kept]]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns], pa.array(content, pa.binary())],
                    names=["anchor", "doc_id", "tie", "lo", "hi", "content"],
                )

    return texts.mapInArrow(scan, "anchor bigint, doc_id bigint, tie bigint, lo bigint, hi bigint, content binary")


def dense_ranks(keys: np.ndarray) -> np.ndarray:
    """Rank of every key among the distinct keys, in order."""
    order = np.argsort(keys)
    held = keys[order]
    step = np.zeros(len(keys), dtype=np.int64)
    step[1:] = held[1:] != held[:-1]
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(step)
    return ranks


class SuffixRanks:
    """Ranks of all suffixes of ``symbols`` by their first 1 (8 for bytes), 2, 4, ... symbols, by prefix doubling.

    ``depths`` and ``tables`` hold them up to half of ``length``; ``at`` ranks given places by their first
    ``length`` symbols. Suffixes share a rank exactly when they agree so far, and ranks follow the order of
    the symbols. Bytes start from eight at a time, read as one number.
    """

    def __init__(self, symbols: np.ndarray, length: int):
        self.symbols, self.length = symbols, length
        if symbols.dtype == np.uint8:
            padded = np.zeros(len(symbols) + 8, dtype=np.uint64)
            padded[: len(symbols)] = symbols
            keys = padded[: len(symbols)].copy()
            for j in range(1, 8):
                keys = (keys << np.uint64(8)) | padded[j : j + len(symbols)]
            depth = 8
            if depth > length:
                keys, depth = keys >> np.uint64(8 * (8 - length)), length
        else:
            keys, depth = symbols, 1
        self.depths, self.tables = [depth], [dense_ranks(keys).astype(np.int32)]
        every = np.arange(len(symbols))
        while depth * 2 < length:
            self.tables.append(self._doubled(every, depth).astype(np.int32))
            depth *= 2
            self.depths.append(depth)

    def _doubled(self, places: np.ndarray, ahead: int) -> np.ndarray:
        ranks = self.tables[-1]
        far = np.minimum(places + ahead, len(ranks) - 1)
        return dense_ranks(ranks[places].astype(np.int64) * np.int64(len(ranks) + 1) + ranks[far])

    def at(self, places: np.ndarray) -> np.ndarray:
        depth = self.depths[-1]
        return self._doubled(places, self.length - depth) if depth < self.length else self.tables[-1][places].astype(np.int64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``, up to ``length``, which both must have."""
        same = np.zeros(len(a), dtype=np.int64)
        for depth, ranks in zip(reversed(self.depths), reversed(self.tables)):
            fits = np.flatnonzero(same + depth <= self.length)
            more = fits[ranks[a[fits] + same[fits]] == ranks[b[fits] + same[fits]]]
            same[more] += depth
        # what is left is shorter than the first table's depth
        open_ = np.flatnonzero(same < self.length)
        while len(open_):
            open_ = open_[self.symbols[a[open_] + same[open_]] == self.symbols[b[open_] + same[open_]]]
            same[open_] += 1
            open_ = open_[same[open_] < self.length]
        return same


# which of the windows at ``places`` of ``symbols`` go: (symbols, places, length, text of each, start of each)
Judge = Callable[[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray], np.ndarray]


def judged_pieces(contexts: DataFrame, unit: str, length: int, judge: Judge) -> DataFrame:
    """Removed window ranges (doc_id, tie, first, last) of groups that fit into a piece."""
    dtype = np.uint8 if unit == "bytes" else np.uint64

    names = ["doc_id", "tie", "first", "last"]

    def piece(rows: list) -> pa.RecordBatch:
        symbols = np.frombuffer(b"".join(r[5] for r in rows), dtype=dtype)
        sizes = np.array([len(r[5]) // symbols.itemsize for r in rows], dtype=np.int64)
        texts, text_of = np.unique(np.array([r[1:3] for r in rows], dtype=np.int64), axis=0, return_inverse=True)
        lo, hi = np.array([r[3] for r in rows], dtype=np.int64), np.array([r[4] for r in rows], dtype=np.int64)
        base, count = np.cumsum(sizes) - sizes, hi - lo + 1
        owner = np.repeat(np.arange(len(rows)), count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        doc = text_of.reshape(-1)[owner]
        start = lo[owner] + within
        removed = judge(symbols, base[owner] + within, length, doc, start)
        edge = np.r_[True, owner[1:] != owner[:-1]]
        begin = removed & (edge | ~np.r_[False, removed[:-1]])
        over = removed & np.r_[edge[1:] | ~removed[1:], True]
        columns = [*texts[doc[begin]].T, start[begin], start[over]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def pieces(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and row[:4] == held[-1][:4]:
                    continue  # a row that is there twice: one text
                if size >= PIECE_BYTES and row[0] != held[-1][0]:
                    yield piece(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield piece(held)

    # rows of an anchor follow each other, so only a piece is held at a time
    grouped = contexts.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "tie", "lo")
    return grouped.mapInArrow(pieces, ", ".join(f"{n} bigint" for n in names))


def counted_windows(contexts: DataFrame, unit: str, length: int, keep: str) -> DataFrame:
    """Removed windows of groups too large for one task: each window by digest, counted map-side."""

    names = ["anchor", "digest", "doc_id", "tie", "first"]
    width = 1 if unit == "bytes" else 8

    def windows(batches):
        for batch in batches:
            for anchor, doc, tie, lo, hi, content in zip(*(column.to_pylist() for column in batch.columns)):
                at = np.arange(hi - lo + 1)
                digest = digests(content, at * width, (at + length) * width)
                columns = [np.full(len(at), anchor), digest, np.full(len(at), doc), np.full(len(at), tie), lo + at]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    rows = settle(contexts.mapInArrow(windows, ", ".join(f"{n} bigint" for n in names)), "hot_windows")
    place = F.struct("doc_id", "tie", "first")
    seen = rows.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("earliest"))
    joined = rows.join(settle(seen.filter("n > 1"), "hot_repeats"), ["anchor", "digest"])
    if keep == "first":
        joined = joined.filter(place != F.col("earliest"))
    return joined.select("doc_id", "tie", "first", F.col("first").alias("last"))


def repeated_windows(
    texts: DataFrame, unit: str, length: int, gram: int, keep: str, judge: Judge, hot: int = HOT_GROUP
) -> DataFrame:
    """(doc_id, tie, spans): removed windows of each text as sorted (first, last) starts.

    ``keep`` "first" removes windows whose symbols also start earlier (smaller id, or same text
    earlier); "none" removes all windows that occur more than once. ``texts`` comes from ``prepared``.
    """
    anchors = settle(scan_anchors(texts, unit, length, gram), "anchors")
    repeated = anchors.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("covered").alias("least"), F.max("covered").alias("most")
    )
    repeated = settle(
        repeated.filter("n > 1").select("anchor", (F.col("least") != F.col("most")).alias("differ")), "repeated_anchors"
    )
    found = settle(anchors.join(repeated, "anchor"), "repeated_places")
    same = found.groupBy("anchor", "covered").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "tie", "lo")).alias("earliest"))
    same = settle(same.filter("n > 1").drop("n"), "same_covered")
    placed = settle(found.join(same, ["anchor", "covered"], "left"), "placed_anchors")
    is_first = F.struct("doc_id", "tie", "lo") == F.col("earliest")

    whole = placed.filter(F.col("earliest").isNotNull())
    if keep == "first":
        whole = whole.filter(~is_first)
    spans = whole.select("doc_id", "tie", F.col("lo").alias("first"), F.col("hi").alias("last"))

    inner = placed.filter(F.col("differ") & (F.col("earliest").isNull() | is_first)).select("doc_id", "tie", "lo")
    contexts = settle(scan_contexts(texts, inner, unit, length, gram), "contexts")
    large = settle(contexts.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "hot_anchors")
    small_groups = contexts.join(large, "anchor", "left_anti")
    hot_groups = contexts.join(large, "anchor", "left_semi")
    spans = spans.unionByName(judged_pieces(small_groups, unit, length, judge))
    spans = spans.unionByName(counted_windows(hot_groups, unit, length, keep))
    # a set: copies of a row with one id bring the same spans
    return spans.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans"))


def prepared(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, tie, text); only texts whose id is missing or occurs again have a tie other than 0."""
    texts = documents.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))
    shared = settle(
        texts.filter(F.col("doc_id") != NO_ID).groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("shared")),
        "shared_ids",
    )
    unclear = F.col("shared") | (F.col("doc_id") == NO_ID)
    tie = F.conv(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 15), 16, 10).cast("bigint")
    return texts.join(shared, "doc_id", "left").select("doc_id", F.when(unclear, tie).otherwise(F.lit(0)).alias("tie"), "text")


def covered_symbols(first: np.ndarray, last: np.ndarray, length: int, size: int) -> np.ndarray:
    """True where a removed window lies, by first and last starts; what is beyond ``size`` is cut."""
    step = np.zeros(size + 1, dtype=np.int64)
    np.add.at(step, np.minimum(first, size), 1)
    np.add.at(step, np.minimum(last + length, size), -1)
    return np.cumsum(step[:size]) > 0


def runs_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of each run of True."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def with_spans(texts: DataFrame, spans: DataFrame, take_out, schema: str) -> DataFrame:
    """``take_out(text bytes, first starts, last starts)`` for every text, as rows of ``schema`` after doc_id."""

    def apply(batches):
        for batch in batches:
            made = []
            raw, offsets = text_buffer(batch.column(1))
            found, cuts = batch.column(2), np.asarray(batch.column(2).offsets)
            first, last = (np.asarray(found.values.field(name)) for name in ("first", "last"))
            for r, doc in enumerate(batch.column(0).to_pylist()):
                inside = slice(cuts[r], cuts[r + 1])
                data = raw[offsets[r] : offsets[r + 1]].tobytes()
                made.append((None if doc == NO_ID else doc, *take_out(data, first[inside], last[inside])))
            columns = list(zip(*made)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = [part.split()[0] for part in schema.split(",")]
    arrow = {"bigint": pa.int64(), "string": pa.string()}
    kinds = [arrow[part.split()[1]] for part in schema.split(",")]
    return texts.join(spans, ["doc_id", "tie"], "left").select("doc_id", "text", "spans").mapInArrow(apply, schema)
