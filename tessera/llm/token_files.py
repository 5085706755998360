"""Token ids in ORC files: whole texts encoded, written in id order, and read back.

Rows are range-partitioned and sorted by document id, so each file holds one range of ids and stripes
and row groups have narrow id statistics; a Bloom filter on the id prunes what they leave.
Ids are integer lists, which ORC run-length encodes. A row also holds its shard and the number
of ids before it in the shard: a corpus-wide start is that plus the shard's offset, from one
sum per shard.

Words of the space-separated text are encoded once each per worker: the tokenizer drops white
space and never joins across it. Cached words are found by 64-bit hashes; the cache is
bounded and half of it leaves at a time.

Defined cases: null and empty texts have only the end id; rows with the same id are ordered by
their text (null first), each with its own start; a null id comes first; an empty table
writes an empty table; extra columns are not written.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.llm.words import WordReader, chunks, give_back, text_buffer
from tessera.session import scratch_path, settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 1
CACHED_WORDS = 800_000
YOUNG_WORDS = 50_000
PIECES_PER_CALL = 200
# Symbols tried as the mark between words of one call.
MARKS = ("♥", "☺", "★", "€", "§")
FILE_SCHEMA = "shard int, local_start bigint, doc_id bigint, n_tokens bigint, ids array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


class Known:
    """Ids of words by sorted 64-bit keys: word i has ``count[i]`` ids of ``flat`` from ``begin[i]``."""

    def __init__(self, keys=None, begin=None, count=None, flat=None):
        self.keys = np.zeros(0, np.uint64) if keys is None else keys
        self.begin = np.zeros(0, np.int64) if begin is None else begin
        self.count = np.zeros(0, np.int64) if count is None else count
        self.flat = np.zeros(0, np.int32) if flat is None else flat

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not held."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = -1
        held = at >= 0
        at[held] = np.where(self.keys[at[held]] == keys[held], at[held], -1)
        return at

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids) of the words at these places, in their order."""
        begin, count = self.begin[at], self.count[at]
        total = np.cumsum(count)
        index = np.repeat(begin - total + count, count) + np.arange(total[-1] if len(total) else 0)
        return self.flat[index], count

    def with_(self, other: Known) -> Known:
        """Both together; they share no key."""
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")
        begin = np.concatenate([self.begin, other.begin + len(self.flat)])[order]
        count = np.concatenate([self.count, other.count])[order]
        return Known(keys[order], begin, count, np.concatenate([self.flat, other.flat]))


class WordIds:
    """Ids of words, each encoded once while it is in the cache.

    New words go to a young part, which is small and cheap to add to. It joins the middle one when it
    holds ``YOUNG_WORDS``; a middle part of half the cache replaces the old one, so that about half
    of the words leave at a time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        single = [(m, self._encode(m)) for m in MARKS]
        self.mark, self.mark_id = next(((m, ids[0]) for m, ids in single if len(ids) == 1), (None, None))
        self.parts = [Known(), Known(), Known()]

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each word); many words share one call, kept apart by a symbol with one id of its own."""
        counts = np.zeros(len(words), np.int64)
        flat: list[np.ndarray] = []
        own = None if self.mark is None else self.mark.encode()

        def alone(i: int) -> None:
            ids = self._encode(words[i].decode("utf-8", "replace"))
            counts[i] = len(ids)
            flat.append(ids)

        def together(first: int, last: int) -> None:
            if first == last:
                return
            joined = b" " + own + b" "
            ids = self._encode(joined.join(words[first:last]).decode("utf-8", "replace"))
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) != last - first - 1:
                for i in range(first, last):
                    alone(i)
                return
            counts[first:last] = np.diff(np.r_[-1, marks, len(ids)]) - 1
            flat.append(np.delete(ids, marks))

        # words that hold the mark or a special token's opening are encoded by themselves
        apart = [i for i, w in enumerate(words) if own is None or own in w or b"<|" in w]
        first = 0
        for stop in [*apart, len(words)]:
            for start in range(first, stop, PIECES_PER_CALL):
                together(start, min(start + PIECES_PER_CALL, stop))
            if stop < len(words):
                alone(stop)
            first = stop + 1
        return np.concatenate([np.zeros(0, np.int32), *flat]), counts

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """(flat ids, number of ids per word) of words in order."""
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        places = [part.find(keys) for part in self.parts]
        fresh = np.flatnonzero(np.maximum.reduce(places) < 0)
        data = raw.tobytes()
        flat, count = self.encode_words([data[a:b] for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())])
        made = Known(keys[fresh], np.cumsum(count) - count, count, flat)
        found = [np.flatnonzero(at >= 0) for at in places]
        taken = [part.ids(at[rows]) for part, at, rows in zip(self.parts, places, found)] + [(flat, count)]
        # the different words' ids, part by part, and from them those of all words
        order = np.concatenate([*found, fresh])
        length = np.empty(len(keys), np.int64)
        length[order] = np.concatenate([c for _, c in taken])
        begin = np.empty(len(keys), np.int64)
        begin[order] = np.cumsum(length[order]) - length[order]
        every = Known(keys, begin, length, np.concatenate([f for f, _ in taken]))
        self._keep(made)
        return every.ids(inverse)

    def _keep(self, made: Known) -> None:
        old, middle, young = self.parts
        young = young.with_(made)
        if len(young.keys) >= YOUNG_WORDS:
            middle, young = middle.with_(young), Known()
        if len(middle.keys) >= CACHED_WORDS // 2:
            old, middle = middle, Known()
        self.parts = [old, middle, young]

def word_ids(path: str) -> WordIds:
    """One encoder per worker process and vocabulary file, so that its cache outlives a task."""
    held = sys.modules.setdefault("tessera_word_ids", types.ModuleType("tessera_word_ids")).__dict__
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def encode_texts(column: pa.Array, reader: WordReader, encode: WordIds, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(flat ids, ids per text) of consecutive texts, end id included."""
    raw, offsets = text_buffer(column)
    for first, last in chunks(offsets):
        part = raw[offsets[first] : offsets[last]]
        starts, ends, bounds = reader.spans(part, offsets[first : last + 1] - offsets[first])
        flat, count = encode(part, starts, ends, reader.hashes(part, starts, ends))
        upto = np.r_[0, np.cumsum(count)][bounds]
        yield np.insert(flat, upto[1:], end_id).astype(np.int32), np.diff(upto) + 1


def write_token_files(
    documents: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode every row of ``documents`` and write the files to ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, ids_of = WordReader(), word_ids(vocabulary)
        shard, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            done = 0
            for flat, count in encode_texts(batch.column(1), reader, ids_of, end_id):
                n = len(count)
                upto = np.r_[0, np.cumsum(count)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard, np.int32)),
                        pa.array(before + upto[:-1]),
                        batch.column(0).slice(done, n),
                        pa.array(count.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(flat)),
                    ],
                    names=["shard", "local_start", "doc_id", "n_tokens", "ids"],
                )
                done, before = done + n, before + int(upto[-1])
        # what a task took goes back to the system, since the worker lives on with its cache
        give_back()

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    # one row per file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sums.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset")), "shard_offsets")
    return rows.join(offsets, "shard").withColumn("start", F.col("offset") + F.col("local_start"))


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows of a few documents; statistics and Bloom filters skip stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path).filter(F.col("doc_id").isin(ids))


def token_digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): CRC-32 of the ids as little-endian 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            values = np.asarray(ids.values).astype("<u4", copy=False)
            bounds = np.asarray(ids.offsets)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    narrow = rows.select("doc_id", "start", "n_tokens", "ids")
    return narrow.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenised(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Write ``documents`` as token files in the shared folder and digest what is read back."""
    spark = documents.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(documents, path, vocabulary)
    return token_digests(read_token_files(spark, path))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op2_token_files")
def op2_token_files(spark, sf_dir) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"), default_vocabulary())
