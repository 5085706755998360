"""Toxicity by multiple-instance learning: sentences are scored, a text is their noisy-or.

A text is a bag of sentences, ended by ``.``, ``!``, ``?`` or a line end. A sentence's probability is logistic in
the words it holds and in how they begin: every word gives itself and its proper prefixes of
``PREFIXES`` bytes, so that a stem counts apart from the words formed with it. A text is toxic unless
all its sentences are not: ``1 - product(1 - p)``. Weights are learnt from labels of texts only,
through that product, so the sentences that explain a label get the high scores and can be shown
(``offending_sentences``).

Fitting takes at most ``SAMPLE`` labelled texts, those with the least hash of their id, whole. Two passes over
them in Spark: document frequencies by label in ``SLOTS`` counters choose beginnings whose log-likelihood
ratio is ``LEAST_RATIO`` or more, at most the ``FEATURES`` most telling, and then only those of each
sentence are sent on, equal sentences of a text once with their number. Scoring reads all sentences of all texts where they are read, without a
shuffle; what it broadcasts is one weight per slot, a fixed size.

Defined cases: null and empty texts, and texts without words, are one sentence without words and get
the score that its bias gives; several labels of one id are averaged; rows with a null label or id
teach nothing, and of several rows with one labelled id each is a text with that label; without labels of both kinds
every score is the share of label 1 (0.5 without labels); repeated rows get equal scores; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.dense import CHUNK, count_rows, summed_counts
from tessera.llm.quality import held_out
from tessera.llm.registry import register, table
from tessera.llm.words import MIX_1, WordReader, chunks, mix, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 8_000
SLOTS = 1 << 21
FEATURES = 4096
LEAST_TEXTS = 4
LEAST_RATIO = 12.0
PREFIXES = (3, 4, 5, 6, 7, 8)
THRESHOLD = 0.5
SCAN_BYTES = 1 << 20
STEPS, RATE, SHRINK = 400, 0.1, 4e-4
# Bytes that end a sentence; other bytes than letters, digits and those of longer characters part words.
ENDS = b".!?\n\r"
LETTERS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))


class SentenceReader:
    """Words, their sentences and their features of a buffer of texts."""

    def __init__(self):
        self.words = WordReader(fold_case=True)
        self.words.gap = np.ones(256, dtype=bool)
        self.words.gap[list(LETTERS)] = False
        self.ends = np.zeros(256, dtype=bool)
        self.ends[list(ENDS)] = True

    def slots(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """For each kind of feature in turn: (which words have it, its slot)."""
        for n in (0, *PREFIXES):
            longer = np.flatnonzero(ends - starts > n)
            stop = starts[longer] + n if n else ends[longer]
            kind = np.uint64(n * int(MIX_1) % (1 << 64))
            hashed = mix(self.words.hashes(raw, starts[longer], stop) + kind)
            yield longer, (hashed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def sentences(self, raw: np.ndarray, offsets: np.ndarray):
        """(word starts, word ends, sentence of each word, first sentence of each text, byte bounds of sentences).

        Sentences without words do not count, but a text has one at least.
        """
        starts, ends, bounds = self.words.spans(raw, offsets)
        stops = np.flatnonzero(self.ends[raw])
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        turn = np.searchsorted(stops, starts)
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (turn[1:] != turn[:-1]) | (text[1:] != text[:-1])
        held = np.bincount(text[fresh], minlength=len(offsets) - 1)
        first = np.r_[0, np.cumsum(np.maximum(held, 1))]
        within = np.cumsum(fresh) - 1 - (np.cumsum(held) - held)[text] if len(text) else np.zeros(0, np.int64)
        return starts, ends, first[text] + within, first

    def parts(self, column: pa.Array):
        """(bytes, their offsets) of consecutive texts, none cut."""
        raw, offsets = text_buffer(column)
        for first, last in chunks(offsets, SCAN_BYTES):
            yield raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def picked_texts(documents: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int) -> DataFrame:
    """(text, label) of at most ``sample`` labelled ids."""
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.avg("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # at most ``sample`` rows on this side
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label")


def telling_slots(picked: DataFrame) -> tuple[np.ndarray, float, float]:
    """The slots whose texts differ most by label, and the numbers of texts of either label."""
    schema = "chunk int, blob binary"

    def count(batches):
        reader, counts = SentenceReader(), np.zeros(2 * SLOTS + CHUNK)
        for batch in batches:
            label, row = np.asarray(batch.column(1)), 0
            for raw, offsets in reader.parts(batch.column(0)):
                starts, ends, bounds = reader.words.spans(raw, offsets)
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
                found = [np.unique(text[words] * SLOTS + slot) for words, slot in reader.slots(raw, starts, ends)]
                seen = np.unique(np.concatenate(found))
                one = label[row : row + len(offsets) - 1]
                home, slot = seen // SLOTS, seen % SLOTS
                np.add.at(counts, slot, one[home])
                np.add.at(counts, SLOTS + slot, 1 - one[home])
                counts[2 * SLOTS] += one.sum()
                counts[2 * SLOTS + 1] += (1 - one).sum()
                row += len(offsets) - 1
        # in millionths, so that averaged labels add up the same in any order
        chunk, blob = count_rows(np.round(counts * 1e6).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), pa.array(blob, pa.binary())], names=["chunk", "blob"])

    counts = summed_counts(picked.select("text", "label").mapInArrow(count, schema), 2 * SLOTS + CHUNK) / 1e6
    with_one, with_zero = counts[:SLOTS], counts[SLOTS : 2 * SLOTS]
    ones, zeros = counts[2 * SLOTS], counts[2 * SLOTS + 1]
    held = np.flatnonzero(with_one + with_zero >= LEAST_TEXTS)
    a, b = with_one[held], with_zero[held]
    share = (a + b) / max(ones + zeros, 1)

    def gain(seen, total):
        expected = np.maximum(share * total, 1e-9)
        missing = np.maximum((1 - share) * total, 1e-9)
        return seen * np.log(np.maximum(seen, 1e-9) / expected) + (total - seen) * np.log(np.maximum(total - seen, 1e-9) / missing)

    ratio = gain(a, ones) + gain(b, zeros)
    order = np.lexsort((held, -ratio))[:FEATURES]
    return np.sort(held[order[ratio[order] >= LEAST_RATIO]]), float(ones), float(zeros)


def bags_of(picked: DataFrame, chosen: np.ndarray):
    """Bags of all picked texts: (text of each sentence, number of such sentences, sentence of each feature, feature, labels)."""
    place = np.full(SLOTS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    shared = picked.sparkSession.sparkContext.broadcast(place)

    def encode(batches):
        reader, place = SentenceReader(), shared.value
        for batch in batches:
            label, row = batch.column(1), 0
            for raw, offsets in reader.parts(batch.column(0)):
                starts, ends, sentence, first = reader.sentences(raw, offsets)
                pairs = []
                for words, slot in reader.slots(raw, starts, ends):
                    feature = place[slot]
                    known = feature >= 0
                    pairs.append(sentence[words][known] * FEATURES + feature[known])
                pairs = np.unique(np.concatenate(pairs))
                home = pairs // FEATURES
                cuts = np.searchsorted(home, first)
                blobs = []
                for t in range(len(offsets) - 1):
                    mine = pairs[cuts[t] : cuts[t + 1]]
                    runs = np.split(mine % FEATURES, np.flatnonzero(np.diff(mine // FEATURES)) + 1) if len(mine) else []
                    kinds: dict[bytes, int] = {}
                    for run in runs:
                        key = run.astype("<i2").tobytes()
                        kinds[key] = kinds.get(key, 0) + 1
                    plain = int(first[t + 1] - first[t]) - len(runs)
                    sizes = [0, *[len(k) // 2 for k in kinds]]
                    numbers = [plain, *kinds.values()]
                    blobs.append(
                        np.array([len(sizes), *sizes, *numbers], "<i4").tobytes() + b"".join(kinds)
                    )
                yield pa.RecordBatch.from_arrays([label.slice(row, len(blobs)), pa.array(blobs, pa.binary())], names=["label", "bag"])
                row += len(blobs)

    # Spark may deliver texts in any order; sorted, the same texts give the same weights
    rows = sorted(
        (bytes(r["bag"]), r["label"]) for r in picked.select("text", "label").mapInArrow(encode, "label double, bag binary").toLocalIterator()
    )
    shared.unpersist()
    texts, numbers, sizes, features = [], [], [], []
    for t, (bag, _) in enumerate(rows):
        n = int(np.frombuffer(bag, "<i4", 1)[0])
        head = np.frombuffer(bag, "<i4", 2 * n, 4)
        texts.append(np.full(n, t))
        sizes.append(head[:n])
        numbers.append(head[n:])
        features.append(np.frombuffer(bag, "<i2", offset=4 * (2 * n + 1)).astype(np.int64))
    empty = np.zeros(0, np.int64)
    text, number, size, feature = (np.concatenate([empty, *x]).astype(np.int64) for x in (texts, numbers, sizes, features))
    return text, number, np.repeat(np.arange(len(size)), size), feature, np.array([y for _, y in rows])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def loss_and_gradient(weights, bias, text, number, owner, feature, labels):
    """Mean log loss of noisy-or and its gradient by weight and bias."""
    z = bias + np.bincount(owner, weights[feature], minlength=len(text))
    p = sigmoid(z)
    # minus the logarithm of the product of (1 - p)
    a = np.bincount(text, number * np.logaddexp(0, z), minlength=len(labels))
    a = np.maximum(a, 1e-12)
    none = np.exp(-a)
    some = -np.expm1(-a)
    loss = -(labels * np.log(some) - (1 - labels) * a).mean()
    on_a = ((1 - labels) - labels * none / some) / len(labels)
    dz = number * p * on_a[text]
    return loss, np.bincount(feature, dz[owner], minlength=len(weights)), dz.sum()


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE
) -> tuple[np.ndarray, float]:
    """(weight of every slot, bias of a sentence), or without labels of both kinds (no weights, the share of label 1)."""
    picked = picked_texts(documents, labels, doc_id, text, label, sample)
    chosen, ones, zeros = telling_slots(picked)
    if ones == 0 or zeros == 0:
        return np.zeros(0, dtype=np.float32), ones / (ones + zeros) if ones + zeros else 0.5
    held, number, owner, feature, known = bags_of(picked, chosen)
    per_text = number.sum() / len(known)
    p = np.zeros(len(chosen) + 1)
    p[-1] = np.log(max(known.mean(), 1e-3) / per_text / 2)
    moment, spread = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        _, on_weights, on_bias = loss_and_gradient(p[:-1], p[-1], held, number, owner, feature, known)
        g = np.r_[on_weights + SHRINK * p[:-1] / np.sqrt(len(known)), on_bias]
        moment, spread = 0.9 * moment + 0.1 * g, 0.999 * spread + 0.001 * g * g
        p -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(SLOTS, dtype=np.float32)
    weights[chosen] = p[:-1]
    return weights, float(p[-1])


def sentence_scores(reader: SentenceReader, raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float):
    """(log odds of every sentence, first sentence of each text, sentence of each word, word starts, word ends)."""
    starts, ends, sentence, first = reader.sentences(raw, offsets)
    pairs = []
    for words, slot in reader.slots(raw, starts, ends):
        known = weights[slot] != 0
        pairs.append(sentence[words[known]] * SLOTS + slot[known])
    pairs = np.unique(np.concatenate(pairs))
    z = bias + np.bincount(pairs // SLOTS, weights[pairs % SLOTS], minlength=int(first[-1]))
    return z, first, sentence, starts, ends


def toxicity_scores(documents: DataFrame, model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences and n_offending of every row."""
    weights, bias = model
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    names = ["doc_id", "score", "n_sentences", "n_offending"]

    def score(batches):
        reader = SentenceReader()
        for batch in batches:
            row = 0
            for raw, offsets in reader.parts(batch.column(1)):
                n = len(offsets) - 1
                if len(shared.value):
                    z, first, *_ = sentence_scores(reader, raw, offsets, shared.value, bias)
                    value = -np.expm1(-np.add.reduceat(np.logaddexp(0, z), first[:-1]))
                    bad = np.add.reduceat(sigmoid(z) >= threshold, first[:-1], dtype=np.int64)
                else:
                    first = reader.sentences(raw, offsets)[3]
                    value, bad = np.full(n, bias), np.zeros(n, np.int64)
                columns = [batch.column(0).slice(row, n), pa.array(value), pa.array(np.diff(first)), pa.array(bad)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                row += n
            pa.default_memory_pool().release_unused()

    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    scored = texts.mapInArrow(score, "doc_id bigint, score double, n_sentences bigint, n_offending bigint")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_sentences",
        "n_offending",
    )


def offending_sentences(documents: DataFrame, model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, sentence, score, passage): sentences at or above the threshold, numbered from 0, from their first word to their last."""
    weights, bias = model
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def locate(batches):
        reader = SentenceReader()
        for batch in batches:
            row = 0
            for raw, offsets in reader.parts(batch.column(1)):
                n = len(offsets) - 1
                if len(shared.value):
                    z, first, sentence, starts, ends = sentence_scores(reader, raw, offsets, shared.value, bias)
                    edge = np.flatnonzero(np.diff(np.r_[-1, sentence]))
                    last = np.r_[edge[1:], len(sentence)] - 1
                    p = sigmoid(z[sentence[edge]])
                    bad = np.flatnonzero(p >= threshold)
                    home = np.searchsorted(first, sentence[edge[bad]], side="right") - 1
                    passages = [raw[starts[edge[i]] : ends[last[i]]].tobytes().decode("utf-8", "replace") for i in bad.tolist()]
                    ids = batch.column(0).slice(row, n).take(pa.array(home))
                    turn = sentence[edge[bad]] - first[home]
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(turn, pa.int64()), pa.array(p[bad]), pa.array(passages, pa.string())],
                        names=["doc_id", "sentence", "score", "passage"],
                    )
                row += n

    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return texts.mapInArrow(locate, "doc_id bigint, sentence bigint, score double, passage string")


@register("op12_toxicity")
def op12_toxicity(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity_scores(documents, fit_toxicity(documents, table(spark, sf_dir, "labels")))
