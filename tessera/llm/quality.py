"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of 64 words. Every passage of every whole text is encoded by the kinds of
its characters and their pairs and by how its words vary and repeat; then a hidden layer. Gated attention
gives each passage a weight within its text, and the score is a logistic function of the weighted
sum. All parts are learnt together from labels of texts only; the weights that passages
get are learnt from them too.

Fitting uses a sample of labelled texts, whole: in order of the hash of their id, at most ``SAMPLE`` rows and as
many as have ``SAMPLE_BYTES`` of text together, which bounds what the driver holds (a passage takes 696 bytes there
and has some 400 bytes of text, 128 at least); a single text longer than that does not teach. Scoring reads all passages of all texts,
where they are read, without a shuffle.

Defined cases: null and empty texts are one passage without characters and get a score like
any; several labels of one id are averaged; rows with a null label or id teach nothing; without
labels of both kinds every score is the share of label 1 (0.5 without labels); repeated rows
get equal scores; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.llm.words import WordReader, chunks, give_back, mix, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PASSAGE_WORDS = 64
SAMPLE = 4000
SAMPLE_BYTES = 64 << 20
THRESHOLD = 0.3
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.01, 1e-4
SCAN_BYTES = 1 << 20

# Kinds of bytes; what is not named is kind 0 (controls).
KINDS = [
    (b"abcdefghijklmnopqrstuvwxyz", 1),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2),
    (b"0123456789", 3),
    (b" ", 4),
    (b"\t\n\r\x0b\x0c", 5),
    (b".,;:", 6),
    (b"!?", 7),
    (b"'\"-()", 8),
    (b"#$%&*+=@^~", 9),
    (b"|<>[]{}\\/_`", 10),
    (bytes(range(128, 192)), 11),
    (bytes(range(192, 256)), 12),
]
N_KINDS = 13
N_FEATURES = N_KINDS * N_KINDS + 5


def kind_table() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.int64)
    for members, kind in KINDS:
        kinds[list(members)] = kind
    return kinds


class PassageEncoder:
    """Feature rows of all passages of a buffer of texts, with the bounds of each text's passages."""

    def __init__(self):
        self.reader, self.kinds = WordReader(), kind_table()

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, words = self.reader.spans(raw, offsets)
        per_text = np.maximum(-(-np.diff(words) // PASSAGE_WORDS), 1)
        bounds = np.r_[0, np.cumsum(per_text)]
        n = int(bounds[-1])
        # bytes of a passage run from its first word to the next passage's; a text's first takes what is before
        text = np.repeat(np.arange(len(per_text)), per_text)
        nth = np.arange(n) - bounds[text]
        begin = offsets[text].copy()
        later = nth > 0
        begin[later] = starts[words[text[later]] + nth[later] * PASSAGE_WORDS]
        size = np.diff(np.r_[begin, len(raw)])
        owner = np.repeat(np.arange(n), size)
        kinds = self.kinds[raw]
        features = np.zeros((n, N_FEATURES), dtype=np.float32)
        if len(raw) > 1:
            pair = kinds[:-1] * N_KINDS + kinds[1:]
            same = owner[1:] == owner[:-1]
            code = (owner[:-1] * (N_KINDS * N_KINDS) + pair)[same]
            counts = np.bincount(code, minlength=n * N_KINDS * N_KINDS).reshape(n, -1)
            features[:, : N_KINDS * N_KINDS] = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])
        if len(starts):
            hashes = self.reader.hashes(raw, starts, ends)
            home = owner[starts]
            held = np.bincount(home, minlength=n)
            many = np.maximum(held, 1)
            keys = hashes ^ mix(home.astype(np.uint64))
            order = np.argsort(keys)
            fresh = np.r_[True, keys[order][1:] != keys[order][:-1]]
            different = np.bincount(home[order[fresh]], minlength=n)
            repeat = (hashes[1:] == hashes[:-1]) & (home[1:] == home[:-1])
            features[:, -5] = different / many
            features[:, -4] = np.bincount(home[1:][repeat], minlength=n) / many
            features[:, -3] = np.log1p(np.bincount(home, weights=ends - starts, minlength=n) / many)
            features[:, -2] = held / PASSAGE_WORDS
        features[:, -1] = np.log1p(per_text)[text]
        return features, bounds


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Hidden layer, gated attention over the passages of a text, logistic output."""

    def __init__(self, features: int, seed: int = 7):
        rng = np.random.default_rng(seed)

        def weights(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.p = {
            "w": weights(features, HIDDEN), "b": np.zeros(HIDDEN),
            "v": weights(HIDDEN, GATE), "u": weights(HIDDEN, GATE), "a": weights(GATE, 1)[:, 0],
            "c": weights(HIDDEN, 1)[:, 0], "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict:
        p, first = self.p, bounds[:-1]
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        text = np.repeat(np.arange(len(first)), np.diff(bounds))
        weight = np.exp(e - np.maximum.reduceat(e, first)[text])
        weight /= np.add.reduceat(weight, first)[text]
        z = np.add.reduceat(weight[:, None] * h, first)
        return {"x": x, "h": h, "t": t, "g": g, "text": text, "weight": weight, "z": z, "score": sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, f: dict, labels: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, bounds[:-1]
        out = (f["score"] - labels) / len(labels)
        dz = out[:, None] * p["c"]
        on_h = f["weight"][:, None] * dz[f["text"]]
        on_weight = (dz[f["text"]] * f["h"]).sum(axis=1)
        centre = np.add.reduceat(f["weight"] * on_weight, first)
        de = f["weight"] * (on_weight - centre[f["text"]])
        dt = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        on_h += dt @ p["v"].T + dg @ p["u"].T
        dx = on_h * (1 - f["h"] ** 2)
        return {
            "w": f["x"].T @ dx, "b": dx.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ dg,
            "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ out, "d": np.array([out.sum()]),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> AttentionModel:
        rows = np.concatenate(bags)
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 0.02
        rng, step = np.random.default_rng(seed), 0
        moment = {k: np.zeros_like(v) for k, v in self.p.items()}
        spread = {k: np.zeros_like(v) for k, v in self.p.items()}
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for start in range(0, len(order), BATCH):
                part = order[start : start + BATCH]
                bounds = np.r_[0, np.cumsum([len(bags[i]) for i in part])]
                f = self.forward(np.concatenate([bags[i] for i in part]), bounds)
                step += 1
                for k, g in self.gradients(f, labels[part], bounds).items():
                    g = g + DECAY * self.p[k]
                    moment[k] = 0.9 * moment[k] + 0.1 * g
                    spread[k] = 0.999 * spread[k] + 0.001 * g * g
                    size = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] = self.p[k] - size * moment[k] / (np.sqrt(spread[k]) + 1e-8)
        return self


class ConstantModel:
    """The share of label 1, where there is nothing to tell labels apart by."""

    def __init__(self, share: float):
        self.share = share

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict:
        return {"score": np.full(len(bounds) - 1, self.share)}


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def each_text(column: pa.Array, encoder: PassageEncoder):
    """(first row, features, bounds) of consecutive texts."""
    raw, offsets = text_buffer(column)
    for first, last in chunks(offsets, SCAN_BYTES):
        yield encoder(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])


def sample_bags(documents: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int, sample_bytes: int = SAMPLE_BYTES) -> tuple[list, np.ndarray]:
    """Feature bags and labels of at most ``sample`` texts with ``sample_bytes`` together, in order of their id."""
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.avg("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # at most ``sample`` rows on this side, here and below
    sized = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sized = sized.filter(F.col("bytes") <= sample_bytes).withColumn("upto", F.sum("bytes").over(order))
    taken = sized.filter(F.col("upto") <= sample_bytes).select("doc_id", "label")
    picked = texts.join(F.broadcast(taken), "doc_id").select("doc_id", "text", "label")

    def encode(batches):
        encoder = PassageEncoder()
        for batch in batches:
            bags = []
            for features, bounds in each_text(batch.column(1), encoder):
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    bags.append(features[a:b].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"])
        give_back()

    found = {}
    for row in picked.mapInArrow(encode, "doc_id bigint, label double, bag binary").toLocalIterator():
        bag = np.frombuffer(bytes(row["bag"]), dtype=np.float16).astype(np.float32).reshape(-1, N_FEATURES)
        found[row["doc_id"]] = (bag, row["label"])
    order = sorted(found)
    return [found[k][0] for k in order], np.array([found[k][1] for k in order])


def fit_quality(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> AttentionModel | ConstantModel:
    bags, known = sample_bags(documents, labels, doc_id, text, label, sample)
    if len(known) == 0 or known.min() == known.max():
        return ConstantModel(float(known.mean()) if len(known) else 0.5)
    return AttentionModel(N_FEATURES).fit(bags, known)


def text_scores(column: pa.Array, encoder: PassageEncoder, model) -> np.ndarray:
    parts = [model.forward(features, bounds)["score"] for features, bounds in each_text(column, encoder)]
    return np.concatenate(parts) if parts else np.zeros(0)


def quality_scores(documents: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def score(batches):
        encoder = PassageEncoder()
        for batch in batches:
            scores = text_scores(batch.column(1), encoder, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
        give_back()

    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    scored = texts.mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, model, text: str = "text") -> DataFrame:
    """The rows of ``documents`` with a score of at least the threshold, columns as they are."""
    place = documents.columns.index(text)

    def keep(batches):
        encoder = PassageEncoder()
        for batch in batches:
            yield batch.filter(pa.array(text_scores(batch.column(place), encoder, model) >= THRESHOLD))
        give_back()

    return documents.mapInArrow(keep, documents.schema)


@register("op6_quality")
def op6_quality(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_scores(documents, fit_quality(documents, table(spark, sf_dir, "labels")))
