"""Merkle manifest, toxicity and filter audit."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import filter_audit, merkle, toxicity

from .conftest import frame, sentence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc, source, lang, n, text) -> str:
    return sha("".join(map(framed, (doc, source, lang, n, text))))


def levels_of(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def steps_of(levels, r):
    out = []
    for nodes in levels[:-1]:
        run = nodes[r - r % 2 : r - r % 2 + 2]
        out.append(("".join(run[: r % 2]), "".join(run[r % 2 + 1 :])))
        r //= 2
    return out


def expected_manifest(rows):
    """Rows (doc, text, lang, source, n) by plain recursion."""
    trees: dict = {}
    for doc, text, lang, source, n in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0
        start = leaf_of(doc, source, lang, n + 1 if hit and n is not None else n, text)
        trees.setdefault(lang, []).append((doc, leaf_of(doc, source, lang, n, text), start))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[lang] = levels_of([x[1] for x in trees[lang]])
    tops = levels_of([built[lang][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        for r, (doc, leaf, start) in enumerate(trees[lang]):
            path = steps_of(built[lang], r) + steps_of(tops, at)
            held = start
            for left, right in path:
                held = sha(left + held + right)
            proof = sha("".join(a + b for a, b in path))
            out.append((doc, leaf, built[lang][-1][0], tops[-1][0], proof, held, held == tops[-1][0]))
    return out


def made_manifest(df):
    made = merkle.manifest(df, tampered=merkle.one_in_seven(F.col("doc_id")))
    shown = made.select(
        "doc_id",
        *[merkle.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.proof_text(F.col("path")), 256),
        merkle.folded(F.col("changed"), F.col("path")).alias("folded"),
    )
    return [tuple(r) for r in shown.withColumn("ok", F.col("folded") == F.col("root")).collect()]


def key(row):
    return tuple((x is not None, str(x)) for x in row)


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [7, 2, 5, 300]])
def test_manifest(spark, sizes):
    rng = random.Random(3)
    langs = [None, "zz", "a-ü", ""]
    ids = rng.sample(range(10_000), sum(sizes))
    rows = []
    for lang, n in zip(langs, sizes):
        rows += [(ids.pop(), rng.choice([None, "", "né", "x" * 50]), lang, rng.choice([None, "s|1", "2:ab"]), rng.choice([None, 0, 2**63 - 1])) for _ in range(n)]
    rng.shuffle(rows)
    got = made_manifest(spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn("level", F.lit("x")))
    assert sorted(got, key=key) == sorted(expected_manifest(rows), key=key)


def test_manifest_of_repeated_rows_and_missing_ids(spark):
    rows = [(5, "a", "en", "s", 1)] * 3 + [(None, "b", "en", None, None), (None, "c", "en", "t", 1), (5, "a", "en", "s", 2)] + [(9, "long " * 300_000, "en", "s", 1)]
    got = made_manifest(spark.createDataFrame(rows, SCHEMA))
    assert sorted(got, key=key) == sorted(expected_manifest(rows), key=key)
    assert made_manifest(spark.createDataFrame([], SCHEMA)) == []


def test_manifest_over_several_level_buckets(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(i, f"t{i}", "de" if i % 3 else "fr", "s", i) for i in range(90)]
    assert sorted(made_manifest(spark.createDataFrame(rows, SCHEMA)), key=key) == sorted(expected_manifest(rows), key=key)


def test_siblings_are_what_is_left_of_the_parent(spark):
    nodes = [("t", 0, i, i, bytes([i])) for i in range(5)] + [("t", 1, 0, 1, b"p"), ("t", 1, 2, 3, b"q"), ("t", 1, 4, 4, b"r")]
    made = merkle.with_siblings(spark.createDataFrame(nodes, "tree string, level int, lo long, hi long, digest binary")).collect()
    got = {(r["level"], r["from"], r["to"]): (bytes(r["left"]), bytes(r["right"])) for r in made}
    assert got[(0, 1, 1)] == (b"\x00", b"") and got[(0, 2, 2)] == (b"", b"\x03") and got[(0, 4, 4)] == (b"", b"")
    assert got[(1, 0, 1)] == (b"", b"q") and got[(1, 4, 4)] == (b"", b"")


def expected_audit(rows, labels):
    def words(t):
        return [w for w in re.split("[ \x09-\x0d]+", t) if w]

    texts = [(d, t or "", s or "") for d, t, s in rows]
    judged = []
    for d, t, part in texts:
        w = words(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": d is not None and any(o is not None and o < d and x == t for o, x, _ in texts),
        }
        mine = [(q, x) for i, q, x in labels if i == d and d is not None]
        judged.append((part, fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in judged}:
        for order in permutations("ABCDE"):
            left = [r[1:] for r in judged if r[0] == part]
            gone = []
            for n, f in enumerate(order):
                out_now = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                alone = sum(r[1][f] and sum(r[1].values()) == 1 for r in judged if r[0] == part)
                out[(part, "".join(order), n + 1)] = [len(left), len(out_now), sum(r[0][f] for r in gone), alone, sum(r[1] for r in out_now), sum(r[2] for r in out_now)]
                shapley[(part, f)] += len(out_now)
                gone += out_now
    return sorted((*k, *v, shapley[(k[0], k[1][k[2] - 1])]) for k, v in out.items())


def test_filter_audit(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PIECE_ROWS", 7)
    rng = random.Random(9)
    texts = [None, "", sentence(rng, 250), "HELLO world", "a|b", " ".join(["same"] * 300), "É" * 40 + "AB", "x   \x0b y", sentence(rng, 230) + " #", "long " * 200_000]
    rows = [(i, rng.choice(texts), rng.choice(["s", None, "t", ""])) for i in range(120)]
    rows += [(3, rows[3][1], "s"), (3, "other", "u"), (None, texts[2], "s"), (None, texts[2], "s"), (500, texts[4], "s"), (500, texts[4], "s"), (-1, texts[5], "v")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 130, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (4, 1, 1)]
    docs = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], SCHEMA).selectExpr("*", "1 AS part", "'x' AS digest", "2 AS bits")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(1))
    made = filter_audit.interactions(filter_audit.combinations(docs, known), "ABCDE")
    assert sorted(map(tuple, made.collect())) == expected_audit(rows, labels)


def test_filter_audit_of_little(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interactions(filter_audit.combinations(frame(spark, []), none), "ABCDE").count() == 0
    made = filter_audit.interactions(filter_audit.combinations(frame(spark, [(1, None)]), none), "ABCDE").collect()
    assert len(made) == 600 and {(r.part, r.good_lost, r.toxic_lost) for r in made} == {("", 0, 0)}
    assert {r.shapley for r in made if r.filter_order[r.step - 1] == "A"} == {120}


def test_noisy_or_gradient():
    rng = np.random.default_rng(4)
    text, number = np.array([0, 0, 1, 2, 2]), np.array([3, 1, 2, 1, 5])
    owner, feature, labels = np.array([0, 1, 1, 3, 4]), np.array([0, 1, 2, 2, 0]), np.array([1.0, 0.0, 0.4])
    w, b = rng.normal(size=3), -0.7
    _, on_w, on_b = toxicity.loss_and_gradient(w, b, text, number, owner, feature, labels)
    for i in range(4):
        step = np.eye(4)[i] * 1e-5
        up, down = (toxicity.loss_and_gradient(w + s * step[:3], b + s * step[3], text, number, owner, feature, labels)[0] for s in (1, -1))
        assert math.isclose((up - down) / 2e-5, np.r_[on_w, on_b][i], rel_tol=1e-4, abs_tol=1e-8)


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    return toxicity.fit_toxicity(docs, labels)


def test_toxicity_on_held_out_texts(spark, toxic_model):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.toxicity_scores(docs, toxic_model)
    assert scored.count() == docs.count()
    held = scored.join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    wrong = sum(r.predicted for r in held if not r.toxic) / sum(1 - r.toxic for r in held)
    assert caught >= 0.8 and wrong <= 0.02


def test_offending_sentences_are_located(spark, toxic_model):
    texts = [
        (1, "The thand here. You stupid IDIOT and clown! And of the."), (2, "and the of thing"), (3, None), (4, ""), (None, "what scum, you idiot.\n\n moron and clown"),
        (5, "the of and. " * 60_000 + "such trash, worthless loser"),
    ]
    df = frame(spark, texts).selectExpr("*", "1 AS score", "'a' AS sentence", "0 AS label")
    found = {(r.doc_id, r.sentence): r.passage for r in toxicity.offending_sentences(df, toxic_model).collect()}
    assert found == {(1, 1): "You stupid IDIOT and clown", (None, 0): "what scum, you idiot", (None, 1): "moron and clown", (5, 60_000): "such trash, worthless loser"}
    scored = {r.doc_id: r for r in toxicity.toxicity_scores(df, toxic_model).collect()}
    assert {d for d, r in scored.items() if r.predicted} == {1, None, 5}
    assert (scored[1].n_sentences, scored[1].n_offending, scored[3].n_sentences, scored[5].n_sentences) == (3, 1, 1, 60_001)
    assert scored[3].score == scored[4].score and not scored[None].held_out


def test_noisy_or_combines_the_sentences(spark, toxic_model):
    texts = [(0, "one of thand. pathetic here the! nothing"), (1, "one of thand"), (2, "pathetic here the"), (3, "nothing")]
    whole, *parts = [r.score for r in sorted(toxicity.toxicity_scores(frame(spark, texts), toxic_model).collect())]
    assert math.isclose(whole, 1 - math.prod(1 - p for p in parts), rel_tol=1e-9)


def test_toxicity_edges(spark):
    df = frame(spark, [(1, None), (2, ""), (3, "plain words"), (3, "plain words"), (None, "x"), (4, " \n.")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity_scores(df, toxicity.fit_toxicity(df, none)).collect()} == {0.5}
    one = spark.createDataFrame([(3, 0, 1), (1, 0, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity_scores(df, toxicity.fit_toxicity(df, one)).collect()} <= {0.5, 1.0}
    assert toxicity.offending_sentences(df, toxicity.fit_toxicity(df, none)).count() == 0
    two = spark.createDataFrame([(i, 0, i % 2) for i in range(1, 6)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(df, two)
    scored = toxicity.toxicity_scores(df, model)
    assert scored.count() == 6 and scored.filter("score BETWEEN 0 AND 1").count() == 6
    empty = frame(spark, [])
    assert toxicity.toxicity_scores(empty, toxicity.fit_toxicity(empty, two)).count() == 0
