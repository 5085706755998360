"""Token files, quality, decontamination, scoring and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, lm_score, ngram_join, quality, token_files
from tessera.session import scratch_path

from .conftest import frame, sentence


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_files.default_vocabulary())


AWKWARD = ["<|endoftext|> mid<|startoftext|>dle", "♥ love♥ ♥♥", "it's we'll  I'D", "e\u0301 ﬁ Σ ΑΣ İ", "a\u00a0b\u3000c", "1234 x1y2", "\x00\x01 z", "日本語 テキスト"]


def test_token_files_round_trip(spark, corpus, tokenizer):
    rows = [*corpus, *[(500 + i, t) for i, t in enumerate(AWKWARD)]]
    random.Random(1).shuffle(rows)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(frame(spark, rows), path, token_files.default_vocabulary())
    back = token_files.read_token_files(spark, path)
    start, got = 0, {r.doc_id: r for r in token_files.token_digests(back).collect()}
    stored = {r.doc_id: r.ids for r in back.select("doc_id", "ids").collect()}
    for doc, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert stored[doc] == ids
        assert tuple(got[doc]) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_cache_may_fill_up(spark, corpus, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 50)
    monkeypatch.setattr(token_files, "YOUNG_WORDS", 20)
    ids_of = token_files.WordIds(token_files.default_vocabulary())
    import pyarrow as pa

    texts = [t for _, t in corpus if t is None or len(t) < 5000] + AWKWARD
    flat, count = zip(*token_files.encode_texts(pa.array(texts), token_files.WordReader(), ids_of, 1))
    expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert np.concatenate(flat).tolist() == [i for e in expected for i in e]


def test_token_file_edges(spark):
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(frame(spark, []), path, token_files.default_vocabulary())
    assert token_files.read_token_files(spark, path).count() == 0
    path = scratch_path(spark, "tokens")
    df = frame(spark, [(2, "b"), (None, "a"), (2, "a a"), (2, "b"), (1, None)]).withColumn("shard", F.lit("x"))
    token_files.write_token_files(df, path, token_files.default_vocabulary())
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.read_token_files(spark, path).collect())
    assert got == [(0, None, 2), (2, 1, 1), (3, 2, 3), (6, 2, 2), (8, 2, 2)]
    found = token_files.read_documents(spark, path, [1])
    assert [r.ids for r in found.collect()] == [[1]]
    assert "EqualTo(doc_id,1)], ReadSchema" in found._jdf.queryExecution().toString()


def test_quality_on_held_out_texts(spark, data):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_quality(documents, labels)
    scored = quality.quality_scores(documents, model)
    assert scored.count() == documents.count()
    held = scored.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in held)
    kept = quality.keep_good(documents, model)
    assert kept.columns == documents.columns and kept.count() == scored.filter("predicted = 1").count()


def test_quality_learns_from_whole_texts(spark):
    known = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5][:4]
    texts = dict(zip(known, ["w " * 40_000, "plain words", None, "x"]))
    df = frame(spark, list(texts.items()))
    labels = spark.createDataFrame([(i, i % 2) for i in known], "doc_id long, quality int")
    args = (df, labels, "doc_id", "text", "quality")
    bags, _ = quality.sample_bags(*args, 10)
    assert [len(b) for b in bags] == [625, 1, 1, 1]
    bags, _ = quality.sample_bags(*args, 10, sample_bytes=79_999)
    assert [len(b) for b in bags] == [1, 1, 1]
    assert len(quality.sample_bags(*args, 2)[0]) == 2


def test_attention_gradients():
    rng = np.random.default_rng(3)
    model = quality.AttentionModel(6)
    bounds, labels = np.array([0, 2, 3, 7]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(size=(7, 6))

    def loss():
        s = model.forward(x, bounds)["score"]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    made = model.gradients(model.forward(x, bounds), labels, bounds)
    for name, values in model.p.items():
        at = tuple(0 for _ in values.shape)
        held = values[at]
        values[at] = held + 1e-5
        up = loss()
        values[at] = held - 1e-5
        down = loss()
        values[at] = held
        assert math.isclose((up - down) / 2e-5, made[name][at], rel_tol=1e-4, abs_tol=1e-7)


def test_quality_edges(spark):
    df = frame(spark, [(1, None), (2, ""), (3, "plain words here"), (3, "plain words here"), (None, "x"), (4, "w " * 40_000), (5, " \n")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(df, quality.fit_quality(df, none)).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(df, quality.fit_quality(df, one)).collect()} <= {0.5, 1.0}
    two = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 6)], "doc_id long, quality int, toxic int")
    extra = df.selectExpr("*", "1 AS score", "'a' AS held_out", "0 AS label")
    scored = quality.quality_scores(extra, quality.fit_quality(extra, two))
    assert scored.count() == 7 and scored.filter("score BETWEEN 0 AND 1").count() == 7
    empty = frame(spark, [])
    assert quality.quality_scores(empty, quality.fit_quality(empty, two)).count() == 0


def expected_leaks(docs, items):
    """All windows of every item's size, by the exact similarity alone."""
    def bag(words):
        n = min(5, len(words))
        return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))

    found = {}
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            want = (item or "").lower().split()
            for s in range(len(words) - len(want) + 1) if want else []:
                a, b = bag(words[s : s + len(want)]), bag(want)
                share = (a & b).total() / (a | b).total()
                if share >= 0.8 and share > found.get((d, i), (0, 0))[0]:
                    found[(d, i)] = (share, s)
    return found


def test_contaminated(spark):
    rng = random.Random(2)
    items = [(i, sentence(rng, n)) for i, n in enumerate([14, 22, 22, 37, 60, 3, 5])] + [(90, None), (91, ""), (92, " \n ")]
    docs = []
    for d in range(60):
        words = sentence(rng, rng.randrange(20, 90)).split()
        if d % 3 == 0:
            leak = items[rng.randrange(7)][1].split()
            for _ in range(d % 2):
                leak[rng.randrange(len(leak))] = "changed"
            words[10:10] = [w.upper() for w in leak]
        docs.append((d, " ".join(words)))
    docs += [(70, None), (71, ""), (72, items[3][1]), (72, items[3][1]), (None, items[3][1])]
    got = decontaminate.contaminated(frame(spark, docs).withColumn("n", F.lit(1)), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in got.collect()}
    exact = expected_leaks([x for x in docs if x[0] is not None], items)
    assert found == exact
    kept = decontaminate.decontaminate(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in exact}


def test_text_shorter_than_the_item(spark):
    def similarity(words, want):
        a, b = (Counter(tuple(x[i : i + 5]) for i in range(len(x) - 4)) for x in (words, want))
        return (a & b).total() / (a | b).total()

    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate([20, 21, 40, 4])]
    docs, exact = [], {}
    for item, text in items:
        words = text.split()
        for cut in range(1, min(len(words), 9)):
            docs += [(len(docs), " ".join(words[:-cut])), (len(docs) + 1, " ".join(words[cut:]).upper())]
    docs += [(len(docs), "short"), (len(docs) + 1, None), (None, items[0][1][:-6])]
    for d, text in docs:
        for i, item in items[:3]:
            words, want = (text or "").lower().split(), item.split()
            if d is not None and 5 <= len(words) < len(want) and similarity(words, want) >= 0.8:
                exact[(d, i)] = (0, len(words), similarity(words, want))
    assert len(exact) == 2 * (3 + 3 + 7)
    made = decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.similarity) for r in made} == exact


def test_decontamination_edges(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contaminated(frame(spark, []), items).count() == 0
    assert decontaminate.contaminated(frame(spark, [(1, "a b c")]), items.limit(0)).count() == 0


def test_block_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, (30, 2), dtype=np.uint64)
    rows = []
    for i, words in enumerate(base):
        for j, distance in enumerate((0, 15, 31, decontaminate.RADIUS)):
            changed = words.copy()
            for bit in rng.choice(128, distance, replace=False).tolist():
                changed[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
            rows.append((i * 10 + j, *changed.view(np.int64).tolist()))
    asked = decontaminate.blocks(spark.createDataFrame(rows, "q long, high long, low long"), False)
    items = spark.createDataFrame([(i, *r) for i, r in enumerate(base.view(np.int64).tolist())], "item long, high long, low long")
    posted = decontaminate.blocks(items, True).select("item", "block", "value")
    met = asked.join(posted, ["block", "value"]).filter("q div 10 = item").select("q").distinct()
    assert {r.q for r in met.collect()} == {q for q, _, _ in rows}


def test_radius_holds_borderline_windows():
    """Windows of similarity just above 0.8 lie within the radius: a run of words is changed until it is barely reached."""
    rng = np.random.default_rng(5)
    for size in (18, 36, 116):
        changed = size // 9
        for _ in range(400):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            b = a.copy()
            b[:changed] = rng.integers(0, 1 << 63, changed, dtype=np.uint64)
            smaller, larger = decontaminate.weighted_similarity(a, b)
            assert 80 * larger <= 100 * smaller <= 84 * larger
            apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(decontaminate.simhash(a), decontaminate.simhash(b)))
            assert apart <= decontaminate.RADIUS


def expected_scores(rows, order):
    texts = [(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()) for d, t in rows]
    all_counts, own = Counter(), []
    for _, words in texts:
        mine = Counter(tuple(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1))
        own.append(mine)
        all_counts += mine
    total = sum(len(w) for _, w in texts)
    out = []
    for (d, words), mine in zip(texts, own):
        score = 0.0
        for i in range(len(words)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(words[i - n + 1 : i + 1])
                seen = all_counts[gram] - mine[gram]
                if n == 1:
                    score += math.log(max(seen, 1) / max(total - len(words), 1))
                elif seen:
                    score += math.log(seen / (all_counts[gram[:-1]] - mine[gram[:-1]]))
                    break
                else:
                    score += math.log(0.4)
        out.append((d, len(words), round(score, 6)))
    return out


@pytest.mark.parametrize("order, block, part", [(1, 10_000, 500), (2, 3_000, 2_000), (3, 1 << 20, 100), (3, 5_000, 1 << 20)])
def test_lm_scores(spark, corpus, order, block, part):
    rows = [(d, t) for d, t in corpus if t is None or len(t) < 50_000] + [(None, "a b a b"), (7, "repeated id"), (8, "Repeated ID")]
    got = lm_score.lm_scores(frame(spark, rows).withColumn("block", F.lit(1)), order, block_bytes=block, part_grams=part).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r.n_words, round(r.log_score, 6)) for r in got), key=key) == sorted(expected_scores(rows, order), key=key)


def test_lm_scores_of_little(spark):
    assert lm_score.lm_scores(frame(spark, [])).count() == 0
    got = lm_score.lm_scores(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r.n_words, r.log_score, r.mean_log_score) for r in got] == [(0, 0.0, None)] * 2


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"t-{name}")
        stage(spark, docs, data).write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
        if name != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = seen["near_copies"]
    groups = ngram_join.similar_groups(before, 5, 80, 100)
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups.collect()}
    before, after = seen["decontamination"]
    leaks = {r.doc_id for r in decontaminate.contaminated(before, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in before.collect()} - leaks == {r.doc_id for r in after.collect()}
    before, after = seen["tokens"]
    assert before.count() == after.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, data).collect())) == sorted(map(tuple, after.collect()))
