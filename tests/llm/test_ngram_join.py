"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from tessera.llm import ngram_join
from tessera.llm.components import components
from tessera.llm.ngram_join import drop_similar, similar_groups

from .conftest import frame, sentence


def shingle_set(text, size):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def expected_groups(rows, size, num, den):
    sets = {d: shingle_set(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and den * len(x & y) >= num * len(x | y):
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    return {d: (len(sets[d]), root(d)) for d in sets}


def chains(seed):
    """Near copies at every distance, in chains, so that hubs alone do not join them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(8):
        words = sentence(rng, rng.choice([12, 40, 90])).split()
        for _ in range(14):
            rows.append(" ".join(words))
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.2:
                words = words[rng.randrange(3) :]
    rows += [rows[0], rows[5].upper()]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size, num", [(3, 90), (5, 80), (2, 60)])
def test_chains(spark, size, num):
    rows = chains(size)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame(spark, rows), size, num, 100).collect()}
    assert got == expected_groups(rows, size, num, 100)


def expected_links(rows, size, num, den):
    """For every row, the different sets other than its own that it is similar to."""
    sets = {d: frozenset(shingle_set(t, size)) for d, t in rows}
    classes = set(sets.values())
    return {d: sum(den * len(x & y) >= num * len(x | y) for y in classes if x and y and x != y) for d, x in sets.items()}


@pytest.mark.parametrize("size, num, block", [(3, 90, 128), (5, 80, 5), (2, 60, 3)])
def test_all_links_are_counted(spark, monkeypatch, size, num, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    rows = chains(size)
    got = {r.doc_id: r.n_links for r in similar_groups(frame(spark, rows), size, num, 100).collect()}
    assert got == expected_links(rows, size, num, 100)


def test_each_of_three_similar_texts_has_two_links(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words, *([f"end{i}"] if i else [])])) for i in range(3)] + [(9, " ".join(words).upper())]
    got = sorted((r.doc_id, r.n_links) for r in similar_groups(frame(spark, [*rows, rows[1]])).collect())
    assert got == [(0, 2), (1, 2), (1, 2), (2, 2), (9, 2)]


def test_corpus(spark, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame(spark, corpus)).collect()}
    assert got == expected_groups(corpus, 3, 90, 100)


def test_given_texts(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df).collect()}
    assert got == expected_groups(rows, 3, 90, 100)


def test_one_row_of_each_group_stays(spark, corpus):
    groups = expected_groups(corpus, 5, 80, 100)
    kept = drop_similar(frame(spark, corpus))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in groups.items() if c == d)


def test_edge_rows(spark):
    assert similar_groups(frame(spark, [])).count() == 0
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "A b  c\nd"), (9, None), (8, "")]
    df = frame(spark, rows).selectExpr("*", "1 AS token", "2 AS n", "3 AS u", "4 AS node")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in similar_groups(df).collect())
    assert got == [(0, 2, None), (2, 2, 2), (4, 2, 2), (4, 2, 2), (8, 0, 8), (9, 0, 9)]


def test_text_without_id_takes_no_link_from_others(spark):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [(None, words), (3, f"{words} end"), (5, f"{words} other"), (None, f"{words} end")]
    got = sorted(((r.doc_id or 0), r.component_id or 0, r.n_links) for r in similar_groups(frame(spark, rows)).collect())
    assert got == [(0, 0, 0), (0, 0, 0), (3, 3, 1), (5, 3, 1)]
    assert sorted(r.doc_id or 0 for r in drop_similar(frame(spark, rows)).collect()) == [0, 0, 3]


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
