"""Repeated bytes and words against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import repeats
from tessera.llm.substring_dedup import substring_dedup
from tessera.llm.suffix_dedup import factors, previous_factors, suffix_dedup
from tessera.llm.words import WordReader

from .conftest import frame


def removed_mask(sequences, length, keep):
    """By sequence number (ids ascending): which symbols lie in a removed window."""
    seen = defaultdict(list)
    for i, symbols in enumerate(sequences):
        for s in range(len(symbols) - length + 1):
            seen[tuple(symbols[s : s + length]) if isinstance(symbols, list) else symbols[s : s + length]].append((i, s))
    masks = [np.zeros(len(x), dtype=bool) for x in sequences]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places if keep == "none" else places[1:]:
                masks[i][s : s + length] = True
    return masks


def bytes_result(rows, length, keep):
    data = [(t or "").encode() for _, t in rows]
    out = {}
    for (doc, _), raw, mask in zip(rows, data, removed_mask(data, length, keep)):
        kept = bytes(np.frombuffer(raw, np.uint8)[~mask])
        out[doc] = (len(raw), int(mask.sum()), len(repeats.runs_of(mask)), hashlib.sha256(kept).hexdigest())
    return out


def words_result(rows, length):
    data = [(t or "").encode().split() for _, t in rows]
    out = {}
    for (doc, _), words, mask in zip(rows, data, removed_mask(data, length, "first")):
        kept = b" ".join(w for w, m in zip(words, mask) if not m)
        out[doc] = (len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [repeats.HOT_GROUP, 1])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_bytes(spark, corpus, keep, hot):
    rows = [(d, t) for d, t in corpus if t is None or len(t) < 50_000]
    got = suffix_dedup(frame(spark, rows), 60, keep, hot=hot).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == bytes_result(rows, 60, keep)


def test_bytes_at_the_contract_length(spark, corpus):
    rows = [(d, t) for d, t in corpus if t is None or len(t) < 50_000]
    got = suffix_dedup(frame(spark, rows), keep="none").collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == bytes_result(rows, 200, "none")


@pytest.mark.parametrize("hot", [repeats.HOT_GROUP, 1])
@pytest.mark.parametrize("length", [20, 7])
def test_words(spark, corpus, hot, length):
    got = substring_dedup(frame(spark, corpus), length, hot=hot).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == words_result(corpus, length)


def test_given_texts(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    rows.sort()
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup(frame(spark, rows)).collect()}
    assert got == words_result(rows, 20)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup(frame(spark, rows), keep="none").collect()}
    assert got == bytes_result(rows, 200, "none")


def test_empty_repeated_and_unnamed_rows(spark):
    assert suffix_dedup(frame(spark, [])).count() == 0
    assert substring_dedup(frame(spark, [])).count() == 0
    text = " ".join(f"x{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (2, text), (3, None)]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in substring_dedup(frame(spark, rows)).collect())
    # the row without id comes first and keeps its words; copies under one id are both later
    assert got == [(False, 0, 0), (True, 1, 30), (True, 1, 30), (True, 2, 30), (True, 3, 0)]


def test_extra_columns(spark):
    df = frame(spark, [(1, "a b"), (2, "c")]).selectExpr("*", "1 AS anchor", "'x' AS covered", "2 AS first", "3 AS spans")
    assert suffix_dedup(df).count() == substring_dedup(df).count() == 2


def test_suffix_ranks_follow_the_order_of_bytes():
    raw = np.frombuffer(b"banana bandana banana banda", dtype=np.uint8)
    for length in (3, 8, 13):
        places = np.arange(len(raw) - length + 1)
        ranks = repeats.SuffixRanks(raw, length).at(places)
        strings = [raw[p : p + length].tobytes() for p in places]
        assert [sorted(set(strings)).index(s) for s in strings] == np.unique(ranks, return_inverse=True)[1].tolist()


def shared_prefix(a, b) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("dtype", [np.uint8, np.uint64])
@pytest.mark.parametrize("length", [1, 3, 8, 13, 20, 40])
def test_common_prefixes(length, dtype):
    rng = np.random.default_rng(length)
    symbols = np.r_[rng.integers(0, 2, 150), np.tile([0, 1, 1], 40), rng.integers(0, 2, 150)].astype(dtype)
    places = np.arange(len(symbols) - length + 1)
    a, b = rng.choice(places, 600), rng.choice(places, 600)
    got = repeats.SuffixRanks(symbols, length).common(a, b)
    assert got.tolist() == [shared_prefix(symbols[x : x + length], symbols[y : y + length]) for x, y in zip(a, b)]


@pytest.mark.parametrize("seed", range(4))
def test_previous_factors(seed):
    """Longest previous factors of a whole text against all pairs, and sources that are such matches."""
    rng = np.random.default_rng(seed)
    text = bytes(rng.integers(97, 99 + seed, 120).astype(np.uint8)) + b"abab" * 10
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = [0] + [shared_prefix(text[a:], text[b:]) for a, b in zip(order, order[1:])]
    factor, source = previous_factors(order, common)
    for here, long, at in zip(order, factor, source):
        assert long == max((shared_prefix(text[j:], text[here:]) for j in range(here)), default=0)
        if long:
            assert order[at] < here and shared_prefix(text[order[at] :], text[here:]) == long
        else:
            assert at == -1


def test_factors_up_to_a_length():
    rng = np.random.default_rng(9)
    text = np.r_[rng.integers(0, 3, 200), np.tile([0, 1], 50), rng.integers(0, 3, 100)].astype(np.uint8)
    for length in (2, 7, 30):
        places = np.arange(len(text) - length + 1)
        doc = np.sort(rng.integers(0, 3, len(places)))
        order, factor, source = factors(text, places, length, doc, places)
        for i, here in enumerate(order):
            window = text[here : here + length]
            assert factor[i] == max((shared_prefix(text[j : j + length], window) for j in range(here)), default=0)
            assert (source[i] < 0) == (factor[i] == 0)


def with_ids(rows):
    """Rows in the order that the operators define: missing ids first, then by id, then by digest of the text."""
    tie = lambda t: int(hashlib.sha256((t or "").encode()).hexdigest()[:15], 16)
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))


@pytest.mark.parametrize("hot", [repeats.HOT_GROUP, 1])
def test_rows_that_share_an_id_or_have_none(spark, corpus, hot):
    """Texts of their own: nothing is removed from one because of what another with its id repeats."""
    texts = sorted({t or "" for _, t in corpus if t is None or len(t) < 5_000})
    rows = with_ids([([None, 7, 8, i][i % 4], t) for i, t in enumerate(texts)])
    named = list(enumerate(t for _, t in rows))
    want = sorted((rows[i][0] or -1, *r) for i, r in words_result(named, 20).items())
    got = substring_dedup(frame(spark, rows), hot=hot).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in got) == want
    for keep in ("none", "first"):
        want = sorted((rows[i][0] or -1, *r) for i, r in bytes_result(named, 60, keep).items())
        got = suffix_dedup(frame(spark, rows), 60, keep, hot=hot).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in got) == want


@pytest.mark.parametrize("keep, lost", [("none", [0, 0, 90, 90]), ("first", [0, 0, 0, 90])])
def test_unrelated_text_under_a_shared_id(spark, keep, lost):
    x, y, z = (" ".join(f"{c}{i}" for i in range(90)) for c in "xyz")
    rows = [(7, f"{x} q"), (7, y), (None, x), (None, z)]
    if keep == "first":
        got = [r.n_removed for r in substring_dedup(frame(spark, rows)).collect()]
        assert sorted(got) == lost
    got = [(r.doc_id, r.n_removed) for r in suffix_dedup(frame(spark, rows), keep=keep).collect()]
    assert sorted(n for _, n in got) == [len(x) if n else 0 for n in lost]
    # copies of one row without id: one text that occurs twice
    copies = [(None, x), (None, x), (None, y)]
    assert sorted(r.n_removed for r in suffix_dedup(frame(spark, copies), keep=keep).collect()) == ([0, len(x), len(x)] if keep == "none" else [0, 0, 0])


def thue_morse(n: int) -> tuple[str, str]:
    """Two words of n letters on which every polynomial modulo a power of two with an odd base agrees from some length on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_words_of_a_pattern_stay_different(spark, n):
    one, two = thue_morse(n)
    raw = np.frombuffer(f"{one} {two} {one}".encode(), np.uint8)
    reader = WordReader()
    a, b, c = reader.hashes(raw, *reader.spans(raw, np.array([0, len(raw)]))[:2])
    assert a == c != b
    rows = [(i, " ".join([w, *(f"w{k}" for k in range(19))])) for i, w in enumerate((one, two, one))]
    got = substring_dedup(frame(spark, rows)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 0, 1: 0, 2: 20}


def test_word_hashes_do_not_depend_on_their_surroundings():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 2, 7, 63, 64, 65, 66, 300)]
    reader = WordReader(fold_case=True)

    def hashed(text: bytes) -> list[int]:
        raw = np.frombuffer(text, np.uint8)
        return reader.hashes(raw, *reader.spans(raw, np.array([0, len(raw)]))[:2]).tolist()

    want = [hashed(w)[0] for w in words]
    assert len(set(want)) == len(words)
    assert hashed(b"  " + b" \n".join(words).upper() + b"\t") == want
