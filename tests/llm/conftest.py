"""Helpers of the operator tests: awkward rows that every operator must take."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, lang, source) as a table of documents."""
    full = [(*r, None, None)[:4] if len(r) < 4 else r[:4] for r in rows]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA)


def sentence(rng: random.Random, n: int, words: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int, str | None]]:
    """Copies, near copies, shared passages, separators, accents, empty, null and very long texts."""
    rng = random.Random(5)
    base = [sentence(rng, rng.randrange(30, 160)) for _ in range(25)]
    passage = sentence(rng, 45)
    rows = [*base, base[0], base[0], base[3], passage, "", None, " \t\n ", "one", "Zwei  wörter", "a b c"]
    for i in range(12):
        words = base[1].split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    for i in range(10):
        rows.append(f"{sentence(rng, 20 + i)}\n{passage} {sentence(rng, 30)}")
    rows.append("ab" * 400)
    rows.append(" ".join(["again"] * 90))
    rows.append(sentence(rng, 60_000, 10**7) + " " + passage)
    rows.append("né " * 150 + passage)
    rng.shuffle(rows)
    return list(enumerate(rows))
