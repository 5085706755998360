"""Operators with Python code run where executors have no copy of this package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's path only: workers start with their own
from pyspark.sql import functions as F
from tessera.session import build_session
spark = build_session("no package", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[2]})

def absent(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("tessera") is None
        yield batch

ids = spark.range(40).withColumnRenamed("id", "doc_id")
words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), (i * (1 + F.col("doc_id") % 7)).cast("string"))), " ")
docs = ids.select("doc_id", words.alias("text"), F.lit("en").alias("lang"), F.lit("src1").alias("source"), F.lit(1).cast("bigint").alias("n_chars"))
assert docs.mapInArrow(absent, docs.schema).count() == 40
labels = ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
items = ids.limit(3).join(docs, "doc_id").select(F.col("doc_id").alias("item_id"), "text")

from tessera.llm import decontaminate, lm_score, ngram_join, quality, substring_dedup, suffix_dedup, token_files, toxicity
"""

RUNS = {
    "suffix_dedup": "suffix_dedup.suffix_dedup(docs)",
    "substring_dedup": "substring_dedup.substring_dedup(docs)",
    "quality": "quality.quality_scores(docs, quality.fit_quality(docs, labels))",
    "keep_good": "quality.keep_good(docs, quality.fit_quality(docs, labels))",
    "ngram_join": "ngram_join.similar_groups(docs, 3, 90, 100)",
    "decontaminate": "decontaminate.decontaminate(docs, items)",
    "lm_score": "lm_score.lm_scores(docs)",
    "toxicity": "toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, labels))",
    "token_files": "token_files.tokenised(docs, token_files.default_vocabulary())",
}


@pytest.fixture(scope="module")
def outcome(tmp_path_factory) -> dict[str, str]:
    """What each operator did, from one session in a process of its own."""
    folder = tmp_path_factory.mktemp("elsewhere")
    body = "".join(
        f"""
try:
    print("RESULT {name} rows", len({code}.collect()))
except Exception as problem:
    print("RESULT {name} failed", type(problem).__name__, str(problem)[-300:].replace(chr(10), " "))
"""
        for name, code in RUNS.items()
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    command = [sys.executable, "-c", SCRIPT + body, str(REPO), str(folder / "shared")]
    done = subprocess.run(command, capture_output=True, text=True, cwd=folder, env=environment, timeout=600)
    lines = [line.split(" ", 2)[1:] for line in done.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, done.stderr[-2000:]
    return dict(lines)


@pytest.mark.parametrize("name", RUNS)
def test_runs_without_the_package(outcome, name):
    assert outcome[name].startswith("rows "), outcome[name]
