"""A training corpus from raw documents, stage by stage.

Each stage reads what the one before wrote, so it starts by deleting the intermediate tables
of that one: call a stage only when the result of the stage called before has been written.

All but the last return the columns of documents; the last writes token files and returns one
row per document read back from them. Mixing repeats a document once for every epoch that takes
it, so its id may come more than once from there on.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, ngram_join, quality, token_files
from tessera.llm.registry import bound_batches
from tessera.session import drop_paths, scratch_mark, scratch_since, settle

SHINGLE_WORDS, LEAST_SIMILARITY = 5, 80

_LEFT_OVER: list[str] = []


def tidy(stage):
    """A stage that first deletes what the stage called before it left in the shared folder."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        drop_paths(spark, _LEFT_OVER)
        mark = scratch_mark()
        result = stage(spark, docs, sf_dir)
        _LEFT_OVER[:] = scratch_since(mark)
        return result

    return run_stage


@tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


@tidy
def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more: the smallest id."""
    return ngram_join.drop_similar(docs, SHINGLE_WORDS, LEAST_SIMILARITY, 100)


@tidy
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their leaf's budget takes them."""
    return mixing.mix(docs, mixing.source_domain(), mixing.weight_table(spark), mixing.SHARE, mixing.MAX_EPOCHS)


@tidy
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 from the token files."""
    return token_files.tokenised(docs, token_files.default_vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# The classifier, the fingerprints and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
