"""All queries of this subpackage."""

from __future__ import annotations

from tessera.llm import (  # noqa: F401
    decontaminate,
    exact_dedup,
    filter_audit,
    lm_score,
    merkle,
    mixing,
    ngram_join,
    quality,
    substring_dedup,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)
from tessera.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
