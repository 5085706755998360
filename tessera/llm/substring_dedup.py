"""Substring dedup of words by prefix-partitioned suffix trees.

Suffixes that can repeat (see ``repeats``) are dealt out by a prefix of words at their anchor; a group
that is too large for a task is dealt out by the whole window instead, the longest prefix that
matters. A piece of groups is sorted, and the intervals of suffixes that share a prefix are the nodes of
its suffix tree. Nodes at least ``length`` words deep are the maximal repeats: their leaves are all
places where those words start, and all but the earliest leaf are removed.

Defined cases: null is a text without words; texts shorter than a window lose nothing; a window
that overlaps its own copy counts; rows that share an id, or have none, are texts of their own, in the
order of a digest of their text; rows without id come first; rows equal in id and text are one text that
occurs twice, and neither is the earlier one; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tessera.llm.registry import register, table
from tessera.llm.repeats import HOT_GROUP, SuffixRanks, covered_symbols, prepared, repeated_windows, with_spans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 20
GRAM = 4


def deep_nodes(ranks: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves in tree order, and first and last leaf of every node at full depth with two leaves or more."""
    leaves = np.lexsort((start, doc, ranks))
    cut = np.flatnonzero(np.diff(ranks[leaves]) != 0) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(leaves)] - 1
    deep = last > first
    return leaves, first[deep], last[deep]


def later_leaves(symbols: np.ndarray, places: np.ndarray, length: int, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """All leaves of deep nodes but those at the node's earliest place."""
    ranks = SuffixRanks(symbols, length).at(places)
    leaves, first, last = deep_nodes(ranks, doc, start)
    size = last - first + 1
    node = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    earliest = leaves[first][node]
    held = leaves[at]
    removed = np.zeros(len(ranks), dtype=bool)
    removed[held] = (doc[held] != doc[earliest]) | (start[held] != start[earliest])
    return removed


def substring_dedup(
    documents: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", hot: int = HOT_GROUP
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (kept words joined by one space) of every text."""
    texts = prepared(documents, doc_id, text)
    gram = min(GRAM, max(1, length // 2))
    spans = repeated_windows(texts, "words", length, gram, "first", later_leaves, hot)

    def take_out(data: bytes, first: np.ndarray, last: np.ndarray):
        words = data.split()  # at space and the controls 9 to 13
        n, removed = len(words), 0
        if len(first):
            mask = covered_symbols(first, last, length, n)
            removed = int(mask.sum())
            words = [words[i] for i in np.flatnonzero(~mask).tolist()]
        return n, removed, hashlib.sha256(b" ".join(words)).hexdigest()

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return with_spans(texts, spans, take_out, schema)


@register("op5_substring_dedup")
def op5_substring_dedup(spark, sf_dir) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))
