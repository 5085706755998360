"""Suffix-array dedup of bytes: repeated strings removed by longest-previous-factor arrays.

Groups of suffixes that can repeat (see ``repeats``) are sorted as suffix arrays in pieces, with the common prefix of
each suffix and the one before it. In suffix order, a suffix's best earlier match is its previous or its next
smaller position: one pass with a stack finds both, and the longer of the two common prefixes is the
suffix's longest previous factor, the match its source. Positions are ordered by text, then place in it.
Common prefixes are measured up to ``length``, since nothing longer changes a result; of suffixes that agree so
far only the first needs the stack, the others' source is the one before them.

``keep="first"`` removes the windows whose longest previous factor reaches ``length``; ``keep="none"`` those and their
sources. Windows with equal surroundings, and groups above ``hot``, are decided before by digest (see ``repeats``).

Defined cases: null is the empty text; texts shorter than a window lose nothing; a window that
overlaps its own copy counts; rows that share an id, or have none, are texts of their own, in the order of
a digest of their text; rows without id come first; rows equal in id and text are one text that occurs
twice, and neither is the earlier one; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.llm.repeats import HOT_GROUP, SuffixRanks, covered_symbols, prepared, repeated_windows, runs_of, with_spans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 200


def previous_factors(position: list[int], common: list[int]) -> tuple[list[int], list[int]]:
    """(longest previous factor, its source) of every suffix, in suffix order; without one, 0 and -1.

    ``position`` is each suffix's place in the corpus, ``common[i]`` its common prefix with suffix i - 1. The stack
    holds suffixes with ascending positions: when one leaves, the suffix that comes is its next smaller
    position, and the one below it on the stack was its previous smaller position.
    """
    n = len(position)
    factor, source, stack = [0] * n, [-1] * n, []
    below = [0] * n  # common prefix with the suffix below on the stack
    for i in range(n):
        here, shared = position[i], common[i] if i else 0
        while stack and position[stack[-1]] > here:
            left = stack.pop()
            if shared > factor[left]:
                factor[left], source[left] = shared, i
            # what i shares with the one below, it shares through the one that left
            shared = min(shared, below[left])
        if stack and shared:
            factor[i], source[i] = shared, stack[-1]
        below[i] = shared if stack else 0
        stack.append(i)
    return factor, source


def factors(symbols: np.ndarray, places: np.ndarray, length: int, doc: np.ndarray, start: np.ndarray):
    """(suffix order, longest previous factors, sources) of the windows at ``places``; factors and sources are in suffix order."""
    ranks = SuffixRanks(symbols, length)
    depth = ranks.at(places)
    order = np.lexsort((start, doc, depth))
    equal = np.r_[False, depth[order][1:] == depth[order][:-1]]
    position = np.empty(len(order), dtype=np.int64)
    position[np.lexsort((start, doc))] = np.arange(len(order))
    heads = np.flatnonzero(~equal)
    at = places[order[heads]]
    common = np.r_[0, ranks.common(at[:-1], at[1:])]
    factor = np.where(equal, length, 0)
    source = np.arange(len(order)) - 1
    own, match = previous_factors(position[order[heads]].tolist(), common.tolist())
    factor[heads], source[heads] = own, np.where(np.array(match) < 0, -1, heads[match])
    return order, factor, source


def later_copies(symbols: np.ndarray, places: np.ndarray, length: int, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows whose longest previous factor reaches ``length``."""
    order, factor, _ = factors(symbols, places, length, doc, start)
    removed = np.zeros(len(order), dtype=bool)
    removed[order] = factor >= length
    return removed


def all_copies(symbols: np.ndarray, places: np.ndarray, length: int, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows whose longest previous factor reaches ``length``, and their sources."""
    order, factor, source = factors(symbols, places, length, doc, start)
    removed = np.zeros(len(order), dtype=bool)
    long = factor >= length
    removed[order[long]] = True
    removed[order[source[long]]] = True
    return removed


def repeated_strings(texts: DataFrame, length: int = LENGTH, keep: str = "first", hot: int = HOT_GROUP) -> DataFrame:
    """(doc_id, tie, spans) of repeated windows of ``prepared`` texts; ``keep`` is "first" or "none"."""
    gram = max(1, 2 * length // 5)
    judge = later_copies if keep == "first" else all_copies
    return repeated_windows(texts, "bytes", length, gram, keep, judge, hot)


def suffix_dedup(
    documents: DataFrame, length: int = LENGTH, keep: str = "first", doc_id: str = "doc_id", text: str = "text", hot: int = HOT_GROUP
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every text."""
    texts = prepared(documents, doc_id, text)
    spans = repeated_strings(texts, length, keep, hot)

    def take_out(data: bytes, first: np.ndarray, last: np.ndarray):
        runs = runs_of(covered_symbols(first, last, length, len(data))) if len(first) else []
        kept, at = [], 0
        for a, b in runs:
            kept.append(data[at:a])
            at = b
        kept.append(data[at:])
        removed = sum(b - a for a, b in runs)
        return len(data), removed, len(runs), hashlib.sha256(b"".join(kept)).hexdigest()

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return with_spans(texts, spans, take_out, schema)


@register("op1_suffix_dedup")
def op1_suffix_dedup(spark, sf_dir) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), keep="none")
