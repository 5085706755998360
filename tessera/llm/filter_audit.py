"""What each filter of a chain removes, by itself and after the others, in every order.

Four filters judge a row by its text. The fifth is existential: a row fails if the same text stands under a
smaller id anywhere in the table. That is a left-semi join on digest, exact text and smaller id:
only rows whose digest stands under several ids take part, and the right side is one
row per text with its smallest id, which is all that "some smaller id" asks for. Groups of copies
are dealt to as many pieces as their size asks for (``PIECE_ROWS``), so a text that a third of all
rows share does not become one task.

Whole texts only move where their digest is among those: a bit set of a fixed size spares the scan the
others. When it fills up more rows pass, and the join behind it drops them: slower, never different.

The ids that fail there are united with the failures of the other filters, and rows are counted by
part and combination of failures. Everything after that works on at most ``2 ** filters * 4`` rows a
part: with the rows that fail none of a set of filters, for all sets, every figure of every order is a
difference of two of them.

Defined cases: null and empty texts are empty, have no words and fail the word count only; a null
part is the empty string; rows without id are never copies and no row is a copy of them; of rows with the
same id and text none makes the other a copy; several labels of an id count when any is 1, null
labels do not; rows count as often as they occur; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.dense import bit_set, holds
from tessera.llm.registry import register, table
from tessera.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_ROWS = 2000
DIGEST_BITS = 1 << 26
# The limits of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
WORD_GAP = "[ \\x09-\\x0D]+"
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def too_few_words(text: Column) -> Column:
    return F.size(words_of(text)) < LEAST_WORDS


def too_repetitive(text: Column) -> Column:
    words = words_of(text)
    return F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT


def too_loud(text: Column) -> Column:
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * MOST_CAPITALS


def holds_symbols(text: Column) -> Column:
    return text.rlike(SYMBOLS)


BY_TEXT: dict[str, Callable[[Column], Column]] = {
    "A": too_few_words,
    "B": too_repetitive,
    "C": too_loud,
    "D": holds_symbols,
}
COPIES = "E"


def judged(documents: DataFrame, filters: dict, doc_id: str, text: str, part: str) -> DataFrame:
    """(doc_id, part, digest, bits): the failures of the filters by text; one scan, settled."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bits = [F.when(fails(F.col("_text")), F.lit(1 << n)).otherwise(F.lit(0)) for n, fails in enumerate(filters.values())]
    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        whole.alias("_text"),
    )
    narrow = rows.select(
        "doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("digest"), reduce(Column.bitwiseOR, bits, F.lit(0)).alias("bits")
    )
    return settle(narrow, "judged-rows")


def copies(documents: DataFrame, keyed: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """(doc_id, part, digest) of rows whose text stands under a smaller id."""
    groups = (
        keyed.filter("doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))
        .filter("least < most")
        .select("digest", "least", F.ceil(F.col("n") / PIECE_ROWS).cast("int").alias("pieces"))
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        whole.alias("text"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
    ).filter("doc_id IS NOT NULL")
    groups = settle(groups, "copied-digests")
    key = F.xxhash64("digest")
    bits = documents.sparkSession.sparkContext.broadcast(bit_set(groups.select(key.alias("key")), DIGEST_BITS))

    @F.pandas_udf("boolean")
    def may_be_shared(keys: pd.Series) -> pd.Series:
        return pd.Series(holds(bits.value, keys.to_numpy()))

    shared = settle(rows.filter(may_be_shared(key)).join(groups, "digest"), "copied-texts")
    first = shared.groupBy("digest", "text").agg(F.min("doc_id").alias("first"), F.max("pieces").alias("pieces"))
    smaller = first.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    later = shared.filter("doc_id > least").withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int"))
    left, right = later.alias("l"), smaller.alias("r")
    same = ["digest", "piece", "text"]
    met = reduce(Column.__and__, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in same], F.col("r.first") < F.col("l.doc_id"))
    return left.join(right, met, "left_semi").select("doc_id", "part", "digest")


def combinations(
    documents: DataFrame,
    labels: DataFrame,
    filters: dict[str, Callable[[Column], Column]] = BY_TEXT,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """(part, bits, good, toxic, n): rows by the set of filters they fail and by their labels.

    Bit i is the i-th of ``filters``; the bit after them is the filter of copies.
    """
    keyed = judged(documents, filters, doc_id, text, part)
    failed = copies(documents, keyed, doc_id, text, part)
    both = keyed.withColumn("n", F.lit(1)).unionByName(
        failed.withColumns({"bits": F.lit(1 << len(filters)), "n": F.lit(0)})
    )
    rows = both.groupBy("doc_id", "digest", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    known = labels.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")
    ).filter("doc_id IS NOT NULL")
    known = settle(known.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")), "label-flags")
    marked = rows.select("doc_id", "part", "bits", "n").join(known, "doc_id", "left")
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")}
    return marked.withColumns(flags).groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """Every order and step of the filters, from the counts of ``combinations``.

    ``stays[m]`` is the number of rows that fail no filter of the set m, so the filter f after the set m
    removes ``stays[m] - stays[m + f]`` rows.
    """
    size, sets = len(letters), range(1 << len(letters))

    def staying(when: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.expr(f"CASE WHEN bits & {m} = 0 AND {when} THEN n END")), F.lit(0)) for m in sets])

    alone = F.array(*[F.coalesce(F.sum(F.expr(f"CASE WHEN bits = {1 << f} THEN n END")), F.lit(0)) for f in range(size)])
    parts = counts.groupBy("part").agg(
        staying("true").alias("stays"), staying("good").alias("good"), staying("toxic").alias("toxic"), alone.alias("alone")
    )
    removed_by = []
    for f in range(size):
        before = [m for m in sets if not m >> f & 1]
        # orders in which exactly the filters of the set m come before f
        orders = [factorial(m.bit_count()) * factorial(size - 1 - m.bit_count()) for m in before]
        terms = [F.lit(k) * (F.col("stays")[m] - F.col("stays")[m | 1 << f]) for m, k in zip(before, orders)]
        removed_by.append(reduce(Column.__add__, terms))
    parts = parts.withColumn("shapley", F.array(*removed_by))
    steps = []
    for order in permutations(range(size)):
        done = 0
        for n, f in enumerate(order):
            steps.append(("".join(letters[i] for i in order), n + 1, f, done, done | 1 << f))
            done |= 1 << f
    names = ["filter_order", "step", "f", "was", "then"]
    listed = F.from_json(F.lit(_json(names, steps)), "array<struct<filter_order:string,step:int,f:int,was:int,then:int>>")
    each = parts.select("*", F.explode(listed).alias("at"))
    was, then, f = F.col("at.was"), F.col("at.then"), F.col("at.f")

    def gone(name: str) -> Column:
        return F.get(name, was) - F.get(name, then)

    fails = F.get("stays", F.lit(0)) - F.get("stays", F.pow(F.lit(2), f).cast("int"))
    return each.select(
        "part",
        "at.filter_order",
        "at.step",
        F.get("stays", then).alias("kept"),
        gone("stays").alias("removed"),
        (fails - gone("stays")).alias("redundant"),
        F.get("alone", f).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.get("shapley", f).alias("shapley"),
    )


def _json(names: list[str], rows: list[tuple]) -> str:
    import json

    return json.dumps([dict(zip(names, row)) for row in rows])


@register(
    "op13_filter_audit",
    """
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
            list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D ]+'), lambda w: w <> '') AS w
        FROM documents
    ),
    firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
    rows_ AS (
        SELECT part, doc_id,
            (len(w) < 200)::INT
            + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
            + 8 * regexp_matches(t, '[#$%&*|]')::INT
            + 16 * coalesce(doc_id > first_id, false)::INT AS bits
        FROM texts JOIN firsts USING (t)
    ),
    known AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
    counts AS (
        SELECT part, bits, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
        FROM rows_ LEFT JOIN known USING (doc_id) GROUP BY ALL
    ),
    letters AS (SELECT unnest(range(0, 5)) AS i),
    orders AS (
        SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.i NOT IN (b.i, c.i, d.i, e.i) AND b.i NOT IN (c.i, d.i, e.i) AND c.i NOT IN (d.i, e.i) AND d.i <> e.i
    ),
    steps AS (
        SELECT substr('ABCDE', a + 1, 1) || substr('ABCDE', b + 1, 1) || substr('ABCDE', c + 1, 1)
                || substr('ABCDE', d + 1, 1) || substr('ABCDE', e + 1, 1) AS filter_order,
            s + 1 AS step, [a, b, c, d, e][s + 1] AS f,
            list_sum([0] || list_transform([a, b, c, d, e][1:s], lambda x: (1 << x))) AS was
        FROM orders, (SELECT unnest(range(0, 5)) AS s)
    ),
    made AS (
        SELECT part, filter_order, step, f,
            sum(n) FILTER (bits & (was::BIGINT | (1 << f)) = 0) AS kept,
            sum(n) FILTER (bits & was::BIGINT = 0 AND bits & (1 << f) > 0) AS removed,
            sum(n) FILTER (bits & was::BIGINT > 0 AND bits & (1 << f) > 0) AS redundant,
            sum(n) FILTER (bits = 1 << f) AS unique_fails,
            sum(n) FILTER (good AND bits & was::BIGINT = 0 AND bits & (1 << f) > 0) AS good_lost,
            sum(n) FILTER (toxic AND bits & was::BIGINT = 0 AND bits & (1 << f) > 0) AS toxic_lost
        FROM counts, steps GROUP BY ALL
    )
    SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
        coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
        coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
        coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
    FROM made
    """,
)
def op13_filter_audit(spark, sf_dir) -> DataFrame:
    counts = combinations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return interactions(counts, "".join(BY_TEXT) + COPIES)
