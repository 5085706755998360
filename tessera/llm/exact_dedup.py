"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

A Misra-Gries pass over digests names at most ``1 / support`` candidates, a superset of all
digests above that share of rows. Their exact counts and winners are computed with map-side
combine, and those that are truly frequent form a table of at most ``1 / support`` rows, which
is broadcast: copies of frequent texts meet their winner where they are read. The other digests
are below the share, so an ordinary shuffle spreads them.

Defined cases: null text is the empty text; equal texts tie to the largest id; repeated
rows (same id and text) count as copies, and all of them keep that id; a row without id gives way to any
row with the same text and an id, and rows without id stay where none has one; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.session import settle

SUPPORT = 0.001


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the whole text in UTF-8."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(whole, 256)).alias("digest"))


def frequent(keyed: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, keep_id, group_size) of digests on more than ``support`` of all rows.

    At most ``1 / support`` rows, whatever the input: the candidates are a Misra-Gries summary
    (``freqItems``), and only those whose exact count passes the share are kept.
    """
    named = keyed.select(F.hex("digest").alias("digest")).freqItems(["digest"], support)
    candidates = named.select(F.explode("digest_freqItems").alias("name")).select(F.unhex("name").alias("digest"))
    counted = (
        keyed.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return counted.filter(F.col("group_size") > support * keyed.count())


def exact_groups(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", support: float = SUPPORT
) -> DataFrame:
    """Every row with its group: doc_id, digest, keep_id, group_size, kept."""
    keyed = settle(digests(documents, doc_id, text), "digests")
    winners = settle(frequent(keyed, support), "frequent_digests")
    hot = keyed.join(F.broadcast(winners), "digest")
    rest = keyed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = settle(
        rest.groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > 1),
        "digest_groups",
    )
    cold = rest.join(groups, "digest", "left").withColumns(
        {
            "keep_id": F.coalesce("keep_id", "doc_id"),
            "group_size": F.coalesce("group_size", F.lit(1).cast("bigint")),
        }
    )
    shown = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"]
    return hot.select(*shown).unionByName(cold.select(*shown))


def exact_dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` whose text is the kept one of its group."""
    kept = exact_groups(documents, doc_id, text).filter("kept").select("doc_id", "digest").distinct().alias("kept")
    own = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    same = F.col(f"rows.{doc_id}").eqNullSafe(F.col("kept.doc_id")) & (F.col("_own_digest") == F.col("kept.digest"))
    return documents.withColumn("_own_digest", own).alias("rows").join(kept, same, "left_semi").drop("_own_digest")


@register(
    "op9_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
)
def op9_exact_dedup(spark, sf_dir) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
