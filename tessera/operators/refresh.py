"""Keeping a stored vector index in step with its texts.

Only what changed is touched. Rows are compared by digests: an id whose row digest is stored stays as it is; of
the others, texts whose digest is stored under any id take that vector, and only texts that no stored
row holds meet the encoder, each different one once. Ids that are no longer there leave. All of it
becomes one delta of the store, so readers see the old index until the new one is complete.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.keep import keep_one
from tessera.operators.search import Encoder, embed
from tessera.session import settle
from tessera.sources.index_store import IndexStore

STAMPS = ("text_digest", "row_digest")


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: rows written or changed, different texts encoded, ids removed."""

    changed: int
    encoded: int
    removed: int


def stamped(documents: DataFrame, text: str = "document") -> DataFrame:
    """Rows with the digest of their text and of the whole row."""
    whole = F.to_json(F.struct(*[c for c in documents.columns if c != text]), {"ignoreNullFields": "false"})
    body = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    absent = F.when(F.col(text).isNull(), F.lit("-")).otherwise(F.lit("+"))
    return documents.withColumns({"text_digest": body, "row_digest": F.sha2(F.concat(absent, body, whole), 256)})


def refresh_index(
    store: IndexStore, documents: DataFrame, load_encoder: Callable[[], Encoder], text: str = "document"
) -> Refreshed:
    """Bring the index to exactly ``documents`` (one row per id stays, as ``keep_one`` chooses)."""
    key = store.key
    now = stamped(keep_one(documents, [key]), text)
    held = store.read()
    if held is None:
        held = store.spark.createDataFrame([], embed(now, text, load_encoder).schema)
        store.replace(held)
    keys = settle(now.select(key, *STAMPS), "index-keys")
    known = held.select(key, *STAMPS)
    changed = settle(keys.join(known, [key, "row_digest"], "left_anti").select(key, "text_digest"), "index-changed")
    gone = settle(known.select(key).join(keys.select(key), key, "left_anti"), "index-gone")
    rows = settle(now.join(changed.select(key), key, "left_semi"), "index-rows")
    wanted = rows.select("text_digest", text).groupBy("text_digest").agg(F.min(text).alias(text))
    unknown = wanted.join(known.select("text_digest"), "text_digest", "left_anti")
    encoded = settle(embed(unknown, text, load_encoder).select("text_digest", "embedding"), "index-encoded")
    taken = held.join(changed.select("text_digest"), "text_digest", "left_semi").groupBy("text_digest")
    reused = taken.agg(F.any_value("embedding").alias("embedding"))
    vectors = settle(encoded.unionByName(reused), "index-vectors")
    made = rows.join(vectors, "text_digest").select(*held.columns)
    done = Refreshed(changed.count(), encoded.count(), gone.count())
    if done.changed or done.removed:
        store.apply(made, gone)
    return done
