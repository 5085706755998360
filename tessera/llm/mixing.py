"""Mixing to target weights by hierarchical budgets, in DataFrame functions only.

Leaves (domain, language, source) hold tokens; a leaf can give its tokens ``max_epochs`` times. The
budget flows from the root down. At each node it is shared among the children by weight, no child
above what its subtree can give; what one cannot take goes to its siblings. A parent is
never given more than its subtree can give, so a shortage reaches the ancestors only
when all siblings are full.

A leaf's allotment is whole epochs plus a prefix of one more, in an order seeded by epoch and
document. The prefix is found without ordering a leaf in one task: tokens are summed per leaf and
hash bucket with map-side combine, running sums over at most 4,096 buckets find the one in which the
prefix ends, and only that bucket's documents are ordered. Documents then compare their own key with
the leaf's cut, so no text is shuffled.

Defined cases: null text has no tokens; null domain, language or source is "unknown"; rows with
the same id share one key and are taken together; a document that would pass the allotment ends the
prefix; weight 0 or a leaf without tokens gets nothing; a missing weight is 1; an empty table gives
an empty result; extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.session import settle

LEVELS = ("domain", "lang", "source")
SEED = 17
BUCKET_CHARS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def tree_columns(domain: Column) -> list[Column]:
    """domain, lang and source of a document, never null."""
    named = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    return [F.coalesce(c.cast("string"), F.lit("unknown")).alias(k) for k, c in named.items()]


def with_weight(nodes: DataFrame, weights: DataFrame, depth: int) -> DataFrame:
    """``weight`` of nodes at one depth; ``weights`` leaves the deeper levels null."""
    keys = LEVELS[:depth]
    own = weights.filter(F.col(keys[-1]).isNotNull())
    for deeper in LEVELS[depth:]:
        own = own.filter(F.col(deeper).isNull())
    own = own.groupBy(*keys).agg(F.max("weight").alias("weight"))
    return nodes.join(own, list(keys), "left").withColumn("weight", F.coalesce("weight", F.lit(1)).cast("bigint"))


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``allotted`` tokens of every child of ``parent``: its weight's share up to its capacity.

    With children ordered by capacity per weight, filling level j is what is left when all
    before j are full, spread over the weights from j on; the true level is the highest of them.
    """
    ratio = F.col("capacity") / F.nullif(F.col("weight"), F.lit(0))
    order = Window.partitionBy(*parent).orderBy(ratio.asc_nulls_last(), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    level = left.cast("double") / F.nullif(F.sum("weight").over(onward), F.lit(0))
    levels = nodes.withColumn("_level", level)
    share = F.floor(F.least(F.col("capacity").cast("double"), F.col("weight") * F.max("_level").over(Window.partitionBy(*parent))))
    return levels.withColumn("allotted", F.coalesce(F.greatest(share, F.lit(0)), F.lit(0)).cast("bigint")).drop("_level")


def leaf_budgets(leaves: DataFrame, weights: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Allotted tokens of every leaf (domain, lang, source, available)."""
    depths = {}
    below = with_weight(leaves.withColumn("capacity", F.col("available") * max_epochs), weights, 3)
    for depth in (3, 2, 1):
        usable = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)
        depths[depth] = below.withColumn("capacity", usable.cast("bigint"))
        if depth > 1:
            above = depths[depth].groupBy(*LEVELS[: depth - 1]).agg(F.sum("capacity").alias("capacity"))
            below = with_weight(above, weights, depth - 1)
    total = leaves.agg(F.floor(F.sum("available") * F.lit(share)).cast("bigint").alias("budget")).first()["budget"] or 0
    given = share_out(depths[1].withColumns({"budget": F.lit(total), "_root": F.lit(0)}), ["_root"], "domain").drop("_root")
    for depth in (2, 3):
        parent = list(LEVELS[: depth - 1])
        budgets = given.select(*parent, F.col("allotted").alias("budget"))
        given = share_out(depths[depth].join(budgets, parent), parent, LEVELS[depth - 1])
    return given.select(*LEVELS, "available", "allotted")


def order_key(epoch: Column, doc_id: Column, seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.md5(text)


def selection(
    documents: DataFrame,
    domain: Column,
    weights: DataFrame,
    share: float,
    max_epochs: int = 2,
    seed: int = SEED,
    doc_id: str = "doc_id",
) -> tuple[DataFrame, DataFrame]:
    """(narrow rows, leaf cuts): every document's leaf and tokens, and where each leaf's prefix ends."""
    rows = settle(
        documents.select(F.col(doc_id).alias("doc_id"), *tree_columns(domain), word_count(F.col("text")).alias("n_tokens")),
        "mix_rows",
    )
    leaves = settle(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available")), "mix_leaves")
    budget = leaf_budgets(leaves, weights, share, max_epochs)
    epochs = F.when(F.col("available") > 0, F.expr("allotted div available")).otherwise(0)
    plan = settle(
        budget.withColumn("epochs", epochs.cast("bigint")).withColumn(
            "rest", F.col("allotted") - F.col("epochs") * F.col("available")
        ),
        "mix_budgets",
    )
    keyed = rows.join(plan.filter("rest > 0"), list(LEVELS)).withColumn("key", order_key(F.col("epochs"), F.col("doc_id"), seed))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_CHARS))
    sums = keyed.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("held"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("upto", F.sum("held").over(running)).filter("upto > rest AND upto - held <= rest")
    edge = settle(
        ends.groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("held")).alias("before"))).alias("e"))
        .select(*LEVELS, F.col("e.bucket").alias("edge"), F.col("e.before").alias("before")),
        "mix_edges",
    )
    inside = keyed.join(edge, list(LEVELS)).filter(F.col("bucket") == F.col("edge"))
    peers = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    taken = inside.withColumn("upto", F.col("before") + F.sum("n_tokens").over(peers)).filter("upto <= rest")
    last = taken.groupBy(*LEVELS).agg(F.max("key").alias("last"))
    cuts = (
        plan.join(edge, list(LEVELS), "left")
        .join(last, list(LEVELS), "left")
        .select(*LEVELS, "epochs", F.coalesce("last", "edge").alias("cut"))
    )
    return rows, settle(cuts, "mix_cuts")


def with_copies(rows: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """``copies`` of each row (doc_id, domain, lang, source, ...): whole epochs, and one more up to the leaf's cut."""
    own = cuts.select(*LEVELS, F.col("epochs").alias("_epochs"), F.col("cut").alias("_cut"))
    joined = rows.join(own, list(LEVELS), "left")
    # without a bucket in which it ends, the prefix is empty; a cut that is a bucket's name precedes its keys
    extra = F.coalesce(order_key(F.col("_epochs"), F.col("doc_id"), seed) <= F.col("_cut"), F.lit(False)).cast("bigint")
    return joined.withColumn("copies", F.coalesce(F.col("_epochs") + extra, F.lit(0)).cast("bigint")).drop("_epochs", "_cut")


def mix(
    documents: DataFrame,
    domain: Column,
    weights: DataFrame,
    share: float,
    max_epochs: int = 2,
    seed: int = SEED,
    doc_id: str = "doc_id",
) -> DataFrame:
    """``documents``, each row as many times as its leaf's epochs take it."""
    _, cuts = selection(documents, domain, weights, share, max_epochs, seed, doc_id)
    # the row travels as one value, so that no column of it can clash with those made here
    row = F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row")
    rows = with_copies(documents.select(row, F.col(doc_id).alias("doc_id"), *tree_columns(domain)), cuts, seed)
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return rows.filter("copies > 0").select("row", times.alias("epoch")).select("row.*")


# Fixed values of the registered query: weights by tree node, the share of all tokens, epochs.
WEIGHTS = [
    ("domain0", None, None, 4),
    ("domain1", None, None, 3),
    ("domain2", None, None, 2),
    ("domain3", None, None, 1),
    *[(f"domain{d}", lang, None, w) for d in range(4) for lang, w in (("en", 5), ("de", 3), ("fr", 3), ("es", 2))],
    ("domain0", "en", "src0", 2),
]
SHARE, MAX_EPOCHS = 0.6, 2


def source_domain() -> Column:
    """Sources in fives: src0 to src4 are domain0, and so on."""
    number = F.regexp_extract("source", r"^src(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.expr("cast(try_cast(regexp_extract(source, '^src([0-9]+)$', 1) AS int) div 5 AS string)")))


def weight_table(spark) -> DataFrame:
    return spark.createDataFrame(WEIGHTS, "domain string, lang string, source string, weight bigint")


def _fill_sql(nodes: str, parent: str, name: str) -> str:
    return f"""(SELECT *, CAST(greatest(floor(least(CAST(capacity AS DOUBLE), weight * max(level) OVER (PARTITION BY {parent}))), 0) AS BIGINT) AS allotted
        FROM (SELECT *, CAST(budget - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY ratio NULLS LAST, {name}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
          / CAST(sum(weight) OVER (PARTITION BY {parent} ORDER BY ratio NULLS LAST, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
        FROM (SELECT *, CAST(capacity AS DOUBLE) / weight AS ratio FROM {nodes})))"""


@register(
    "op8_mixing",
    f"""
    WITH r AS (SELECT doc_id, 'domain' || CAST(CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INT) // 5 AS VARCHAR) AS domain, lang, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
    l3 AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS available, CAST(sum(n_tokens) * {MAX_EPOCHS} AS BIGINT) AS capacity,
        CASE WHEN domain = 'domain0' AND lang = 'en' AND source = 'src0' THEN 2 ELSE 1 END AS weight FROM r GROUP BY ALL),
    l2 AS (SELECT domain, lang, CAST(sum(capacity) AS BIGINT) AS capacity, CASE lang WHEN 'en' THEN 5 WHEN 'es' THEN 2 ELSE 3 END AS weight FROM l3 GROUP BY ALL),
    l1 AS (SELECT domain, CAST(sum(capacity) AS BIGINT) AS capacity, CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS weight FROM l2 GROUP BY ALL),
    b1 AS (SELECT *, (SELECT CAST(floor(CAST(sum(available) AS DOUBLE) * {SHARE}) AS BIGINT) FROM l3) AS budget, 0 AS root FROM l1),
    g1 AS {_fill_sql('b1', 'root', 'domain')},
    b2 AS (SELECT l2.*, g1.allotted AS budget FROM l2 JOIN g1 USING (domain)),
    g2 AS {_fill_sql('b2', 'domain', 'lang')},
    b3 AS (SELECT l3.*, g2.allotted AS budget FROM l3 JOIN g2 USING (domain, lang)),
    g3 AS {_fill_sql('b3', 'domain, lang', 'source')},
    p AS (SELECT *, CASE WHEN available > 0 THEN allotted // available ELSE 0 END AS epochs FROM g3),
    k AS (SELECT r.*, epochs, allotted - epochs * available AS rest, md5('{SEED}:' || epochs || ':' || doc_id) AS key FROM r JOIN p USING (domain, lang, source)),
    c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k)
    SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM c
    """,
)
def op8_mixing(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rows, cuts = selection(documents, source_domain(), weight_table(spark), SHARE, MAX_EPOCHS)
    return with_copies(rows, cuts, SEED).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "copies"
    )
