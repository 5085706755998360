"""A Merkle manifest of a table: a digest per row, a tree per group, a proof per row.

A leaf is the SHA-256 of a row's framed columns. The leaves of a group are ranked, and every node
of the group's tree is labelled with the interval of leaf ranks that it covers: nested intervals
are ancestors. Trees are built and read eight levels at a time (``LEVELS``):

* Going up, the ``2 ** 8`` entries of a block become the nodes of eight levels in one grouping, so
  a tree over n leaves takes log256(n) rounds, and no group is larger than a block.
* Siblings are the interval difference of a parent and its child, found in a grouping by parent.
* Going down, a containment join, bucketed by level, attaches to each entry its ancestors of
  these eight levels and with them their siblings. Only the few entries of the next eight levels
  carry on, so a leaf is joined to eight ancestors and once to every further eight levels' paths.

The roots of the groups' trees are the leaves of one more tree by the same code.

Defined cases: a null is framed as ``-``, unlike any value; leaves rank by id, null first, then by
digest, so repeated rows are neighbours and interchangeable, each with its own proof; a null group
is a group, the first; a lone leaf is its group's root, and a lone group's root the whole root; rows without id
are never tampered with; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.operators.strata import ranked_slices
from tessera.session import settle

FANOUT = 2
LEVELS = 8
# Fixed value: the columns of a leaf, in their order.
FRAMED = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left:binary,right:binary>>"


def framed(value: Column) -> Column:
    """Byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf(values: dict[str, Column]) -> Column:
    return digest(F.concat(*[framed(values[name]) for name in FRAMED]))


def width(level: Column | int) -> Column:
    """Leaves under a whole node of a level."""
    return F.pow(F.lit(float(FANOUT)), F.lit(level) if isinstance(level, int) else level).cast("bigint")


def ranked(leaves: DataFrame) -> DataFrame:
    """Leaves (tree, *order, digest) with ``lo`` = ``hi`` = their rank in the tree, and the tree's height."""
    order = [c for c in leaves.columns if c not in ("tree", "digest", "changed")] + ["digest"]
    placed, offsets = ranked_slices(leaves, ["tree"], order)
    offsets = settle(offsets, "tree-offsets")
    # FANOUT ** height is the least power that reaches the number of leaves
    powers = F.array(*[F.lit(FANOUT**h) for h in range(63) if FANOUT**h < 1 << 62])
    sizes = (
        placed.groupBy("tree")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("tree", F.size(F.filter(powers, lambda p: p < F.col("n"))).alias("height"))
    )
    whole = placed.join(offsets, ["tree", "_slice"]).join(settle(sizes, "tree-heights"), "tree")
    rank = F.col("_before") + F.col("_place") - 1
    return settle(whole.withColumn("lo", rank).withColumn("hi", rank).drop("_slice", "_place", "_before"), "ranked-leaves")


def parents_of(nodes: Column) -> Column:
    """The nodes above a run of sibling nodes in order, each over ``FANOUT`` of them, the last over what is left."""

    def over(i: Column) -> Column:
        run = F.slice(nodes, i * FANOUT + 1, FANOUT)
        joined = F.array_join(F.transform(run, lambda x: hexed(x["digest"])), "")
        return F.struct(
            run[0]["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"), digest(joined).alias("digest")
        )

    last = ((F.size(nodes) - 1) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), over)


def blocks_above(entries: DataFrame, base: int) -> DataFrame:
    """Blocks of entries of level ``base``: the nodes of ``LEVELS`` levels and what stands above them."""
    grouped = entries.withColumn("block", F.floor(F.col("lo") / width(base + LEVELS))).groupBy("tree", "height", "block")
    made = grouped.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("level_0"))
    for step in range(LEVELS):
        below = F.col(f"level_{step}")
        above = F.when(F.col("height") > base + step, parents_of(below)).otherwise(below)
        made = made.withColumn(f"level_{step + 1}", above)
    return settle(made, "tree-blocks")


def nodes_of(blocks: DataFrame, base: int) -> DataFrame:
    """(tree, level, lo, hi, digest) of the nodes that have a parent."""
    levels = F.array(*[F.struct(F.lit(base + s).alias("level"), F.col(f"level_{s}").alias("nodes")) for s in range(LEVELS)])
    held = blocks.select("tree", "height", F.explode(levels).alias("at")).filter("at.level < height")
    return held.select("tree", F.col("at.level").alias("level"), F.explode("at.nodes").alias("node")).select("tree", "level", "node.*")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with the digests left and right of them within their parent's interval."""

    def packed(kept: Column) -> Column:
        return F.unhex(F.array_join(F.transform(kept, lambda x: hexed(x["digest"])), ""))

    parent = F.floor(F.col("lo") / width(F.col("level") + 1))
    families = nodes.groupBy("tree", "level", parent.alias("parent")).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")
    )
    each = families.select("tree", "level", "children", F.explode("children").alias("node"))
    return each.select(
        "tree",
        "level",
        F.floor(F.col("node.lo") / width(F.col("level"))).alias("bucket"),
        F.col("node.lo").alias("from"),
        F.col("node.hi").alias("to"),
        packed(F.filter("children", lambda x: x["hi"] < F.col("node.lo"))).alias("left"),
        packed(F.filter("children", lambda x: x["lo"] > F.col("node.hi"))).alias("right"),
    )


def paths_within(entries: DataFrame, family: DataFrame, base: int) -> DataFrame:
    """(tree, lo, path): per entry the siblings of the nodes that contain it, from level ``base`` on."""
    top = F.least(F.col("height"), F.lit(base + LEVELS)) - 1
    asked = entries.filter(F.col("height") > base).select(
        "tree", "lo", "hi", F.explode(F.sequence(F.lit(base), top)).alias("level")
    )
    asked = asked.withColumn("bucket", F.floor(F.col("lo") / width(F.col("level"))))
    inside = (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
    met = asked.join(family, ["tree", "level", "bucket"]).filter(inside)
    held = met.groupBy("tree", "lo").agg(F.array_sort(F.collect_list(F.struct("level", "left", "right"))).alias("steps"))
    return held.select("tree", "lo", F.transform("steps", lambda s: F.struct(s["left"], s["right"])).alias("path"))


def proofs(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranked leaves with ``path``, the siblings from leaf to root; and (tree, root)."""
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    entries = leaves.select("tree", "height", "lo", "hi", "digest")
    roots = entries.filter("height = 0").select("tree", F.col("digest").alias("root"))
    paths = []
    for base in range(0, tallest, LEVELS):
        blocks = blocks_above(entries, base)
        paths.append(paths_within(entries, with_siblings(nodes_of(blocks, base)), base))
        tops = blocks.select("tree", "height", F.explode(f"level_{LEVELS}").alias("node")).select("tree", "height", "node.*")
        done = F.col("height").between(base + 1, base + LEVELS)
        roots = roots.unionByName(tops.filter(done).select("tree", F.col("digest").alias("root")))
        entries = tops.filter(F.col("height") > base + LEVELS)
    whole = leaves.withColumn("path", F.array().cast(PATH))
    for n, path in enumerate(paths):
        far = settle(path, "tree-paths").select("tree", F.col("lo").alias("_from"), F.col("path").alias("_path"))
        start = (F.floor(F.col("lo") / width(n * LEVELS)) * width(n * LEVELS)).alias("_from")
        keyed = whole.withColumn("_from", start)
        whole = keyed.join(far, ["tree", "_from"], "left").withColumn(
            "path", F.concat("path", F.coalesce("_path", F.array().cast(PATH)))
        )
        whole = whole.drop("_path", "_from")
    return whole, settle(roots, "tree-roots")


def manifest(documents: DataFrame, group: str = "lang", tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, changed, subroot, root and path of every row.

    ``tampered`` marks rows whose ``changed`` is the leaf with one more character counted; it is
    the leaf elsewhere. ``path`` holds the siblings, level by level, from the leaf to the whole root.
    """
    values = {name: F.col(name) for name in FRAMED}
    more = values | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    made = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        # null first, then the names by their bytes
        F.coalesce(F.concat(F.lit("+"), F.col(group)), F.lit("!")).alias("tree"),
        leaf(values).alias("digest"),
        F.when(hit, leaf(more)).alias("changed"),
    )
    leaves, subroots = proofs(ranked(settle(made, "leaves")))
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    joined, root = proofs(ranked(tops))
    above = joined.join(root, "tree").select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("_above")
    )
    whole = leaves.join(settle(above, "subroots"), "tree")
    return whole.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        F.coalesce("changed", "digest").alias("changed"),
        "subroot",
        "root",
        F.concat("path", "_above").alias("path"),
    )


def proof_text(path: Column) -> Column:
    """All siblings of a path as hex text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), "")


def folded(start: Column, path: Column) -> Column:
    """Root that a leaf and the siblings of its path lead to, as hex text."""
    return F.aggregate(
        path, hexed(start), lambda held, s: F.sha2(F.concat(hexed(s["left"]), held, hexed(s["right"])), 256)
    )


def one_in_seven(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0


@register(
    "op11_merkle_manifest",
    """
    WITH RECURSIVE framed AS (
        SELECT doc_id, coalesce('+' || lang, '!') AS tree, n_chars,
            CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
            || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
            || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
            CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
            list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda held, b: list_reduce(
                    list_prepend(xor(held, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda x, step: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
                )
            ) AS turned
        FROM documents
    ),
    leaves AS (
        SELECT doc_id, tree,
            sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
            sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1) END || tail) AS other,
            coalesce(xor(turned, 4294967295) % 7 = 0, false) AS hit
        FROM framed
    ),
    places AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves
    ),
    levels AS (
        SELECT tree, 0 AS level, list(leaf ORDER BY r) AS nodes FROM places GROUP BY tree
        UNION ALL
        SELECT tree, level + 1,
            list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
        FROM levels WHERE len(nodes) > 1
    ),
    subroots AS (
        SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS r FROM levels WHERE len(nodes) = 1
    ),
    tops AS (
        SELECT 0 AS level, list(subroot ORDER BY r) AS nodes FROM subroots
        UNION ALL
        SELECT level + 1,
            list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
        FROM tops WHERE len(nodes) > 1
    ),
    flat AS (
        SELECT tree, level, unnest(nodes) AS digest, generate_subscripts(nodes, 1) - 1 AS i FROM levels WHERE len(nodes) > 1
    ),
    flat_tops AS (
        SELECT level, unnest(nodes) AS digest, generate_subscripts(nodes, 1) - 1 AS i FROM tops WHERE len(nodes) > 1
    ),
    low AS (
        SELECT p.tree, p.r, list(CASE WHEN (p.r >> m.level) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(f.digest, '') ORDER BY m.level) AS steps
        FROM places p JOIN (SELECT DISTINCT tree, level FROM flat) m ON m.tree = p.tree
        LEFT JOIN flat f ON f.tree = p.tree AND f.level = m.level AND f.i = xor(p.r >> m.level, 1)
        GROUP BY ALL
    ),
    high AS (
        SELECT s.tree, list(CASE WHEN (s.r >> m.level) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(f.digest, '') ORDER BY m.level) AS steps
        FROM subroots s CROSS JOIN (SELECT DISTINCT level FROM flat_tops) m
        LEFT JOIN flat_tops f ON f.level = m.level AND f.i = xor(s.r >> m.level, 1)
        GROUP BY ALL
    ),
    done AS (
        SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
            CASE WHEN p.hit THEN p.other ELSE p.leaf END AS start,
            list_concat(coalesce(low.steps, []::VARCHAR[]), coalesce(high.steps, []::VARCHAR[])) AS steps
        FROM places p JOIN subroots s USING (tree)
        LEFT JOIN low ON low.tree = p.tree AND low.r = p.r
        LEFT JOIN high ON high.tree = p.tree
    ),
    folds AS (
        SELECT *, list_reduce(
            list_prepend(start, steps),
            lambda a, s: CASE WHEN s[1] = 'L' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END
        ) AS folded_root
        FROM done
    )
    SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
        folded_root, folded_root = root AS verified
    FROM folds
    """,
)
def op11_merkle_manifest(spark, sf_dir) -> DataFrame:
    made = manifest(table(spark, sf_dir, "documents"), tampered=one_in_seven(F.col("doc_id")))
    shown = made.select(
        "doc_id",
        hexed(F.col("leaf")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        folded(F.col("changed"), F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
