"""URL rules by host suffix and path prefix, in DataFrame functions only.

Each distinct URL is expanded into its host suffixes times those path prefixes whose lengths occur
among the rules. Expressions meet the rules in an equi-join on the first bytes of their
digest; full digests confirm, and of the rules that fit, the longest wins. Verdicts are per
distinct URL, so a URL on a third of all rows is judged once; they return to the rows by a
join that adaptive execution can split.

Defined cases: a null URL, or one without ``://``, has an empty host and path and no rule; ports
and user names stay part of the host; empty labels are kept; a rule given twice counts once,
and where verdicts differ "block" wins; of two rules equally long the one with the longer host
wins; no rule gives the default verdict; repeated rows stay; an empty table or an empty rule list
gives an empty result or default verdicts; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.registry import register, table
from tessera.session import settle

HASH_CHARS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.expr("substring(url, {0} + 3)".format("locate('://', url)"))).otherwise("")


def expression_digest(host: Column, path: Column) -> Column:
    """Digest of host and path; the length of the host keeps the two apart."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digest and rank; one row per host and path."""
    named = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
    named = named.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    digest = expression_digest(F.col("host"), F.col("path"))
    return named.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.length("host").alias("host_chars"),
        F.length("path").alias("path_chars"),
        F.substring(digest, 1, HASH_CHARS).alias("short"),
        digest.alias("digest"),
    )


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """(url, short, full): host suffixes times path prefixes of the given lengths."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    with_host = urls.select("url", "path", F.explode(suffixes).alias("suffix"))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    each = with_host.select("url", "suffix", "path", F.explode(fitting).alias("n"))
    digest = expression_digest(F.col("suffix"), F.expr("substring(path, 1, n)"))
    return each.select("url", digest.alias("full")).select(
        "url", F.substring("full", 1, HASH_CHARS).alias("short"), F.col("full")
    )


def url_verdicts(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every row of ``urls`` with host, path, rule (null: none) and verdict.

    ``rules`` has host, path and verdict ("allow" or "block"). It is written once, so the join
    with it is planned by its real size.
    """
    known = settle(prepared_rules(rules), "url_rules")
    # one row of a few numbers: no more than the longest path of a rule has characters
    lengths = known.agg(F.array_sort(F.collect_set("path_chars")).alias("n")).first()["n"]
    distinct = (
        urls.select("url").distinct().withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    )
    asked = expressions(distinct.filter(F.col("host") != ""), lengths)
    hits = asked.join(known, "short").filter(F.col("full") == F.col("digest"))
    rank = F.struct((F.col("host_chars") + F.col("path_chars")).alias("chars"), "host_chars", "rule", "verdict")
    best = settle(hits.groupBy("url").agg(F.max(rank).alias("best")).select("url", "best.rule", "best.verdict"), "verdicts")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    judged = urls.drop("host", "path", "rule", "verdict").join(best, "url", "left")
    return judged.withColumns({"host": host, "path": path, "verdict": F.coalesce("verdict", F.lit(default))})


# Rules of the registered query as (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

HOST_SQL = r"translate(regexp_extract(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PATH_SQL = r"regexp_extract(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '(?s)^[^/?#]*([^?#]*)', 1)"


@register(
    "op4_url_filter",
    f"""
    WITH rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
        ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    p AS (SELECT page_id, coalesce({HOST_SQL}, '') AS host, coalesce({PATH_SQL}, '') AS path FROM pages),
    m AS (SELECT p.*, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST) AS k
        FROM p LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM m WHERE k = 1
    """,
)
def op4_url_filter(spark, sf_dir) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")
