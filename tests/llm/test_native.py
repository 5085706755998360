"""Exact dedup, URL rules and mixing against brute force and SQL."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import exact_dedup, exact_groups, frequent, digests
from tessera.llm.mixing import LEVELS, leaf_budgets, mix, selection, with_copies, order_key
from tessera.llm.url_filter import url_verdicts
from tessera.session import settle

from .conftest import frame


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))


@pytest.mark.parametrize("support", [0.001, 0.05, 0.5])
def test_exact_groups(spark, corpus, support):
    rows = [*corpus, *[(1000 + i, "hot text") for i in range(40)]]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    expected = {
        (d, max(groups[t or ""]), len(groups[t or ""]), d == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
        for d, t in rows
    }
    got = exact_groups(frame(spark, rows), support=support).withColumn("sha", F.lower(F.hex("digest"))).drop("digest")
    assert {tuple(r) for r in got.collect()} == expected


def test_frequent_digests_are_bounded_and_complete(spark):
    rows = [(i, f"t{i}") for i in range(300)] + [(1000 + i, "hot") for i in range(60)]
    found = frequent(settle(digests(frame(spark, rows)), "t"), 0.1).collect()
    assert [(r.keep_id, r.group_size) for r in found] == [(1059, 60)]


def test_exact_dedup_edges(spark):
    assert exact_groups(frame(spark, [])).count() == 0
    df = frame(spark, [(1, "a"), (1, "a"), (None, "a"), (2, None), (3, "")]).withColumn("digest", F.lit(1)).withColumn("kept", F.lit(2))
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in exact_groups(df).collect())
    assert got == [(0, 1, 3), (1, 1, 3), (1, 1, 3), (2, 3, 2), (3, 3, 2)]
    assert sorted(r.doc_id for r in exact_dedup(df).collect()) == [1, 1, 3]


RULES = [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("a.com", "/", "block")]


def judged(url):
    import re

    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in ((h.lower(), p, v) for h, p, v in RULES) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


URLS = [
    "http://x.Example.org/es/1", "http://example.org/en/12?q", "http://example.org/en/2", "http://notexample.org/es/", "https://b.a.com/fr/x",
    "http://a.com", "http://.com/fr/", "http://com/fr/?x", None, "", "no scheme/org/", "a://b://c.org/x", "http://EXAMPLE.ORG/ES/", "http://u@x.org:80/",
    "http://x.org?y=/es/", "http://É.org/", "http://line\nbreak.org/a\nb#c", "http://x.org/" + "p" * 5000,
]


def test_url_verdicts(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 3)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("host", F.lit("x"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(df, rules).collect()}
    assert got == {i: judged(u) for i, u in rows}


def test_url_edges(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_verdicts(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    df = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert url_verdicts(df, rules.limit(0), "block").first().verdict == "block"
    twice = spark.createDataFrame([("org", "/", "allow"), ("org", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
    assert url_verdicts(df, twice).first().verdict == "block"


def test_native_plans_hold_no_python(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    for df in (exact_groups(documents), mix(documents, F.lit("d"), weights(spark, []), 0.5)):
        assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df) and "Cartesian" not in plan_of(df)


def weights(spark, rows):
    return spark.createDataFrame(rows, "domain string, lang string, source string, weight bigint")


def budgets(spark, leaves, weight_rows, share, epochs=2):
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, available bigint")
    return {tuple(r)[:3]: r.allotted for r in leaf_budgets(df, weights(spark, weight_rows), share, epochs).collect()}


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", "1", 100), ("a", "x", "2", 1000), ("a", "y", "1", 1000), ("b", "x", "1", 2000)]
    got = budgets(spark, leaves, [("a", None, None, 1), ("b", None, None, 1)], 0.5, 1)
    # 2050 over a and b evenly; within a.x the first leaf is short and its sibling takes the rest
    assert got == {("a", "x", "1"): 100, ("a", "x", "2"): 412, ("a", "y", "1"): 512, ("b", "x", "1"): 1025}
    got = budgets(spark, leaves, [("a", None, None, 1), ("b", None, None, 9)], 0.9, 1)
    # b cannot take its nine tenths, so the shortage reaches a
    assert got[("b", "x", "1")] == 2000 and sum(got.values()) in range(3680, 3691)


def test_budget_edges(spark):
    leaves = [("a", "x", "1", 0), ("a", "x", "2", 10), ("c", "x", "1", 50)]
    got = budgets(spark, leaves, [("c", None, None, 0)], 1.0, 2)
    assert got == {("a", "x", "1"): 0, ("a", "x", "2"): 20, ("c", "x", "1"): 0}
    assert budgets(spark, [], [], 1.0) == {}


def test_mix_takes_a_prefix_of_every_leaf(spark, corpus):
    rows = [(d, t, "en" if d % 3 else None, f"src{d % 2}") for d, t in corpus if t is None or len(t) < 50_000]
    rows += [(rows[0][0], *rows[0][1:])]
    df = frame(spark, rows)
    got, cuts = selection(df, F.lit("d"), weights(spark, []), 0.55, 2)
    chosen = with_copies(got, cuts, 17)
    plan = {tuple(r)[:3]: r for r in leaf_budgets(got.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available")), weights(spark, []), 0.55, 2).collect()}
    by_leaf = defaultdict(list)
    for r in chosen.withColumn("key0", order_key(F.lit(0), F.col("doc_id"), 17)).withColumn("key1", order_key(F.lit(1), F.col("doc_id"), 17)).collect():
        by_leaf[(r.domain, r.lang, r.source)].append(r)
    for leaf, members in by_leaf.items():
        epochs, rest = divmod(plan[leaf].allotted, plan[leaf].available)
        key = "key0" if epochs == 0 else "key1"
        members.sort(key=lambda r: r[key])
        total, expected = 0, {}
        for name in dict.fromkeys(r[key] for r in members):
            total += sum(r.n_tokens for r in members if r[key] == name)
            expected[name] = epochs + (rest > 0 and total <= rest)
        assert {r[key]: r.copies for r in members} == expected
    repeated = mix(df, F.lit("d"), weights(spark, []), 0.55)
    assert repeated.columns == df.columns
    assert repeated.count() == sum(r.copies for r in chosen.collect())


def test_mix_of_nothing(spark):
    assert mix(frame(spark, []), F.lit("d"), weights(spark, []), 0.5).count() == 0
    assert mix(frame(spark, [(None, None, None, None)]), F.lit("d"), weights(spark, []), 0.5).count() == 0


def test_mix_keeps_columns_of_any_name(spark):
    rows = [(i, "one two three", "en", f"src{i % 3}") for i in range(30)]
    names = ["copies", "_lang", "_epochs", "epoch", "row", "domain", "_cut", "a.b", "key"]
    df = frame(spark, rows)
    wide = df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    got = mix(wide, F.lit("d"), weights(spark, []), 0.55)
    assert got.columns == wide.columns
    held = got.collect()
    assert sorted(r.doc_id for r in held) == sorted(r.doc_id for r in mix(df, F.lit("d"), weights(spark, []), 0.55).collect())
    assert held and all(r[n] == f"own {n}" for r in held for n in names)


def test_exact_dedup_of_rows_without_id(spark):
    rows = [(None, "alone"), (None, "shared"), (4, "shared"), (1, "a"), (5, "a"), (1, "b"), (None, None), (None, "")]
    df = frame(spark, rows)
    got = {(r.doc_id, r.digest.hex()[:4], r.keep_id, r.group_size, r.kept) for r in exact_groups(df).collect()}
    name = {t: hashlib.sha256((t or "").encode()).hexdigest()[:4] for _, t in rows}
    assert got == {
        (None, name["alone"], None, 1, True), (None, name["shared"], 4, 2, False), (4, name["shared"], 4, 2, True),
        (1, name["a"], 5, 2, False), (5, name["a"], 5, 2, True), (1, name["b"], 1, 1, True), (None, name[""], None, 2, True),
    }
    left = sorted((str(r.doc_id), r.text or "") for r in exact_dedup(df).collect())
    assert left == [("1", "b"), ("4", "shared"), ("5", "a"), ("None", ""), ("None", ""), ("None", "alone")]
