"""What the SQL guard lets through and what it refuses."""

from __future__ import annotations

import pytest

from tessera.plans.guard import Refused, guarded

TABLES = ["facts", "places"]


@pytest.fixture(scope="module")
def views(spark):
    spark.range(20).selectExpr("id", "id % 3 AS k", "array(1, 2) AS a").createOrReplaceTempView("facts")
    spark.range(3).selectExpr("id AS k", "cast(id AS string) AS name").createOrReplaceTempView("places")
    spark.range(3).createOrReplaceTempView("secret")
    spark.udf.register("of_a_user", lambda x: x)
    spark.sql("CREATE TABLE IF NOT EXISTS guarded_catalog_table USING parquet AS SELECT 1 AS a")
    yield spark
    spark.sql("DROP TABLE guarded_catalog_table")
    for name in ("facts", "places", "secret"):
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize(
    "text, n",
    [
        ("SELECT * FROM facts", 20),
        ("  select * from FACTS ;  ", 20),
        ("SELECT k, count(*) AS n FROM facts WHERE id IN (SELECT id FROM facts WHERE id > 1) GROUP BY k HAVING count(*) > 1 ORDER BY n LIMIT 2", 2),
        ("WITH a AS (SELECT * FROM facts), b AS (SELECT * FROM a) SELECT b.id, row_number() OVER (PARTITION BY b.k ORDER BY b.id) AS r FROM a JOIN b USING (id)", 20),
        ("SELECT f.id, x FROM facts f LATERAL VIEW explode(a) t AS x", 40),
        ("SELECT * FROM (VALUES (1, 2), (3, 4)) t(a, b)", 2),
        ("SELECT transform(a, y -> y + 1) FROM facts", 20),
        ("SELECT date_trunc('MONTH', DATE '2020-01-05'), extract(year FROM DATE '2020-01-01'), substring('abc' FROM 2), CAST('1' AS INT)", 1),
        ("SELECT k, percentile_approx(id, 0.5), count(DISTINCT id) FILTER (WHERE id > 1) FROM facts GROUP BY ROLLUP (k)", 4),
        ("SELECT CASE WHEN EXISTS (SELECT 1 FROM facts WHERE id = 3) THEN (SELECT max(id) FROM facts) END AS x", 1),
        ("SELECT id FROM facts INTERSECT SELECT k FROM places", 3),
        ("WITH secret AS (SELECT 1 AS a) SELECT * FROM secret", 1),
        ("SELECT name FROM facts JOIN places USING (k) -- a comment", 20),
    ],
)
def test_queries_pass(views, text, n):
    assert guarded(views, text, TABLES).count() == n


@pytest.mark.parametrize(
    "text",
    [
        "",
        "-- nothing",
        "SELECT * FROM secret",
        "TABLE secret",
        "WITH x AS (SELECT * FROM secret) SELECT 1",
        "SELECT (SELECT max(id) FROM secret)",
        "SELECT * FROM facts WHERE id = (SELECT max(id) FROM secret)",
        "SELECT * FROM guarded_catalog_table",
        "SELECT * FROM spark_catalog.default.guarded_catalog_table",
        "SELECT * FROM parquet.`/any/path`",
        "SELECT * FROM csv.`/etc/passwd`",
        "SELECT * FROM identifier('secret')",
        "SELECT identifier('reflect')('java.lang.System', 'getProperty', 'user.home')",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT id FROM facts ORDER BY java_method('java.lang.System', 'getProperty', 'user.home')",
        "SELECT sum(id) OVER (ORDER BY reflect('java.lang.System', 'getProperty', 'user.home')) FROM facts",
        "SELECT transform(a, y -> reflect('java.lang.System', 'getProperty', 'user.home')) FROM facts",
        "SELECT of_a_user(id) FROM facts",
        "SELECT current_user",
        "SELECT input_file_name() FROM facts",
        "SELECT version()",
        "SELECT raise_error('x')",
        "SELECT * FROM range(10)",
        "SELECT TRANSFORM (id) USING 'cat' AS (x) FROM facts",
        "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 5) SELECT * FROM r",
        "SELECT 1) UNION ALL (SELECT 2",
        "SELECT 1; SELECT 2",
        "BEGIN SELECT 1; END",
        "EXECUTE IMMEDIATE 'SELECT * FROM secret'",
        "DROP TABLE guarded_catalog_table",
        "INSERT INTO guarded_catalog_table SELECT 1",
        "SET spark.sql.ansi.enabled = false",
        "SHOW TABLES",
        "DESCRIBE secret",
        "EXPLAIN SELECT 1",
        "CACHE TABLE facts",
        "SELECT * FROM facts WHERE :a = 1",
        "SELECT no_such_column FROM facts",
        "SELECT no_such_function(id) FROM facts",
    ],
)
def test_everything_else_is_refused(views, text):
    with pytest.raises(Refused):
        guarded(views, text, TABLES)
    assert views.table("guarded_catalog_table").count() == 1 and views.conf.get("spark.sql.ansi.enabled") == "true"
