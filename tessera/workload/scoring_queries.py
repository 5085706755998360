"""Scoring of recorded question-and-answer runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import scoring
from tessera.workload import roles
from tessera.workload.oracle import contains_any
from tessera.workload.registry import query


def _scores(spark, sf):
    return scoring.score_runs(roles.runs(spark, sf))


@query(
    "eval_scores",
    """SELECT id, difficulty, expected_route, route_taken, route_accuracy, tool_coverage, round(faithfulness, 6) AS faithfulness,
        round(tool_success, 6) AS tool_success FROM score""",
)
def eval_scores(spark, sf):
    return _scores(spark, sf).select(
        "id", "difficulty", "expected_route", "route_taken", "route_accuracy", "tool_coverage", "faithfulness", "tool_success"
    )


@query("numeric_grounding", "SELECT id, grounding::DOUBLE AS grounding FROM score")
def numeric_grounding(spark, sf):
    value = scoring.numeric_grounding(F.col("context"), F.col("answer"))
    return roles.runs(spark, sf).select("id", value.alias("grounding"))


@query("eval_filtered", "SELECT id, expected_route, route_accuracy FROM score WHERE difficulty = 2")
def eval_filtered(spark, sf):
    return scoring.chosen_runs(_scores(spark, sf), difficulty=2).select("id", "expected_route", "route_accuracy")


_MEANS_SQL = """count(*) AS n, round_even(avg(route_accuracy), 2) AS avg_route_accuracy, round_even(avg(tool_coverage), 2) AS avg_tool_coverage,
    round_even(avg(faithfulness) FILTER (faithfulness >= 0), 2) AS avg_faithfulness, round_even(avg(elapsed_seconds), 1) AS avg_elapsed_s"""


@query("eval_summary", f"SELECT {_MEANS_SQL} FROM score")
def eval_summary(spark, sf):
    return scoring.run_summary(_scores(spark, sf))


@query(
    "eval_breakdown",
    f"""SELECT 'route' AS kind, expected_route AS name, {_MEANS_SQL} FROM score GROUP BY 2
    UNION ALL SELECT 'difficulty', difficulty::VARCHAR, {_MEANS_SQL} FROM score GROUP BY 2""",
)
def eval_breakdown(spark, sf):
    scored = _scores(spark, sf).withColumn("difficulty", F.col("difficulty").cast("string"))
    parts = [
        scoring.run_breakdown(scored, column).withColumnRenamed(column, "name").withColumn("kind", F.lit(kind))
        for kind, column in (("route", "expected_route"), ("difficulty", "difficulty"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "scored_context",
    """SELECT id, md5(string_agg('[' || tool || ']' || chr(10) || result, chr(10) || chr(10) ORDER BY position)) AS context_md5
    FROM tool_result GROUP BY 1""",
)
def scored_context(spark, sf):
    """Labelled results of every question in call order."""
    made = scoring.scored_context(roles.tool_results(spark, sf))
    return made.select("id", F.md5("context").alias("context_md5"))


def _answer_sql() -> str:
    return f"""SELECT id, md5(string_agg('[' || tool || ']' || chr(10) || body, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY call)) AS context_md5
        FROM (SELECT id, call, tool, string_agg(CASE WHEN tool IN ('{scoring.REVIEW_TOOL}', '{scoring.CONTEXT_TOOL}') THEN document
                ELSE label || ': ' || round(amount, 2) END, chr(10) ORDER BY rank) AS body
              FROM tool_result WHERE error IS NULL GROUP BY 1, 2, 3)
        GROUP BY 1"""


@query("context_assembly", _answer_sql())
def context_assembly(spark, sf):
    """What an answer is written from: all rows of every tool that did not fail, whole texts."""
    made = scoring.answer_context(roles.tool_results(spark, sf))
    return made.select("id", F.md5("context").alias("context_md5"))


@query(
    "tool_summary",
    """SELECT row_number() OVER (ORDER BY season, borough) AS rank, '{"season":"' || season || '","borough":"' || borough || '","reviews":' || reviews || '}' AS piece
    FROM (SELECT season, borough, count(*) AS reviews FROM fact_review JOIN dim_date USING (date_id) JOIN dim_neighbourhood USING (neighbourhood_id)
          GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 15)""",
)
def tool_summary(spark, sf):
    """The rows of a warehouse answer that a reader is shown."""
    star = roles.star(spark, sf)
    result = (
        star["fact_review"]
        .groupBy("date_id", "neighbourhood_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(star["dim_date"].select("date_id", "season"), "date_id")
        .join(star["dim_neighbourhood"].select("neighbourhood_id", "borough"), "neighbourhood_id")
        .groupBy("season", "borough")
        .agg(F.sum("n").alias("reviews"))
    )
    return scoring.summarised_rows(result, scoring.WAREHOUSE_TOOL, [F.col("season"), F.col("borough")], 15)


_PLANS = ["warehouse", "geodata", "semantic", "geodata+warehouse", "warehouse+semantic", "other"]
_ASKED = [" occupancy by season", " food near me", " top rated venues in town, price and host", " what guests say"]


@query(
    "route_labels",
    f"""SELECT conv_id, turn, place AS mentions_place, stats AS mentions_warehouse,
        CASE WHEN place AND NOT stats AND plan NOT IN ('geodata', 'geodata+warehouse') THEN 'geodata'
            WHEN place AND stats THEN 'geodata+warehouse' ELSE plan END AS route
    FROM (SELECT conv_id, turn, {contains_any('asked', scoring.PLACE_WORDS + scoring.PLACE_PHRASES)} AS place,
            {contains_any('asked', scoring.WAREHOUSE_WORDS)} AS stats,
            CASE WHEN planned = 'other' THEN 'warehouse' ELSE planned END AS plan
        FROM (SELECT conv_id, turn, text || {_ASKED}[(conv_id % 4)::INT + 1] AS asked, {_PLANS}[(conv_id % 6)::INT + 1] AS planned
              FROM conversations))""",
)
def route_labels(spark, sf):
    """Planned routes corrected by the words of each turn."""
    def pick(values, n):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("conv_id") % n).cast("int") + 1)

    asked = roles.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat("text", pick(_ASKED, 4)).alias("question"), pick(_PLANS, 6).alias("planned")
    )
    return scoring.route_labels(asked, "question", "planned").drop("question", "planned")
